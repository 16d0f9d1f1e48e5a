"""Byte counts as larger units and as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary unit names.
UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]


def gigabytes(size: Column) -> Column:
    """Bytes / 2**30 as a double.

    Dividing by a power of two is exact, so one division equals a chain of
    three, and the total of a group can be scaled after an exact integer sum.
    """
    return size.cast("double") / F.lit(float(2**30))


def megabytes(size: Column) -> Column:
    return size.cast("double") / F.lit(float(2**20))


def readable_size(size: Column) -> Column:
    """Text such as ``1.50 KiB``: two decimals, halves up, null for null."""
    text = None
    for power, unit in enumerate(UNITS):
        value = size.cast("double") / F.lit(float(1024**power))
        label = F.format_string(f"%.2f {unit}", value)
        below = size < F.lit(1024 ** (power + 1)) if unit != UNITS[-1] else size.isNotNull()
        text = F.when(below, label) if text is None else text.when(below, label)
    return text
