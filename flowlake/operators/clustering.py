"""Rows that are alike in several columns, laid side by side.

Sorted by time alone, every file holds every address, and a filter on one address
reads them all.  Along a Z-order curve a file spans a small part of each column, so
its footer lets a filter on any of them skip most files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_BITS = 10  # of each column: a thousand slots
_SLOTS = 1 << SLOT_BITS
_DAY = 86_400_000_000_000

# Characters of an address as text, in byte order.
_ADDRESS = ".0123456789:abcdef"
# The most characters whose order fits a long, an IPv4 address whole.
_LEADING = 15


def address_order(address: Column) -> Column:
    """A long in the order of the text of addresses, by which footers know them.

    It tells apart texts that differ in the first 15 characters.  Any other text comes
    after all addresses, null before them."""
    base = len(_ADDRESS)
    digits = F.translate(F.rpad(address, _LEADING, "."), _ADDRESS, "0123456789abcdefgh"[:base])
    number = F.conv(digits, base, 10).cast("bigint")
    return F.when(address.isNull(), -1).when(address.rlike("^[.0-9:a-f]+$"), number).otherwise(base**_LEADING)


def slot_bounds(df: DataFrame, *values: Column) -> tuple[int, list[list[int]]]:
    """Number of rows, and of each of ``values`` the bounds of slots that hold about
    equally many rows.  Sketches merged between tasks; the driver sees a thousand
    numbers for each, whatever the size.  A hot value fills several slots alone."""
    parts = F.array(*[F.lit(i / _SLOTS) for i in range(1, _SLOTS)])
    bounds = [F.percentile_approx(value, parts, 4 * _SLOTS).alias(f"b{i}") for i, value in enumerate(values)]
    rows, *found = df.agg(F.count(F.lit(1)), *bounds).first()
    return rows, [list(b or []) for b in found]


def slot_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at or below ``value``, by halving."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))])
    # As element of an array ``value`` is worked out once, not at every step.
    slots = F.transform(
        F.array(value),
        lambda known: F.aggregate(
            steps,
            F.lit(0),
            # A step beyond the last bound finds null and is not taken.
            lambda at, step: F.when(F.get(table, at + step - 1) <= known, at + step).otherwise(at),
        ),
    )
    return F.get(slots, F.lit(0))


def time_slot(nanos: Column) -> Column:
    """Slot of the time of day, all slots equally long."""
    return F.floor(F.pmod(nanos, F.lit(_DAY)) * _SLOTS / _DAY).cast("int")


def interleaved(*slots: Column) -> Column:
    """Place on the Z-order curve: the bits of ``slots`` in turn, highest first."""
    bits = [
        F.shiftleft(F.shiftright(slot, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(slots) + turn)
        for bit in range(SLOT_BITS)
        for turn, slot in enumerate(slots)
    ]
    return reduce(Column.bitwiseOR, bits)


def with_place(df: DataFrame, name: str, nanos: str, *addresses: str) -> tuple[DataFrame, int]:
    """``df`` with ``name``, its place on a curve through the time of day and
    ``addresses``, and the number of its rows.  Nulls come first."""
    orders = [address_order(F.col(address)) for address in addresses]
    rows, bounds = slot_bounds(df, *orders)
    slots = [F.coalesce(time_slot(F.col(nanos)), F.lit(0))] + [slot_of(o, b) for o, b in zip(orders, bounds)]
    names = [f"{name}{i}" for i in range(len(slots))]
    # A projection of their own: each slot is mentioned once a bit.
    found = df.withColumns(dict(zip(names, slots)))
    return found.withColumn(name, interleaved(*map(F.col, names))).drop(*names), rows
