"""Raw collector rows to the export layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions import addresses as A
from flowlake.schema import DECODED


def _or(value: Column, default: int | str) -> Column:
    return F.coalesce(value, F.lit(default))


class _Steps:
    """Columns to compute in three consecutive projections."""

    def __init__(self) -> None:
        self.first: dict[str, Column] = {}
        self.second: dict[str, Column] = {}
        self.third: dict[str, Column] = {}

    def ip_address(self, name: str, family: Column) -> None:
        """IPv4 rows show the first four bytes, IPv6 rows all, others ``unknown``."""
        is_v4, is_v6 = family.eqNullSafe(A.ETYPE_IPV4), family.eqNullSafe(A.ETYPE_IPV6)
        address = F.col(name)
        high, low, plain, run = (f"_{name}_{part}" for part in ("high", "low", "plain", "run"))
        words = F.col(high), F.col(low)
        self.first[high] = _or(F.when(is_v4 | is_v6, A.address_word(address, 0)), 0)
        self.first[low] = _or(F.when(is_v6, A.address_word(address, 1)), 0)
        self.second[plain] = (
            F.when(is_v4, A.ipv4_text(F.col(high)))
            .when(is_v6, A.ipv6_groups(*words))
            .otherwise(F.lit("unknown"))
        )
        self.second[run] = _or(F.when(is_v6, A.zero_run(*words)), 0)
        self.third[name] = F.when(
            address.isNotNull() | ~(is_v4 | is_v6),
            A.ipv6_text(F.col(low), F.col(plain), F.col(run)),
        )

    def ipv4_address(self, name: str) -> None:
        high = f"_{name}_high"
        self.first[high] = _or(A.address_word(F.col(name), 0), 0)
        self.second[name] = F.when(F.col(name).isNotNull(), A.ipv4_text(F.col(high)))

    def mac(self, name: str) -> None:
        digits = f"_{name}_digits"
        self.first[digits] = _or(A.mac_digits(F.col(name)), "")
        self.second[name] = A.mac_text(F.col(name), F.col(digits))

    def apply(self, df: DataFrame) -> DataFrame:
        for step in (self.first, self.second, self.third):
            df = df.withColumns(step) if step else df
        return df


def with_address_text(df: DataFrame, family: Column, *names: str) -> DataFrame:
    """Replace packed IP address columns by text according to ``family`` (etype)."""
    steps = _Steps()
    for name in names:
        steps.ip_address(name, family)
    return steps.apply(df).select(*df.columns)


def decode_flows(raw: DataFrame) -> DataFrame:
    """Text MACs and addresses, all other columns passed through.

    One code-generated stage without a shuffle; a column nobody reads is pruned
    together with its steps.  The sampler is an IPv4 device whatever the family
    of the flow.
    """
    steps = _Steps()
    for name in ("src_addr", "dst_addr"):
        steps.ip_address(name, F.col("etype"))
    steps.ipv4_address("sampler_address")
    for name in ("src_mac", "dst_mac"):
        steps.mac(name)
    return steps.apply(raw).select(*DECODED.names)
