"""Column functions against independent Python implementations."""

import random
import socket
from datetime import datetime, timezone
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.names import PROTOCOLS, SERVICES, protocol_name, service_name
from flowlake.functions.sizes import gigabytes, readable_size
from flowlake.functions.times import (
    bucket_end,
    day_of,
    days_before,
    flow_time,
    hour_of,
    partition_key,
    run_stamp,
)
from flowlake.operators.decode import decode_flows, with_address_text
from flowlake.schema import RAW


def values(spark, kind, items, column):
    frame = spark.createDataFrame([(item,) for item in items], f"v {kind}")
    return [row[0] for row in frame.select(column(F.col("v"))).collect()]


def packed_addresses(count=4000):
    """Addresses with every pattern of zero groups, plus embedded IPv4 ones."""
    draw = random.Random(7)
    result = [bytes(16), b"\xff" * 16, bytes(15) + b"\x01", b"\x00\x01" + bytes(14)]
    for _ in range(count):
        pattern = draw.randrange(256)
        groups = [
            0 if pattern >> bit & 1 else draw.choice([1, 15, 255, 4096, draw.randrange(65536)])
            for bit in range(8)
        ]
        result.append(b"".join(group.to_bytes(2, "big") for group in groups))
    for _ in range(200):
        tail = draw.randbytes(4)
        result += [bytes(10) + b"\xff\xff" + tail, bytes(12) + tail, bytes(8) + b"\xff\xff\0\0" + tail]
    return result + [bytes(10) + b"\xff\xff" + bytes(4)]


def test_ipv6_text_equals_inet_ntop(spark):
    packed = packed_addresses()
    frame = spark.createDataFrame([(bytearray(p), bytearray(p)) for p in packed], "a binary, k binary")
    rows = with_address_text(frame, F.lit(34525), "a").collect()
    assert [r["a"] for r in rows] == [socket.inet_ntop(socket.AF_INET6, bytes(r["k"])) for r in rows]
    assert len(rows) == len(packed)


def test_ipv4_text_and_unknown_family(spark):
    packed = packed_addresses(300)
    frame = spark.createDataFrame(
        [(bytearray(p), family, bytearray(p)) for p in packed for family in (2048, 2054, None)],
        "a binary, family int, k binary",
    )
    for row in with_address_text(frame, F.col("family"), "a").collect():
        first_four = socket.inet_ntop(socket.AF_INET, bytes(row["k"][:4]))
        assert row["a"] == (first_four if row["family"] == 2048 else "unknown")


def test_short_and_missing_addresses(spark):
    frame = spark.createDataFrame(
        [
            (2048, bytearray(b"\x0a\x00\x00\x01")),
            (2048, bytearray(b"\x0a")),
            (34525, bytearray(b"\x20\x01\x0d\xb8")),
            (2048, None),
            (34525, None),
            (1, None),
        ],
        "family int, a binary",
    )
    got = [r["a"] for r in with_address_text(frame, F.col("family"), "a").collect()]
    assert got == ["10.0.0.1", "10.0.0.0", "2001:db8::", None, None, "unknown"]


def raw_row(**given):
    defaults = dict.fromkeys(RAW.names)
    return tuple({**defaults, **given}.values())


def test_mac_text(spark):
    macs = {
        0: None,
        None: None,
        1: "00:00:00:00:00:01",
        0x0A1B2C3D4E5F: "0A:1B:2C:3D:4E:5F",
        0xFFFFFFFFFFFF: "FF:FF:FF:FF:FF:FF",
        # Beyond 48 bits the topmost byte is the leading octet.
        0x1FF0203040506: "01:02:03:04:05:06",
        0x12FF0203040506: "12:02:03:04:05:06",
        0x7F12FF0203040506: "7F:02:03:04:05:06",
    }
    raw = spark.createDataFrame([raw_row(src_mac=m, dst_mac=m) for m in macs], RAW)
    for row, text in zip(decode_flows(raw).collect(), macs.values(), strict=True):
        assert row["src_mac"] == row["dst_mac"] == text


def test_sampler_is_ipv4_whatever_the_family(spark):
    sampler = bytearray(b"\xc0\xa8\x00\x01" + bytes(12))
    raw = spark.createDataFrame(
        [raw_row(sampler_address=sampler, etype=e) for e in (2048, 34525, 5)] + [raw_row()], RAW
    )
    got = [r["sampler_address"] for r in decode_flows(raw).collect()]
    assert got == ["192.168.0.1"] * 3 + [None]


def test_flow_time_rounds_double_seconds_half_even(spark):
    draw = random.Random(3)
    nanos = [draw.randrange(0, 2 * 10**18) for _ in range(5000)] + [0, 500, 1500, 2500, 999, None]

    def expected(ns):
        if ns is None:
            return None
        micros = Decimal(ns / 1e9 * 1e6).quantize(Decimal(1), ROUND_HALF_EVEN)
        return int(micros)

    got = values(spark, "long", nanos, lambda c: F.unix_micros(flow_time(c)))
    assert got == [expected(ns) for ns in nanos]


def test_buckets_and_stamps(spark):
    moment = datetime(2024, 2, 29, 23, 59, 58, 123456)
    frame = spark.createDataFrame([(moment,)], "t timestamp_ntz").select(F.col("t").cast("timestamp"))
    t = F.col("t")
    row = frame.select(
        hour_of(t), day_of(t), bucket_end(hour_of(t)), partition_key(t), run_stamp(t),
        days_before(F.lit(moment.date()), 7),
    ).first()
    assert tuple(row) == (
        datetime(2024, 2, 29, 23),
        datetime(2024, 2, 29),
        datetime(2024, 3, 1),
        "20240229",
        "20240229_235958",
        datetime(2024, 2, 22),
    )


def test_readable_size(spark):
    sizes = {
        None: None,
        0: "0.00 B",
        1: "1.00 B",
        1023: "1023.00 B",
        1024: "1.00 KiB",
        1152: "1.13 KiB",  # 1.125, halves go up
        1048575: "1024.00 KiB",
        1048576: "1.00 MiB",
        192851925: "183.92 MiB",
        2**62: "4.00 EiB",
    }
    assert values(spark, "long", list(sizes), readable_size) == list(sizes.values())
    draw = random.Random(5)
    plain = [draw.randrange(1024, 1024**2) for _ in range(2000)]
    two = Decimal("0.01")
    assert values(spark, "long", plain, readable_size) == [
        f"{(Decimal(n) / 1024).quantize(two, ROUND_HALF_UP)} KiB" for n in plain
    ]


def test_gigabytes_equals_three_divisions(spark):
    sizes = [random.Random(9).randrange(2**53) for _ in range(1000)]
    assert values(spark, "long", sizes, gigabytes) == [n / 1024.0 / 1024.0 / 1024.0 for n in sizes]


def test_names(spark):
    assert len(SERVICES) == 35 and len(PROTOCOLS) == 14
    assert values(spark, "int", [22, 443, 50000, None], service_name) == ["SSH", "HTTPS", "50000", None]
    assert values(spark, "int", [6, 17, 99, None], protocol_name) == ["TCP", "UDP", "PROTO-99", "PROTO-"]


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "UTC"])
def test_buckets_follow_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamp = datetime(2024, 1, 1, 20, 10, tzinfo=timezone.utc)
        frame = spark.createDataFrame([(int(stamp.timestamp()) * 10**9,)], "ns long")
        day = frame.select(F.date_format(day_of(flow_time(F.col("ns"))), "yyyy-MM-dd")).first()[0]
        assert day == ("2024-01-02" if zone == "Asia/Kolkata" else "2024-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_types_of_decoded_columns(spark):
    decoded = decode_flows(spark.createDataFrame([], RAW))
    assert isinstance(decoded.schema["src_addr"].dataType, T.StringType)
    assert decoded.count() == 0
