"""Column functions over byte strings, timestamps and cell sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellarium.model import LATEST

MICROS_CLAMP = LATEST - LATEST % 1000
MILLIS_CEILING = LATEST // 1000
PUT_CELL_OVERHEAD = 20
STORED_CELL_OVERHEAD = 24


def successor(prefix: bytes) -> bytes | None:
    """Smallest key above every key with this prefix; None means no upper bound."""
    head = prefix.rstrip(b"\xff")
    return head[:-1] + bytes([head[-1] + 1]) if head else None


def successor_of(prefix: Column) -> Column:
    """Column form of :func:`successor`; NULL where there is no upper bound.

    The trailing-FF pattern is anchored on whole bytes, so a byte such as 0xAF
    before the run is left alone.
    """
    head = F.regexp_extract(F.hex(prefix), "^((?:[0-9A-F]{2})*?)(?:FF)*$", 1)
    size = F.length(head)
    last = F.conv(head.substr(size - 1, F.lit(2)), 16, 10).cast("int")
    bumped = F.concat(head.substr(F.lit(1), size - 2), F.lpad(F.hex(last + 1), 2, "0"))
    return F.when(size > 0, F.unhex(bumped))


def next_key(key: Column) -> Column:
    """The key directly after ``key``."""
    return F.concat(key, F.lit(b"\x00"))


def to_micros(ts: Column) -> Column:
    """Milliseconds to microseconds; what would overflow takes the clamp value."""
    return F.when(ts < MILLIS_CEILING, F.least(ts, F.lit(MILLIS_CEILING - 1)) * 1000).otherwise(
        F.lit(MICROS_CLAMP)
    )


def to_millis(ts: Column) -> Column:
    return F.when(ts >= MICROS_CLAMP, F.lit(LATEST)).otherwise(F.floor(ts / 1000).cast("bigint"))


def long_to_bytes(value: Column) -> Column:
    """8 bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def bytes_to_long(value: Column) -> Column:
    return F.conv(F.hex(value), 16, -10).cast("bigint")


def found(subject: Column, pattern: str) -> Column:
    """Regex found anywhere in the bytes; an empty pattern matches only empty bytes.

    Latin-1 gives one character per byte, so a pattern sees bytes.
    """
    if pattern == "":
        return F.length(subject) == 0
    return F.decode(subject, "ISO-8859-1").rlike("(?s)" + pattern)


def put_cell_size() -> Column:
    return _cell_bytes() + PUT_CELL_OVERHEAD


def stored_cell_size() -> Column:
    return _cell_bytes() + STORED_CELL_OVERHEAD


def _cell_bytes() -> Column:
    return (
        F.octet_length("row").cast("bigint")
        + F.octet_length("family")
        + F.octet_length("qualifier")
        + F.octet_length("value")
    )


def short_hex(value: Column, longest: int = 32) -> Column:
    """Hex text for reports; the middle of a long value is elided."""
    side = longest // 2
    shown = F.hex(value)
    return F.when(
        F.octet_length(value) > longest,
        F.concat(F.left(shown, F.lit(2 * side)), F.lit("..."), F.right(shown, F.lit(2 * side))),
    ).otherwise(shown)


def in_time_range(ts: Column, start: int | None, stop: int | None) -> Column:
    """Start inclusive, stop exclusive; None or the latest timestamp is unbounded."""
    test = F.lit(True)
    if start is not None and start > 0:
        test = test & (ts >= start)
    if stop is not None and stop != LATEST:
        test = test & (ts < stop)
    return test


def cell_md5() -> Column:
    """md5 of one cell; every byte field is in hex, so no two cells give one text."""
    return F.md5(
        F.concat_ws(
            "|",
            F.hex("row"),
            F.hex(F.col("family").cast("binary")),
            F.hex("qualifier"),
            F.col("ts").cast("string"),
            F.hex("value"),
        )
    )


def md5_lanes() -> list[Column]:
    """Two 60-bit numbers from the md5 of a cell, to be combined by XOR."""
    return [
        F.conv(F.substring(cell_md5(), start, 15), 16, 10).cast("bigint") for start in (1, 17)
    ]


def fast_lanes() -> list[Column]:
    """Two 64-bit numbers of a cell for comparisons inside one job."""
    fields = ["row", "family", "qualifier", "ts", "value"]
    return [F.xxhash64(*fields), F.xxhash64(F.lit("second lane"), *fields)]


def hash_share(key: Column, share: float, seed: str = "") -> Column:
    """True for about ``share`` of the keys; the same key always answers the same."""
    head = F.substring(F.md5(F.concat(key, F.lit(seed.encode("utf-8")))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") < int(share * 2**32)
