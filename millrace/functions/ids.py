"""Deterministic identifiers, hashes and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash(*parts: Column, length: int = 12) -> Column:
    """The first hex digits of the SHA-1 of the parts, joined by bars; null parts are left out."""
    return F.substring(F.sha1(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, length)


def unit_hash(salt: str, key: Column) -> Column:
    """A place in [0, 1): 48 bits of the SHA-1 of salt and key."""
    return F.conv(F.substring(F.sha1(F.concat(F.lit(f"{salt}|"), key.cast("string"))), 1, 12), 16, 10).cast("bigint") / F.lit(float(16**12))


def numbered(prefix: str, number: Column, width: int = 3) -> Column:
    """Like seq_001; a longer number keeps its digits."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", number.cast("bigint")))


def bits(hex16: Column) -> Column:
    """A 16-digit hex fingerprint as a signed 64-bit number."""
    upper, lower = (F.conv(F.substring(hex16, k, 8), 16, 10).cast("bigint") for k in (1, 9))
    return F.shiftleft(upper, 32).bitwiseOR(lower)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hex fingerprints; 64 if one is missing or the lengths differ."""
    return F.when(a.isNull() | b.isNull() | (F.length(a) != 16) | (F.length(b) != 16), F.lit(64)).otherwise(F.bit_count(bits(a).bitwiseXOR(bits(b))))


def content_hash(*columns: Column) -> Column:
    """SHA-256 of the columns as JSON; callers pass them in sorted order."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def sign_bits(vector: Column) -> Column:
    """The signs of a vector's first 64 values as a signed 64-bit number: 1 for positive."""
    return F.aggregate(F.transform(F.slice(vector, 1, 64), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
