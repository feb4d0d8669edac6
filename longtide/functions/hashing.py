"""Fingerprints of values and rows that keep nulls apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_aware(cols: list[str | Column]) -> list[Column]:
    """Two arguments per column for hash functions that skip nulls: is it null, and its text."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [x for c in cs for x in (c.isNull(), F.coalesce(c.cast("string"), F.lit("")))]


def row_hash64(cols: list[str | Column]) -> Column:
    """64-bit hash of a row in which a null is no gap: (a, null, b) differs from (a, b, null)."""
    return F.xxhash64(*null_aware(cols))


def content_fingerprint(cols: list[str]) -> Column:
    """Aggregate: a fingerprint of a bag of rows, the same in any order. A sum, so that pairs of equal rows do not
    cancel; wide enough not to overflow."""
    return F.sum(row_hash64(cols).cast("decimal(38,0)"))


def portable_fingerprint(cols: list[str]) -> Column:
    """The same kind of fingerprint from MD5, which any engine can compute: the sum of the first 60 bits of the digests of
    ``=value`` or ``~`` (null), each followed by a unit separator."""
    text = F.concat(*[x for c in cols for x in (F.when(F.col(c).isNull(), "~").otherwise(F.concat(F.lit("="), F.col(c).cast("string"))), F.lit("\x1f"))])
    return F.sum(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)"))


def exact_token(values: list[str], kinds: dict[str, str]) -> Column:
    """A column that tells values apart in null-safe comparisons between neighbours. One number, date or truth value is its own
    exact hash (null equals null, NaN equals NaN, zeros are equal) and packs better than a scrambled one; one text or other value
    is a 64-bit hash, null for null; several values are a hash of all with their null marks."""
    if len(values) == 1:
        v = F.col(values[0])
        if kinds[values[0]] in ("double", "float", "bigint", "int", "smallint", "tinyint", "date", "boolean", "timestamp", "timestamp_ntz"):
            return v
        return F.when(v.isNotNull(), F.xxhash64(v))
    return row_hash64(list(values))
