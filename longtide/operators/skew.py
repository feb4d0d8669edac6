"""Joins that hold when one key has a third of all rows.

A side is broadcast only after its size has been measured; otherwise the hot keys of the large side are found by a
map-side-combined count, its rows are spread over salts, and the small side's rows of those keys are repeated once
per salt."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of at most so many rows and bytes of text in its columns may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
#: A key with more than this share of a table's rows is hot; there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.005


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` was counted and stays under both bounds. Counting stops at ``rows`` + 1 rows."""
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    each = sum(text, F.lit(16 * len(df.columns)))
    n, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0))).first()
    return n <= rows and total <= size


def hot_keys(df: DataFrame, keys: list[str], total: int | None = None, share: float = HOT_SHARE) -> DataFrame:
    """The keys with more than ``share`` of the rows, with ``__splits``, the number of salts that brings each part
    under that share. At most 1 / share rows."""
    total = df.count() if total is None else total
    cut = max(1, math.floor(total * share))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > cut)
    return counted.select(*keys, F.ceil(F.col("__n") / cut).cast("int").alias("__splits"))


def spread(left: DataFrame, right: DataFrame, keys: list[str], share: float = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``__salt``. Left rows of hot keys get one of ``__splits`` salts by a hash of the
    whole row (the same again if the task runs again), right rows of those keys stand once under each. Equal rows
    of the left hash alike, so rows repeated many times should be counted first; a join on ``keys`` and ``__salt``
    then gives what one on ``keys`` gives. Null keys meet nothing in an equi-join and get salts of their own."""
    hot = F.broadcast(hot_keys(left.filter(_all_set(keys)), keys, share=share))
    splits = F.coalesce(F.col("__splits"), F.lit(1))
    atomic = [c for c, t in left.dtypes if not t.startswith("map") and "variant" not in t]
    h = F.xxhash64(*[F.col(c) for c in atomic], F.monotonically_increasing_id())
    out = left.join(hot, keys, "left").withColumn("__salt", F.pmod(h, F.when(_all_set(keys), splits).otherwise(F.lit(64)))).drop("__splits")
    many = right.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (splits - 1).cast("bigint")))).drop("__splits")
    return out, many


def _all_set(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
