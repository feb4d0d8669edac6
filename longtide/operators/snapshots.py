"""What changed between full snapshots (problem 3).

Every key is windowed by snapshot index: a lag of the value hash reveals changes, a gap in the index reveals a removal
and a later addition. Two exchanges: one that keeps, with map-side combine, the valid row of each key and snapshot, and
one that brings the at most one row per snapshot of a key together, so no key is larger than the number of snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import spelled_day
from ..functions.hashing import exact_token


def latest_rows(deliveries: DataFrame, keys: list[str], snapshot: str, order: str, values: list[str]) -> DataFrame:
    """One row per key and snapshot, the one with the highest ``order``. Repeated rows, a third of the table under
    one key too, are combined before the exchange. Rows without an ``order`` lose against any with one."""
    token = exact_token(values, dict(deliveries.dtypes))
    rank = F.coalesce(F.col(order).cast("bigint"), F.lit(-(2**63)))
    return deliveries.groupBy(*keys, snapshot).agg(F.max_by(token, rank).alias("token"))


def snapshot_changes(
    deliveries: DataFrame, keys: list[str], *, snapshot: str = "snapshot_no", order: str = "row_no", values: list[str] = ("value",), snapshots: DataFrame | None = None,
) -> DataFrame:
    """Additions, removals and changes between consecutive snapshots.

    ``deliveries`` holds whole snapshots, numbered by ``snapshot``; ``order`` decides between rows of one key within
    a snapshot. Returns ``snapshot`` (the later one of the pair), ``keys`` and ``change``, one row each.
    Consecutive means consecutive among the numbers in ``snapshots`` (default: the numbers that occur), so a number
    that was never delivered is no removal of everything. Null equals null, NaN equals NaN, zeros are equal. Rows with
    a null key or snapshot number are left out. An empty table gives no rows; extra columns are ignored."""
    keys, values = list(keys), list(values)
    known = deliveries.filter(F.col(snapshot).isNotNull())
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    numbers = (known if snapshots is None else snapshots.filter(F.col(snapshot).isNotNull())).select(F.col(snapshot).cast("bigint").alias("no")).distinct()
    listed = [r[0] for r in numbers.orderBy("no").collect()]  # one number per delivery, not per row
    if len(listed) < 2:
        return known.select(F.col(snapshot).cast("bigint").alias(snapshot), *keys, F.lit("").alias("change")).limit(0)
    arr = F.array(*[F.lit(n).cast("bigint") for n in listed])
    one = latest_rows(known.select(*keys, F.array_position(arr, F.col(snapshot).cast("bigint")).cast("int").alias("ix"), order, *values), keys, "ix", order, values)
    w = Window.partitionBy(*keys).orderBy("ix")
    seen = one.select(*keys, "ix", F.lag("token").over(w).alias("was"), F.lag("ix").over(w).alias("before"), F.lead("ix").over(w).alias("after"), "token")
    same = F.col("was").eqNullSafe(F.col("token"))
    first, gap = F.col("before").isNull(), F.col("before") < F.col("ix") - 1
    arrived: Column = F.when((first & (F.col("ix") > 1)) | gap, "added").when(~first & ~gap & ~same, "changed")
    left: Column = F.when((F.col("after").isNull() & (F.col("ix") < len(listed))) | (F.col("after") > F.col("ix") + 1), "removed")
    events = F.array(F.struct(F.col("ix").alias("at"), arrived.alias("change")), F.struct((F.col("ix") + 1).alias("at"), left.alias("change")))
    return (
        seen.filter(arrived.isNotNull() | left.isNotNull())
        .select(*keys, F.explode(F.filter(events, lambda e: e["change"].isNotNull())).alias("e"))
        .select(F.element_at(arr, F.col("e.at")).alias(snapshot), *keys, F.col("e.change").alias("change"))
    )


def observation_changes(deliveries: DataFrame, **columns: str) -> DataFrame:
    """``snapshot_changes`` of a store of observations: the key is ``series_key`` and the calendar day that ``obs_date``
    names, however it is spelled; rows without a full, valid day are left out."""
    days = deliveries.select("snapshot_no", "series_key", F.unix_date(spelled_day(F.col("obs_date"))).alias("obs_day"), "value", "row_no")
    out = snapshot_changes(days, ["series_key", "obs_day"], snapshots=deliveries.select("snapshot_no"))
    return out.select("snapshot_no", "series_key", F.date_format(F.date_from_unix_date("obs_day"), "yyyy-MM-dd").alias("obs_day"), "change")
