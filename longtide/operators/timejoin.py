"""Joins on spans of time instead of equal labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import GrainRefusal

# Months or days of one unit of a grain.
GRAINS = {"daily": (0, 1), "weekly": (0, 7), "monthly": (1, 0), "quarterly": (3, 0), "semiannual": (6, 0), "annual": (12, 0)}


def _shift(date: Column, grain: str, sign: int) -> Column:
    months, days = GRAINS[grain]
    return F.add_months(date, sign * months) if months else F.date_add(date, sign * days)


def check_grain(*grains: str) -> None:
    """Refuse grains that have no computable span."""
    for g in grains:
        if g not in GRAINS:
            raise GrainRefusal(f"grain {g!r} has no span")


def span(label: Column, grain: str, stamp: str) -> Column:
    """Half-open span of a row: struct ``start``, ``end``. ``stamp``: date (daily only), start (the label is the first day)
    or end (the label is the last day, included)."""
    check_grain(grain)
    if stamp == "end":
        end = F.date_add(label, 1)
        return F.struct(_shift(end, grain, -1).alias("start"), end.alias("end"))
    if stamp == "start" or (stamp == "date" and grain == "daily"):
        return F.struct(label.alias("start"), _shift(label, grain, 1).alias("end"))
    raise GrainRefusal(f"stamp {stamp!r} of grain {grain!r} has no span")


def truncated(date: Column, grain: str) -> Column:
    """First day of the calendar period that holds a day."""
    unit = {"weekly": "WEEK", "monthly": "MONTH", "quarterly": "QUARTER", "annual": "YEAR"}
    if grain == "daily":
        return date
    if grain == "semiannual":
        return F.make_date(F.year(date), F.when(F.month(date) <= 6, 1).otherwise(7), F.lit(1))
    return F.trunc(date, unit[grain])


def same_period(left: DataFrame, right: DataFrame, *, left_grain: str, left_stamp: str, right_grain: str, right_stamp: str, left_date: str = "obs_date", right_date: str = "obs_date", on: list[str] = (), value: str = "value", out: str = "period_value") -> DataFrame:
    """Beside each left row, the coarser right value whose span contains the row's span (look-ahead: the value may have become
    known later). Calendar grains nest, so the join is an equi-join on the first day of the right period. Refused when the
    right side is finer. Of several right rows of a period, the greatest value stands."""
    check_grain(left_grain, right_grain)
    order = list(GRAINS)
    if order.index(right_grain) < order.index(left_grain):
        raise GrainRefusal("the attached side must not be finer than the rows")
    r = right.select(*on, span(F.col(right_date), right_grain, right_stamp)["start"].alias("__p"), F.col(value).alias(out)).groupBy(*on, "__p").agg(F.max(out).alias(out))
    ls = span(F.col(left_date), left_grain, left_stamp)
    l = left.withColumn("__p", F.when(ls["end"] <= _shift(truncated(ls["start"], right_grain), right_grain, 1), truncated(ls["start"], right_grain)))
    return l.join(r, [*on, "__p"], "left").drop("__p")


def containing_period(left: DataFrame, right: DataFrame, *, left_grain: str, left_stamp: str, right_grain: str, right_stamp: str, left_date: str = "obs_date", right_date: str = "obs_date", on: list[str] = (), value: str = "value", out: str = "period_value") -> DataFrame:
    """``same_period`` for calendars that do not nest: the right value whose own span, wherever it begins, contains the row's whole span; null
    where a row crosses the border of two. No range join: a right row stands once in every month that its span touches (at most 13), a left row
    in the month of its first day. Of several right rows that contain it, the greatest value stands."""
    check_grain(left_grain, right_grain)
    if list(GRAINS).index(right_grain) < list(GRAINS).index(left_grain):
        raise GrainRefusal("the attached side must not be finer than the rows")
    rs, ls = span(F.col(right_date), right_grain, right_stamp), span(F.col(left_date), left_grain, left_stamp)
    r = right.select(*[F.col(c).alias(f"__{c}") for c in on], rs["start"].alias("__a"), rs["end"].alias("__z"), F.col(value).alias(out)).filter(F.col("__a").isNotNull())
    r = r.groupBy(*[f"__{c}" for c in on], "__a", "__z").agg(F.max(out).alias(out))
    r = r.withColumn("__m", F.explode(F.sequence(F.trunc("__a", "MONTH"), F.trunc(F.date_sub("__z", 1), "MONTH"), F.expr("INTERVAL 1 MONTH"))))
    l = left.withColumn("__s", ls["start"]).withColumn("__e", ls["end"]).withColumn("__id", F.monotonically_increasing_id())
    cond = (F.trunc("__s", "MONTH") == F.col("__m")) & (F.col("__a") <= F.col("__s")) & (F.col("__e") <= F.col("__z"))
    for c in on:
        cond = cond & (F.col(c) == F.col(f"__{c}"))
    hits = l.join(r, cond).groupBy("__id").agg(F.max(out).alias(out)) if right_stamp == "end" and right_grain != "daily" else None
    if hits is None:  # spans of one start do not overlap: at most one contains a row
        return l.join(r, cond, "left").select(*left.columns, out)
    return l.join(hits, "__id", "left").select(*left.columns, out)


def last_known(rows: DataFrame, values: DataFrame, *, on: list[str], row_at: str, known_at: str, order: list[str], value: str = "value", out: str = "known_value", bucket: str = "month") -> DataFrame:
    """Beside each row, the value of its series with the latest availability at or before the row's start; among several of
    one instant, the last by ``order``. Both ``on`` and ``row_at`` must be set for a row to get a value.

    No range join: rows and values meet in one window per series and calendar ``bucket``, so that a series with a third of
    all rows is still many tasks; what a bucket inherits from those before it comes from one row per bucket."""
    cols = [c for c in rows.columns if c not in on]
    os_ = [f"__o{i}" for i in range(len(order))]
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    l = rows.select(*on, F.col(row_at).cast("timestamp").alias("__t"), F.lit(1).alias("__side"), none(values, value).alias("__v"), F.struct(*cols).alias("__row"), *[none(values, o).alias(n) for o, n in zip(order, os_, strict=True)])
    r = values.filter(F.col(known_at).isNotNull()).select(*on, F.col(known_at).cast("timestamp").alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"), F.lit(None).cast(l.schema["__row"].dataType).alias("__row"), *[F.col(o).alias(n) for o, n in zip(order, os_, strict=True)])
    both = l.unionByName(r).withColumn("__b", F.date_trunc(bucket, "__t"))
    w = Window.partitionBy(*on, "__b").orderBy("__t", "__side", *os_).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("__known", F.last(F.when(F.col("__side") == 0, F.struct("__v")), ignorenulls=True).over(w)).filter("__side = 1")
    set_ = F.lit(True)
    for k in on:
        set_ = set_ & F.col(k).isNotNull()
    per = both.filter(set_ & F.col("__b").isNotNull()).groupBy(*on, "__b").agg(F.max(F.when(F.col("__side") == 0, F.struct("__t", *os_, "__v"))).alias("__x"))
    past = Window.partitionBy(*on).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*on, "__b", F.last("__x", ignorenulls=True).over(past).alias("__c"))
    j = here.join(carry, [*on, "__b"], "left")
    known = F.when(F.col("__known").isNotNull(), F.col("__known.__v")).otherwise(F.col("__c.__v"))
    return j.select(*on, "__row.*", F.when(set_ & F.col("__t").isNotNull(), known).alias(out))


def last_complete(rows: DataFrame, *, by: str, start: str, last_day: str, through: str) -> DataFrame:
    """Of each ticker, whether the last row that starts by ``through`` is complete: ``complete`` is true, false, or null where
    ``through`` is null. A ticker without such a row does not appear."""
    r = rows.filter(F.col(through).isNull() | (F.col(start) <= F.col(through)))
    return r.groupBy(by).agg(F.max_by(F.struct(F.col(last_day).alias("d"), F.col(through).alias("t")), F.col(start)).alias("x")).select(by, (F.col("x.d") <= F.col("x.t")).alias("complete"))
