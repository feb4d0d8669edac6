"""Audits of keys, dates and copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import content_fingerprint


def conflicting_groups(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one different value (null is a value): ``n_values``. Distinct first, so it spills."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values")).filter("n_values > 1")


def conflicting_rows(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The rows of keys with more than one different value, whole. Null keys are equal. Only the keys in conflict are joined back."""
    bad = conflicting_groups(df, keys, value).select(*[F.col(k).alias(f"__{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(bad, cond, "left_semi")


def spanning_keys(df: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that stand in more than one group: ``n_groups``."""
    return df.filter(F.col(key).isNotNull()).select(key, group).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n_groups")).filter("n_groups > 1")


def parity(left: DataFrame, right: DataFrame, key: str, norm: Column | None = None) -> DataFrame:
    """Normalised keys that only one side holds: ``key``, ``side`` (missing: only left, orphaned: only right)."""
    k = (norm if norm is not None else F.col(key)).alias("key")
    both = left.select(k, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(k, F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy("key").agg(F.max("l").alias("l"), F.max("r").alias("r")).filter("l <> r").select("key", F.when(F.col("l") == 1, "missing").otherwise("orphaned").alias("side"))


def key_census(df: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Per group: ``n_rows``, ``n_first`` (different first keys, null not among them), ``n_tuples`` (different key tuples, nulls
    among them). Two aggregates over distinct tuples instead of distinct counts over rows."""
    t = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("c"))
    f = t.groupBy(*by, keys[0]).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("t"))
    return f.groupBy(*by).agg(F.sum("c").alias("n_rows"), F.count(keys[0]).alias("n_first"), F.sum("t").alias("n_tuples"))


def is_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_keys`` (nulls compared as equal), ``is_unique``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def duplicate_measures(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: ``n_rows``, ``n_keys``, ``n_key_values``."""
    v = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    k = v.groupBy(*keys).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"))
    return k.agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.sum("v").alias("n_key_values"))


def table_dates(df: DataFrame, by: str, date: str = "obs_date") -> DataFrame:
    """First and last date and rows with a date of every table."""
    return df.groupBy(by).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(date).alias("n_dates"))


def redundancy(sample: DataFrame, store: DataFrame, key: str, by: str) -> DataFrame:
    """Of each source's keys, the share that another store holds too: ``n_keys``, ``n_found``, ``verdict``."""
    k = sample.filter(F.col(key).isNotNull()).select(by, key).distinct()
    s = store.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().withColumn("__f", F.lit(1))
    a = k.join(s, key, "left").groupBy(by).agg(F.count(F.lit(1)).alias("n_keys"), F.count("__f").alias("n_found"))
    share = F.col("n_found") / F.col("n_keys")
    return a.withColumn("verdict", F.when(share >= 0.99, "REDUNDANT").when(share > 0, "MIXED").otherwise("NO KEY OVERLAP"))


def content_check(left: DataFrame, right: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Groups of two copies by fingerprint: ``verdict`` (same, different, only_left, only_right)."""
    fp = lambda d, n: d.groupBy(by).agg(content_fingerprint(cols).alias(n))
    j = fp(left, "a").withColumnRenamed(by, "ka").join(fp(right, "b").withColumnRenamed(by, "kb"), F.col("ka").eqNullSafe(F.col("kb")), "full")
    return j.select(F.coalesce("ka", "kb").alias(by), F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right").when(F.col("a") == F.col("b"), "same").otherwise("different").alias("verdict"))


def impossible_dates(df: DataFrame, by: str, date: str = "obs_date", horizon: str = "2200-01-01") -> DataFrame:
    """Dates beyond the horizon per source, reported and never dropped: ``n_impossible``, ``worst``."""
    bad = F.col(date) > F.lit(horizon).cast("date")
    return df.groupBy(by).agg(F.count_if(bad).alias("n_impossible"), F.max(F.when(bad, F.col(date))).alias("worst"))
