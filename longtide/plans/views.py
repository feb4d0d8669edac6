"""Views over the test tables in the shapes that the operators work on, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import spelled_day
from ..session import table

# The day named by a spelled obs_date, as SQL.
_DAY = r"""coalesce(
    CASE WHEN regexp_matches(trim(obs_date), '^\d{4}-\d{2}-\d{2}([Tt ].*)?$') THEN try_cast(substr(trim(obs_date), 1, 10) AS DATE) END,
    CASE WHEN regexp_matches(trim(obs_date), '^\d{8}([Tt ].*)?$') THEN try_cast(substr(trim(obs_date), 1, 4) || '-' || substr(trim(obs_date), 5, 2) || '-' || substr(trim(obs_date), 7, 2) AS DATE) END)"""


def line_obs(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as observations: ``series_key`` LI:flag:status:supplier, ``obs_date``, ``value``, ``row_no``."""
    t = table(spark, d, "lineitem")
    key = F.concat_ws(":", F.lit("LI"), "l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string"))
    return t.select(key.alias("series_key"), F.to_date("l_shipdate").alias("obs_date"), F.col("l_extendedprice").alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"))


LINE_OBS = "(SELECT concat_ws(':', 'LI', l_returnflag, l_linestatus, CAST(l_suppkey AS VARCHAR)) AS series_key, CAST(l_shipdate AS DATE) AS obs_date, l_extendedprice AS value, l_orderkey * 10 + l_linenumber AS row_no FROM lineitem)"


def delivery(spark: SparkSession, d: str, number: int) -> DataFrame:
    """One full delivery of the store; nulls, NaN, repeated rows and unreadable days included."""
    t = table(spark, d, "obs_snapshots").filter(F.col("snapshot_no") == number)
    return t.select("source_id", "series_key", spelled_day(F.col("obs_date")).alias("obs_date"), "value", "row_no")


def delivery_sql(number: int) -> str:
    return f"(SELECT source_id, series_key, {_DAY} AS obs_date, value, row_no FROM obs_snapshots WHERE snapshot_no = {number})"


def stored(spark: SparkSession, d: str, number: int) -> DataFrame:
    """A delivery with one row per key, the last one."""
    from ..operators.merge import merge_keep_last

    t = delivery(spark, d, number).drop("source_id")
    return merge_keep_last(t.limit(0), t, position="row_no")


def stored_sql(number: int) -> str:
    return f"(SELECT series_key, obs_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_key, obs_date ORDER BY row_no DESC) AS rn FROM {delivery_sql(number)}) WHERE rn = 1)"


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Events as a run log: ``id``, ``ts``, ``source_id``, ``unit_id``, ``status``, ``dur_s``."""
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", "transient_fail").when(F.col("event_id") % 11 == 0, "window_stopped").when(F.col("event_id") % 7 == 0, "partial").when(F.col("event_type") == "view", "no_change").otherwise("ok")
    return e.select(F.col("event_id").alias("id"), "ts", F.concat(F.lit("s"), (F.col("user_id") % 13).cast("string")).alias("source_id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("unit_id"), status.alias("status"), F.col("value").alias("dur_s"))


RUNS = """(SELECT event_id AS id, ts, 's' || CAST(user_id % 13 AS VARCHAR) AS source_id, 'u' || CAST(user_id AS VARCHAR) AS unit_id,
  CASE WHEN event_type = 'error' THEN 'transient_fail' WHEN event_id % 11 = 0 THEN 'window_stopped' WHEN event_id % 7 = 0 THEN 'partial' WHEN event_type = 'view' THEN 'no_change' ELSE 'ok' END AS status, value AS dur_s FROM events)"""


def nan_apart(df: DataFrame, column: str = "value") -> DataFrame:
    """NaN as null and a mark of its own, as engines differ in what NaN equals; every row stays."""
    nan = F.coalesce(F.isnan(column), F.lit(False))
    return df.withColumn("is_nan", nan).withColumn(column, F.when(~nan, F.col(column)))


def nan_apart_sql(sql: str, column: str = "value") -> str:
    return f"SELECT * REPLACE (CASE WHEN NOT isnan({column}) THEN {column} END AS {column}), coalesce(isnan({column}), false) AS is_nan FROM ({sql})"
