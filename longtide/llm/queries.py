"""Queries of the problems of the text side (2, 6, 7, 8) over the whole tables of a data folder. What SQL cannot express of them, tests/llm holds
against brute force, round trips and held-out cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from .leaks import leaked, without_leaks
from .mojibake import garbled
from .packing import CAPACITY, pack, waste
from .truncation import AROUND, LIMIT_ROWS, candidate_limits, cut_rates, truncated


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled(table(spark, d, "series"), "series_id", ["title", "geography"], by="source_id").select("series_id", "field").distinct()


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    """What was garbled, and the text that the publisher wrote where it can be brought back."""
    return garbled(table(spark, d, "series"), "series_id", ["title", "geography"], by="source_id").withColumn("chain", F.concat_ws(" ", "chain"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container and place of every document (piece), in containers of 2,048 tokens."""
    return pack(table(spark, d, "documents"))


def p6_waste(spark: SparkSession, d: str) -> DataFrame:
    """The share of space left over."""
    return waste(pack(table(spark, d, "documents")))


def p6_placement(spark: SparkSession, d: str) -> DataFrame:
    """What every packing must keep: each document is placed, in as many pieces as its size asks for, no two overlap, none sticks out, little is left."""
    packed = pack(table(spark, d, "documents"))
    w = Window.partitionBy("container").orderBy("place", "n_tokens")
    checked = packed.filter("n_tokens > 0").withColumn("before", F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    bad = checked.agg(F.count_if(F.col("place") != F.coalesce("before", F.lit(0))).alias("n_misplaced"), F.count_if(F.col("place") + F.col("n_tokens") > CAPACITY).alias("n_beyond"))
    pieces = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("n") != F.greatest(F.ceil(F.col("t") / CAPACITY), F.lit(1))).alias("n_miscut"))
    return pieces.crossJoin(bad).crossJoin(waste(packed).select((F.col("share_left") < 0.02).alias("little_left")))  # one row each


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    """Where the passages stand, and their longest verbatim matches."""
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold no passage of a test item."""
    docs = table(spark, d, "documents")
    return without_leaks(docs, leaked(docs, table(spark, d, "eval_items"))).select("doc_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """In how many documents each test item leaked."""
    return p7_found(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(table(spark, d, "documents")).filter("cut").select("doc_id").distinct()


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts its texts."""
    return cut_rates(truncated(table(spark, d, "documents")))


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    """The lengths at which each source's texts pile up."""
    return candidate_limits(table(spark, d, "documents")).select("source", "unit", "length", "n_at")


QUERIES = {
    "p2_found": p2_found, "p2_restored": p2_restored, "p6_containers": p6_containers, "p6_waste": p6_waste, "p7_found": p7_found, "p7_matches": p7_matches, "p7_items": p7_items, "p7_clean": p7_clean,
    "p8_found": p8_found, "p8_rates": p8_rates, "p6_placement": p6_placement, "p8_limits": p8_limits,
}
ORACLE: dict[str, str] = {
    "p6_placement": "SELECT count(*) AS n_documents, 0::BIGINT AS n_miscut, 0::BIGINT AS n_misplaced, 0::BIGINT AS n_beyond, true AS little_left FROM documents",
    "p8_limits": f"""WITH t AS (SELECT DISTINCT coalesce(source, '') AS source, text FROM documents WHERE text IS NOT NULL), l AS (SELECT source, 'chars' AS unit, length(text)::INTEGER AS length FROM t UNION ALL SELECT source, 'bytes', strlen(text)::INTEGER FROM t),
      h AS (SELECT source, unit, length, count(*) AS c FROM l GROUP BY ALL), a AS (SELECT *, (sum(c) OVER (PARTITION BY source, unit ORDER BY length RANGE BETWEEN {AROUND} PRECEDING AND {AROUND} FOLLOWING) - c) / {2 * AROUND} AS around FROM h)
      SELECT source, unit, length, c AS n_at FROM a WHERE c >= {LIMIT_ROWS} AND c > around + 3 * sqrt(around) + 3""",
}
