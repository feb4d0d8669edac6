"""Handing out series: CSV with citation and completeness lines, and bundles with a manifest."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyRefusal, LongtideError

COMPLETE = "# complete rows="


def citation_lines(series: Column, source: Column, licence: Column, terms: Column, non_commercial: Column, share_alike: Column, no_derivatives: Column) -> Column:
    """The head of a delivered file, as an array of lines beginning with ``#``; a null field has no line."""
    line = lambda head, c: F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"# {head}: "), c))
    note = lambda cond, text: F.when(cond, F.lit(f"# NOTE: {text}"))
    return F.array_compact(F.array(line("series", series), line("source", source), line("licence", licence), note(non_commercial, "NON-COMMERCIAL use only"), note(share_alike, "SHARE-ALIKE"), note(no_derivatives, "NO DERIVATIVES"), line("terms", terms)))


def csv_text(df: DataFrame) -> DataFrame:
    """Rows of a series table as CSV lines, per series: ``series_id``, ``obs_date``, ``line``; nulls are empty fields."""
    q = lambda c: F.when(c.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    val = F.coalesce(F.col("value").cast("string"), F.lit(""))
    return df.select("series_id", "obs_date", F.concat_ws(",", F.coalesce(q(F.col("series_id")), F.lit("")), F.coalesce(F.col("obs_date").cast("string"), F.lit("")), val).alias("line"))


def write_csv(df: DataFrame, path: str, key: str = "series_id", date: str = "obs_date") -> None:
    """One sort for all series; files hold whole key ranges in order of key and date. An empty table is refused."""
    if df.isEmpty():
        raise EmptyRefusal("no rows to derive")
    df.orderBy(F.col(key).asc_nulls_last(), F.col(date).asc_nulls_last()).write.option("header", True).option("emptyValue", "").option("nullValue", "").mode("overwrite").csv(path)


def write_by_series(df: DataFrame, path: str, key: str = "series_key", date: str = "obs_date", buckets: int = 1024) -> None:
    """All series in key order, in ``buckets`` folders by a hash of the key, from one shuffle: a series is found by its bucket and the
    row groups' key ranges, without a folder of its own. ``read_series`` reads one."""
    b = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    df.withColumn("bucket", b).repartitionByRange("bucket", key, date).sortWithinPartitions("bucket", key, F.col(date).asc_nulls_last()).write.partitionBy("bucket").mode("overwrite").parquet(path)


def read_series(spark: SparkSession, path: str, series: str, key: str = "series_key", buckets: int = 1024) -> DataFrame:
    """One series of ``write_by_series``; only its bucket is listed, and only row groups that may hold it are read."""
    return spark.read.parquet(path).filter((F.col("bucket") == F.pmod(F.xxhash64(F.lit(series)), F.lit(buckets)).cast("int")) & (F.col(key) == series)).drop("bucket")


def write_complete_csv(df: DataFrame, path: str, head: list[str] = ()) -> None:
    """A table of ``series_id``, ``obs_date``, ``value`` as CSV files in key order; the first begins with the ``head`` lines, and a file after
    all others holds the completeness line."""
    if df.isEmpty():
        raise EmptyRefusal("no rows to derive")
    spark = df.sparkSession
    write_csv(df.select("series_id", "obs_date", "value"), path)
    n = spark.read.option("header", True).csv(path).count()
    ends = spark.createDataFrame([(t,) for t in [*head, f"{COMPLETE}{n}"]], "value string").coalesce(1)
    ends.write.mode("append").text(path)  # a text file sorts by the number of its task, not by time; readers look for the line


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A delivered CSV: lines that begin with # are passed over. The number of rows is checked against the last completeness line (in
    order of files and places in them): one that is missing or differs is an error of its own."""
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", at.alias("at")).filter(F.col("value").startswith(COMPLETE))
    told = lines.agg(F.max_by(F.substring("value", len(COMPLETE) + 1, 20).try_cast("bigint"), "at")).first()[0]
    df = spark.read.option("header", True).option("comment", "#").option("enforceSchema", True).schema("series_id string, obs_date date, value double").csv(path)
    if told is None:
        raise LongtideError("the completeness line is missing: the file was cut")
    if (n := df.count()) != told:
        raise LongtideError(f"{n} rows, but the file should have {told}")
    return df


#: Rows of one file of a bundle.
BUNDLE_ROWS = 5_000_000


def write_bundle(spark: SparkSession, tidy: DataFrame, path: str, unresolved: list[str] = (), snapshot: str | None = None) -> dict:
    """Native files per source and a manifest with a SHA-256 of each file. Returns the manifest."""
    tidy.repartitionByRange("source", "series_id", "obs_date").sortWithinPartitions("source", "series_id", "obs_date").write.partitionBy("source").option("maxRecordsPerFile", BUNDLE_ROWS).mode("overwrite").parquet(f"{path}/data")
    counts = {r["source"]: r for r in tidy.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("series_id").alias("series")).collect()}  # one per source
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    sums = files.select(F.regexp_extract("path", r"source=([^/]+)/", 1).alias("source"), F.regexp_extract("path", r"(data/.*)$", 1).alias("file"), F.sha2("content", 256).alias("sha256")).orderBy("file").collect()
    out = {"snapshot": snapshot, "unresolved": sorted(unresolved), "resources": [{"source": s.source, "path": s.file, "sha256": s.sha256} for s in sums], "sources": {k: {"rows": v["rows"], "series": v["series"]} for k, v in sorted(counts.items())}}
    spark.createDataFrame([(json.dumps(out, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return out


def pull_bundle(spark: SparkSession, path: str) -> DataFrame:
    """A bundle's rows, after every file's sum has been checked against the manifest."""
    told = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    have = {r[0]: r[1] for r in files.select(F.regexp_extract("path", r"(data/.*)$", 1), F.sha2("content", 256)).collect()}
    if have != {r["path"]: r["sha256"] for r in told["resources"]}:
        raise LongtideError("the files of the bundle are not those of its manifest")
    return spark.read.parquet(f"{path}/data")


def text_sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
