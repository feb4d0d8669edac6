"""Parquet stores: several vintages of files, live halves, positions, partitions, and a connector contract."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import NotFound
from ..session import ship


def read_store(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Files of several vintages as one table; columns that a file lacks are null."""
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    return df.select(*columns) if columns else df


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``_file`` (name without its ending) and ``_row`` (place in the file) of a file-backed table."""
    return df.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.parquet$", "").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def with_live_half(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The frozen file and, if there is one, its live half."""
    jvm = spark.sparkContext._jvm
    paths = [f"{directory}/{name}.parquet", f"{directory}/_live/{name}.parquet"]
    found = [p for p in paths if (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(h)]
    if not found:
        raise NotFound(f"{name} in {directory}")
    return read_store(spark, *found)


def footer_stats(spark: SparkSession, path: str, date: str = "obs_date") -> DataFrame:
    """``path``, ``n_rows`` and ``last_date`` of every file, from its footer alone, read by the executors; ``last_date`` is null where the
    column or its statistics are missing. The driver knows the file names, as it does for any scan."""
    ship(spark)

    def run(batches):
        import pandas as pd
        from pyarrow import fs as afs
        from pyarrow import parquet

        for b in batches:
            out = []
            for p in b["path"]:
                system, inner = afs.FileSystem.from_uri(p)
                with system.open_input_file(inner) as f:
                    meta = parquet.read_metadata(f)
                last = None
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        st = group.column(c).statistics if group.column(c).path_in_schema == date else None
                        if st is not None and st.has_min_max:
                            last = st.max if last is None else max(last, st.max)
                out.append((p, meta.num_rows, last))
            yield pd.DataFrame(out, columns=["path", "n_rows", "last_date"])

    files = spark.read.parquet(path).inputFiles()
    listed = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism * 4)))
    return listed.mapInPandas(run, "path string, n_rows bigint, last_date date")


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """One folder per value of ``by``; rows of a value are spread over as many files as their number asks for."""
    df.repartition(F.col(by), F.pmod(F.monotonically_increasing_id(), F.lit(8))).write.partitionBy(by).mode("overwrite").option("maxRecordsPerFile", 5_000_000).parquet(path)


@dataclass
class SeriesMeta:
    series_id: str
    title: str
    frequency: str = "irregular"
    unit: str | None = None
    geography: str | None = None
    category: str | None = None
    license_id: str | None = None
    metadata: str | None = None


class Connector(ABC):
    """What a source offers: its series, and the observations of one since a date."""

    @abstractmethod
    def discover(self) -> list[SeriesMeta]: ...

    @abstractmethod
    def fetch(self, series_id: str, since: str | None) -> Iterator[tuple]: ...

    def as_source(self, name: str, since: str | None = None) -> type[DataSource]:
        """A Spark data source over this connector: one partition per series, ``series_key``, ``obs_date``, ``value``."""
        connector, ids = self, [m.series_id for m in self.discover()]

        class _Reader(DataSourceReader):
            def partitions(self):
                return [InputPartition(i) for i in ids]

            def read(self, partition):
                for date, value in connector.fetch(partition.value, since):
                    yield partition.value, date, value

        class _Source(DataSource):
            @classmethod
            def name(cls):
                return name

            def schema(self):
                return "series_key string, obs_date date, value double"

            def reader(self, schema):
                return _Reader()

        return _Source

    def catalogue(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(m) for m in self.discover()], "series_id string, title string, frequency string, unit string, geography string, category string, license_id string, metadata string")
