"""Session helpers: defaults for local use, table access, and lineage cuts that survive lost executors."""

from __future__ import annotations

import hashlib
import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .errors import LongtideError

#: Settings that a session made here starts with; a session handed in is used as it is.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", partitions: int = 8, **conf: str) -> SparkSession:
    """A session on ``local[cpus]`` for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("longtide").config("spark.driver.memory", memory)
    for k, v in (DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions)} | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder is made and
    set if the master is local (tests on one machine); on a cluster that is an error, as executors would write to their own disks."""
    sc = spark.sparkContext
    there = sc._jsc.sc().getCheckpointDir()
    if there.isDefined():
        return there.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not re.match(r"local(\[|$)", sc.master):
        raise LongtideError("set spark.checkpoint.dir to a folder that all executors share")
    path = path or tempfile.mkdtemp(prefix="longtide-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through the shared folder. Without it, operators whose tasks run
    Python would need the package to be installed on every machine."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{shared_dir(spark)}/{root.name}-{hashlib.sha256(packed.getvalue()).hexdigest()[:12]}.zip"
    put_bytes(spark, path, packed.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def put_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a small file to the shared folder; it goes when the JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    out.write(content)
    out.close()
    fs.deleteOnExit(target)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(hadoop_path)
    return path


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back. This cuts the lineage, keeps the result
    on storage that outlives any executor, and gives the planner exact sizes. The files go when the JVM ends."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widened(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than the cluster has cores, spread over as many; any other as it is, unshuffled. For inputs of a
    few files whose rows are costly to work on."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
