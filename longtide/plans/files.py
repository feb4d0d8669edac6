"""Queries over files: every reader and writer on files made from whole test tables, and the contract of published stores, each beside
its SQL over the tables themselves."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LongtideError
from ..operators import delivery, merge, series
from ..session import put_bytes, scratch, table
from ..sources import formats, stores
from .reference import ORACLE as _REFERENCE
from .views import LINE_OBS, delivery_sql, line_obs, nan_apart, nan_apart_sql
from .views import delivery as delivered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# --- text formats -------------------------------------------------------------------------------------------------------


@query(f"SELECT 'FREQ=D:FLAG=' || split_part(series_key, ':', 2) || ':SUPPLIER=' || split_part(series_key, ':', 4) AS series_key, obs_date, value FROM {LINE_OBS}")
def source_sdmx_csv(spark, d):
    part = F.split("series_key", ":")
    t = line_obs(spark, d).select(F.lit("L").alias("DATAFLOW"), F.lit("D").alias("FREQ"), part[1].alias("FLAG"), part[3].alias("SUPPLIER"), F.lit("").alias("EMPTY"), F.col("obs_date").alias("TIME_PERIOD"), F.col("value").alias("OBS_VALUE"), F.lit("A").alias("OBS_STATUS"))
    path = scratch(spark, "sdmx-csv")
    t.write.option("header", True).csv(path)
    return formats.read_sdmx_csv(spark, path)


_BY_YEAR = "(SELECT l_returnflag AS f, l_linestatus AS s, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY ALL)"


def _by_year(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT 'FLAG=' || f || ':STATUS=' || s AS series_key, make_date(y, 12, 31) AS obs_date, n::DOUBLE AS value FROM {_BY_YEAR}")
def source_sdmx_xml(spark, d):
    obs = F.collect_list(F.struct(F.col("y").cast("string").alias("_TIME_PERIOD"), F.col("n").alias("_OBS_VALUE")))
    path = scratch(spark, "sdmx-xml")
    _by_year(spark, d).groupBy(F.col("f").alias("_FLAG"), F.col("s").alias("_STATUS")).agg(obs.alias("Obs")).write.format("xml").option("rootTag", "DataSet").option("rowTag", "Series").option("attributePrefix", "_").save(path)
    return formats.read_sdmx_xml(spark, path)


@query(ORACLE["source_sdmx_xml"])
def source_sdmx_generic_xml(spark, d):
    pair = lambda i, c: F.struct(F.lit(i).alias("_id"), c.alias("_value"))
    obs = F.collect_list(F.struct(F.struct(F.col("y").cast("string").alias("_value")).alias("ObsDimension"), F.struct(F.col("n").cast("string").alias("_value")).alias("ObsValue")))
    t = _by_year(spark, d).groupBy("f", "s").agg(obs.alias("Obs")).select(F.struct(F.array(pair("FLAG", F.col("f")), pair("STATUS", F.col("s"))).alias("Value")).alias("SeriesKey"), "Obs")
    path = scratch(spark, "sdmx-generic")
    t.write.format("xml").option("rootTag", "DataSet").option("rowTag", "Series").option("attributePrefix", "_").save(path)
    return formats.read_sdmx_generic_xml(spark, path)


_YEARS = range(1990, 2003)


@query(f"""SELECT 'flag=' || f || ':status=' || s AS series_key, make_date(y, 1, 1) AS obs_date, 'A' AS frequency, CASE WHEN y % 5 <> 0 THEN n::DOUBLE END AS value, CASE WHEN y % 5 = 0 THEN 'b' WHEN y % 2 = 0 THEN 'p' ELSE '' END AS flags
  FROM {_BY_YEAR} WHERE y BETWEEN {_YEARS[0]} AND {_YEARS[-1]}""")
def source_sdmx_tsv(spark, d):
    """A wide table: years across, a missing mark and flags in cells."""
    n = F.col("n").cast("string")
    cell = F.when(F.col("y") % 5 == 0, ": b").when(F.col("y") % 2 == 0, F.concat(n, F.lit(" p"))).otherwise(n)
    wide = _by_year(spark, d).groupBy("f", "s").pivot("y", list(_YEARS)).agg(F.first(cell))
    lines = wide.select(F.concat_ws("\t", F.concat_ws(",", "f", "s"), *[F.coalesce(F.col(str(y)), F.lit("")) for y in _YEARS]).alias("value"))
    head = "\t".join(["flag,status\\TIME_PERIOD", *map(str, _YEARS)])
    path = scratch(spark, "sdmx-tsv")
    spark.createDataFrame([(0, head)], "o int, value string").unionByName(lines.withColumn("o", F.lit(1))).repartition(1).sortWithinPartitions("o").select("value").write.text(path)  # a few lines
    return formats.read_sdmx_tsv(spark, path).withColumn("flags", F.array_join("flags", " "))


@query(f"SELECT 'flag=' || f || ':status=' || s AS series_key, make_date(y, 12, 31) AS obs_date, n::DOUBLE AS value FROM {_BY_YEAR}")
def source_jsonstat(spark, d):
    """One cube per flag: two statuses by all years, nulls where nothing was shipped."""
    years = [str(y) for y in range(1985, 2015)]
    grid = spark.createDataFrame([(s, y, i * len(years) + j) for i, s in enumerate("FO") for j, y in enumerate(map(int, years))], "s string, y int, pos int")
    flags = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("f")).distinct()
    full = flags.crossJoin(F.broadcast(grid)).join(_by_year(spark, d), ["f", "s", "y"], "left")  # sixty cells a cube
    cells = full.groupBy("f").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("n").cast("double").alias("n")))), lambda x: x["n"]).alias("v"))
    value = F.concat(F.lit("["), F.array_join(F.transform("v", lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ","), F.lit("]"))
    index = ",".join(f'"{y}":{i}' for i, y in enumerate(years))
    text = F.concat(F.lit('{"class":"dataset","id":["flag","status","time"],"size":[1,2,' + str(len(years)) + '],"dimension":{"flag":{"category":{"index":["'), F.col("f"),
                    F.lit('"]}},"status":{"category":{"index":["F","O"]}},"time":{"category":{"index":{' + index + '}}}},"value":'), value, F.lit("}"))
    path = scratch(spark, "jsonstat")
    cells.select(text.alias("value")).write.text(path)
    return formats.jsonstat_rows(spark.read.text(path).withColumnRenamed("value", "text"), "time")


@query("SELECT metric || '.Tag.USD' AS metric, obs_date, CASE WHEN NOT isnan(value) THEN value END AS value, vintage_date FROM facts WHERE metric IS NOT NULL AND obs_date IS NOT NULL")
def source_companyfacts(spark, d):
    """One document per entity and year; every filed vintage comes back."""
    t = table(spark, d, "facts").filter("metric IS NOT NULL AND obs_date IS NOT NULL")
    point = F.struct(F.col("obs_date").cast("string").alias("end"), F.when(~F.isnan("value"), F.col("value")).alias("val"), F.col("vintage_date").cast("string").alias("filed"))
    units = t.groupBy("metric", F.year("obs_date").alias("y"), F.pmod("fact_id", F.lit(64)).alias("part")).agg(F.collect_list(point).alias("p"))  # a 64th of an entity's year
    doc = F.to_json(F.struct(F.col("metric").alias("cik"), F.create_map(F.lit("gaap"), F.create_map(F.lit("Tag"), F.struct(F.create_map(F.lit("USD"), F.col("p")).alias("units")))).alias("facts")))
    path = scratch(spark, "companyfacts")
    units.select(doc.alias("value")).write.text(path)
    return formats.companyfacts_rows(spark.read.text(path).withColumnRenamed("value", "text"))


def _few(spark, d, name: str) -> list:
    return [list(map(str, r)) for r in table(spark, d, name).collect()]  # of tables with as many rows at every scale


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, '2020Q1' AS DATASET_PERIOD, 'zip' AS SOURCE_ID FROM nation")
def source_zip(spark, d):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("N.tsv", "\n".join(map("\t".join, [["n_nationkey", "n_name", "n_regionkey"], *_few(spark, d, "nation")])) + "\n")
    path = scratch(spark, "zip") + "/n.zip"
    put_bytes(spark, path, packed.getvalue())
    return formats.read_zipped_tables(spark, path, "N.tsv", "2020Q1", "zip")


@query("SELECT 1 AS sheet, CAST(n_nationkey + 1 AS INTEGER) AS row, CAST(n_nationkey AS VARCHAR) || '|' || n_name || '|~|' || CAST(n_regionkey AS VARCHAR) AS cells FROM nation UNION ALL SELECT 2, CAST(r_regionkey + 1 AS INTEGER), CAST(r_regionkey AS VARCHAR) || '|' || r_name FROM region")
def source_xlsx(spark, d):
    """Two sheets; a gap between cells is null."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda at, v: f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = lambda rows: f"<worksheet {ns}><sheetData>" + "".join(f'<row r="{int(r[0]) + 1}">' + "".join(cell(f"{c}{int(r[0]) + 1}", v) for c, v in zip(cols, r, strict=True)) + "</row>" for cols, r in rows) + "</sheetData></worksheet>"
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet([("ABD", r) for r in _few(spark, d, "nation")]))
        z.writestr("xl/worksheets/sheet2.xml", sheet([("AB", r) for r in _few(spark, d, "region")]))
    path = scratch(spark, "xlsx") + "/n.xlsx"
    put_bytes(spark, path, packed.getvalue())
    return formats.read_xlsx_rows(spark, path, sheets=None).select("sheet", "row", F.array_join("cells", "|", "~").alias("cells"))


# --- stores -------------------------------------------------------------------------------------------------------------


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def store_schema_drift(spark, d):
    """Files of two vintages, one without a column."""
    t, path = table(spark, d, "supplier"), scratch(spark, "drift")
    t.filter("s_suppkey % 2 = 0").select("s_suppkey", "s_acctbal").write.parquet(f"{path}/a")
    t.filter("s_suppkey % 2 <> 0").select("s_suppkey").write.parquet(f"{path}/b")
    return stores.read_store(spark, f"{path}/a", f"{path}/b", columns=["s_suppkey", "s_acctbal"])


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS row, true AS named FROM supplier")
def store_positions(spark, d):
    """The place of every row in its file, and the file's name."""
    path = scratch(spark, "positions")
    table(spark, d, "supplier").repartition(1).sortWithinPartitions("s_suppkey").write.parquet(path)
    return stores.with_position(spark.read.parquet(path)).select("s_suppkey", F.col("_row").alias("row"), F.col("_file").startswith("part-").alias("named"))


@query("SELECT year(o_orderdate) AS part, count(*) AS n_rows, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders GROUP BY 1")
def store_footers(spark, d):
    """Rows and last date of every file, from its footer."""
    path = scratch(spark, "footers")
    table(spark, d, "orders").select(F.year("o_orderdate").alias("part"), F.to_date("o_orderdate").alias("obs_date"), "o_totalprice").repartition("part").write.partitionBy("part").parquet(path)
    f = stores.footer_stats(spark, path)
    return f.groupBy(F.regexp_extract("path", r"part=(\d+)/", 1).cast("bigint").alias("part")).agg(F.sum("n_rows").alias("n_rows"), F.max("last_date").alias("last_date"))


@query("SELECT coalesce(frequency, '-') AS frequency, count(*) AS n, count(DISTINCT series_id) AS n_series FROM series GROUP BY 1")
def store_partitions(spark, d):
    path = scratch(spark, "partitions")
    stores.write_partitioned(table(spark, d, "series").withColumn("frequency", F.coalesce("frequency", F.lit("-"))), path, "frequency")
    return spark.read.parquet(path).groupBy(F.col("frequency").cast("string").alias("frequency")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_id").alias("n_series"))


@query("SELECT s_suppkey, s_name FROM supplier")
def store_live_half(spark, d):
    t, path = table(spark, d, "supplier").select("s_suppkey", "s_name"), scratch(spark, "live")
    t.filter("s_suppkey % 3 = 0").write.parquet(f"{path}/x.parquet")
    t.filter("s_suppkey % 3 <> 0").write.parquet(f"{path}/_live/x.parquet")
    return stores.with_live_half(spark, path, "x")


@query("SELECT r_name AS series_key, CAST(n_name AS VARCHAR) AS member, make_date(2000 + n_nationkey, 1, 1) AS obs_date, n_nationkey::DOUBLE AS value FROM nation JOIN region ON n_regionkey = r_regionkey")
def store_connector(spark, d):
    """A source that is a Python class: what it discovers and fetches."""
    from datetime import date

    names = dict(map(tuple, _few(spark, d, "region")))
    held = {}
    for k, n, r in _few(spark, d, "nation"):
        held.setdefault(names[r], []).append((date(2000 + int(k), 1, 1), float(k), n))

    class Nations(stores.Connector):
        def discover(self):
            return [stores.SeriesMeta(r, r) for r in held]

        def fetch(self, series_id, since):
            for day, value, _ in held[series_id]:
                yield day, value

    spark.dataSource.register(Nations().as_source("nations"))
    label = table(spark, d, "nation").select(F.col("n_name").alias("member"), F.col("n_nationkey").cast("double").alias("value"))
    return spark.read.format("nations").load().join(label, "value").select("series_key", "member", "obs_date", "value")


# --- publishing ---------------------------------------------------------------------------------------------------------


def _published(spark, d):
    """A store with the first delivery, into which the second is merged."""
    path = scratch(spark, "store") + "/s.parquet"
    a, b = (delivered(spark, d, n).drop("source_id") for n in (1, 2))
    merge.merge_and_write(spark, path, a, mode="overwrite", position="row_no")
    return path, merge.merge_and_write(spark, path, b, report_changed=True, position="row_no")


@query(_REFERENCE["merge_changed_keys"])
def publish_changes(spark, d):
    """Which series a published merge changed."""
    return _published(spark, d)[1][2]


@query(_REFERENCE["merge_keep_last"])
def publish_store(spark, d):
    """What the store holds after the merge."""
    return nan_apart(spark.read.parquet(_published(spark, d)[0]).select("series_key", "obs_date", "value"))


@query(f"SELECT count(*) AS n_rows, max(obs_date) AS last_date, false AS out_of_order FROM (SELECT DISTINCT series_key, obs_date FROM {delivery_sql(1)} UNION SELECT DISTINCT series_key, obs_date FROM {delivery_sql(2)})")
def publish_order(spark, d):
    """The merge's own count and last date, and whether any file is out of key order."""
    from pyspark.sql import Window

    path, (n, last, _) = _published(spark, d)
    t = stores.with_position(spark.read.parquet(path))
    w = Window.partitionBy("_file").orderBy("_row")
    k = F.struct(F.col("series_key").isNull(), "series_key", F.col("obs_date").isNull(), "obs_date")
    bad = t.withColumn("__k", k).withColumn("__p", F.lag("__k").over(w)).agg(F.coalesce(F.bool_or(F.col("__p") > F.col("__k")), F.lit(False)).alias("out_of_order"))
    return bad.select(F.lit(n).cast("bigint").alias("n_rows"), F.lit(last).cast("date").alias("last_date"), "out_of_order")


@query("""SELECT * FROM (VALUES ('overwrite shrinks', 'ShrinkRefusal'), ('no rows', 'EmptyRefusal'), ('lacks a stored column', 'SchemaRefusal'), ('lacks a key', 'SchemaRefusal'), ('report of an overwrite', 'ValueError'), ('too many changed', 'ReportRefusal'), ('new column', 'none'), ('small shrink', 'none')) v("case", refused)""")
def publish_refusals(spark, d):
    """What a store refuses, and what it takes; a refusal leaves it as it was."""
    path = scratch(spark, "refusals") + "/s.parquet"
    first = delivered(spark, d, 1).drop("source_id")
    merge.merge_and_write(spark, path, first, mode="overwrite")
    before = spark.read.parquet(path).count()
    cases = {
        "overwrite shrinks": (first.filter("row_no % 2 = 0"), {"mode": "overwrite"}), "no rows": (first.limit(0), {"mode": "overwrite"}), "lacks a stored column": (first.drop("row_no"), {}), "lacks a key": (first.drop("obs_date"), {}),
        "report of an overwrite": (first, {"mode": "overwrite", "report_changed": True}), "too many changed": (delivered(spark, d, 2).drop("source_id"), {"report_changed": True, "report_cap": 1}),
        "new column": (first.withColumn("extra", F.lit(1)), {}), "small shrink": (first.filter("row_no % 100 <> 0"), {"mode": "overwrite", "min_ratio": 0.5}),
    }
    out = []
    for name, (rows, options) in cases.items():
        try:
            merge.merge_and_write(spark, path, rows, **options)
            out.append((name, "none"))
        except (LongtideError, ValueError) as e:
            kept = spark.read.parquet(path).count() == before
            out.append((name, type(e).__name__ if kept else "store was touched"))
    return spark.createDataFrame(out, "case string, refused string")


# --- handing out --------------------------------------------------------------------------------------------------------


@query(f"SELECT 'line:' || series_key AS series_id, obs_date, value FROM {LINE_OBS}")
def delivered_csv(spark, d):
    """All series as CSV behind a citation, and read again against the completeness line."""
    tidy = series.tidy(line_obs(spark, d), "line").select("series_id", "obs_date", "value")
    path = scratch(spark, "csv")
    delivery.write_complete_csv(tidy, path, ["# series: all"])
    return delivery.read_csv(spark, path)


@query("SELECT * FROM (VALUES ('cut', 'LongtideError'), ('short', 'LongtideError'), ('whole', 'none')) v(\"case\", refused)")
def delivered_csv_refusals(spark, d):
    """A file without its completeness line, one with fewer rows than the last line tells, and a whole one."""
    n = table(spark, d, "nation").select(F.concat(F.col("n_name"), F.lit(",2020-01-01,"), F.col("n_nationkey")).alias("value"))
    out, count = [], n.count()
    for name, tail in (("cut", []), ("short", [f"{delivery.COMPLETE}{count}", f"{delivery.COMPLETE}{count + 1}"]), ("whole", [f"{delivery.COMPLETE}1", f"{delivery.COMPLETE}{count}"])):
        lines = spark.createDataFrame([(0, "series_id,obs_date,value")] + [(2 + i, t) for i, t in enumerate(tail)], "o int, value string").unionByName(n.withColumn("o", F.lit(1)))
        path = scratch(spark, "csv")
        lines.repartition(1).sortWithinPartitions("o").select("value").write.text(path)  # 25 rows
        try:
            delivery.read_csv(spark, path).count()
            out.append((name, "none"))
        except LongtideError as e:
            out.append((name, type(e).__name__))
    return spark.createDataFrame(out, "case string, refused string")


@query(f"SELECT split_part(series_key, ':', 2) AS source, count(*) AS n, count(DISTINCT series_key) AS n_series, round(sum(value), 2) AS total FROM {LINE_OBS} GROUP BY 1")
def bundle_round_trip(spark, d):
    """A bundle with a source per flag, checked file by file and pulled."""
    o = line_obs(spark, d)
    tidy = o.select(F.concat(F.lit("line:"), "series_key").alias("series_id"), F.split("series_key", ":")[1].alias("source"), "obs_date", "value")
    path = scratch(spark, "bundle")
    delivery.write_bundle(spark, tidy, path)
    return delivery.pull_bundle(spark, path).groupBy(F.col("source").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_id").alias("n_series"), F.round(F.sum("value"), 2).alias("total"))


__all__ = ["ORACLE", "QUERIES", "nan_apart_sql"]
