"""Parsers per file format, each a plan over text or cells; none iterates over rows in Python except for XML of other shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.periods import sdmx_period, table_period, tsv_period
from ..session import ship

# Names of columns by role, in upper case.
TIME_COLUMNS = ("TIME_PERIOD", "TIME", "PERIOD", "DATE")
VALUE_COLUMNS = ("OBS_VALUE", "VALUE", "OBSVALUE")
KEY_COLUMNS = ("KEY", "SERIES_KEY")
NOT_DIMENSIONS = (
    "DATAFLOW", "STRUCTURE", "STRUCTURE_ID", "ACTION", "LOCALE", "COMMENT", "OBS_STATUS", "OBS_CONF", "OBS_PRE_BREAK", "OBS_COM", "TIME_FORMAT", "LAST_UPDATE", "COLLECTION", "TITLE", "UNIT_MEASURE", "UNIT_MULT",
    "DECIMALS", "SOURCE_AGENCY",
)
MISSING = ("", "NaN", "nan", "NA", "N/A", ".", "...")


def _role(columns: list[str], names: tuple[str, ...]) -> str | None:
    return next((c for c in columns if c.lstrip("﻿").upper() in names), None)


def number(text: Column) -> Column:
    """A finite or infinite number, or null for anything that marks a missing value or is none."""
    return F.when(~text.isin(*MISSING), text.try_cast("double"))


def sdmx_csv_rows(df: DataFrame) -> DataFrame:
    """SDMX-CSV with all columns as text: ``series_key``, ``obs_date``, ``value``. The columns are known by name; the key is the
    ready-made one or NAME=value of all dimensions that have a value. Rows without number or period are left out. Without a
    time or value column there are no rows."""
    time, value, key = (_role(df.columns, names) for names in (TIME_COLUMNS, VALUE_COLUMNS, KEY_COLUMNS))
    if time is None or value is None:
        return df.select(F.lit("").alias("series_key"), F.lit(None).cast("date").alias("obs_date"), F.lit(0.0).alias("value")).limit(0)
    q = lambda c: F.col(f"`{c}`")
    skip = {time, value, *[c for c in df.columns if c in NOT_DIMENSIONS]}
    built = F.concat_ws(":", *[F.when(F.coalesce(q(c), F.lit("")) != "", F.concat(F.lit(c + "="), q(c))) for c in df.columns if c not in skip])
    sid = F.coalesce(F.nullif(q(key), F.lit("")), built) if key else built
    return df.select(sid.alias("series_key"), sdmx_period(q(time)).alias("obs_date"), number(q(value)).alias("value")).filter(F.col("obs_date").isNotNull() & F.col("value").isNotNull())


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    return sdmx_csv_rows(spark.read.option("header", True).option("inferSchema", False).csv(path))


def sdmx_tsv_rows(lines: DataFrame, head: str) -> DataFrame:
    """A wide TSV whose first head is ``dim1,dim2\\TIME_PERIOD`` and whose others are periods. ``lines``: column ``value``, the
    data lines; ``head``: the header line. Gives ``series_key`` (dim=code:...), ``obs_date``, ``frequency``, ``value``, ``flags``. A
    cell is a number and flags; ``:`` is missing; other text is kept as the flag raw=text. Empty cells are left out."""
    first, *periods = head.rstrip("\n").split("\t")
    dims = first.split("\\")[0].split(",")
    cells = F.split(F.col("value"), "\t")
    codes = F.split(F.get(cells, F.lit(0)), ",")
    key = F.concat_ws(":", *[F.concat(F.lit(d.strip() + "="), F.trim(F.get(codes, F.lit(i)))) for i, d in enumerate(dims)])
    tall = lines.select(key.alias("series_key"), F.posexplode(F.slice(cells, 2, len(periods))).alias("i", "cell"))
    period = F.get(F.array(*[F.lit(p.strip()) for p in periods]), F.col("i"))
    parts = F.split(F.trim("cell"), r"\s+", 2)
    token, flag = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    v = F.when(token != ":", token.try_cast("double"))
    raw = F.when((token != ":") & v.isNull(), F.concat(F.lit("raw="), token))
    p = tsv_period(period)
    out = tall.filter(F.trim("cell") != "").select("series_key", p["date"].alias("obs_date"), p["freq"].alias("frequency"), v.alias("value"), F.array_compact(F.array(F.nullif(F.trim(flag), F.lit("")), raw)).alias("flags"))
    return out.filter(F.col("obs_date").isNotNull())


def read_sdmx_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Reads the header from the file's first line, all else in parallel."""
    lines = spark.read.text(path)
    head = lines.first()[0]
    return sdmx_tsv_rows(lines.filter(F.col("value") != head), head)


def read_sdmx_xml(spark: SparkSession, path: str) -> DataFrame:
    """SDMX-ML compact data: Series elements with attributes and Obs elements with TIME_PERIOD and OBS_VALUE."""
    df = spark.read.format("xml").option("rowTag", "Series").option("attributePrefix", "_").option("inferSchema", False).load(path)
    if "Obs" not in df.columns:
        return spark.createDataFrame([], "series_key string, obs_date date, value double")
    obs = F.col("Obs") if df.schema["Obs"].dataType.typeName() == "array" else F.array("Obs")
    dims = [c for c in df.columns if c.startswith("_") and c[1:].upper() not in NOT_DIMENSIONS]
    key = F.concat_ws(":", *[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(c[1:] + "="), F.col(c).cast("string"))) for c in sorted(dims)])
    rows = df.select(key.alias("series_key"), F.explode(obs).alias("o"))
    return rows.select("series_key", sdmx_period(F.col("o._TIME_PERIOD").cast("string")).alias("obs_date"), number(F.col("o._OBS_VALUE").cast("string")).alias("value")).filter(F.col("obs_date").isNotNull() & F.col("value").isNotNull())


def read_sdmx_generic_xml(spark: SparkSession, path: str) -> DataFrame:
    """SDMX-ML generic data: Series with a SeriesKey of Values (id, value) and Obs with ObsDimension and ObsValue. Whatever the
    prefixes of its elements."""
    pair = "array<struct<_id:string,_value:string>>"
    schema = f"SeriesKey struct<Value:{pair}>, Obs array<struct<ObsDimension:struct<_value:string>,ObsValue:struct<_value:string>>>"
    df = spark.read.format("xml").option("rowTag", "Series").option("ignoreNamespace", True).option("attributePrefix", "_").schema(schema).load(path)
    dims = F.filter("SeriesKey.Value", lambda v: (F.coalesce(v["_value"], F.lit("")) != "") & ~v["_id"].isin(*NOT_DIMENSIONS))
    key = F.array_join(F.transform(dims, lambda v: F.concat(v["_id"], F.lit("="), v["_value"])), ":")
    rows = df.select(key.alias("series_key"), F.explode("Obs").alias("o"))
    out = rows.select("series_key", sdmx_period(F.col("o.ObsDimension._value")).alias("obs_date"), number(F.col("o.ObsValue._value")).alias("value"))
    return out.filter(F.col("obs_date").isNotNull() & F.col("value").isNotNull())


def jsonstat_rows(texts: DataFrame, time: str, column: str = "text") -> DataFrame:
    """JSON-stat2 cubes, one per row: ``series_key`` (dim=code of all but the time dimension), ``obs_date``, ``value``. A place in
    the flat value array becomes coordinates by its strides; the category index may be a list or a map. Nulls and codes that
    are no period are left out."""
    js = F.col(column)
    at = lambda p, t: F.from_json(F.get_json_object(js, p), t)
    base = texts.select(at("$.id", "array<string>").alias("dims"), at("$.size", "array<int>").alias("size"), at("$.value", "array<double>").alias("vals"), at("$.dimension", "map<string,string>").alias("dim"))
    index = lambda d: F.get_json_object(F.element_at("dim", d), "$.category.index")
    places = lambda d: F.from_json(index(d), "map<string,int>")
    codes = F.transform("dims", lambda d: F.coalesce(
        F.from_json(index(d), "array<string>"),
        F.transform(F.array_sort(F.map_values(places(d))), lambda n: F.element_at(F.map_from_arrays(F.map_values(places(d)), F.map_keys(places(d))), n))))
    strides = F.transform("dims", lambda d, i: F.aggregate(F.slice("size", i + 2, F.size("size")), F.lit(1), lambda acc, n: acc * n))
    flat = base.select("dims", "size", codes.alias("codes"), strides.alias("strides"), F.posexplode("vals").alias("pos", "value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    coord = F.transform("dims", lambda d, i: F.element_at(F.element_at("codes", i + 1), (F.floor(F.col("pos") / F.element_at("strides", i + 1)) % F.element_at("size", i + 1) + 1).cast("int")))
    out = flat.select("dims", coord.alias("c"), "value")
    key = F.array_join(F.filter(F.zip_with("dims", "c", lambda d, c: F.when(d != time, F.concat(d, F.lit("="), c))), lambda x: x.isNotNull()), ":")
    when = F.element_at("c", F.array_position("dims", time).cast("int"))
    return out.select(key.alias("series_key"), table_period(when).alias("obs_date"), "value").filter(F.col("obs_date").isNotNull())


def companyfacts_rows(texts: DataFrame, column: str = "text") -> DataFrame:
    """XBRL company facts, one document per row: ``metric`` (entity.tag.unit), ``obs_date``, ``value``, ``vintage_date``; every
    filed vintage is kept. Four nested explodes over maps."""
    unit = "array<struct<end:string,val:double,filed:string>>"
    df = texts.select(F.from_json(column, f"struct<cik:string,facts:map<string,map<string,struct<units:map<string,{unit}>>>>>").alias("d"))
    a = df.select("d.cik", F.explode("d.facts").alias("taxonomy", "tags")).select("cik", F.explode("tags").alias("tag", "t")).select("cik", "tag", F.explode("t.units").alias("unit", "points")).select("cik", "tag", "unit", F.explode("points").alias("p"))
    return a.select(F.concat_ws(".", "cik", "tag", "unit").alias("metric"), F.col("p.end").try_cast("date").alias("obs_date"), F.col("p.val").alias("value"), F.col("p.filed").try_cast("date").alias("vintage_date")).filter(F.col("obs_date").isNotNull())


def resolve_time(candidates: DataFrame, table: str = "table_id", dim: str = "dim", code: str = "code", flag: str | None = None, least: float = 0.6) -> DataFrame:
    """Which dimension of each table is time: the flagged one; else the one of which most codes parse as periods of sane years, if
    at least ``least`` do (names like time break ties); else one that is named like time and has a code that parses.
    ``table``, ``time_dim``, ``rate``, ``rule``."""
    d = table_period(F.col(code))
    ok = F.coalesce(F.year(d).between(1500, 2100), F.lit(False))
    a = candidates.groupBy(table, dim).agg(F.avg(ok.cast("double")).alias("rate"), F.max(F.col(flag) if flag else F.lit(False)).alias("flagged"))
    named = F.lower(F.col(dim)).rlike("^(time|tid|year|period|date|month|quarter|vuosi|ano|jahr|rok|tlist.*)$")
    rank = F.when(F.col("flagged"), 3).when(F.col("rate") >= least, 2).when(named & (F.col("rate") > 0), 1).otherwise(0)
    best = a.withColumn("rank", rank).filter("rank > 0").groupBy(table).agg(F.max(F.struct("rank", "rate", named.alias("named"), F.col(dim).alias("d"))).alias("b"))
    return best.select(table, F.col("b.d").alias("time_dim"), F.col("b.rate").alias("rate"), F.when(F.col("b.rank") == 3, "flag").when(F.col("b.rank") == 2, "rate").otherwise("name").alias("rule"))


def read_zipped_tables(spark: SparkSession, path: str, member: str, period: str, source: str) -> DataFrame:
    """A tab-separated member of zip files as text columns, empty fields as null, with the period and source of the delivery.
    Every archive is opened by one task; its lines are cut into columns by Spark."""
    import io
    import zipfile

    from pyspark.sql import types as T

    ship(spark)

    def lines(batches):
        import pandas as pd

        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    with z.open(member) as f:
                        head = f.readline().decode("utf-8-sig").rstrip("\r\n")
                        part = []
                        for line in io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n"):
                            part.append(line.rstrip("\r\n"))
                            if len(part) == 20_000:
                                yield pd.DataFrame({"head": head, "value": part})
                                part = []
                        if part:
                            yield pd.DataFrame({"head": head, "value": part})

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, T.StructType.fromDDL("head string, value string"))
    head = raw.select("head").first()
    names = head[0].split("\t") if head else []
    cells = F.split("value", "\t")
    return raw.select(*[F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)], F.lit(period).alias("DATASET_PERIOD"), F.lit(source).alias("SOURCE_ID"))


def read_xlsx_rows(spark: SparkSession, path: str, sheets: list[int] | None = (1,)) -> DataFrame:
    """The cells of workbooks (zip of XML), as ``path``, ``sheet`` (from 1), ``row``, ``cells`` (array of text); of the listed sheets, or of
    all (None). Each workbook is parsed by one task with the standard library."""
    from .workbook import sheet_rows

    ship(spark)
    wanted = None if sheets is None else list(sheets)

    def run(batches):
        import pandas as pd

        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                rows = list(sheet_rows(bytes(content), wanted))
                if not rows:
                    continue
                yield pd.DataFrame({"path": p, "sheet": [s for s, _, _ in rows], "row": [r for _, r, _ in rows], "cells": [c for _, _, c in rows]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, sheet int, row int, cells array<string>")


def forward_filled(rows: DataFrame, header_rows: int, group: str = "path", row: str = "row", cells: str = "cells") -> DataFrame:
    """Heads of several rows as one row per column: an empty head takes the one to its left (merged cells), and the rows are joined by
    `` / ``. ``group``, ``column`` (from 0), ``head``. Only head rows are looked at."""
    h = rows.filter(F.col(row) <= header_rows).select(group, row, F.posexplode_outer(cells).alias("column", "text"))
    w = Window.partitionBy(group, row).orderBy("column").rowsBetween(Window.unboundedPreceding, 0)
    filled = h.withColumn("text", F.last(F.nullif(F.trim("text"), F.lit("")), ignorenulls=True).over(w)).filter(F.col("text").isNotNull())
    per = filled.groupBy(group, "column").agg(F.sort_array(F.collect_list(F.struct(row, "text"))).alias("x"))  # at most header_rows each
    return per.select(group, "column", F.array_join(F.array_distinct(F.transform("x", lambda e: e["text"])), " / ").alias("head"))


def read_tar_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """The text members of tar archives (plain or compressed), line by line: ``path``, ``member``, ``line`` (from 0), ``value``. Every
    archive is opened by one task."""
    import io
    import tarfile

    ship(spark)

    def run(batches):
        import pandas as pd

        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    for m in t:
                        if m.isfile() and m.name.endswith(suffix):
                            lines = t.extractfile(m).read().decode("utf-8", "replace").splitlines()
                            if not lines:
                                continue
                            yield pd.DataFrame({"path": p, "member": m.name, "line": range(len(lines)), "value": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, line int, value string")
