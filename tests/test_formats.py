"""Parsers, periods, spans, streaming, delivery and the connector contract on small inputs."""

import json
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from longtide import errors
from longtide.functions import periods as P
from longtide.operators import delivery, freshness, series, timejoin
from longtide.sources import formats, stores
from longtide.streaming import upsert

from .conftest import rows

D = date


@pytest.mark.parametrize("code,want", [
    ("2020", D(2020, 12, 31)), ("2020M02", D(2020, 2, 1)), ("2020m13", None), ("2020-07", D(2020, 7, 1)), ("202007", D(2020, 7, 1)), ("202013", None), ("2020Q3", D(2020, 7, 1)), ("2020k4", D(2020, 10, 1)), ("2020Q5", None),
    ("2020H2", D(2020, 7, 1)), ("2020H3", None), ("2020W53", D(2020, 12, 28)), ("2021W53", None), ("2021W01", D(2021, 1, 4)), ("2024-02-30", None), ("2024-02-29", D(2024, 2, 29)), ("2010M01D05", D(2010, 1, 5)), ("2010M02D30", None),
    ("2003-2004", D(2003, 12, 31)), ("1990-2000", None), ("11", None), ("", None), (None, None), (" 2020 ", D(2020, 12, 31)), ("0980", D(980, 12, 31)), ("0000", None)])
def test_table_period(spark, code, want):
    assert spark.createDataFrame([(code,)], "c string").select(P.table_period(F.col("c"))).first()[0] == want


def test_other_periods(spark):
    sdmx = {"2020": D(2020, 12, 31), "2020-03": D(2020, 3, 1), "2020-Q2": D(2020, 4, 1), "2020-S2": D(2020, 7, 1), "2020-W10": D(2020, 3, 2), "2020-01-31": D(2020, 1, 31), "2020-A1": D(2020, 12, 31), "x": None}
    df = spark.createDataFrame([(k,) for k in sdmx], "c string")
    assert {r[0]: r[1] for r in df.select("c", P.sdmx_period(F.col("c"))).collect()} == sdmx
    tsv = {"2020": (D(2020, 1, 1), "A"), "2020-Q2": (D(2020, 4, 1), "Q"), "2020-S2": (D(2020, 7, 1), "S"), "2020-12": (D(2020, 12, 1), "M"), "2020-W10": (D(2020, 3, 2), "W"), "2020-02-30": (None, None), "zz": (None, None)}
    df = spark.createDataFrame([(k,) for k in tsv], "c string")
    assert {r[0]: tuple(r[1]) for r in df.select("c", P.tsv_period(F.col("c"))).collect()} == tsv


def test_sdmx_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("DATAFLOW,FREQ,GEO,TIME_PERIOD,OBS_VALUE,OBS_STATUS\nX,A,DE,2020,1.5,A\nX,A,,2021,2,A\nX,A,FR,2020,NaN,A\nX,A,FR,bad,3,A\nX,A,FR,2020-Q2,abc,A\n")
    assert rows(formats.read_sdmx_csv(spark, str(p))) == [("FREQ=A", D(2021, 12, 31), 2.0), ("FREQ=A:GEO=DE", D(2020, 12, 31), 1.5)]
    p.write_text("a,b\n1,2\n")
    assert formats.read_sdmx_csv(spark, str(p)).count() == 0


def test_sdmx_tsv(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text("freq,geo\\TIME_PERIOD\t2020 \t2021-Q1 \nA,DE\t57.8\t7 p\nA,FR\t: b\t0:42 u\nA,IT\t:\t\n")
    got = rows(formats.read_sdmx_tsv(spark, str(p)))
    assert ("freq=A:geo=DE", D(2021, 1, 1), "Q", 7.0, ["p"]) in got and ("freq=A:geo=DE", D(2020, 1, 1), "A", 57.8, []) in got
    assert ("freq=A:geo=FR", D(2020, 1, 1), "A", None, ["b"]) in got and ("freq=A:geo=FR", D(2021, 1, 1), "Q", None, ["u", "raw=0:42"]) in got and len(got) == 5


def test_sdmx_xml(spark, tmp_path):
    p = tmp_path / "a.xml"
    p.write_text('<D><DataSet><Series FREQ="A" GEO="DE"><Obs TIME_PERIOD="2020" OBS_VALUE="1"/><Obs TIME_PERIOD="2021" OBS_VALUE="NaN"/></Series><Series FREQ="A" GEO="FR"><Obs TIME_PERIOD="2020" OBS_VALUE="3"/></Series></DataSet></D>')
    assert rows(formats.read_sdmx_xml(spark, str(p))) == [("FREQ=A:GEO=DE", D(2020, 12, 31), 1.0), ("FREQ=A:GEO=FR", D(2020, 12, 31), 3.0)]


def test_sdmx_generic_xml(spark, tmp_path):
    p = tmp_path / "g.xml"
    one = '<g:Obs><g:ObsDimension value="{}"/><g:ObsValue value="{}"/></g:Obs>'
    p.write_text('<m:D xmlns:m="m" xmlns:g="g"><m:DataSet><g:Series><g:SeriesKey><g:Value id="FREQ" value="Q"/><g:Value id="GEO" value="DE"/></g:SeriesKey>' + one.format("2020-Q2", "1.5") + one.format("2020-Q3", "NaN") + one.format("x", "2") + "</g:Series></m:DataSet></m:D>")
    assert rows(formats.read_sdmx_generic_xml(spark, str(p))) == [("FREQ=Q:GEO=DE", D(2020, 4, 1), 1.5)]


def test_jsonstat(spark):
    cube = {"id": ["sex", "time"], "size": [2, 2], "value": [1, 2, None, 4], "dimension": {"sex": {"category": {"index": {"F": 1, "M": 0}}}, "time": {"category": {"index": ["2020", "2021"]}}}}
    df = spark.createDataFrame([(json.dumps(cube),)], "text string")
    assert rows(formats.jsonstat_rows(df, "time")) == [("sex=F", D(2021, 12, 31), 4.0), ("sex=M", D(2020, 12, 31), 1.0), ("sex=M", D(2021, 12, 31), 2.0)]


def test_companyfacts(spark):
    doc = {"cik": "7", "facts": {"gaap": {"Rev": {"units": {"USD": [{"end": "2020-12-31", "val": 5, "filed": "2021-02-01"}, {"end": "2020-12-31", "val": 6, "filed": "2021-03-01"}, {"end": "x", "val": 1, "filed": None}]}}}}}
    df = spark.createDataFrame([(json.dumps(doc),)], "text string")
    assert rows(formats.companyfacts_rows(df)) == [("7.Rev.USD", D(2020, 12, 31), 5.0, D(2021, 2, 1)), ("7.Rev.USD", D(2020, 12, 31), 6.0, D(2021, 3, 1))]


def test_resolve_time(spark):
    data = [("t", "region", c) for c in ("0101", "9999", "12")] + [("t", "aika", c) for c in ("2020M01", "2020M02")] + [("u", "year", c) for c in ("2020", "total", "all")] + [("v", "x", "a")]
    got = formats.resolve_time(spark.createDataFrame(data, "table_id string, dim string, code string"))
    assert [(r[0], r[1], r[3]) for r in got.orderBy("table_id").collect()] == [("t", "aika", "rate"), ("u", "year", "name")]


def test_zip_and_workbook(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("T.tsv", "A\tB\n1\t\n2\tx\n")
    assert rows(formats.read_zipped_tables(spark, str(tmp_path / "z.zip"), "T.tsv", "2020Q1", "s")) == [("1", None, "2020Q1", "s"), ("2", "x", "2020Q1", "s")]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>hi</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row></sheetData></worksheet>')
    assert [(r["row"], r["cells"]) for r in formats.read_xlsx_rows(spark, str(tmp_path / "w.xlsx")).collect()] == [(1, ["hi", None, "5"])]
    

def test_spans_and_joins(spark):
    df = spark.createDataFrame([(D(2024, 2, 29),)], "d date")
    s = lambda g, st: tuple(df.select(timejoin.span(F.col("d"), g, st).alias("s")).select("s.*").first())
    assert s("daily", "date") == (D(2024, 2, 29), D(2024, 3, 1)) and s("monthly", "end") == (D(2024, 2, 1), D(2024, 3, 1)) and s("annual", "end") == (D(2023, 3, 1), D(2024, 3, 1))
    for bad in (("mixed", "start"), ("monthly", "mid"), ("monthly", "date")):
        with pytest.raises(errors.GrainRefusal):
            timejoin.span(F.col("d"), *bad)
    left = spark.createDataFrame([("a", D(2024, 2, 29)), ("a", D(2024, 3, 1)), (None, D(2024, 3, 1))], "k string, obs_date date")
    right = spark.createDataFrame([("a", D(2024, 2, 29), 5.0)], "k string, obs_date date, value double")
    got = timejoin.same_period(left, right, left_grain="daily", left_stamp="date", right_grain="monthly", right_stamp="end", on=["k"])
    assert rows(got.select("k", "obs_date", "period_value")) == sorted([("a", D(2024, 2, 29), 5.0), ("a", D(2024, 3, 1), None), (None, D(2024, 3, 1), None)], key=repr)
    with pytest.raises(errors.GrainRefusal):
        timejoin.same_period(left, right, left_grain="monthly", left_stamp="start", right_grain="daily", right_stamp="date")
    done = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 1, 31), D(2024, 2, 15)), ("a", D(2024, 2, 1), D(2024, 2, 29), D(2024, 2, 15)), ("b", D(2024, 1, 1), D(2024, 1, 31), None), ("c", D(2024, 3, 1), D(2024, 3, 31), D(2024, 2, 1))], "k string, s date, l date, t date")
    assert rows(timejoin.last_complete(done, by="k", start="s", last_day="l", through="t")) == [("a", False), ("b", None)]


def test_freshness_rules(spark):
    now = F.lit("2024-01-13 12:00:00").cast("timestamp")  # a Saturday
    df = spark.createDataFrame([(datetime(2024, 1, 12),), (datetime(2024, 1, 10),), (datetime(2023, 12, 30),), (datetime(2025, 1, 1),), (None,)], "t timestamp")
    assert [r[0] for r in df.select(freshness.business_age_days(F.col("t"), now)).collect()] == [1.0, 3.0, 10.0, 0.0, None]
    assert [r[0] for r in spark.range(1, 8).select(freshness.retry_wait_hours(F.col("id"))).collect()] == [12.0, 24.0, 48.0, 96.0, 192.0, 384.0, 384.0]


def test_series_rules(spark):
    reg = series.Registry(lambda s, n: series.Resolution(f"{s}.parquet", "series_key", series.grain("series_key", n)))

    @reg.rule("flat")
    def flat(source, native):
        return series.Resolution(f"{native}.parquet", "k", stamp=native)

    assert reg.resolve("flat:x").stamp == "x" and reg.resolve("o:AB").path == "o.parquet" and reg.sources() == ["flat"]
    with pytest.raises(errors.NotFound):
        reg.resolve("nothing")
    df = spark.createDataFrame([("AB",), ("AB:1",), ("ABC",)], "series_key string")
    assert rows(df.filter(reg.resolve("o:AB").predicate)) == [("AB",), ("AB:1",)]
    assert rows(df.filter(series.id_range("series_key", "AB:"))) == [("AB:1",)]
    cat = spark.createDataFrame([("p:d:1", None, None, None, "d", "p", "M"), ("p:e", None, None, None, None, "p", "A")], "series_id string, title string, unit string, geography string, category string, source_id string, frequency string")
    assert rows(series.mask(cat, "p", "d")) == [("p:d:1",)] and series.mask(cat, "p", frequency=[]).count() == 0
    with pytest.raises(errors.UnsupportedFilter):
        series.mask(cat, "p", colour=["x"])


def test_stream_upsert(spark, tmp_path):
    src, path = tmp_path / "in", str(tmp_path / "store")
    schema = "series_key string, obs_date date, value double"
    for i, data in enumerate(([("a", D(2020, 1, 1), 1.0)], [("a", D(2020, 1, 1), 2.0), ("b", D(2020, 1, 1), 1.0)])):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(str(src))
        upsert.upsert_stream(spark.readStream.schema(schema).json(str(src)), path, str(tmp_path / "cp"), changed_path=str(tmp_path / "changed")).awaitTermination()
        assert i < 2
    assert rows(spark.read.parquet(path)) == [("a", D(2020, 1, 1), 2.0), ("b", D(2020, 1, 1), 1.0)]
    assert spark.read.parquet(str(tmp_path / "changed")).count() == 3
    ev = spark.createDataFrame([(datetime(2020, 1, 1, 0, 1), "a", 1.0), (datetime(2020, 1, 1, 0, 6), "a", 2.0)], "t timestamp, k string, value double")
    assert upsert.windowed_activity(ev, "t", "5 minutes", "10 minutes", ["k"]).count() == 2


def test_delivery(spark, tmp_path):
    tidy = spark.createDataFrame([("s:a", "s", D(2020, 1, 1), 1.0), ("s:b", "s", D(2020, 1, 1), None), ("t:c", "t", D(2020, 1, 1), 3.0)], "series_id string, source string, obs_date date, value double")
    told = delivery.write_bundle(spark, tidy, str(tmp_path / "b"), unresolved=["x"])
    assert told["sources"] == {"s": {"rows": 2, "series": 2}, "t": {"rows": 1, "series": 1}}
    assert delivery.pull_bundle(spark, str(tmp_path / "b")).count() == 3
    f = next((tmp_path / "b" / "data").rglob("*.parquet"))
    f.with_name(f".{f.name}.crc").unlink()
    f.write_bytes(f.read_bytes()[:-4] + b"XXXX")
    with pytest.raises(errors.LongtideError):
        delivery.pull_bundle(spark, str(tmp_path / "b"))
    with pytest.raises(errors.EmptyRefusal):
        delivery.write_csv(tidy.limit(0), str(tmp_path / "c"))
    delivery.write_csv(tidy.drop("source"), str(tmp_path / "c"))
    good = tmp_path / "g.csv"
    good.write_text("# series: a\nseries_id,obs_date,value\na,2020-01-01,1\n# complete rows=1\n")
    assert delivery.read_csv(spark, str(good)).count() == 1
    for bad in ("series_id,obs_date,value\na,2020-01-01,1\n", "series_id,obs_date,value\na,2020-01-01,1\n# complete rows=2\n"):
        good.write_text(bad)
        with pytest.raises(errors.LongtideError):
            delivery.read_csv(spark, str(good))


def test_stores_and_connector(spark, tmp_path):
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    a.coalesce(1).write.parquet(str(tmp_path / "x.parquet"))
    a.withColumn("w", F.lit(2)).coalesce(1).write.parquet(str(tmp_path / "_live/x.parquet"))
    assert stores.with_live_half(spark, str(tmp_path), "x").count() == 2
    with pytest.raises(errors.NotFound):
        stores.with_live_half(spark, str(tmp_path), "y")
    assert [r["_row"] for r in stores.with_position(spark.read.parquet(str(tmp_path / "x.parquet"))).collect()] == [0]

    class Two(stores.Connector):
        def discover(self):
            return [stores.SeriesMeta("x:1", "one"), stores.SeriesMeta("x:2", "two")]

        def fetch(self, series_id, since):
            yield D(2020, 1, 1), float(series_id[-1])

    spark.dataSource.register(Two().as_source("two"))
    assert rows(spark.read.format("two").load()) == [("x:1", D(2020, 1, 1), 1.0), ("x:2", D(2020, 1, 1), 2.0)]
    assert Two().catalogue(spark).count() == 2


def test_core_stands_without_llm():
    import subprocess
    import sys

    code = "import sys; sys.modules['longtide.llm'] = None; import __spark_entry__ as e; assert not any(n.startswith(('p2', 'p6', 'p7', 'p8')) for n in e.queries()); assert 'p1_found' in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 2)[0])
