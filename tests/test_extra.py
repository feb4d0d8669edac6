"""Conflicts, splits, drifting types, lookups, leases, publishing and many-flow updates on small tables with nulls, ties and clashing names."""

import io
import tarfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from longtide import errors, session, update
from longtide.library import Library
from longtide.operators import audits, catalogue, copies, delivery, freshness, merge, rollups, series, timejoin
from longtide.sources import formats, stores

from .conftest import rows

D = date(2024, 1, 1)


def test_conflicting_rows(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 1.0, "y"), ("b", 1.0, "x"), ("b", None, "x"), (None, 1.0, "x"), (None, 2.0, "x")], "k string, v double, n_values string")
    assert rows(audits.conflicting_rows(df, ["k"], "v").select("k", "v")) == sorted([("b", 1.0), ("b", None), (None, 1.0), (None, 2.0)], key=repr)
    assert audits.conflicting_rows(df.limit(0), ["k"], "v").count() == 0


@pytest.mark.parametrize("left,right,a,b,same", [
    ("bigint", "int", 9007199254740993, 5, False), ("bigint", "double", 3, 3.0, True), ("double", "double", -0.0, 0.0, True), ("double", "string", 1.5, "1.50", True), ("double", "string", 1.5, "x", False), ("date", "timestamp", D, datetime(2024, 1, 1), True),
    ("date", "timestamp", D, datetime(2024, 1, 1, 9, 30), False), ("string", "date", "2024-01-01", D, True), ("binary", "binary", b"\x00", b"\x00", True), ("string", "string", "a", "A", False), ("bigint", "bigint", 9007199254740993, 9007199254740992, False)])
def test_comparable(spark, left, right, a, b, same):
    la, rb = copies.comparable("v", left, right)
    x = spark.createDataFrame([(a,)], f"v {left}").select(la.alias("t")).first()[0]
    y = spark.createDataFrame([(b,)], f"v {right}").select(rb.alias("t")).first()[0]
    assert (x == y) == same
    assert spark.createDataFrame([(None,)], f"v {left}").select(la.alias("t")).first()[0] is None


def test_split_plan(spark):
    df = spark.createDataFrame([(f"c{i % 3}", f"d{i % 4}", f"code{i:04d}") for i in range(240)], "a string, b string, c string")
    assert rows(rollups.split_plan(df, ["a", "b"], 80)) == [("a", 0, 3, 80)]
    assert rows(rollups.split_plan(df, ["a", "b"], 60)) == [("b", 0, 4, 60)]
    assert rows(rollups.split_plan(df, ["a", "b"], 20)) == [("a+b", 0, 12, 20)]
    assert rollups.split_plan(df, ["a", "b"], 1).count() == 0 == rollups.split_plan(df.limit(0), ["a", "b"], 5).count()
    tilde = df.withColumn("a", F.concat("a", F.lit("~x")))
    assert rollups.split_plan(tilde, ["a", "b"], 20).count() == 0
    assert rows(rollups.split_plan(df.withColumn("c", F.concat("b", "c")).select("c", F.lit("z").alias("z")), ["c", "z"], 240))[0][0] == "c"


def test_rings_and_leases(spark):
    df = spark.createDataFrame([(x,) for x in "bca"], "name string")
    first = {d: freshness.daily_ring(df, "name", d).filter("place = 1").first()[0] for d in range(6)}
    assert first == {0: "a", 1: "b", 2: "c", 3: "a", 4: "b", 5: "c"}
    ring = spark.createDataFrame([("aa",), ("z",)], "name string")
    assert [r[0] for r in freshness.daily_ring(df, "name", 4, ring).orderBy("place").collect()] == ["a", "b", "c"]
    held = spark.createDataFrame([("k1", "o1", datetime(2024, 1, 2)), ("k2", "o1", datetime(2023, 1, 1)), ("k3", "o2", datetime(2024, 1, 2))], "key string, owner string, expires timestamp")
    asked = spark.createDataFrame([("k1", "o2"), ("k2", "o2"), ("k2", "o3"), ("k3", "o2"), ("k4", "o9"), (None, "o1")], "key string, owner string")
    got = {r["key"]: (r["owner"], r["claimed"]) for r in freshness.claim_leases(held, asked, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert got == {"k1": ("o1", False), "k2": ("o2", True), "k3": ("o2", True), "k4": ("o9", True)}


def test_containing_period(spark):
    left = spark.createDataFrame([("a", date(2024, 1, 14)), ("a", date(2024, 1, 15)), ("a", date(2024, 1, 20)), (None, date(2024, 1, 20)), ("a", None)], "k string, obs_date date")
    right = spark.createDataFrame([("a", date(2024, 1, 15), 5.0), ("a", date(2024, 1, 15), 4.0), ("a", None, 9.0)], "k string, obs_date date, value double")
    got = timejoin.containing_period(left, right, left_grain="daily", left_stamp="date", right_grain="monthly", right_stamp="start", on=["k"])
    assert rows(got) == sorted([("a", date(2024, 1, 14), None), ("a", date(2024, 1, 15), 5.0), ("a", date(2024, 1, 20), 5.0), (None, date(2024, 1, 20), None), ("a", None, None)], key=repr)
    with pytest.raises(errors.GrainRefusal):
        timejoin.containing_period(left, right, left_grain="annual", left_stamp="start", right_grain="daily", right_stamp="date")


def test_catalogue_lookups(spark):
    cat = spark.createDataFrame([("s:A:1", "s", "Hotel nights, monthly average", None), ("s:A:2", "s", "Average monthly hotel", "Ort"), ("s:AB", "s", None, None), (None, "s", "x", None)], "series_id string, source_id string, title string, geography string")
    assert rows(catalogue.match_phrases(cat, 'hotel "monthly average"').select("series_id")) == [("s:A:1",)] and catalogue.match_phrases(cat, "hotel").count() == 0 == catalogue.match_phrases(cat, '""').count()
    index = catalogue.inverted_index(cat)
    assert rows(catalogue.match_index(index, cat, "Hotel AVERAGE hotel").select("series_id")) == [("s:A:1",), ("s:A:2",)] and catalogue.match_index(index, cat, "?!").count() == 0
    changed = spark.createDataFrame([("s:A",), ("s:AB",), ("s:no",), (None,)], "series_key string")
    assert rows(catalogue.catalogue_expansions(changed, cat)) == [("s:A", "s:A:1"), ("s:A", "s:A:2"), ("s:AB", "s:AB")]
    a, b = (spark.createDataFrame([(x,) for x in xs], "series_id string") for xs in ("cab", "ab"))
    assert [r[0] for r in catalogue.merge_shards([a, b], limit=3, offset=1).collect()] == ["b", "c", "a"]
    why = catalogue.bundle_reasons(spark.createDataFrame([("x",), ("s:A:1",)], "series_id string"), cat, spark.createDataFrame([("x", "closed"), ("s:A:1", "open")], "series_id string, gate string"), None, cat)
    assert rows(why.select("series_id", "reason")) == [("s:A:1", "withheld"), ("x", "gate")]
    assert rows(catalogue.manifest(why).select("series_id", "n_series")) == [("s:A:1", 1), ("x", 1)]


def test_publishing_recovers(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "series_key string, obs_date date, value double"
    a = spark.createDataFrame([("a", D, 1.0), (None, D, 2.0), ("b", None, 3.0)], schema)
    merge.merge_and_write(spark, path, a)
    (tmp_path / "store").rename(tmp_path / "store.old")  # broken off between the two moves
    spark.createDataFrame([("a", D, 7.0)], schema).write.parquet(f"{path}.ready")
    assert merge.recover(spark, path) and rows(spark.read.parquet(path)) == [("a", D, 7.0)] and not (tmp_path / "store.old").exists()
    assert not merge.recover(spark, path)
    with pytest.raises(errors.ReportRefusal):
        merge.merge_and_write(spark, path, a, report_changed=True, report_cap=2)
    assert merge.merge_and_write(spark, path, a, report_changed=True, report_cap=3)[0] == 3
    for bad in (a.unionByName(a), a.drop("value").withColumn("other", F.lit(1.0))):
        with pytest.raises(errors.SchemaRefusal):
            merge.keep_served(a, bad)
    text = spark.createDataFrame([("a", "2024-1-1", 1.0)], "series_key string, obs_date string, value double")
    with pytest.raises(errors.SchemaRefusal):
        merge.keep_served(text, text)


def test_series_by_bucket(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i % 7}", date(2024, 1, 1 + i % 28), float(i)) for i in range(100)] + [(None, D, 0.0)], "series_key string, obs_date date, value double")
    delivery.write_by_series(df, str(tmp_path / "s"), buckets=5)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 101 and len(list((tmp_path / "s").glob("bucket=*"))) <= 5
    assert rows(delivery.read_series(spark, str(tmp_path / "s"), "k3", buckets=5)) == rows(df.filter("series_key = 'k3'"))


def test_sources(spark, tmp_path):
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        for name, body in (("a.txt", b"one\ntwo"), ("b.bin", b"x"), ("empty.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert rows(formats.read_tar_members(spark, str(tmp_path / "t.tar.gz"), ".txt").select("member", "line", "value")) == [("a.txt", 0, "one"), ("a.txt", 1, "two")]
    heads = spark.createDataFrame([("p", 1, ["R", None, "S", ""]), ("p", 2, ["a", "b", "c", "d"]), ("p", 3, ["1", "2", "3", "4"])], "path string, row int, cells array<string>")
    assert rows(formats.forward_filled(heads, 2).select("column", "head")) == [(0, "R / a"), (1, "R / b"), (2, "S / c"), (3, "S / d")]
    spark.createDataFrame([(1, D), (2, None)], "k int, obs_date date").coalesce(1).write.parquet(str(tmp_path / "f"))
    assert rows(stores.footer_stats(spark, str(tmp_path / "f")).select("n_rows", "last_date")) == [(2, D)]
    assert rows(stores.footer_stats(spark, str(tmp_path / "f"), "other").select("n_rows", "last_date")) == [(2, None)]


def test_thousands_of_ids_are_one_join(spark, tmp_path):
    spark.createDataFrame([(f"K{i}:x", D, float(i)) for i in range(3000)], "series_key string, obs_date date, value double").write.parquet(str(tmp_path / "p.parquet"))
    cat = spark.createDataFrame([(f"p:K{i}", "p", "free", "M") for i in range(3000)], "series_id string, source_id string, license_id string, frequency string")
    lib = Library(spark, str(tmp_path), cat.withColumn("category", F.lit(None).cast("string")), spark.createDataFrame([("p", "P", "free", D, None)], "source_id string, name string, license_id string, added_on date, removed_on date"),
                  spark.createDataFrame([("free", "F", 1, D, None)], "license_id string, name string, reservable int, added_on date, removed_on date"))
    assert lib.fetch("p").frame.count() == 3000
    assert lib.fetch_ids([f"p:K{i}" for i in range(0, 3000, 2)])[0].count() == 1500
    reg = series.Registry(lambda s, n: series.Resolution(str(tmp_path / "p.parquet"), "series_key", series.grain("series_key", n)))
    assert Library(spark, str(tmp_path), cat, cat, cat, reg).fetch_ids([f"p:K{i}" for i in range(1200)])[0].count() == 1200


def test_many_flows(spark, tmp_path):
    obs = "series_key string, obs_date date, value double"
    catalogue_ = spark.createDataFrame([("f1", "v1", 1), ("f2", "v1", 2), ("f3", "v2", 3), ("f4", "v1", 4)], "flow_id string, vintage string, position int")
    state = spark.createDataFrame([("f1", "v1", "ok"), ("f3", "v1", "ok"), ("f4", "v1", "failed")], "flow_id string, vintage string, status string")
    fetched = []

    def fetch_flow(flow):
        fetched.append(flow)
        return spark.createDataFrame([(flow, D, 1.0)] if flow != "f4" else [], obs)

    unit = update.Unit("s", "u", str(tmp_path / "u"), "giant_changed_units", lambda since: spark.createDataFrame([], obs), vintage=lambda: "t2", flows=lambda: (catalogue_, state, 10), fetch_flow=fetch_flow)
    r = update.STRATEGIES["giant_changed_units"](spark, unit, update.State(vintage="t1"))
    assert fetched == ["f2", "f3", "f4"] and r.status == "partial" and r.vintage == "t1" and r.rows == 2 and r.changed.count() == 2
    assert update.STRATEGIES["giant_changed_units"](spark, unit, update.State(vintage="t2")).status == "no_change"


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        class O:
                            isDefined = staticmethod(lambda: False)

                        return O

                return S

    class Fake:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(errors.LongtideError):
        session.shared_dir(Fake)
