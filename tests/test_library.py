"""The front and the update loop on small stores."""

from datetime import date, datetime, timedelta

import pytest

from longtide import errors, update
from longtide.library import Library, LicenceRefusal

from .conftest import rows

D = date(2024, 1, 1)
OBS = "series_key string, obs_date date, value double"


@pytest.fixture(scope="module")
def lib(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    spark.createDataFrame([("A", D, 1.0), ("A:DE", D, 2.0), ("A:DE", date(2024, 2, 1), 3.0), ("B", D, 9.0), ("AB", D, 7.0)], OBS).write.parquet(f"{root}/ecb.parquet")
    cat = spark.createDataFrame([("ecb:A", "ecb", "Alpha", None, "fx", "M", None, None, "2024-02-01", None), ("ecb:B", "ecb", "Beta", None, "fx", "Q", "shut", None, None, None), ("bls:C", "bls", "Gamma", None, None, "M", None, None, None, None), ("gone:D", "gone", "Delta", None, None, "M", "free", None, None, None)],
                                "series_id string, source_id string, title string, geography string, category string, frequency string, license_id string, metadata string, end_date string, unit string")
    src = spark.createDataFrame([("ecb", "Bank", "free", None, D, None), ("bls", "Bureau", None, None, D, None), ("gone", "Gone", "free", None, D, None)], "source_id string, name string, license_id string, homepage string, added_on date, removed_on date")
    lic = spark.createDataFrame([("free", "Free", 1, 1, None, D, None), ("shut", "Shut", 0, 0, None, D, None)], "license_id string, name string, reservable int, commercial_ok int, url string, added_on date, removed_on date")
    return Library(spark, root, cat, src, lic)


def test_find(lib):
    assert lib.get_series("ecb:A")["title"] == "Alpha" and lib.get_source("ecb")["name"] == "Bank" and lib.get_license("shut")["reservable"] == 0
    assert [r["series_id"] for r in lib.search("alpha").collect()] == ["ecb:A"] and lib.list_sources().count() == 3
    for f, x in ((lib.get_series, "no:X"), (lib.get_source, "no"), (lib.get_license, "no")):
        with pytest.raises(errors.NotFound):
            f(x)


def test_fetch(lib):
    got = lib.fetch("ecb")
    assert rows(got.frame.select("series_id", "obs_date", "value")) == [("ecb:A", D, 1.0), ("ecb:A:DE", D, 2.0), ("ecb:A:DE", date(2024, 2, 1), 3.0)]
    assert got.closed == ["ecb:B"] and got.unresolved == []
    assert lib.fetch("bls").closed == ["bls:C"] and lib.fetch("gone").unresolved == ["gone:D"] and lib.fetch("ecb", frequency=[]).frame.count() == 0
    assert sorted(lib.fetch("ecb", "A", wide=True).frame.columns) == ["ecb:A", "ecb:A:DE", "obs_date"]


def test_csv_and_bundle(lib, tmp_path):
    head, lines = lib.series_csv("ecb:A", start="2024-01-15", geo="DE")
    assert head[-1] == "# complete rows=1" and [r["line"] for r in lines.collect()] == ["ecb:A:DE,2024-02-01,3.0"]
    for bad, err in (({"series_id": "ecb:B"}, LicenceRefusal), ({"series_id": "no:X"}, errors.NotFound), ({"series_id": "ecb:A", "freq": "M"}, errors.UnsupportedFilter), ({"series_id": "ecb:A", "geo": "XX"}, errors.NotFound), ({"series_id": "gone:D"}, errors.NotFound)):
        with pytest.raises(err):
            lib.series_csv(**bad)
    told = lib.bundle(["ecb:A", "ecb:B", "no:X", "gone:D"], str(tmp_path / "b"))
    assert told["unresolved"] == ["ecb:B", "gone:D", "no:X"] and lib.pull(str(tmp_path / "b")).count() == 3


def test_update_loop(spark, tmp_path):
    now = datetime(2024, 3, 1)
    asked = []

    def fetch(since):
        asked.append(since)
        return spark.createDataFrame([("a", D + timedelta(days=len(asked)), 1.0)], OBS)

    token = ["v1"]
    units = [
        update.Unit("s1", "ext", str(tmp_path / "ext"), "extend_by_date", fetch, cadence="daily"),
        update.Unit("s2", "over", str(tmp_path / "over"), "overwrite_if_changed", lambda since: spark.createDataFrame([("a", D, 1.0)], OBS), lambda: token[0], "weekly"),
        update.Unit("s3", "bad", str(tmp_path / "bad"), "bulk_snapshot_if_changed", lambda since: 1 / 0, cadence="daily"),
        update.Unit("s4", "empty", str(tmp_path / "empty"), "overwrite_if_changed", lambda since: spark.createDataFrame([], OBS), cadence="daily"),
        update.Unit("s5", "hand", str(tmp_path / "hand"), "manual_vintage", fetch, lambda: None, "daily"),
    ]
    states, log = update.run_once(spark, units, {}, now, {"s1": 5000.0})
    assert {r["unit_id"]: r["status"] for r in log.collect()} == {"ext": "ok", "over": "ok", "bad": "transient_fail", "empty": "refused", "hand": "no_change"}
    assert log.orderBy("id").collect()[-1]["unit_id"] == "ext" and states["bad"].last_success is None
    states, log = update.run_once(spark, units, states, now + timedelta(days=1))
    assert {r["unit_id"] for r in log.collect()} == {"ext", "bad", "empty", "hand"}
    assert asked[-1] == states["ext"].last_date - timedelta(days=1) - timedelta(days=45) and spark.read.parquet(units[0].path).count() == 2
    states, log = update.run_once(spark, units, states, now + timedelta(days=8), force=True)
    assert {r["unit_id"]: r["status"] for r in log.collect()}["over"] == "no_change"
    token[0] = "v2"
    states, log = update.run_once(spark, units[1:2], states, now + timedelta(days=20))
    assert states["over"].vintage == "v2" and log.first()["status"] == "ok"


def test_cursors(spark):
    df = spark.createDataFrame([("a", D, 1.0), ("a", date(2024, 2, 1), 1.0), ("b", D, 1.0), (None, D, 1.0), ("c", None, 1.0)], OBS)
    c = update.cursors(df)
    assert rows(c) == [("a", "2024-02-01"), ("b", "2024-01-01")] and rows(update.cursors(df, cap=1)) == [("a", "2024-02-01")]
    assert rows(update.merge_cursors(c, spark.createDataFrame([("b", "2025-01-01"), ("d", "2020-01-01")], "series_key string, cursor string"), cap=2)) == [("a", "2024-02-01"), ("b", "2025-01-01")]
