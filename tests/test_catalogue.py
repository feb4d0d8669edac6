"""The search ladder, gates, pages and censuses on a small catalogue."""

import pytest

from longtide import errors
from longtide.operators import catalogue as C
from longtide.operators import rollups

from .conftest import rows

SCHEMA = "series_id string, source_id string, title string, geography string, category string, frequency string, license_id string, metadata string, end_date string"


@pytest.fixture(scope="module")
def cat(spark):
    return spark.createDataFrame([
        ("ecb:EXR.USD", "ecb", "Exchange rate, US dollar", "Euro area", None, "D", None, '{"titles": {"es": "Tipo de cambio"}}', "2024-01-01"),
        ("ecb:HICP", "ecb", "Harmonised prices 100% total", None, None, "M", None, None, "2950-01-01"),
        ("bls:CUUR", "bls", "Consumer prices", "United States", None, "M", "open", "bad", None),
        ("bls:abc", "bls", None, None, None, None, None, None, "x"),
    ], SCHEMA)


@pytest.mark.parametrize("query,source,stage,ids", [
    ("ecb", None, "source", ["ecb:EXR.USD", "ecb:HICP"]), ("ecb:EX", None, "id", ["ecb:EXR.USD"]), ("PRICES consumer", None, "terms", ["bls:CUUR"]), ("cuur", None, "code", ["bls:CUUR"]), ("us doll", None, "prefix", ["ecb:EXR.USD"]),
    ("zzz", None, "none", []), ("", None, "none", []), ("100% t", "ecb", "like", ["ecb:HICP"]), ("prices", "ecb", "terms", ["ecb:HICP"]), ("prices", "nowhere", "none", []), ("'; --", None, "none", [])])
def test_ladder(cat, query, source, stage, ids):
    df, name = C.search(cat, query, source)
    assert name == stage and [r["series_id"] for r in df.collect()] == ids


def test_pages_counts_titles(cat):
    assert [r["series_id"] for r in C.page(cat, "series_id", 2, 1).collect()] == ["bls:abc", "ecb:EXR.USD"]
    assert C.page(cat, "series_id", 0, -5).count() == 1
    assert tuple(C.capped_count(cat, 3).first()) == (3, True) and tuple(C.capped_count(cat, 4).first()) == (4, False)
    assert [r[0] for r in cat.orderBy("series_id").select(C.localised_title("es")).collect()] == ["Consumer prices", None, "Tipo de cambio", "Harmonised prices 100% total"]
    with pytest.raises(errors.UnsupportedFilter):
        C.localised_title("de")
    assert rows(C.data_through(cat).select("source_id", "n_series")) == [("bls", 2), ("ecb", 2)]


def test_reasons_fail_closed(spark, cat):
    asked = spark.createDataFrame([("ecb:HICP",), ("bls:CUUR",), ("x:1",), ("bls:abc",)], "series_id string")
    gates = spark.createDataFrame([("ecb:HICP", "open"), ("bls:CUUR", "unknown"), ("bls:abc", "open")], "series_id string, gate string")
    served = spark.createDataFrame([("ecb:HICP",)], "series_id string")
    got = C.bundle_reasons(asked, cat, gates, served.limit(0), served)
    assert {r[0]: r[2] for r in got.collect()} == {"ecb:HICP": "ok", "bls:CUUR": "gate", "x:1": "not_found", "bls:abc": "not_migrated"}
    closed = C.bundle_reasons(asked, cat, gates, None, served)
    assert "ok" not in {r[2] for r in closed.collect()}


def test_census_says_how(spark):
    df = spark.range(3000).selectExpr("if(id < 100, 'small', 'big') AS g", "cast(id AS string) AS k")
    got = {r[0]: tuple(r)[1:] for r in rollups.distinct_census(df, "g", "k", ceiling=500).collect()}
    assert got["small"] == (100, "exact", 100) and got["big"][1] == "hll" and abs(got["big"][0] - 2900) < 300


def test_unmapped_codes_are_refused(spark):
    df = spark.createDataFrame([("A", "B", 2020, 5), ("A", "Z", 2020, None)], "a string, b string, y int, v int")
    with pytest.raises(errors.SchemaRefusal):
        rollups.bilateral_totals(df, "a", "b", "y", {"tv": "v"}, spark.createDataFrame([("A",), ("B",)], "code string"))
    assert rollups.bilateral_totals(df, "a", "b", "y", {"tv": "v"}).count() == 1
    with pytest.raises(errors.UnsupportedFilter):
        C.label_join(df, spark.createDataFrame([("A", "x")], "b string, l string"), "b", "l")
