"""The merge against a row-by-row model, refusals, publishing, and the comparisons of two vintages."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from longtide import errors
from longtide.operators import merge

from .conftest import rows

SCHEMA = "series_key string, obs_date date, value double, pos bigint"
DAY = date(2020, 1, 1)


def table(rng, n):
    return [(rng.choice([None, "a", "b", "c"]), rng.choice([None, *[DAY + timedelta(days=i) for i in range(6)]]), rng.choice([None, math.nan, 0.0, 1.0, 2.0]), i) for i in range(n)]


def same(a, b):
    return a == b or a is not None and b is not None and math.isnan(a) and math.isnan(b)


@pytest.mark.parametrize("seed", range(6))
def test_merge_is_model(spark, seed):
    rng = random.Random(seed)
    old, new = table(rng, rng.randrange(0, 90)), table(rng, rng.randrange(0, 50))
    rng.shuffle(old)
    win, base = {}, {}
    for r in sorted(old, key=lambda r: r[3]):
        win[r[:2]] = base[r[:2]] = r[2]
    changed = {}
    for r in sorted(new, key=lambda r: r[3]):
        win[r[:2]] = r[2]
    for k, v in win.items():
        if k not in base or not same(base[k], v):
            changed.setdefault(k[0], []).append(k[1])
    a, b = spark.createDataFrame(old, SCHEMA).repartition(3), spark.createDataFrame(new, SCHEMA).repartition(2)
    assert rows(merge.merge_keep_last(a, b, position="pos").select("series_key", "obs_date", "value")) == sorted(((*k, "NaN" if v is not None and math.isnan(v) else v) for k, v in win.items()), key=repr)
    want = [(k, max((d for d in ds if d is not None), default=None)) for k, ds in changed.items()]
    assert rows(merge.changed_keys(a, b, position="pos")) == sorted(want, key=repr)
    c = merge.merge_counts(a, b, position="pos").first()
    assert (c.n_existing or 0, c.n_incoming or 0, c.n_merged) == (len(old), len(new), len(win))


def test_schema_rules(spark):
    a = spark.createDataFrame([("a", DAY, 1.0, "n")], "series_key string, obs_date date, value double, note string")
    with pytest.raises(errors.SchemaRefusal):
        merge.merge_keep_last(a, a.drop("note"))
    wider = merge.merge_keep_last(a.drop("note"), spark.createDataFrame([("b", DAY, 2.0, "n")], a.schema))
    assert rows(wider.select("series_key", "note")) == [("a", None), ("b", "n")]


def test_merge_and_write(spark, tmp_path):
    path = str(tmp_path / "store")
    a = spark.createDataFrame([("a", DAY, 1.0), ("b", DAY, 2.0)], "series_key string, obs_date date, value double")
    assert merge.merge_and_write(spark, path, a)[:2] == (2, DAY)
    n, _, changed = merge.merge_and_write(spark, path, spark.createDataFrame([("b", DAY, 3.0), ("a", DAY, 1.0)], a.schema), report_changed=True)
    assert n == 2 and rows(changed) == [("b", DAY)]
    assert rows(spark.read.parquet(path)) == [("a", DAY, 1.0), ("b", DAY, 3.0)]
    with pytest.raises(errors.ShrinkRefusal):
        merge.merge_and_write(spark, path, a.limit(1), mode="overwrite")
    with pytest.raises(errors.EmptyRefusal):
        merge.merge_and_write(spark, str(tmp_path / "none"), a.limit(0))
    with pytest.raises(errors.SchemaRefusal):
        merge.merge_and_write(spark, path, a.drop("obs_date"))
    with pytest.raises(ValueError):
        merge.merge_and_write(spark, path, a, mode="overwrite", report_changed=True)
    assert rows(spark.read.parquet(path)) == [("a", DAY, 1.0), ("b", DAY, 3.0)]
    assert len(list(tmp_path.iterdir())) == 1


def test_supersede_and_union(spark):
    s = "series_key string, obs_date date, value double"
    old = spark.createDataFrame([("A-1", DAY, 1.0), ("b", DAY, 2.0)], s)
    new = spark.createDataFrame([("a1", DAY, 5.0)], s)
    norm = F.regexp_replace(F.lower("series_key"), "[^a-z0-9]", "")
    assert rows(merge.supersede(old, new, norm)) == [("a1", DAY, 5.0), ("b", DAY, 2.0)]
    assert merge.multiset_union(old.unionByName(old), old, ["series_key", "value"]).count() == 4


def test_rebuild_refusals(spark):
    s = "series_key string, obs_date date, value double"
    old = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + timedelta(days=40), 2.0), ("b", DAY + timedelta(days=40), 2.0)], s)
    assert merge.rebuild_refusals(old, old, "2020-02-01") == []
    bad = spark.createDataFrame([("a", DAY, 9.0), ("a", DAY + timedelta(days=40), 2.0)], s)
    assert len(merge.rebuild_refusals(old, bad, "2020-02-01")) == 3
    assert len(merge.rebuild_refusals(old, bad, "2020-02-01", allowed=["b"], floor_bp=9000)) == 1


def test_numbered_in_ranges(spark):
    from longtide.operators.ordering import numbered

    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"), F.lit("x").alias("v")).repartition(6)
    for bound in (10, 10_000):
        got = numbered(df, "place", F.col("k").desc(), one_task=bound).collect()
        assert sorted((500 - r["k"], r["place"]) for r in got) == [(i, i) for i in range(1, 501)]


def test_many_copies(spark):
    a = spark.range(10_000).select(F.lit("x").alias("k"))
    b = spark.createDataFrame([("x",), ("y",), (None,), (None,)], "k string")
    got = {r[0]: r[1] for r in merge.multiset_union(a, b, ["k"]).groupBy("k").count().collect()}
    assert got == {"x": 10_000, "y": 1, None: 2}
