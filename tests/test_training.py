"""The general training-data operators against brute force, on small tables with nulls, ties, repeats and hot keys."""

import math
import random
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtide.functions.persistent import PersistentTree
from longtide.operators import asof, skew
from longtide.operators.asof import as_known
from longtide.operators.copies import catalogue_row_hash, except_all, group_differences, keyed_differences, same_json
from longtide.operators.orphans import Reference, orphan_report, orphans
from longtide.operators.snapshots import observation_changes, snapshot_changes

from .conftest import rows

DAY = date(2020, 1, 1)


def test_persistent_tree_answers_every_version():
    rng = np.random.default_rng(1)
    for n_keys in (1, 2, 3, 7, 16, 33):
        ranks = rng.integers(0, n_keys, 60)
        tree = PersistentTree(ranks, n_keys)
        for root in range(-1, 60):
            want = [max((t for t in range(root + 1) if ranks[t] == k), default=-1) for k in range(n_keys)]
            assert tree.search(np.full(n_keys, root), np.arange(n_keys)).tolist() == want
    assert PersistentTree(np.zeros(0, dtype=int), 0).search(np.array([-1]), np.array([0])).tolist() == [-1]


def facts_and_reads(seed, n=400, hot=0.0):
    rng = random.Random(seed)
    pick = lambda: None if rng.random() < 0.05 else ("hot" if rng.random() < hot else rng.choice("abcd"))
    day = lambda: None if rng.random() < 0.05 else DAY + timedelta(days=rng.randrange(4))
    facts = [(i, pick(), day(), rng.choice([None, math.nan, 1.0, 2.0]), None if rng.random() < 0.1 else DAY + timedelta(days=rng.randrange(12)), "x") for i in rng.sample(range(10 * n), n)]
    reads = [(i, pick(), day(), None if rng.random() < 0.05 else datetime(2020, 1, 1, tzinfo=timezone.utc) + timedelta(hours=rng.randrange(0, 14 * 24)), rng.choice([None, "r"])) for i in range(n)]
    return facts, reads + reads[:5]


F_SCHEMA = "fact_id bigint, metric string, obs_date date, value double, vintage_date date, read_id string"
R_SCHEMA = "read_id bigint, metric string, obs_date date, read_at timestamp, reader string"


def brute_known(facts, reads, inclusive=False):
    out = []
    for r in reads:
        if r[3] is None:
            continue
        d = r[3].date()
        best = max(((f[4], f[0]) for f in facts if None not in (f[1], f[2], f[4]) and f[1] == r[1] and f[2] == r[2] and (f[4] < d or inclusive and f[4] == d)), default=None)
        if best:
            out.append((r[0], best[1]))
    return sorted(out)


@pytest.mark.parametrize("seed,hot,inclusive", [(1, 0.0, False), (2, 0.6, False), (3, 0.3, True)])
def test_as_known_is_brute_force(spark, seed, hot, inclusive, monkeypatch):
    facts, reads = facts_and_reads(seed, hot=hot)
    monkeypatch.setattr(asof, "TASK_EVENTS", 10)
    got = as_known(spark.createDataFrame(reads, R_SCHEMA).repartition(3), spark.createDataFrame(facts, F_SCHEMA).repartition(5), inclusive=inclusive, shard_facts=25)
    assert sorted(map(tuple, got.collect())) == brute_known(facts, reads, inclusive)


def test_as_known_salts_hot_shards(spark, monkeypatch):
    monkeypatch.setattr(asof, "TASK_EVENTS", 500)
    reads = [(i, "m", DAY, datetime(2020, 1, 9, tzinfo=timezone.utc), None) for i in range(5000)]
    facts = [(i, "m", DAY, 1.0, DAY + timedelta(days=i % 5), "") for i in range(300)]
    got = as_known(spark.createDataFrame(reads, R_SCHEMA), spark.createDataFrame(facts, F_SCHEMA), shard_facts=50)
    assert {tuple(r) for r in got.collect()} == {(i, 299) for i in range(5000)} and got.count() == 5000


def test_as_known_columns_and_empty(spark):
    facts, reads = facts_and_reads(5, 60)
    f, r = spark.createDataFrame(facts, F_SCHEMA), spark.createDataFrame(reads, R_SCHEMA)
    got = as_known(r, f, event_columns=["read_id", "reader"], fact_columns=["value", "read_id", "fact_id"])
    assert got.columns == ["read_id", "reader", "value", "read_id_fact", "fact_id"]
    assert sorted((x["read_id"], x["fact_id"]) for x in got.collect()) == brute_known(facts, reads)
    assert as_known(r.limit(0), f).count() == 0 and as_known(r, f.limit(0)).count() == 0


SPELL = [lambda d: d.isoformat(), lambda d: d.strftime("%Y%m%d"), lambda d: f" {d.isoformat()} ", lambda d: d.isoformat() + "T00:00:00Z", lambda d: d.isoformat() + " 10:00:00"]
O_SCHEMA = "snapshot_no bigint, series_key string, obs_date string, value double, row_no bigint, change string"


def test_observation_changes_is_brute_force(spark):
    rng = random.Random(4)
    data = []
    for i in range(900):
        d = DAY + timedelta(days=rng.randrange(5))
        text = rng.choice(SPELL)(d) if rng.random() < 0.9 else rng.choice([None, "", "2020-02-30", "n/a", "2020", "20201301"])
        data.append((rng.choice([1, 2, 4, 5]), rng.choice([None, "a", "b", "c"]), text, rng.choice([None, math.nan, 0.0, -0.0, 1.0, 1.0000000001]), i, "x"))
    data += [(2, "hot", "2020-01-01", 1.0, 1000 + i, "x") for i in range(400)] + [(4, "hot", "20200101", 2.0, 5000, "x")]
    got = observation_changes(spark.createDataFrame(data, O_SCHEMA).repartition(6))

    def day(t):
        t = (t or "").strip()
        try:
            return date.fromisoformat(f"{t[:4]}-{t[4:6]}-{t[6:8]}" if t[:8].isdigit() else t[:10] if t[4:5] == "-" else "").isoformat()
        except ValueError:
            return None

    last = {}
    for s, k, t, v, n, _ in data:
        if k is not None and (d := day(t)):
            if n >= last.get((s, k, d), (None, -1))[1]:
                last[s, k, d] = (v, n)
    same = lambda a, b: a == b or (a is None) == (b is None) and a is not None and math.isnan(a) and math.isnan(b)
    want = []
    for p, q in ((1, 2), (2, 4), (4, 5)):
        for k, d in {(k, d) for s, k, d in last if s in (p, q)}:
            a, b = last.get((p, k, d)), last.get((q, k, d))
            c = "added" if a is None else "removed" if b is None else None if same(a[0], b[0]) else "changed"
            if c:
                want.append((q, k, d, c))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_snapshot_changes_edges(spark):
    df = spark.createDataFrame([(1, "a", "x", 1, 1.0)], "snapshot_no int, k string, v string, row_no int, w double")
    assert snapshot_changes(df, ["k"], values=["v", "w"]).count() == 0
    assert snapshot_changes(df.limit(0), ["k"], values=["v"]).count() == 0
    two = df.unionByName(spark.createDataFrame([(2, "a", None, 1, 1.0), (3, "a", "x", None, None)], df.schema))
    assert rows(snapshot_changes(two, ["k"], values=["v", "w"])) == [(2, "a", "changed"), (3, "a", "changed")]


def parents(spark):
    return spark.createDataFrame([("p", "1", DAY, None), ("q", "1", DAY, DAY + timedelta(days=5)), ("q", "1", DAY + timedelta(days=9), None), ("r", None, DAY, None), ("s", "1", None, None)], "a string, b string, added_on date, removed_on date")


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("match", ["simple", "full", "partial"])
def test_orphans_is_brute_force(spark, match, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr("longtide.operators.orphans.fits_broadcast", lambda *_: False)
        monkeypatch.setattr(skew, "HOT_SHARE", 0.01)
    rng = random.Random(6)
    child = [(i, rng.choice([None, "p", "q", "r", "s", "P", " ", ""]), rng.choice([None, "1", "2"]), rng.choice([None, DAY - timedelta(days=1), DAY, DAY + timedelta(days=5), DAY + timedelta(days=9)]), "c") for i in range(200)]
    child += [(1000 + i, "p", "2", DAY, "c") for i in range(150)]
    df = spark.createDataFrame(child, "id int, x string, y string, day date, a string")
    ref = Reference("x,y", ["x", "y"], parents(spark), ["a", "b"], "day", "added_on", "removed_on", match)
    have = [("p", "1", DAY, None), ("q", "1", DAY, DAY + timedelta(days=5)), ("q", "1", DAY + timedelta(days=9), None), ("r", None, DAY, None)]
    want = []
    for i, x, y, d, _ in child:
        x = None if x is not None and not x.strip() else x
        if x is None and y is None or match == "simple" and None in (x, y):
            continue
        if match == "full" and None in (x, y):
            want.append((i,))
            continue
        ok = any((x is None or x == a) and (y is None or y == b) and d is not None and s <= d and (e is None or d < e) for a, b, s, e in have)
        if not ok:
            want.append((i,))
    assert sorted(map(tuple, orphans(df, ref, ["id"]).collect())) == sorted(want)
    report = orphan_report(df, [ref], "child")
    assert report.agg(F.sum("n_orphans")).first()[0] == len(want)


def test_orphans_without_day_and_empty(spark):
    child = spark.createDataFrame([(1, "p"), (2, "zz"), (3, None)], "id int, x string")
    ref = Reference("x", ["x"], parents(spark), ["a"])
    assert rows(orphans(child, ref, ["id"])) == [(2,)]
    assert orphans(child.limit(0), ref, ["id"]).count() == 0
    assert rows(orphans(child, Reference("x", ["x"], parents(spark).limit(0), ["a"]), ["id"])) == [(1,), (2,)]
    with pytest.raises(ValueError):
        orphans(child, Reference("x", ["x"], parents(spark), ["a"], match="other"), ["id"])


def test_except_all_is_exceptall(spark):
    rng = random.Random(2)
    make = lambda: spark.createDataFrame([(rng.choice([None, "a", "b"]), rng.choice([None, math.nan, 0.0, -0.0, 1.0])) for _ in range(60)], "k string, v double")
    a, b = make(), make()
    l, r = except_all(a, b, ["k", "v"])
    assert l.agg(F.sum("n")).first()[0] == a.exceptAll(b).count() and r.agg(F.sum("n")).first()[0] == b.exceptAll(a).count()


def test_keyed_differences(spark):
    schema = "id string, f string, g string, extra int"
    left = spark.createDataFrame([("1", "a", None, 1), ("1", "a", None, 1), ("2", "a", "b", 1), ("3", "a", "b", 1), ("4", "x", "y", 1), ("4", "z", "y", 1), (None, "n", "n", 1), ("6", '{"a": 1, "b": "\\u00e9"}', "", 0)], schema)
    right = spark.createDataFrame([("1", "a", "", 2), ("2", "A", "c", 2), ("4", "z", "y", 2), ("4", "x", "y", 2), ("5", "q", "q", 2), (None, "m", "n", 2), ("6", '{"b":"é","a":1}', "", 0)], schema)
    both = {"f": (same_json(F.col("f")), same_json(F.col("f"))), "g": (F.col("g"), F.col("g"))}
    got = rows(keyed_differences(left, right, "id", both))
    assert got == sorted([("1", "g"), ("2", "f"), ("2", "g"), ("3", "missing_right"), ("5", "missing_left"), (None, "f")], key=repr)
    assert keyed_differences(left.limit(0), right.limit(0), "id", both).count() == 0


def test_same_json(spark):
    pairs = [('{"a":1}', '{ "a" : 1 }', True), ('{"a":1,"b":{"c":"é"}}', '{"b":{"c":"\\u00e9"},"a":1}', True), ("unknown", "unknown", True), ("unknown", '"unknown"', False), ('{"a":null}', "{}", False), (None, "x", False)]
    df = spark.createDataFrame([(x, y) for x, y, _ in pairs], "x string, y string")
    assert [r[0] for r in df.select(same_json(F.col("x")).eqNullSafe(same_json(F.col("y")))).collect()] == [w for *_, w in pairs]


def test_group_differences(spark):
    schema = "m string, d date, v double"
    left = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY, 1.0), ("b", None, math.nan), ("c", DAY, 0.0), ("d", DAY, None), ("e", DAY, 1.0)] + [("hot", DAY, 5.0)] * 100, schema)
    right = spark.createDataFrame([("a", DAY, 1.0), ("b", None, math.nan), ("c", DAY, -0.0), ("d", DAY, None), ("d", DAY, 2.0), ("f", DAY, 1.0)] + [("hot", DAY, 5.0)] * 100, schema)
    assert rows(group_differences(left, right, ["m", "d"], "v")) == [("a", DAY, "value"), ("d", DAY, "value"), ("e", DAY, "missing_right"), ("f", DAY, "missing_left")]


def test_row_hash(spark):
    import hashlib

    df = spark.createDataFrame([("é", None), ("", "b")], "x string, y string")
    want = [hashlib.sha256(b"".join(c + b"\x00" + (b"\xff" if v is None else v.encode()) + b"\x01" for c, v in ((b"x", x), (b"y", y)))).hexdigest() for x, y in (("é", None), ("", "b"))]
    assert [r[0] for r in df.select(catalogue_row_hash(["x", "y"])).collect()] == want


def test_size_check_and_spread(spark):
    big = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), "id").unionByName(spark.range(900).select(F.lit("hot").alias("k"), "id"))
    assert not skew.fits_broadcast(big, rows=100) and skew.fits_broadcast(big)
    right = spark.createDataFrame([("0", 1), ("hot", 2), ("hot", 3)], "k string, v int")
    a, b = skew.spread(big, right, ["k"], share=0.05)
    assert a.join(b, ["k", "__salt"]).count() == big.join(right, "k").count()
    assert a.filter("k = 'hot'").select("__salt").distinct().count() > 3
