"""Packing: every token of every item has its own place, nothing overlaps, little is left."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from longtide.llm import packing
from longtide.llm.packing import best_fit, pack, waste
from longtide.llm.tokens import TOKENIZER, counter
from longtide.session import table


def check_places(places, capacity):
    at = {}
    for container, place, size in places:
        assert 0 <= place and place + size <= capacity
        at.setdefault(container, []).append((place, size))
    for spans in at.values():
        end = 0
        for place, size in sorted(s for s in spans if s[1]):
            assert place == end
            end += size


def test_best_fit():
    rng = random.Random(3)
    for _ in range(60):
        cap = rng.randrange(1, 40)
        sizes = np.array([rng.randrange(0, cap + 1) for _ in range(rng.randrange(0, 50))], dtype=np.int64)
        bins, offsets, loads = best_fit(sizes, cap)
        check_places(zip(bins, offsets, sizes, strict=True), cap)
        assert (np.bincount(bins, weights=sizes, minlength=len(loads)) == loads).all() and (loads <= cap).all()
        assert np.sum(loads <= cap // 2) - np.sum(loads == 0) <= 1  # best fit leaves at most one bin under half full


def test_going_out_bounds_what_is_passed_up():
    loads = np.array([60] * 500 + [99, 100, 10])
    out = packing.going_out(loads, 100, 0.99, pass_up=65)
    assert (~out).sum() == 65 and out[500] and out[501] and not out[502]
    assert packing.going_out(loads, 100, 0.99).sum() == 2


@pytest.mark.parametrize("chunk", [250, 10_000])
def test_partitions_of_unlike_sizes(spark, chunk):
    """Items of 1,300 tokens in some partitions, of 740 in others: neither fills containers by itself."""
    count = counter()
    sized = {n: next(t for k in range(1, 3000) if count([t := "a " * k])[0] == n) for n in (1300, 740)}
    rows = [(i, sized[1300 if i < 600 else 740]) for i in range(1200)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id int, text string")
    got = pack(df, chunk=chunk)
    assert got.count() == 1200 and waste(got).first()["share_left"] < 0.05
    check_places([(r["container"], r["place"], r["n_tokens"]) for r in got.collect()], packing.CAPACITY)


@pytest.mark.parametrize("fan_in,chunk", [(2, 7), (3, 10_000)])
def test_pack_small(spark, fan_in, chunk):
    data = [(i % 40, None if i % 17 == 0 else "" if i % 13 == 0 else "word " * (i * 7 % 90), "x") for i in range(300)] + [(1000, "many words " * 400, "x")]
    df = spark.createDataFrame(data, "doc_id int, text string, container string").repartition(5)
    got = pack(df, capacity=100, fan_in=fan_in, chunk=chunk).collect()
    count = counter()
    check_places([(r["container"], r["place"], r["n_tokens"]) for r in got], 100)
    want = sorted((k, n) for k, t, _ in data for n in packing._pieces(count([t or ""])[0], 100))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == want
    big = sorted(r["piece"] for r in got if r["doc_id"] == 1000)
    assert big == list(range(len(big))) and len(big) > 5
    assert all(r["container"] is not None for r in got)
    assert pack(df.limit(0)).count() == 0 and waste(pack(df.limit(0))).first()["share_left"] is None


def test_pack_documents(spark, sf):
    docs = table(spark, sf.replace("sf0.001", "sf0.01"), "documents")
    got = pack(docs)
    w = waste(got).first()
    assert w.n_tokens == sum(counter()([r[0] for r in docs.select("text").collect()]))
    assert w.share_left < 0.01
    check_places([(r["container"], r["place"], r["n_tokens"]) for r in got.collect()], packing.CAPACITY)
    assert got.select("doc_id").distinct().count() == docs.count() and got.filter(F.col("container").isNull()).count() == 0


def test_long_texts_count_in_parts(monkeypatch):
    from longtide.llm import tokens

    text = " ".join(f"word{i % 97} 3,{i}" for i in range(4000)) + "\n\n  end  "
    whole = counter(TOKENIZER)([text])
    monkeypatch.setattr(tokens, "PART", 500)
    counter.cache_clear()
    assert counter(TOKENIZER)([text]) == whole
    counter.cache_clear()
