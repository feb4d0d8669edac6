"""Leaks: the suffix array and the lookups against brute force, planted passages, decoys, and edge rows."""

import random

import numpy as np
import pytest

from longtide.llm import leaks as K
from longtide.llm.words import WordIds, bitmap, word_id, words_of

from ..conftest import rows


def test_words():
    assert words_of("The <b>Ca­t</b>,&nbsp;32.6 % of 75,812 — night‑shift​ HOURS") == ["the", "cat", "326", "of", "75812", "nightshift", "hours"]
    assert words_of("сат") == words_of("cat") and words_of("ｆｕｌｌ") == ["full"] and words_of("60 048 and 60 048") == ["60048", "and", "60048"]
    assert words_of("over-\ndraft [link](http://x) **bold**") == ["overdraft", "link", "bold"] and words_of(None) == [] == words_of("")


@pytest.mark.parametrize("seed", range(60))
def test_lookups_are_brute_force(seed):
    rng = np.random.default_rng(seed)
    v = int(rng.integers(2, 6))
    ids = np.concatenate([np.r_[rng.integers(0 if seed % 3 == 0 else 1, v, rng.integers(1, 14)), 0] for _ in range(3)])
    text = np.r_[rng.integers(0, v + 1, rng.integers(1, 50)), 0]

    def suffix(p):
        out = []
        while text[p]:
            out.append(int(text[p]))
            p += 1
        return out

    sa = K.suffix_array(text[:-1])
    assert [suffix(p) for p in sa] == sorted(s for p in range(len(text) - 1) if len(s := suffix(p)) >= K.SEED)
    want = []
    for q in np.flatnonzero(ids):
        for p in range(len(text) - 1):
            n = 0
            while text[p + n] and ids[q + n] == text[p + n]:
                n += 1
            if n >= K.SEED and not (q > 0 and p > 0 and ids[q - 1] and text[p - 1] == ids[q - 1]):
                want.append((int(q), p, n))
    got = K.verbatim_matches(text, sa, ids)
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted(want)


def test_align():
    item, text = np.arange(1, 11), np.array([0, 1, 2, 3, 99, 5, 6, 7, 8, 0, 9, 10])
    assert [x.tolist() for x in K.align(item, text)] == [[0, 1, 2, 4, 5, 6, 7, 8, 9], [1, 2, 3, 5, 6, 7, 8, 10, 11]]
    assert not len(K.align(item, np.zeros(4, dtype=int))[0]) and not len(K.align(np.zeros(3, dtype=int), item)[0])


@pytest.mark.parametrize("seed", range(40))
def test_the_bound_never_rules_out_a_passage(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(18, 60))
    weight, there = rng.random(n) * 3 + 0.05, rng.random(n) < 0.65
    best = max(weight[a:b][there[a:b]].sum() / weight[a:b].sum() for a in range(n) for b in range(a + 18, n + 1))
    assert K.may_hold(there[None], weight[None], 18)[0] == (best >= K.MIN_SHARE)
    held = [(a, b) for a in range(n) for b in range(a + 18, n + 1) if weight[a:b][there[a:b]].sum() >= K.MIN_SHARE * weight[a:b].sum()]
    assert K.reach(there, weight, 18) == ((min(a for a, _ in held), max(b for _, b in held)) if held else None)


def test_word_ids_survive_a_small_bitmap():
    words = [f"w{i}" for i in range(500)]
    ids = WordIds(bitmap(np.array([word_id(w) for w in words[:50]]), 1 << 16))
    got = ids.of(words)
    assert (got[:50] == [word_id(w) for w in words[:50]]).all() and (got[50:] == 0).mean() > 0.95


def sentence(rng, n):
    return " ".join(f"{rng.choice('bcdfgkl')}{rng.choice('aeiou')}{rng.randrange(500)}" for _ in range(n))


def test_planted_passages(spark):
    rng = random.Random(8)
    stock = "Answer with a single number taken from the passage above please and do not round it unless the question asks for it."
    items = [(100 + i, f"{sentence(rng, 30)}. {sentence(rng, 30)}. {stock}", "x") for i in range(12)] + [(200, None, "x"), (201, "", "x")]
    docs, want = [], set()
    for i in range(120):
        body = [sentence(rng, 40)]
        k = rng.randrange(12)
        ws = items[k][1].split()
        kind = i % 6
        if kind == 0:
            a = rng.randrange(0, 35)
            part = ws[a : a + 25]
            for _ in range(2):
                part[rng.randrange(4, 20)] = "changed"
            body.append(" ".join(part).upper().replace(" ", "  \n"))
            want.add((i, items[k][0]))
        elif kind == 1:
            body.append(" ".join(ws[10:19]))
        elif kind == 2:
            body.append(stock)
        elif kind == 3:
            a = rng.randrange(0, 30)
            body.append("<p>" + ",&nbsp;".join(" ".join(ws[j : j + 5]) for j in range(a, a + 30, 5)) + "</p>")
            want.add((i, items[k][0]))
        docs.append((i, " ".join([*body, sentence(rng, 40)]), 0))
    docs += [(500, None, 0), (501, "", 0)] + [(600 + j, docs[0][1], 0) for j in range(40)]
    want |= {(600 + j, n) for j in range(40) for m, n in list(want) if m == 0}
    d, t = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int").repartition(3), spark.createDataFrame(items, "item_id bigint, text string, share string")
    got = K.leaked(d, t, shard_words=700)
    assert {tuple(r) for r in got.select("doc_id", "item_id").collect()} == want
    assert K.leaked(d, t.limit(0)).count() == 0 and K.leaked(d.limit(0), t).count() == 0
    assert K.without_leaks(d, got).count() == len(docs) - len({m for m, _ in want})
    two = K.leaked(d.withColumnRenamed("doc_id", "item_id2").drop("item_id").withColumnRenamed("item_id2", "item_id"), t, doc_key="item_id")
    assert two.columns[:2] == ["item_id", "item_id_item"] and two.count() == len(want)


def test_long_items_go_in_segments(spark):
    rng = random.Random(3)
    long = sentence(rng, 3000)
    ws = long.split()
    docs = [(i, sentence(rng, 30) + " " + " ".join(ws[a : a + 30]) + " " + sentence(rng, 30)) for i, a in enumerate(range(0, 2960, 47))] + [(900, long), (901, sentence(rng, 500))]
    got = K.leaked(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(1, long), (2, sentence(rng, 50))], "item_id int, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in docs if i != 901) and {r["item_id"] for r in got} == {1}
    assert all(r["item_word"] == 47 * r["doc_id"] for r in got if r["doc_id"] < 900)


def test_blocks_of_items_give_the_same(spark, sf):
    from longtide.session import table

    d, t = table(spark, sf, "documents"), table(spark, sf, "eval_items")
    whole = rows(K.leaked(d, t))
    assert whole and rows(K.leaked(d, t, block_words=5_000)) == whole


def test_near_equal_items(spark):
    """Families of four items that differ in one word per sentence, planted with those words altered or as they are."""
    rng = random.Random(4)
    items, docs = [], []
    for family in range(50):
        base = [sentence(rng, 12).split() for _ in range(4)]
        for k in range(4):
            own = [ws[:5] + [f"own{family}x{k}x{n}"] + ws[6:] for n, ws in enumerate(base)]
            i = family * 4 + k
            items.append((i, " ".join(" ".join(ws) + "." for ws in own)))
            kept = own if i % 2 else [ws[:5] + [f"altered{i}x{n}"] + ws[6:] for n, ws in enumerate(own)]
            docs.append((i, sentence(rng, 40) + ". " + " ".join(" ".join(ws) + "." for ws in kept) + " " + sentence(rng, 40)))
    got = K.leaked(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert sum((i, i) in pairs for i, _ in items) >= 0.9 * len(items)
    assert all(d // 4 == i // 4 for d, i in pairs)


def test_every_passage_of_a_pair_comes_out(spark):
    rng = random.Random(6)
    ws = sentence(rng, 120).split()
    gap = sentence(rng, 70)
    doc = " ".join([*ws[:30], gap, *ws[60:100], gap, *ws[:30], gap, *ws[:30]])
    items = [(1, " ".join(ws))] + [(n, sentence(rng, 60)) for n in range(2, 9)]
    got = sorted((r["doc_word"], r["item_word"], r["n_words"]) for r in K.leaked(spark.createDataFrame([(7, doc)], "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect())
    assert got == [(0, 0, 30), (100, 60, 40), (210, 0, 30), (310, 0, 30)]


def test_same_pattern_with_other_names_is_no_passage(spark):
    rng = random.Random(9)

    def item():
        a, b, c = (sentence(rng, 2) for _ in range(3))
        return f"the joint series on {a} was restated back to 19{rng.randrange(90) + 10} which of the two areas had more {b} in 20{rng.randrange(90) + 10} and by how much did {c} fall"

    items = [(i, item() + f" question {i}.") for i in range(60)]
    docs = [(i, "Some say " + item() + " and no more.") for i in range(60)] + [(100 + i, "Some say " + t) for i, t in items]
    got = K.leaked(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(100 + i, i) for i, _ in items}
