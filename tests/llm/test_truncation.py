"""Cut texts: the censored fit against simulation, held-out cuts of the test texts, and edge rows."""

import math
import random
import re

import numpy as np
import pytest

from longtide.llm import truncation as C
from longtide.session import table

from ..conftest import rows


def test_censored_fit_recovers_the_law():
    rng = np.random.default_rng(0)
    x = rng.normal(6.5, 0.8, 20_000)
    limit = math.log(1000)
    whole = x[x < limit]
    mu, sd = C.fit_lengths(len(whole), whole.sum(), (whole**2).sum(), [(limit, int((x >= limit).sum()))])
    assert abs(mu - 6.5) < 0.03 and abs(sd - 0.8) < 0.03
    assert C.fit_lengths(0, 0, 0, []) == (0.0, 1.0) and C.fit_lengths(0, 0.0, 0.0, [(3.0, 5)])[0] >= 3.0


def test_posterior():
    assert C.censoring_posterior(400, 200, 1000, 6.0, 1.0) > 0.95
    assert C.censoring_posterior(400, 1, 1000, 6.0, 1.0) == 0.0 == C.censoring_posterior(400, 6, 1000, 6.0, 1.0)


@pytest.mark.parametrize("text,bare,marked", [("a b…", "a b", True), ("a b [...] ", "a b", True), ("a b</p>\n", "a b", False), ("", "", False), ("…", "", True), ("x...</p>", "x", True)])
def test_bare_ending(text, bare, marked):
    assert C.bare_ending(text) == (bare, marked)


def test_final_stop():
    assert C.final_stop("Done.") and C.final_stop('He said "no."') and not C.final_stop("and the") and not C.final_stop("k,2017-03-06,756.") and C.final_stop("rose by 4.1 percent, of 756.")


def test_stop_of_a_data_line():
    lines = "k_cb:M.OMB.BF.01Y6,2013-01-01,484.60\nk_cb:M.OMB.BF.01Y6,2013-02-01,172.45\n"
    assert not any(C.final_stop(lines + x) for x in ("k_cb:M.OMB.", "k_cb:M.", "k_cb:M.OMB.BF.01Y6,2013-03-01,1."))
    assert all(C.final_stop(x) for x in (lines + "All in euros.", lines + "Done.", "a,b.\na,b.", "www.example.org\nDone."))


def test_broken_rate():
    assert abs(C.broken_rate([(-8.0, 950), (9.0, 50)]) - 0.05) < 0.01 and C.broken_rate([]) == 0.03


def test_held_out_cuts(spark, sf):
    """Whole texts of the test table, some cut anew at a place the classifier has not seen."""
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, sf.replace("sf0.001", "sf0.01"), "documents").collect()]
    rng = random.Random(5)
    data, cut = [], set()
    for i, (_, t, s) in enumerate(docs):
        if not C.final_stop(t):
            continue
        if rng.random() < 0.15 and len(t) > 80:
            p = rng.randrange(40, len(t) - 2)
            if t[p - 1].isalnum() and t[p].isalnum():
                cut.add(i)
                t = t[:p]
        data.append((i, t, s, "x"))
    df = spark.createDataFrame(data, "doc_id int, text string, source string, cut string")
    found = {r[0] for r in C.truncated(df, declared=None).filter("cut").select("doc_id").collect()}
    assert len(cut) > 30 and len(found & cut) / len(cut) >= 0.9 and len(found - cut) <= 0.1 * len(found)


def test_held_out_cuts_after_a_dot(spark, sf):
    """Data lines cut right after a dot, within a key or a number, half of them at a field limit; whole texts stay whole."""
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, sf.replace("sf0.001", "sf0.01"), "documents").collect()]
    rng = random.Random(7)
    data, cut, whole = [], set(), set()
    for i, (_, t, s) in enumerate(docs):
        dots = [m.end() for m in re.finditer(r"(?<=\w)\.(?=\w)", t or "") if m.end() > 100 and re.search(r"\n[^\s,]*[:.,][^\s]*$", t[: m.end()])]
        if t and dots and rng.random() < 0.4:
            p = rng.choice(dots)
            t = t[max(0, p - 300) : p] if rng.random() < 0.5 else t[:p]
            cut.add(i)
        elif t and C.final_stop(t) and " " in t.rsplit("\n", 1)[-1]:
            whole.add(i)
        data.append((i, t, s))
    df = spark.createDataFrame(data, "doc_id int, text string, source string")
    found = {r[0] for r in C.truncated(df, declared=None).filter("cut").select("doc_id").collect()}
    assert len(cut) > 20 and len(found & cut) / len(cut) >= 0.9 and len(found & whole) <= 0.01 * len(whole)


def test_a_limit_that_cuts_a_thousandth(spark):
    """40 of 40,000 texts of a source were cut at 700 characters; copies of one text at another length are no limit."""
    rng = np.random.default_rng(3)
    lengths = np.exp(rng.normal(7.2, 0.9, 40_000)).astype(int).clip(20, 60_000)
    rows = [("s", int(n), int(n), i) for i, n in enumerate(lengths)] + [("s", 700, 700, 100_000 + i) for i in range(40)] + [("s", 9_000, 9_000, -1)] * 60
    got = {(r["unit"], r["length"]): r["posterior"] for r in C.limits_by_source(spark.createDataFrame(rows, "source string, chars int, bytes int, h bigint")).collect()}
    assert got["chars", 700] > 0.3 and got.get(("chars", 9_000), 0.0) == 0.0 and sum(p > 0 for p in got.values()) < 20


def test_padding_longer_than_the_ending(spark):
    whole = [(i, f"Release note {i}. All series were checked and nothing else has changed since.", "s", None) for i in range(300)]
    df = spark.createDataFrame([*whole, (900, "Release note 900. All series were chec" + " " * 3000, "s", None), (901, "Release note 901. All series were checked." + " " * 3000, "s", None)], "doc_id int, text string, source string, n_chars bigint")
    assert {r[0] for r in C.truncated(df).filter("cut").select("doc_id").collect()} == {900}


def test_edges(spark):
    long = "All is well here. " * 3000
    data = [(1, None, "s", 5), (2, "", "s", None), (3, "…", None, 1), (4, long, "s", len(long)), (5, long + "and the", None, 3), (5, long + "and the", None, 3)]
    df = spark.createDataFrame(data, "doc_id int, text string, source string, n_chars bigint")
    got = C.truncated(df)
    assert got.count() == 6 and {r[0]: r[1] for r in got.select("doc_id", "cut").collect()}.items() >= {1: False, 2: False, 4: False}.items()
    assert C.truncated(df.limit(0)).count() == 0
    rates = C.cut_rates(got)
    assert rows(rates.select("source", "n_texts")) == sorted([("s", 3), (None, 3)], key=repr)
