"""Crosswalk of series that share values with many others, against the comparison of all pairs."""

import random
from collections import Counter, defaultdict

import pytest

from longtide.operators import rollups


def all_pairs(left, right, least=8):
    """Best match and verdict of each left series by brute force."""
    at, n, out = defaultdict(set), Counter(k for k, _, _ in set(left)), {}
    for k, d, v in right:
        at[d, v].add(k)
    for k in n:
        agree = Counter(k2 for x, d, v in set(left) if x == k for k2 in at[d, v])
        top = sorted(agree.items(), key=lambda x: (-x[1], x[0]))[:2]
        a, s = top[0][1] if top else 0, top[1][1] if len(top) > 1 else 0
        verdict = "TOO-SHORT" if n[k] < least else "NO-OVERLAP" if not a else "UNMATCHED" if a / n[k] < 0.8 else "AMBIGUOUS" if s and s >= 0.95 * a else "MATCHED"
        out[k] = (top[0][0] if verdict == "MATCHED" else None, a, verdict)
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_crosswalk_counts_common_values(spark, seed):
    rng = random.Random(seed)
    left, right = [], []
    for i in range(14):
        share = rng.choice([0.0, 0.05, 0.3, 0.9])  # of values that no other series has
        for d in range(20):
            v = 1000.0 * i + d if rng.random() < share else float(rng.random() < 0.2) if i % 2 else 0.0
            left.append((f"a{i:02}", d, v))
            if i != 5:
                right.append((f"b{i:02}", d, v if rng.random() < (0.5 if i == 3 else 0.98) else -1.0 - i))
    right += [("c", d, 0.0) for d in range(20)]
    df = lambda x: spark.createDataFrame(x, "series_key string, obs_date int, value double")
    want = all_pairs(left, right)
    got = {r.series_key: (r.match, r.n_agree, r.verdict) for r in rollups.crosswalk(df(left), df(right), fanout=3).collect()}
    assert {k: (m, v) for k, (m, _, v) in got.items()} == {k: (m, v) for k, (m, _, v) in want.items()}
    assert all(got[k][1] == want[k][1] for k in want if want[k][2] in ("MATCHED", "AMBIGUOUS")) and all(got[k][1] <= want[k][1] for k in want)


def test_crosswalk_of_series_mostly_zero(spark):
    """More than 50 series that are 0 but for their last date: each has its match, and one of zeros alone is AMBIGUOUS."""
    obs = [(i, d, 0.0 if d < 9 else float(i)) for i in range(1, 61) for d in range(10)] + [(i, d, 0.0) for i in (98, 99) for d in range(10)]
    df = lambda p: spark.createDataFrame([(f"{p}{i:02}", d, v) for i, d, v in obs], "series_key string, obs_date int, value double")
    got = {r.series_key: (r.match, r.n_agree, r.verdict) for r in rollups.crosswalk(df("a"), df("b")).collect()}
    assert got["a07"] == ("b07", 10, "MATCHED") and got["a99"] == (None, 10, "AMBIGUOUS")
