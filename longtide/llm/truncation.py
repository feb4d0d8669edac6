"""Text cut off by field limits (problem 8).

Lengths: every source gets a log-normal law of its text lengths, right-censored at its candidate limits and fitted by
maximum likelihood; a text as long as a limit is censored with the probability that the fit leaves over for it.
Endings: what the text looks like where it stops, as log-odds of a classifier that learns from texts of the corpus
themselves, which it cuts at random places (cut) and at the ends of their lines and sentences (whole). Both are combined;
the share of texts that broke off away from any limit is fitted from the same odds."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import fits_broadcast, spread
from ..session import ship, staged, widened

#: Texts from which the classifier of endings learns, at most.
SAMPLE_DOCS = 6_000
#: Characters before an ending that are looked at.
TAIL = 400
#: A length is a candidate limit of a source if so many different texts have it, and more than the lengths ``AROUND`` it let expect
#: (three standard deviations and three texts).
LIMIT_ROWS, AROUND = 5, 25
#: Log-odds of blanks or closing markup after an ending without a stop; whole texts hardly ever end so.
CLOSED_ODDS = 5.0
#: Log-odds of a number, or a key, of a data line that stops at its point.
OPEN_ODDS = 7.0
#: Log-odds of a declared length well above the text's own.
TOLD_ODDS = 3.0
#: What ends texts without being part of them.
BLANKS = " \t\n\r\f\u000b\u00a0\u2009\u202f\u3000"
#: Hashed features of the classifier.
BUCKETS = 1 << 17

_MARK = re.compile(r"(?:…|\.\.\.+|\[\s*(?:…|\.\.\.)\s*\])$")
_CLOSERS = re.compile(r"(?:\s+|</\w+\s*>|<br\s*/?>|\*\*|__|```|&nbsp;)$")
_TOKEN = re.compile(r"\d+|[^\W\d_]+|[^\w\s]|_")
_OPEN_NUMBER = re.compile(r"[,;|\t]-?\d+\.$")
_BLANK, _FIELD, _WORD = re.compile(r"[^\S\t]"), re.compile(r"[,;|\t]"), re.compile(r"[^\W_]+")
_FINAL = re.compile(r"[.!?。！？؟][\"'”’»)\]]*$")


def bare_ending(text: str) -> tuple[str, bool]:
    """The text without blanks, closing markup and marks of omission at its end; whether there was such a mark."""
    marked = False
    while True:
        if m := _CLOSERS.search(text):
            text = text[: m.start()]
        elif m := _MARK.search(text):
            text, marked = text[: m.start()], True
        else:
            return text, marked


def final_stop(text: str) -> bool:
    """True if the text ends with the stop of a sentence; a point at the end of a data line is none, be it that of a number
    or that of a key of which the lines before have more."""
    if not _FINAL.search(text):
        return False
    line = text.rsplit("\n", 1)[-1]
    return not _OPEN_NUMBER.search(line) and not _open_line(text)


def _open_line(text: str) -> bool:
    """True if the last line has no blank, ends with a point, and a data line before it begins in the same shape and goes on, or the
    line is a key of several parts where the data line just before has more fields."""
    *before, line = text[-TAIL:].rstrip().split("\n")
    if not line.endswith(".") or _BLANK.search(line):
        return False
    shape = _WORD.sub("a", line)
    fields = len(_FIELD.findall(line))
    if before and not _BLANK.search(before[-1]) and len(_FIELD.findall(before[-1])) > fields == 0 and len(_WORD.findall(line)) > 1:
        return True
    return any(_FIELD.search(x) and not _BLANK.search(x) and len(y := _WORD.sub("a", x)) > len(shape) and y.startswith(shape) and not _FINAL.search(x) for x in before)


def _norm(token: str, known: set[str]) -> str:
    if token.isdigit():
        return "0" * min(len(token), 5)
    if not token[0].isalpha():
        return token
    low = token.lower()
    if low in known:
        return low
    return "Xx" if token[:1].isupper() else "xx"


def features(text: str, known: set[str]) -> list[int]:
    """Hashed features of an ending (without its mark of omission)."""
    tail = text[-TAIL:]
    line = tail.rsplit("\n", 1)[-1]
    raw = _TOKEN.findall(line[-160:])
    toks = [_norm(t, known) for t in raw[-6:]]
    last = raw[-1] if raw else ""
    out = ["bias", f"c:{tail[-1:] if not tail[-1:].isalnum() else ('a' if tail[-1:].isalpha() else '0')}"]
    for n in range(1, 6):
        out.append(f"t{n}:" + " ".join(toks[-n:]) if len(toks) >= n else f"t{n}:^ " + " ".join(toks))
    low = last.lower()
    out += [f"s{n}:{low[-n:]}" for n in (2, 3, 4) if len(low) >= n] + [f"w:{low}" if low in known else f"u:{toks[-1] if toks else ''}"]
    head = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "0", line[:24]))[:6]
    start = [_norm(t, known) for t in _TOKEN.findall(line[:60])[:3]]
    out += [f"h:{head}", f"b:{' '.join(start[:2])}", f"bt:{' '.join(start[:1])}|{toks[-1] if toks else ''}", f"bb:{' '.join(start[:2])}|{' '.join(toks[-2:])}"]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", lambda m: "0" * min(len(m[0]), 4), line))
    out += [f"sh:{shape[-10:]}", f"sl:{shape[-20:]}", f"n:{min(line.count(','), 6)},{min(line.count('|'), 6)},{line[-1:] == '|'}", f"z:{min(len(raw), 12)}|{toks[-1] if toks else ''}"]
    if "," in line and " " not in line.strip():
        out.append(f"csv:{re.sub('[^,.0]', 'x', shape)[-8:]}")
    return [crc32(x.encode()) % BUCKETS for x in out]


class Endings:
    """Log-odds that an ending is a cut, by logistic regression over hashed features."""

    def __init__(self, known: set[str], weights: np.ndarray):
        self.known, self.weights = known, weights

    def log_odds(self, text: str) -> float:
        return float(self.weights[features(text, self.known)].sum())

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, wt: np.ndarray, known: set[str], epochs: int, rate: float = 0.15, l2: float = 2e-5) -> Endings:
        """``x``: features of each example, filled up with BUCKETS, whose weight stays 0."""
        w, g2 = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
        rng = np.random.default_rng(0)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                i = order[a : a + 256]
                at, back = np.unique(x[i], return_inverse=True)
                p = 1 / (1 + np.exp(-w[x[i]].sum(axis=1)))
                g = np.bincount(back.ravel(), weights=np.repeat((p - y[i]) * wt[i], x.shape[1]), minlength=len(at)) + l2 * len(i) * w[at]
                g2[at] += g**2
                w[at] -= rate * g / np.sqrt(g2[at])
                w[BUCKETS] = 0.0
        return cls(known, w[:BUCKETS].astype(np.float32))


def _examples(text: str, seed: int) -> list[tuple[str, int, float]]:
    """Endings that a text offers for learning: whole ones (0), cuts (1), and its own, which is most likely whole (2)."""
    out: list[tuple[str, int, float]] = []
    rng = np.random.default_rng(seed)
    n = len(text)
    bare, marked = bare_ending(text)
    if bare and not marked:
        out.append((bare[-TAIL:], 2, 0.7))
    ends = [m.start() for m in re.finditer(r"(?<=\S)\n", text)]
    stops = [m.start() for m in re.finditer(r"[.!?](?=\s)", text)]
    if ends:
        for p in rng.choice(ends, min(5, len(ends)), replace=False):
            out.append((bare_ending(text[max(0, p - TAIL) : p])[0], 0, 0.8))
    if stops:
        for p in rng.choice(stops, min(4, len(stops)), replace=False):
            out.append((text[max(0, p + 1 - TAIL) : p + 1], 0, 0.5))
            if text[p - 1 : p].isalnum():
                out.append((text[max(0, p - TAIL) : p], 0, 0.6))
    if n > 40:
        for p in rng.integers(20, n, 9):
            cut = text[max(0, p - TAIL) : p]
            if cut.endswith("\n") or text[p] == "\n" or re.match(r"[.!?](?:\s|$)", text[p:]) or re.search(r"[.!?]\s+$", cut):
                continue
            if cut[-1] in ".!?" and not text[p].isalnum():  # else a point that more follows at once ends nothing
                continue
            out.append((bare_ending(cut)[0], 1, 1.0))
    return [(t, y, w) for t, y, w in out if t]


def fit_endings(documents: DataFrame, key: str, text: str, total: int, sample: int = SAMPLE_DOCS) -> Endings:
    """The classifier, learnt by one task from at most about ``sample`` of the ``total`` texts (chosen by a hash of their key) and at
    most some twenty endings of ``TAIL`` characters of each. Only its weights come to the driver."""
    ship(documents.sparkSession)
    share = 1 << 20
    chosen = documents.filter(F.col(text).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(share)) < int(share * min(1.0, sample / max(total, 1))))).select(F.xxhash64(key).alias("seed"), F.col(text).alias("text"))

    def offer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [e for t, s in zip(b["text"], b["seed"], strict=True) for e in _examples(t, int(s) & 0xFFFFFFFF)]
            yield pd.DataFrame(got, columns=["tail", "cut", "weight"])

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            for t in b["tail"]:
                seen.update({x.lower() for x in _TOKEN.findall(t)[:-1] if x[0].isalpha()})
            yield pd.DataFrame(list(seen.items()), columns=["word", "c"])

    examples = staged(widened(chosen.mapInPandas(offer, "tail string, cut int, weight double")), "endings-learnt")
    counted = examples.filter("cut <> 1").mapInPandas(words, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    known = {r[0] for r in counted.filter(F.col("c") >= max(4, examples.count() // 8000)).collect()}  # words of a bounded sample

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(features(t, known), y, w, crc32(t[-60:].encode()) % 2, final_stop(t)) for t, y, w in zip(b["tail"], b["cut"], b["weight"], strict=True)]
            yield pd.DataFrame(out, columns=["f", "y", "w", "half", "stop"])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((tuple(f), y, w, half, stop) for b in batches for f, y, w, half, stop in b.itertuples(index=False))
        if rows:
            x = np.full((len(rows), 32), BUCKETS, dtype=np.int32)
            for n, r in enumerate(rows):
                x[n, : len(r[0])] = r[0]
            yield pd.DataFrame({"weights": [_fit_cleaned(x, *(np.array([r[k] for r in rows]) for k in (1, 2, 3, 4)), known).weights.tobytes()]})

    rows = examples.mapInPandas(look, "f array<int>, y int, w double, half int, stop boolean").repartition(1).mapInPandas(learn, "weights binary").collect()  # one row
    return Endings(known if rows else set(), np.frombuffer(rows[0][0], dtype=np.float32) if rows else np.zeros(BUCKETS, dtype=np.float32))


def _fit_cleaned(x: np.ndarray, y: np.ndarray, wt: np.ndarray, half: np.ndarray, stop: np.ndarray, known: set[str]) -> Endings:
    """Texts that were cut would teach their own endings as whole. So each half judges the other's first, and what it takes
    for cut is left out."""
    keep = y < 2
    for h in (0, 1):
        own, others = half == h, np.flatnonzero((half != h) & (y == 2))
        judge = Endings.fit(x[own], (y[own] == 1).astype(float), np.where(y[own] == 2, 0.35, wt[own]), known, epochs=3)
        odds = np.r_[judge.weights, np.float32(0)][x[others]].sum(axis=1)
        keep[others[stop[others] | (odds < 0.5)]] = True
    return Endings.fit(x[keep], (y[keep] == 1).astype(float), wt[keep], known, epochs=6)


def fit_lengths(n: float, s1: float, s2: float, censored: list[tuple[float, float]], rounds: int = 60) -> tuple[float, float]:
    """Maximum likelihood of a normal law of log-lengths from ``n`` whole texts (sum ``s1``, sum of squares ``s2``) and texts
    right-censored at limits (log-limit, how many), by expectation-maximisation."""
    if n + sum(c for _, c in censored) <= 0:
        return 0.0, 1.0
    mu = s1 / n if n else censored[0][0]
    sd = math.sqrt(max(s2 / n - mu * mu, 0.05)) if n else 1.0
    for _ in range(rounds):
        t0, t1, t2 = n, s1, s2
        for a, c in censored:
            z = (a - mu) / sd
            tail = max(0.5 * math.erfc(z / math.sqrt(2)), 1e-12)
            hazard = math.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) / tail if tail > 1e-12 else z
            t0, t1, t2 = t0 + c, t1 + c * (mu + sd * hazard), t2 + c * (mu * mu + sd * sd + sd * hazard * (a + mu))
        mu, sd = t1 / t0, math.sqrt(max(t2 / t0 - (t1 / t0) ** 2, 0.02))
    return mu, sd


def censoring_posterior(length: int, at: float, total: float, mu: float, sd: float, around: float = 0.0) -> float:
    """The share of the ``at`` texts of exactly this length, of ``total``, that neither the law of whole lengths nor the lengths
    around (``around`` texts each) explain, less what chance piles up among many lengths (three standard deviations and three texts)."""
    z = (math.log(max(length, 1)) - mu) / sd
    whole = max(total * math.exp(-0.5 * z * z) / (sd * math.sqrt(2 * math.pi) * max(length, 1)), around)
    return min(max(1 - (whole + 3 * math.sqrt(whole) + 3) / at, 0.0), 0.995)


def limits_by_source(lengths: DataFrame) -> DataFrame:
    """Of each source, its fitted law and the posterior at its candidate limits: ``source``, ``unit`` (chars or bytes),
    ``length``, ``n_at``, ``posterior``. ``lengths``: ``source``, ``chars``, ``bytes`` and ``h``, a hash of the text; copies of a text count once,
    as they have one length whatever it is."""
    lens = lengths.filter(F.col("chars").isNotNull()).select("source", "chars", "bytes", "h").distinct()
    pair = lambda unit: F.struct(F.lit(unit).alias("unit"), F.col(unit).alias("length"))
    hist = lens.groupBy("source", "chars", "bytes").agg(F.count(F.lit(1)).alias("c")).select("source", "c", F.explode(F.array(pair("chars"), pair("bytes"))).alias("x"))
    hist = hist.groupBy("source", "x.unit", "x.length").agg(F.sum("c").alias("c"))
    near = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-AROUND, AROUND)  # over lengths, not texts
    hist = staged(hist.withColumn("around", (F.sum("c").over(near) - F.col("c")) / (2 * AROUND)), "lengths")
    ln = F.log(F.greatest("length", F.lit(1)).cast("double"))
    sums = hist.groupBy("source", "unit").agg(F.sum("c").alias("n"), F.sum(F.col("c") * ln).alias("s1"), F.sum(F.col("c") * ln * ln).alias("s2"))
    spikes = hist.filter((F.col("c") >= LIMIT_ROWS) & (F.col("c") > F.col("around") + 3 * F.sqrt("around") + 3))
    spikes = spikes.groupBy("source", "unit").agg(F.collect_list(F.struct("length", "c", "around")).alias("spikes"))  # lengths that stand out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                at = sorted((int(x["length"]), int(x["c"]), float(x["around"])) for x in r.spikes)
                over = [(v, max(c - a, 0.0)) for v, c, a in at]  # what stands out is censored, the rest is whole
                left = r.n - sum(c for _, c in over)
                s1 = r.s1 - sum(c * math.log(max(v, 1)) for v, c in over)
                s2 = r.s2 - sum(c * math.log(max(v, 1)) ** 2 for v, c in over)
                mu, sd = fit_lengths(left, s1, s2, [(math.log(max(v, 1)), c) for v, c in over])
                out += [(r.source, r.unit, v, c, censoring_posterior(v, c, r.n, mu, sd, a)) for v, c, a in at]
            yield pd.DataFrame(out, columns=["source", "unit", "length", "n_at", "posterior"])

    return sums.join(spikes, ["source", "unit"]).mapInPandas(run, "source string, unit string, length int, n_at bigint, posterior double")


def truncated(documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", declared: str | None = "n_chars", sample: int = SAMPLE_DOCS) -> DataFrame:
    """Every text with the odds that it was cut: ``key``, ``source``, ``length``, ``limit_posterior`` (0 away from any
    candidate limit), ``ending_odds``, ``probability``, ``cut``.

    A stop at the end is evidence like any other ending: the classifier has learnt stops of sentences as whole and points within
    keys and numbers as cuts, and the posterior of the limit is added. ``declared`` (may be None): a column with the length that the sender gave; one well above the text's own speaks for a cut. Null and empty
    texts are never cut. Rows keep their multiplicity; other columns are ignored; an empty table gives no rows.

    The texts are read twice: once for lengths and endings, which are written out, and once for the sample."""
    spark = documents.sparkSession
    ship(spark)
    ends = staged(_ends(documents, key, text, source, declared), "ends")
    model = spark.sparkContext.broadcast(fit_endings(documents, key, text, ends.count(), sample))
    limits = limits_by_source(ends).filter("posterior > 0").groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("unit", F.lit(":"), "length"), "posterior"))).alias("posteriors"))
    limits = staged(limits, "limits")
    if fits_broadcast(limits.select("source")):
        joined = ends.join(F.broadcast(limits), "source", "left")
    else:
        a, b = spread(ends, limits, ["source"])
        joined = a.join(b, ["source", "__salt"], "left")
    at = F.greatest(*[F.coalesce(F.element_at("posteriors", F.concat(F.lit(f"{u}:"), F.col(u).cast("string"))), F.lit(0.0)) for u in ("chars", "bytes")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            b["ending_odds"] = [_odds(m, tail or "", bool(padded), chars, told_n) for tail, padded, chars, told_n in zip(b["tail"], b["padded"], b["chars"], b["told"], strict=True)]
            yield b.drop(columns=["tail", "told", "padded"])

    kind = documents.schema[key].dataType.simpleString()
    skind = documents.schema[source].dataType.simpleString()
    scored = widened(joined.select("k", "src", "chars", "told", "tail", "padded", at.alias("limit_posterior"))).mapInPandas(run, f"k {kind}, src {skind}, chars int, limit_posterior double, ending_odds double")
    scored = staged(scored, "endings")
    bins = scored.filter((F.col("limit_posterior") < 0.05) & F.col("chars").isNotNull()).groupBy(F.round(F.col("ending_odds"), 1).alias("x")).agg(F.count(F.lit(1)).alias("n")).collect()  # some 400 rows
    rate = broken_rate([(r[0], r[1]) for r in bins])
    p0 = F.greatest(F.col("limit_posterior"), F.lit(rate))
    logit = F.log(p0 / (1 - p0)) + F.col("ending_odds")
    p = F.when(F.col("chars").isNull(), 0.0).otherwise(1 / (1 + F.exp(-logit)))
    return scored.select(F.col("k").alias(key), F.col("src").alias(source), F.col("chars").alias("length"), "limit_posterior", "ending_odds", p.alias("probability"), (p >= 0.5).alias("cut"))


def _ends(documents: DataFrame, key: str, text: str, source: str, declared: str | None) -> DataFrame:
    """What is looked at of every text: its lengths, its last characters before blanks, and a hash."""
    bare = F.rtrim(F.col(text), F.lit(BLANKS))
    return documents.select(
        F.col(key).alias("k"), F.col(source).alias("src"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.char_length(text).alias("chars"), F.octet_length(text).alias("bytes"),
        (F.col(declared).cast("double") if declared else F.lit(None).cast("double")).alias("told"),
        F.when(F.char_length(bare) > TAIL, F.substring(bare, -TAIL, TAIL)).otherwise(bare).alias("tail"), (F.char_length(bare) < F.char_length(text)).alias("padded"), F.xxhash64(text).alias("h"))


def candidate_limits(documents: DataFrame, *, text: str = "text", source: str = "source") -> DataFrame:
    """The lengths at which each source's texts pile up, with how many different texts there are (``n_at``) and the posterior that one of them
    was cut there."""
    ship(documents.sparkSession)
    return limits_by_source(_ends(documents, source, text, source, None).select("source", "chars", "bytes", "h"))


def _odds(model: Endings, tail: str, padded: bool, chars: int, told: float | None) -> float:
    """Log-odds of a cut by the last characters of a text, its mark of omission, what closes it, and its declared length."""
    bare, marked = bare_ending(tail)
    if not bare:
        return -20.0
    stop = final_stop(bare)
    if stop and marked:
        return 4.0
    x = min(max(model.log_odds(bare), -8.0), 8.0) + (8.0 if marked else CLOSED_ODDS if (padded or len(bare) < len(tail)) and not stop else 0.0)
    if _OPEN_NUMBER.search(bare[-40:].rsplit("\n", 1)[-1]) or _open_line(bare):
        x += OPEN_ODDS
    if told is not None and told == told and told > chars + 30 and told > 1.03 * chars:
        x += TOLD_ODDS
    return x


def broken_rate(bins: list[tuple[float, int]], rounds: int = 30) -> float:
    """The share of cut texts among those away from any limit, fitted to their odds (value, how many)."""
    total, r = sum(n for _, n in bins), 0.03
    for _ in range(rounds if total else 0):
        r = sum(n / (1 + math.exp(-min(max(math.log(r / (1 - r)) + x, -60), 60))) for x, n in bins) / total
        r = min(max(r, 1e-5), 0.9)
    return r


def cut_rates(found: DataFrame, source: str = "source") -> DataFrame:
    """Of each source, how many of its texts there are and are cut, and their share. A null source is reported as such."""
    return found.groupBy(source).agg(F.count(F.lit(1)).alias("n_texts"), F.count_if("cut").alias("n_cut")).withColumn("share_cut", F.col("n_cut") / F.col("n_texts"))
