"""Evaluation texts leaking into training text (problem 7).

The corpus is cut into shards of whole documents. Each shard gets a suffix array over its words; every suffix of every test
item is looked up in it by binary search and followed to its longest verbatim matches, with all their places. Where the
words around a match could make up a passage, the stretch is aligned with the item, to count words across the few that were
changed, lost or added."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship, staged, widened
from .words import WordIds, bitmap, sentences_of, word_id, words_of

#: Words of a verbatim match that makes a stretch of a document worth looking at.
SEED = 4
#: Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 300_000
#: Words of the test items that are broadcast together; more items are several blocks, which bounds each broadcast.
BLOCK_WORDS = 400_000
#: Words of an item that a passage must span, and the least share of them that must stand in the document; words count by
#: how few items have them, so that another text of the same pattern with other names and figures is no passage. A passage none of
#: whose words is rare (in at most STOCK_ITEMS items) needs a greater share.
MIN_WORDS, MIN_SHARE, COMMON_SHARE = 20, 0.68, 0.8
#: Words at the two ends of a passage that may have been changed.
EDGE = 2
#: Words of an item that are aligned at once; a longer item is looked up in segments that overlap.
SEGMENT, OVERLAP = 600, 80
#: Sentences that stand in more items than this do not count.
STOCK_ITEMS = 2
#: Pairs whose words are compared at once.
PAIRS = 4_096


@dataclass
class Items:
    """Test items as word ids. ``ids``: of all items in a row, each followed by a 0; 0 also for words of stock sentences.
    ``weight``: of each of these words. ``item``: the place in ``keys`` of the item (a long one has several places, one for each
    segment, whose first word is ``offset``), whose words begin at ``start``. ``solid``: the places of words other than 0, of which
    those of an item begin at ``solid_start``. ``rare``: the least weight of a rare word."""

    keys: list = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    ids: np.ndarray | None = None
    weight: np.ndarray | None = None
    item: np.ndarray | None = None
    start: np.ndarray | None = None
    solid: np.ndarray | None = None
    solid_start: np.ndarray | None = None
    rare: float = 0.0

    @classmethod
    def of(cls, rows: list[tuple[object, np.ndarray, np.ndarray]], n_items: int) -> Items:
        """``rows``: key, word ids and weights of each item; ``n_items``: how many items there are in all."""
        out, ids, weight, sizes = cls(rare=_weight(STOCK_ITEMS, n_items) - 1e-9), [], [], []
        for key, words, heavy in rows:
            for a in range(0, max(1, len(words) - OVERLAP), SEGMENT - OVERLAP):
                ids += [words[a : a + SEGMENT], [0]]
                weight += [heavy[a : a + SEGMENT], [0.0]]
                sizes.append(len(ids[-2]) + 1)
                out.keys.append(key)
                out.offset.append(a)
        out.ids = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, dtype=np.int64)
        out.weight = np.concatenate(weight) if ids else np.zeros(0)
        out.item = np.repeat(np.arange(len(sizes)), sizes)
        out.start = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        out.solid = np.flatnonzero(out.ids > 0)
        out.solid_start = np.searchsorted(out.solid, out.start)
        return out


def _weight(holders: int, n_items: int) -> float:
    return 0.05 + np.log(max(n_items, holders) / max(holders, 1))


def word_weights(words: np.ndarray, held: dict[int, int], n_items: int) -> np.ndarray:
    """What each word counts: more, the fewer items hold it; 0 for words of stock sentences."""
    return np.array([_weight(held.get(w, 1), n_items) if w else 0.0 for w in words.tolist()])


def prepared(items: DataFrame, key: str, text: str, limit: int = STOCK_ITEMS) -> tuple[DataFrame, int, int]:
    """Every different item as ``k``, ``words`` (ids; 0 in sentences that stand in more than ``limit`` items) and ``held`` (word
    and number of items that hold it, of each of its words); how many items and different words there are. Counted over all
    items."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: dict[str, int] = {}
        for b in batches:
            rows = []
            for i, k, t in zip(b["item"], b["k"], b["t"], strict=True):
                for n, s in enumerate(sentences_of(t)):
                    ws = words_of(s)
                    rows.append((i, k, n, word_id(" ".join(ws)), [ids.setdefault(w, word_id(w)) for w in ws]))
            yield pd.DataFrame(rows, columns=["item", "k", "n", "s", "w"])

    kind = items.schema[key].dataType.simpleString()
    listed = items.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).distinct()
    listed = listed.select(F.xxhash64(F.col("k").isNull(), "k", "t").alias("item"), "k", "t")
    parts = staged(listed.mapInPandas(cut, f"item bigint, k {kind}, n int, s bigint, w array<bigint>"), "sentences").filter(F.size("w") > 0)
    stock = parts.groupBy("s").agg(F.count_distinct(F.coalesce(F.col("k").cast("string"), F.lit(""))).alias("n_items")).filter(F.col("n_items") > limit).select("s", F.lit(True).alias("stock"))
    w = F.when(F.col("stock"), F.transform("w", lambda x: F.lit(0).cast("bigint"))).otherwise(F.col("w"))
    whole = parts.join(stock, "s", "left").groupBy("item").agg(F.min("k").alias("k"), F.sort_array(F.collect_list(F.struct("n", w.alias("w")))).alias("x"))
    whole = staged(whole.select("item", "k", F.flatten(F.transform("x", lambda e: e["w"])).alias("words")), "items")
    each = whole.select("item", F.explode(F.array_distinct("words")).alias("w")).filter("w <> 0")
    counts = staged(each.groupBy("w").agg(F.count(F.lit(1)).alias("c")), "words")
    held = each.join(counts, "w").groupBy("item").agg(F.collect_list(F.struct("w", "c")).alias("held"))  # of one item each
    return whole.join(held, "item", "left").select("k", "words", "held"), whole.count(), counts.count()


def shared_items(items: DataFrame, key: str, text: str, block_words: int = BLOCK_WORDS) -> tuple[list[Broadcast], Broadcast]:
    """The items in broadcast blocks of about ``block_words`` words (or of one longer item), and a bitmap of all their words,
    of at most 16 MB. One block at a time is in the driver."""
    sc = items.sparkSession.sparkContext
    rows, n_items, n_words = prepared(items, key, text)
    bits = 1 << min(27, max(16, (16 * n_words).bit_length()))
    blocks, block, size, wanted = [], [], 0, np.zeros(bits >> 3, dtype=np.uint8)

    def close() -> None:
        one = Items.of(block, n_items)
        np.bitwise_or(wanted, bitmap(one.ids[one.ids > 0], bits), out=wanted)
        blocks.append(sc.broadcast(one))

    for r in rows.toLocalIterator():
        words = np.array(r[1], dtype=np.int64)
        block.append((r[0], words, word_weights(words, dict(r[2] or []), n_items)))
        if (size := size + len(words)) >= block_words:
            close()
            block, size = [], 0
    if block:
        close()
    return blocks, sc.broadcast(wanted)


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of at least SEED words that hold no 0 before, in lexical order up to their first 0. By
    prefix doubling: after each round, suffixes are ranked by twice as many words."""
    n = len(ids)
    run = np.zeros(n + 1, dtype=np.int64)  # words up to the next 0
    zero = np.flatnonzero(np.r_[ids, 0] == 0)
    run[:n] = zero[np.searchsorted(zero, np.arange(n))] - np.arange(n)
    rank, k, longest = np.r_[ids, 0], 1, int(run.max(initial=0))
    live = np.flatnonzero(run[:n] > 0)
    while k < longest:
        second = rank[np.minimum(live + k, n)] * (run[live] > k)
        key = rank[live] * (int(rank.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.cumsum(np.r_[1, sorted_key[1:] != sorted_key[:-1]])
        rank = np.zeros(n + 1, dtype=np.int64)
        rank[live[order]] = new
        k *= 2
        if len(new) and new[-1] == len(new):
            break
    sa = live[run[live] >= SEED]
    return sa[np.argsort(rank[sa], kind="stable")]


def _bound(text: np.ndarray, sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
    """Binary search in all intervals at once: the first place in [lo, hi) whose word at ``depth`` is not below (``right``:
    is above) ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        there = text[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + depth, len(text) - 1)]  # closed intervals may lie anywhere
        go = open_ & ((there <= word) if right else (there < word))
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)
    return lo


def verbatim_matches(text: np.ndarray, sa: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All longest verbatim matches of item suffixes that begin where no earlier word matches too and have SEED words:
    place in ``ids`` (which ends with a 0), place in ``text`` (too), words. Every suffix is searched, all at once."""
    empty = np.zeros(0, dtype=np.int64)
    if not len(sa):
        return empty, empty, empty
    q = np.flatnonzero(ids > 0)
    lo, hi = np.zeros(len(q), dtype=np.int64), np.full(len(q), len(sa), dtype=np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def emit(who: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> None:
        if (size := b - a).sum() > 0:
            at = np.repeat(a - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            who, pos = np.repeat(who, size), sa[at]
            # what matches one word earlier too is part of the longer match that begins there
            first = (who == 0) | (pos == 0) | (ids[np.maximum(who - 1, 0)] == 0) | (text[np.maximum(pos - 1, 0)] != ids[np.maximum(who - 1, 0)])
            out.append((who[first], pos[first], np.full(int(first.sum()), depth)))

    depth = 0
    while len(q):
        word = ids[np.minimum(q + depth, len(ids) - 1)]
        a = _bound(text, sa, lo, hi, depth, word, right=False)
        b = _bound(text, sa, lo, hi, depth, word, right=True)
        b = np.where(word == 0, a, b)
        if depth >= SEED:
            gone = a == b
            emit(q[gone], lo[gone], hi[gone], depth)
            emit(q[~gone], lo[~gone], a[~gone], depth)
            emit(q[~gone], b[~gone], hi[~gone], depth)
        keep = a < b
        q, lo, hi, depth = q[keep], a[keep], b[keep], depth + 1
    if not out:
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def align(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best local alignment of an item's words with a stretch of text: the places of the words that match, in the item and in
    the text. Zeros match nothing."""
    n, m = len(item), len(text)
    gap = 2 * np.arange(m + 1, dtype=np.int32)
    score = np.where((item[:, None] == text) & (item[:, None] > 0), np.int32(2), np.int32(-2))
    h = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(n):
        above, row = h[i], h[i + 1]
        np.add(above[:-1], score[i], out=row[1:])
        np.maximum(row, above - 2, out=row)
        np.maximum(row, 0, out=row)
        row += gap
        np.maximum.accumulate(row, out=row)
        row -= gap
    i, j = map(int, np.unravel_index(int(h.argmax()), h.shape))
    met = []
    while i > 0 and j > 0 and h[i, j] > 0:
        same = text[j - 1] == item[i - 1] and item[i - 1] > 0
        if h[i, j] == h[i - 1, j - 1] + (2 if same else -2):
            if same:
                met.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] - 2:
            i -= 1
        else:
            j -= 1
    met.reverse()
    return np.array([a for a, _ in met], dtype=np.int64), np.array([b for _, b in met], dtype=np.int64)


def may_hold(there: np.ndarray, weight: np.ndarray, span: int) -> np.ndarray:
    """Of each row of item words, without those of stock sentences, could a passage of ``span`` words or more be made up of those that
    are ``there``? An upper bound: order and place do not matter."""
    if weight.shape[1] < span:
        return np.zeros(len(weight), dtype=bool)
    gain = np.zeros((len(weight), weight.shape[1] + 1))
    np.cumsum(weight * (there - MIN_SHARE), axis=1, out=gain[:, 1:])
    low = np.minimum.accumulate(gain, axis=1)
    return (gain[:, span:] - low[:, : gain.shape[1] - span] > -1e-6).any(axis=1)


def reach(there: np.ndarray, weight: np.ndarray, span: int) -> tuple[int, int] | None:
    """The stretch of one row of item words that such passages could cover (first word, behind the last); None if there can be none."""
    if len(weight) < span:
        return None
    gain = np.r_[0.0, np.cumsum(weight * (there - MIN_SHARE))]
    ends = np.flatnonzero(gain[span:] - np.minimum.accumulate(gain)[:-span] > -1e-6)
    if not len(ends):
        return None
    starts = np.flatnonzero(np.maximum.accumulate(gain[::-1])[::-1][span:] - gain[:-span] > -1e-6)
    return int(starts[0]), int(ends[-1]) + span


class Shard:
    """Whole documents and the suffix array over their words, made once for all blocks of items."""

    def __init__(self, docs: list[tuple[object, np.ndarray]]):
        self.docs = docs
        self.vocab, text = np.unique(np.concatenate([np.r_[w, 0] for _, w in docs]), return_inverse=True)
        self.text = text.astype(np.int64)  # words by their rank; 0 stays 0, as ids are positive
        self.starts = np.cumsum([0] + [len(w) + 1 for _, w in docs])
        self.sa = suffix_array(self.text[:-1])

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        """Item words as ranks; 0 for those that the shard lacks."""
        at = np.minimum(np.searchsorted(self.vocab, ids), len(self.vocab) - 1)
        return np.where(self.vocab[at] == ids, at, 0)

    def search(self, items: Items, min_words: int) -> list[tuple]:
        """Every passage: (document, item key, *row), rows as of ``_joined``."""
        ids = self.ranks(items.ids)
        at, pos, length = verbatim_matches(self.text, self.sa, ids)
        doc, place = np.searchsorted(self.starts, pos, side="right") - 1, items.item[at]
        pair = doc * len(items.keys) + place
        order = np.lexsort((-length, pair))
        at, pos, length, pair = at[order], pos[order], length[order], pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, dtype=np.int64)
        ends = np.r_[first[1:], len(pair)]
        doc, place = pair[first] // len(items.keys), pair[first] % len(items.keys)
        found: dict[tuple[int, object], list[tuple]] = {}
        for k in np.flatnonzero(self._likely(ids, items, doc, place, min_words - EDGE)).tolist():
            d, n, rows = int(doc[k]), int(place[k]), slice(first[k], ends[k])
            lo, hi = int(items.start[n]), int(items.start[n + 1]) - 1
            words = self.text[self.starts[d] : self.starts[d + 1] - 1]
            for a, *row in _passages(ids[lo:hi], items.weight[lo:hi], items.rare, words, at[rows] - lo, pos[rows] - self.starts[d], length[rows], min_words):
                found.setdefault((d, items.keys[n]), []).append((items.offset[n] + a, *row))
        return [(d, key, *row) for (d, key), rows in found.items() for row in _joined(rows)]

    def _likely(self, ids: np.ndarray, items: Items, doc: np.ndarray, place: np.ndarray, span: int) -> np.ndarray:
        """Which pairs' documents hold enough of the items' words, anywhere."""
        n = len(self.vocab)
        of = np.repeat(np.arange(len(self.docs)), np.diff(self.starts))
        here = np.unique(of[self.text > 0] * n + self.text[self.text > 0])
        out = np.zeros(len(doc), dtype=bool)
        for a in range(0, len(doc), PAIRS):
            d, p = doc[a : a + PAIRS], place[a : a + PAIRS]
            first, size = items.solid_start[p][:, None], np.diff(items.solid_start)[p][:, None]
            col = np.arange(int(size.max(initial=0)))
            at = items.solid[np.minimum(first + col, len(items.solid) - 1)]
            key = d[:, None] * n + ids[at]
            met = (ids[at] > 0) & (here[np.minimum(np.searchsorted(here, key), len(here) - 1)] == key)
            out[a : a + PAIRS] = may_hold(met & (col < size), np.where(col < size, items.weight[at], 1e6), span)
        return out


def _passages(item: np.ndarray, weight: np.ndarray, rare: float, words: np.ndarray, at: np.ndarray, pos: np.ndarray, length: np.ndarray, min_words: int) -> list[tuple]:
    """The passages of one item in one document, around its verbatim matches (longest first): places of the words that match, in
    the item and in the document, their weight and that of the item words spanned, and the longest match. A span may fall short of
    ``min_words`` by what may have been changed at its two ends. What one passage takes up is not looked at again."""
    n, m, span_ = len(item), len(words), min_words - EDGE
    words, out, done, solid = words.copy(), [], np.zeros(len(at), dtype=bool), np.flatnonzero(weight > 0)
    for s in range(len(at)):
        while not done[s]:
            near = words[max(0, int(pos[s] - at[s]) - n // 4 - 8) : int(pos[s] - at[s]) + n + n // 4 + 8]
            may = reach(np.isin(item[solid], near[near > 0]), weight[solid], span_)
            from_, to = (int(solid[may[0]]), int(solid[may[1] - 1]) + 1) if may else (0, 0)
            done[s] = at[s] >= to or at[s] + length[s] <= from_
            if done[s]:
                break
            slack = (to - from_) // 4 + 8
            lo, hi = max(0, int(pos[s] - at[s]) + from_ - slack), min(m, int(pos[s] - at[s]) + to + slack)
            a, b = align(item[from_:to], words[lo:hi])
            a = a + from_
            span = slice(int(a[0]), int(a[-1]) + 1) if len(a) else slice(0, 0)
            enough = MIN_SHARE if (weight[a] >= rare).any() else COMMON_SHARE
            if (weight[span] > 0).sum() < span_ or weight[a].sum() < enough * weight[span].sum():
                done[s] = True
                break
            first, last = lo + int(b[0]), lo + int(b[-1]) + 1
            inside = (pos < last) & (pos + length > first)
            longest = int(length[inside].max(initial=0))
            out.append((a, lo + b, float(weight[a].sum()), float(weight[span].sum()), longest))
            words[first:last] = 0
            done |= inside
    return out


def _joined(passages: list[tuple]) -> list[tuple]:
    """The passages of one item in one document as (first item word, item words spanned, words in common, their weighted share,
    longest verbatim match, first document word, document words spanned). Those that match a word to the same word, as seen
    from two segments of a long item, are one."""
    out: list[list] = []
    for a, b, met, spanned, longest in sorted(passages, key=lambda p: (int(p[1][0]), int(p[0][0]))):
        pairs = set(zip(a.tolist(), b.tolist(), strict=True))
        if out and not pairs.isdisjoint(out[-1][0]):
            out[-1] = [out[-1][0] | pairs, out[-1][1] + met, out[-1][2] + spanned, max(out[-1][3], longest)]
        else:
            out.append([pairs, met, spanned, longest])
    rows = []
    for pairs, met, spanned, longest in out:
        (a0, a1), (b0, b1) = ((min(x), max(x)) for x in zip(*pairs, strict=True))
        rows.append((a0, a1 - a0 + 1, len(pairs), met / spanned, longest, b0, b1 - b0 + 1))
    return rows


def leaked(documents: DataFrame, items: DataFrame, *, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The passages of test items in documents, one row per document row, item and passage: the two keys, ``item_word`` (first word
    of the passage in the item), ``n_words`` (item words that it spans), ``n_common`` (how many of them the document has), ``share`` (by
    weight), ``longest`` (words of the longest verbatim match in it), ``doc_word`` (its first word in the document) and ``doc_words``.

    Case, punctuation, spacing, markup, look-alike and invisible characters do not matter. Sentences of more than two
    items count for nothing. A passage that several near-equal items share is one of each. Null and empty texts hold no passage;
    a document as long as several shards is one shard. If both keys have the same name, the item's comes out with the suffix
    ``_item``. Other columns are ignored. Documents stay where they are read: nothing of the corpus is shuffled (unless it comes in
    fewer files than there are cores), each is read and indexed once, and only the items, in blocks, are sent out."""
    spark = documents.sparkSession
    ship(spark)
    name = f"{item_key}_item" if item_key == doc_key else item_key
    schema = T.StructType([T.StructField(doc_key, documents.schema[doc_key].dataType), T.StructField(name, items.schema[item_key].dataType),
                           *T.StructType.fromDDL("item_word int, n_words int, n_common int, share double, longest int, doc_word int, doc_words int")])
    blocks, wanted = shared_items(items, item_key, item_text, block_words)
    docs = widened(documents.select(F.col(doc_key).alias("k"), F.col(doc_text).alias("t")))
    return docs.mapInPandas(_searching(blocks, wanted, schema.names, min_words, shard_words), schema)


def _searching(blocks: list[Broadcast], wanted: Broadcast, names: list[str], min_words: int, shard_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, docs, size = WordIds(wanted.value), [], 0
        for b in batches:
            for k, t in zip(b["k"], b["t"], strict=True):
                if isinstance(t, str):
                    docs.append((k, ids.of(words_of(t))))
                    size += len(docs[-1][1]) + 1
                if size >= shard_words:
                    yield frame(docs)
                    docs, size = [], 0
        if docs:
            yield frame(docs)

    def frame(docs) -> pd.DataFrame:
        shard = Shard(docs)
        # one block stays in the worker; of several, one at a time is read from the executor's disk
        loaded = (b.value for b in blocks) if len(blocks) == 1 else (b.load_from_path(b._path) for b in blocks)
        rows = [(docs[d][0], *row) for items in loaded for d, *row in shard.search(items, min_words)]
        return pd.DataFrame(rows, columns=names)

    return run


def without_leaks(documents: DataFrame, found: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """The corpus without the documents that hold passages."""
    return documents.join(found.select(doc_key).distinct(), doc_key, "left_anti")
