"""Filling fixed-capacity containers with items (problem 6).

Hierarchical residual packing: every partition of the corpus packs its own items best-fit, largest first, and is done with
the containers that are nearly full. The items of all others (their sizes, not their texts) are mixed over tasks and packed best-fit
again; what is still not nearly full goes up a tree as items, until one task holds the few that are left."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship, staged, widened
from .tokens import TOKENIZER, counter

CAPACITY = 2_048
#: A container that is filled to this share goes out.
NEARLY_FULL = 0.995
#: Containers that are not nearly full which a task of the tree passes up, the emptiest ones. It bounds what a task holds and is reached
#: only where sizes cannot be combined: each task holds a random mixture of what was left, so the others' like are there too.
PASS_UP = 20_000
#: Tasks whose leftovers one task takes in the next round of the tree.
FAN_IN = 16
#: Items that are packed at a time within a partition, which bounds a task's memory.
CHUNK = 200_000


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit of items in falling order of size: of each item its bin and offset, and the load of each bin. Items of no
    size take no room and stand at the start of the first bins, at most ``capacity`` in each. Equal sizes keep their order."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets, loads = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), []
    free: list[tuple[int, int]] = []  # (room left, bin), in order
    for n, i in enumerate(order):
        s = int(sizes[i])
        if s == 0:
            zeros = order[n:]
            bins[zeros], offsets[zeros] = np.arange(len(zeros)) // max(capacity, 1), 0
            loads += [0] * max(0, int(bins[zeros].max()) + 1 - len(loads))
            break
        at = bisect_left(free, (s, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(loads)
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += s
        if room > s:
            insort(free, (room - s, b))
    return bins, offsets, np.array(loads, dtype=np.int64)


def going_out(loads: np.ndarray, capacity: int, nearly: float, pass_up: int = PASS_UP) -> np.ndarray:
    """Which containers a task of the tree is done with: the nearly full ones, and those beyond the ``pass_up`` emptiest."""
    out = loads >= nearly * capacity
    rest = np.flatnonzero(~out)
    out[rest[np.argsort(loads[rest], kind="stable")[pass_up:]]] = True
    return out


def _pieces(n: int, capacity: int) -> list[int]:
    """Sizes of the pieces of an item; only one that exceeds the capacity has several."""
    return [n] if n <= capacity else [capacity] * (n // capacity) + ([n % capacity] if n % capacity else [])


def _local(capacity: int, tokenizer: str, chunk: int, nearly: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, held, held_n, made = counter(tokenizer), [], 0, 0
        for b in batches:
            sizes = count([t if isinstance(t, str) else "" for t in b["text"]])
            held.append((b["part"].iloc[0] if len(b) else 0, b["k"], sizes))
            held_n += len(b)
            if held_n >= chunk:
                yield place(held, made)
                held, held_n, made = [], 0, made + 1
        if held_n:
            yield place(held, made)

    def place(held, made: int) -> pd.DataFrame:
        keys = pd.concat([k for _, k, _ in held], ignore_index=True)
        n = np.array([s for _, _, x in held for s in x], dtype=np.int64)
        cut = [_pieces(int(s), capacity) for s in n]
        of = np.repeat(np.arange(len(n)), [len(c) for c in cut])
        sizes = np.array([s for c in cut for s in c], dtype=np.int64)
        piece = np.array([i for c in cut for i in range(len(c))], dtype=np.int32)
        bins, offsets, loads = best_fit(sizes, capacity)
        name = np.array([f"{held[0][0]}-{made}-{b}" for b in range(len(loads))], dtype=object)
        return pd.DataFrame({"k": keys.to_numpy()[of], "piece": piece, "n_tokens": sizes, "container": name[bins], "place": offsets, "full": (loads >= nearly * capacity)[bins]})

    return run


def _again(capacity: int, nearly: float, round_: int, last: bool):
    """One task's items, which come from several tasks, packed best-fit again; the last task is done with all."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "container", "place"], ascending=[False, True, True], kind="stable")
        bins, offsets, loads = best_fit(pdf["n_tokens"].to_numpy(), capacity)
        done = np.ones(len(loads), dtype=bool) if last else going_out(loads, capacity, nearly)
        name = np.array([f"r{round_}-{key[0]}-{b}" for b in range(len(loads))], dtype=object)
        return pdf.drop(columns="g").assign(container=name[bins], place=offsets, full=done[bins])

    return run


def pack(documents: DataFrame, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, nearly: float = NEARLY_FULL, fan_in: int = FAN_IN, chunk: int = CHUNK) -> DataFrame:
    """Container and place of every item: ``key``, ``piece`` (0 unless the item exceeds the capacity), ``n_tokens``,
    ``container``, ``place`` (first token's position in the container).

    One row per row of ``documents`` and piece; repeated keys are items of their own. Null and empty texts have no tokens
    and stand at place 0 of some container. Other columns are ignored; an empty table gives no rows. Each round of the tree
    moves keys and sizes only, of items whose container is not nearly full; texts are shuffled only where they come in fewer partitions
    than there are cores."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType
    schema = T.StructType([T.StructField("k", kind), *T.StructType.fromDDL("piece int, n_tokens bigint, container string, place bigint, full boolean").fields])
    source = widened(documents.select(F.col(key).alias("k"), F.col(text).alias("text"))).withColumn("part", F.spark_partition_id())
    placed = staged(source.mapInPandas(_local(capacity, tokenizer, chunk, nearly), schema), "packed")
    done, left, round_ = placed.filter("full"), placed.filter(~F.col("full")), 0
    groups = max(1, -(-left.count() // chunk))
    while True:
        mixed = left.withColumn("g", F.pmod(F.xxhash64("container", "place", "k", "piece"), F.lit(groups)).cast("int"))
        now = staged(mixed.groupBy("g").applyInPandas(_again(capacity, nearly, round_, groups == 1), schema), "repacked")
        done = done.unionByName(now.filter("full"))
        if groups == 1:
            break
        left, round_, groups = now.filter(~F.col("full")), round_ + 1, -(-groups // fan_in)
    return done.select(F.col("k").alias(key), "piece", "n_tokens", "container", "place")


def waste(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``n_containers``, ``n_tokens``, ``share_left`` (of all space in the containers that hold any token; null for none)."""
    per = packed.groupBy("container").agg(F.sum("n_tokens").alias("load")).filter(F.col("load") > 0)
    return per.agg(F.count(F.lit(1)).alias("n_containers"), F.coalesce(F.sum("load"), F.lit(0)).alias("n_tokens")).withColumn("share_left", 1 - F.col("n_tokens") / F.nullif(F.col("n_containers") * capacity, F.lit(0)))
