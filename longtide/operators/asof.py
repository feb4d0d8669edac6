"""Attributes as known at event time (problem 1).

Facts are sharded by their entity and valid-time key. Each shard is a path-copied persistent search tree with one root
per filing; an event selects the last root filed before it and searches the valid-time key below that root."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_day
from ..functions.persistent import PersistentTree
from ..session import ship

#: Facts of a shard, on average: what one tree holds in memory.
SHARD_FACTS = 50_000
#: Questions that one task answers, or twice what a shard is asked on average, if that is more. A shard that is asked more than
#: twice as many, and more than HOT_SHARE of all, is answered by several tasks, each with its own copy of the tree.
TASK_EVENTS, HOT_SHARE = 100_000, 0.001


def as_known(
    events: DataFrame, facts: DataFrame, *, keys: list[str] = ("metric", "obs_date"), at: str = "read_at", known: str = "vintage_date", tie: str = "fact_id",
    event_columns: list[str] = ("read_id",), fact_columns: list[str] = ("fact_id",), inclusive: bool = False, shard_facts: int = SHARD_FACTS,
) -> DataFrame:
    """Each event with the fact of its ``keys`` that was valid as known at ``at``.

    ``keys``: the entity column and the valid-time column (a date), compared exactly; null meets nothing. Known is a fact
    with ``known`` before the UTC day of ``at`` (on it too if ``inclusive``); valid is the known fact with the latest
    ``known``, among several of that day the one with the highest ``tie``. A fact without ``known`` is never known, an
    event without ``at`` knows nothing. Events without a valid fact do not appear; a repeated event appears as often as
    it is in ``events``. Columns come out under their own names, those of facts with the suffix ``_fact`` where an
    event column has that name; all others are ignored. Empty tables give no rows.

    Facts filed on the same day for the same key are reduced to the valid one before the exchange, so that a key
    holds at most one fact per calendar day however hot it is; questions only stream past the tree, and a shard that
    is asked for a large share of them is repeated under several salts. Nothing is collected but shard numbers."""
    ship(events.sparkSession)
    entity, valid = keys
    ev, fc = list(event_columns), list(fact_columns)
    key_cols = [F.col(entity).alias("k_entity"), F.unix_date(F.col(valid).cast("date")).alias("k_valid")]
    there = F.col(entity).isNotNull() & F.col(valid).isNotNull()
    f = facts.filter(there & F.col(known).isNotNull()).select(*key_cols, F.unix_date(F.col(known).cast("date")).alias("day"), F.col(tie).alias("tie"), *[F.col(c).alias(f"f{i}") for i, c in enumerate(fc)])
    fs = [f"f{i}" for i in range(len(fc))]
    if fc == [tie]:
        f = f.groupBy("k_entity", "k_valid", "day").agg(F.max("tie").alias("f0"))
    else:
        f = f.groupBy("k_entity", "k_valid", "day").agg(F.max(F.struct("tie", *fs)).alias("m")).select("k_entity", "k_valid", "day", *[F.col(f"m.{x}").alias(x) for x in fs])
    es = [f"e{i}" for i in range(len(ev))]
    q = events.filter(there & F.col(at).isNotNull()).select(*key_cols, utc_day(F.col(at).cast("timestamp")).alias("day"), *[F.col(c).alias(e) for c, e in zip(ev, es, strict=True)])
    n_facts, n_events = facts.count(), events.count()
    shards = max(1, -(-n_facts // shard_facts))
    shard = F.pmod(F.xxhash64("k_entity", "k_valid"), F.lit(shards)).cast("int")
    cut = max(TASK_EVENTS, 2 * n_events // shards)
    asked = q.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 2 * cut) & (F.col("n") > n_events * HOT_SHARE))
    hot = asked.select("shard", F.ceil(F.col("n") / cut).cast("int").alias("splits")).collect() if n_events > 2 * cut else []  # at most 1 / HOT_SHARE rows
    splits = F.coalesce(F.create_map(*[F.lit(x) for r in hot for x in r])[shard], F.lit(1)) if hot else F.lit(1)
    f = f.select("*", shard.alias("shard"), F.explode(F.sequence(F.lit(0), splits - 1)).alias("salt"))
    q = q.select("*", shard.alias("shard"), F.pmod(F.xxhash64("day", F.monotonically_increasing_id()), splits).cast("int").alias("salt"))
    tagged = f.withColumn("side", F.lit(0)).unionByName(q.withColumn("side", F.lit(1)), allowMissingColumns=True)
    n_parts = max(int(tagged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(n_facts + n_events) // 500_000))
    placed = tagged.repartition(n_parts, "shard", "salt").sortWithinPartitions("shard", "salt", "side")
    names = ev + [f"{c}_fact" if c in ev else c for c in fc]
    kinds = [q.schema[e].dataType for e in es] + [f.schema[x].dataType for x in fs]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return placed.mapInArrow(_answering(es, fs, names, "right" if inclusive else "left"), schema)


class _Shard:
    """The tree of a shard and what its updates stand for."""

    def __init__(self, parts: list[pa.RecordBatch], payload: list[str]):
        f = pa.Table.from_batches(parts).combine_chunks()
        f = f.take(np.argsort(f["day"].to_numpy(), kind="stable"))
        self.days, self.payload = f["day"].to_numpy(), f.select(payload).combine_chunks()
        self.names = pc.unique(f["k_entity"].combine_chunks())
        self.keys, rank = np.unique(self._key(f), return_inverse=True)
        self.tree = PersistentTree(rank, len(self.keys))

    def _key(self, rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        code = np.asarray(pc.fill_null(pc.index_in(rows["k_entity"], value_set=self.names), -1)).astype(np.int64)
        return (code << 32) + (rows["k_valid"].to_numpy().astype(np.int64) + (1 << 31))

    def answer(self, q: pa.RecordBatch, day_side: str) -> tuple[np.ndarray, np.ndarray]:
        """Of the questions that have an answer, their positions and the updates."""
        key = self._key(q)
        rank = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank[self.keys[rank] != key] = -1
        root = np.searchsorted(self.days, q["day"].to_numpy(), side=day_side) - 1
        hit = self.tree.search(root, rank)
        at = np.flatnonzero(hit >= 0)
        return at, hit[at]


def _answering(es: list[str], fs: list[str], names: list[str], day_side: str):
    """Partitions sorted by shard, salt and side: a shard's facts are gathered, then its questions stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch[c].to_numpy() for c in ("shard", "salt", "side")], axis=1)
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
            for a, b in zip(starts, np.r_[starts[1:], len(ids)], strict=True):
                if (key := tuple(ids[a, :2])) != now:
                    now, parts, shard = key, [], None
                rows = batch.slice(a, b - a)
                if not ids[a, 2]:
                    parts.append(rows.select(["k_entity", "k_valid", "day", *fs]))
                elif parts or shard:
                    shard, parts = shard or _Shard(parts, fs), []
                    at, hit = shard.answer(rows, day_side)
                    if len(at):
                        got = shard.payload.take(hit)
                        yield pa.RecordBatch.from_arrays([rows[e].take(pa.array(at)) for e in es] + [got[x].combine_chunks() for x in fs], names=names)

    return run
