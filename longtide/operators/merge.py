"""Keyed merge of stored and new observations: the last row of a key wins, null keys are equal, nothing shrinks unseen, and
the report says exactly which series changed."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyRefusal, ReportRefusal, SchemaRefusal, ShrinkRefusal
from ..session import staged

KEYS = ("series_key", "obs_date")
_NEW = 1 << 61


def tagged(existing: DataFrame, incoming: DataFrame, position: str | None = None) -> DataFrame:
    """Existing rows, then new ones, with ``__new`` and ``__rank``, which rises with age order. ``position``: a column that
    orders the rows of a side; without it, the order in which they are read. A column that only new rows have is null
    for existing ones; a stored column that new rows lack is refused."""
    if missing := [c for c in existing.columns if c not in incoming.columns and c != position]:
        raise SchemaRefusal(f"new rows lack the stored columns {missing}")
    pos = F.col(position).cast("bigint") if position else F.monotonically_increasing_id()
    old = existing.withColumn("__rank", pos).withColumn("__new", F.lit(False))
    new = incoming.withColumn("__rank", pos + F.lit(_NEW)).withColumn("__new", F.lit(True))
    return old.unionByName(new, allowMissingColumns=True)


def merge_keep_last(existing: DataFrame, incoming: DataFrame, keys: list[str] = KEYS, position: str | None = None) -> DataFrame:
    """One row per key, the newest: any new row beats all existing ones, within a side the later. Null keys are equal. A
    hash aggregate with map-side combine, so repeated rows of one key never meet in one task unreduced."""
    rows = tagged(existing, incoming, position)
    rest = [c for c in rows.columns if c not in (*keys, "__rank", "__new", position)]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "__rank").alias(c) for c in rest])


def changed_keys(existing: DataFrame, incoming: DataFrame, keys: list[str] = KEYS, value: str = "value", position: str | None = None) -> DataFrame:
    """Which series a merge changes: the first key, and ``last_changed``, the latest second key among its changes (null if
    that is null). A key without existing rows is a change; otherwise the last existing value must differ from the
    winner's (null equals null, NaN equals NaN, no tolerance)."""
    series, date = keys
    rows = tagged(existing, incoming, position)
    per = rows.groupBy(*keys).agg(
        F.max_by(value, "__rank").alias("now"),
        F.expr(f"max_by(`{value}`, __rank) FILTER (WHERE NOT __new)").alias("was"),
        F.count_if(~F.col("__new")).alias("n_old"),
    )
    hit = per.filter((F.col("n_old") == 0) | ~F.col("was").eqNullSafe(F.col("now")))
    return hit.groupBy(series).agg(F.max(date).alias("last_changed"))


def merge_counts(existing: DataFrame, incoming: DataFrame, keys: list[str] = KEYS, position: str | None = None) -> DataFrame:
    """One row: ``n_existing``, ``n_incoming``, ``n_merged``, ``last_date``."""
    rows = tagged(existing, incoming, position)
    per = rows.groupBy(*keys).agg(F.count_if(~F.col("__new")).alias("o"), F.count_if("__new").alias("n"))
    return per.agg(F.sum("o").alias("n_existing"), F.sum("n").alias("n_incoming"), F.count(F.lit(1)).alias("n_merged"), F.max(keys[-1]).alias("last_date"))


def first_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Read-side dedup: the first row of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.min_by(c, position).alias(c) for c in rest if c != position])


def max_wins(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Collapse to a coarser grain: the greatest value of each key."""
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def guard(n_old: int, n_new: int, min_ratio: float = 0.97, allow_empty: bool = False) -> None:
    """Refuse an empty result, and one that shrinks the store below ``min_ratio``."""
    if n_new == 0 and not allow_empty:
        raise EmptyRefusal("no rows to write")
    if n_old and n_new < n_old * min_ratio:
        raise ShrinkRefusal(f"{n_old} rows would become {n_new}")


def merge_and_write(
    spark: SparkSession, path: str, incoming: DataFrame, *, mode: str = "merge", keys: list[str] = KEYS, min_ratio: float = 0.97, allow_empty: bool = False,
    report_changed: bool = False, report_cap: int | None = None, position: str | None = None,
) -> tuple[int, object, DataFrame | None]:
    """Merge ``incoming`` into the Parquet table at ``path`` (or overwrite it), behind the guards. Returns the number of rows, the last
    date, and the changed series if asked for (merge mode only; refused before anything is read if there are more than ``report_cap``
    new rows). The new table is written beside the old one, in key order over all files (nulls last), so a failed write leaves the old
    one as it was. Publishing sets the old table aside and moves the new one in; should that be broken off in between, the
    next call, or ``recover``, finishes it."""
    if mode not in ("merge", "overwrite"):
        raise ValueError(mode)
    if report_changed and mode != "merge":
        raise ValueError("changed series are reported for merges only")
    if lacking := [k for k in keys if k not in incoming.columns]:
        raise SchemaRefusal(f"key columns {lacking} do not exist")
    if report_changed and report_cap is not None and incoming.limit(report_cap + 1).count() > report_cap:
        raise ReportRefusal(f"more than {report_cap} new rows")
    fs, jpath = _fs(spark, path)
    recover(spark, path)
    stored = spark.read.parquet(path) if fs.exists(jpath(path)) else None
    n_old = stored.count() if stored is not None else 0
    if mode == "merge" and stored is not None:
        result = merge_keep_last(stored, incoming, keys, position if position in stored.columns else None)
    elif mode == "merge":
        result = merge_keep_last(incoming.limit(0), incoming, keys, position)
    else:
        result = incoming
    side = f"{path}.new-{uuid.uuid4().hex[:8]}"
    order = [F.col(k).asc_nulls_last() for k in keys]
    result.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(side)
    written = spark.read.parquet(side)
    n, last = written.agg(F.count(F.lit(1)), F.max(keys[-1])).first()
    try:
        guard(n_old, n, min_ratio, allow_empty)
    except Exception:
        fs.delete(jpath(side), True)
        raise
    changed = None
    if report_changed:
        changed = staged(changed_keys(stored if stored is not None else incoming.limit(0), incoming, keys, position=position if stored is None or position in stored.columns else None), "changed")
    ready = f"{path}.ready"
    fs.rename(jpath(side), jpath(ready))  # from here on the new table counts
    _publish(fs, jpath, path, ready)
    return n, last, changed


def _publish(fs, jpath, path: str, ready: str) -> None:
    old = f"{path}.old"
    if fs.exists(jpath(path)):
        fs.rename(jpath(path), jpath(old))
    fs.rename(jpath(ready), jpath(path))
    fs.delete(jpath(old), True)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a publication that was broken off; True if there was one."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath(f"{path}.ready")):
        fs.delete(jpath(f"{path}.old"), True)
        return False
    if fs.exists(jpath(path)):
        fs.delete(jpath(f"{path}.old"), True)
    _publish(fs, jpath, path, f"{path}.ready")
    return True


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


# --- comparing two vintages of a store ------------------------------------------------------------------------------------


def _sided(old: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    return old.select(*cols, F.lit(0).alias("__s")).unionByName(new.select(*cols, F.lit(1).alias("__s")))


def key_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``n_old`` and ``n_new`` of every key; null keys equal. One exchange, combined before it: a full outer join."""
    return _sided(old, new, list(keys)).groupBy(*keys).agg(F.count_if(F.col("__s") == 0).alias("n_old"), F.count_if(F.col("__s") == 1).alias("n_new"))


def multiset_loss(old: DataFrame, new: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """``lost_rows``: copies of keys that ``new`` holds less often; ``lost_keys``: keys that it holds less often."""
    d = F.greatest(F.col("n_old") - F.col("n_new"), F.lit(0))
    return key_counts(old, new, keys).agg(F.coalesce(F.sum(d), F.lit(0)).alias("lost_rows"), F.count_if(d > 0).alias("lost_keys"))


def revised_series(old: DataFrame, new: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Of two tables with unique keys, the series with a key that is new or whose value differs: first key, and
    ``last_changed``, the latest second key among them that ``new`` holds."""
    per = _sided(old, new, [*keys, value]).groupBy(*keys).agg(
        F.max_by(value, "__s").alias("v1"), F.min_by(value, "__s").alias("v0"), F.max("__s").alias("hi"), F.min("__s").alias("lo"))
    changed = per.filter((F.col("lo") != F.col("hi")) & ~F.col("v0").eqNullSafe(F.col("v1")) | (F.col("lo") == 1) | (F.col("hi") == 0))
    return changed.groupBy(keys[0]).agg(F.max(F.when(F.col("hi") == 1, F.col(keys[1]))).alias("last_changed"))


def tail_gain_loss(old: DataFrame, new: DataFrame, keys: list[str], by: Column | None = None) -> DataFrame:
    """``gained`` and ``lost`` copies of keys, over all or per ``by`` (an expression of the keys)."""
    c = key_counts(old, new, keys)
    gain, loss = (F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0))).alias(n) for a, b, n in (("n_new", "n_old", "gained"), ("n_old", "n_new", "lost")))
    return (c.groupBy(by) if by is not None else c).agg(gain, loss)


def dropped_series(old: DataFrame, new: DataFrame, key: str, allowed: list[str] = ()) -> DataFrame:
    """Series of ``old`` that ``new`` lacks and that are not on the list of those that may go; null is a key like others."""
    c = key_counts(old, new, [key]).filter((F.col("n_old") > 0) & (F.col("n_new") == 0))
    return c.filter(~F.coalesce(F.col(key).isin(list(allowed)), F.lit(False))).select(key) if allowed else c.select(key)


def key_overlap(old: DataFrame, new: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Of two tables with unique keys: ``matched``, ``revised`` (value distinct), ``only_old``, ``only_new``."""
    per = _sided(old, new, [*keys, value]).groupBy(*keys).agg(
        F.max_by(value, "__s").alias("v1"), F.min_by(value, "__s").alias("v0"), F.max("__s").alias("hi"), F.min("__s").alias("lo"))
    both = F.col("lo") != F.col("hi")
    return per.agg(F.count_if(both).alias("matched"), F.count_if(both & ~F.col("v0").eqNullSafe(F.col("v1"))).alias("revised"),
                   F.count_if(F.col("hi") == 0).alias("only_old"), F.count_if(F.col("lo") == 1).alias("only_new"))


def multiset_union(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Every row as often as the side that holds it most; nulls equal. Copies are written out in blocks, so a row that stands a
    billion times never becomes one array."""
    n, block = F.greatest("n_old", "n_new"), 4096
    blocks = key_counts(left, right, cols).select(*cols, n.alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / block))).alias("__b"))
    return blocks.select(*cols, F.explode(F.array_repeat(F.lit(1), F.least(F.lit(block), F.col("__n") - F.col("__b") * block).cast("int"))).alias("__i")).drop("__i")


def supersede(old: DataFrame, new: DataFrame, key: Column, keys: list[str] = KEYS) -> DataFrame:
    """The new rows, and the old ones whose normalised key (``key``, an expression) and other keys the new ones lack."""
    on = ["__k", *keys[1:]]
    o, n = old.withColumn("__k", key), new.withColumn("__k", key)
    theirs = n.select(*[F.col(c).alias(f"__{c}") for c in on]).distinct()
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return n.drop("__k").unionByName(o.join(theirs, cond, "left_anti").drop("__k"))


def keep_served(old: DataFrame, new: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """The new value of each key, the old one where the new table lacks the key. Refused where the two cannot be merged safely: other
    columns, a key that stands twice in one of them, or dates given as text that are not exactly YYYY-MM-DD."""
    if sorted(old.columns) != sorted(new.columns):
        raise SchemaRefusal("the columns of the two tables differ")
    both = _sided(old, new, [*keys, value])
    per = both.groupBy(*keys).agg(F.max_by(value, "__s").alias(value), F.greatest(F.count_if(F.col("__s") == 0), F.count_if(F.col("__s") == 1)).alias("__n"))
    odd = ~F.coalesce(F.col(keys[-1]).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)) if dict(old.dtypes)[keys[-1]] == "string" else F.lit(False)
    twice, unclear = per.agg(F.coalesce(F.bool_or(F.col("__n") > 1), F.lit(False)), F.coalesce(F.bool_or(odd), F.lit(False))).first()
    if twice or unclear:
        raise SchemaRefusal("a key stands twice in one table" if twice else "a date is not written YYYY-MM-DD")
    return per.drop("__n")


#: A delivery that spells more than this share of the known series another way is held.
RESPELLED_SHARE = 0.05


def respelled_held(counts: DataFrame, share: float = RESPELLED_SHARE) -> DataFrame:
    """The counts of ``respelled_split`` with ``held``: more than ``share`` of the staged keys of known series come in another spelling,
    so that merging them would double these series."""
    known = F.col("n_known") + F.col("n_extended") + F.col("n_respelled")
    return counts.withColumn("held", F.col("n_respelled") > share * known)


def respelled_split(stored: DataFrame, staged: DataFrame, norm: Column, keys: list[str] = KEYS) -> DataFrame:
    """How staged keys relate to stored ones under a normalised spelling: one row of counts, ``n_staged`` = ``n_known`` (same
    spelling, same date) + ``n_extended`` (known series, new date) + ``n_respelled`` (a series known under another
    spelling) + ``n_unknown``."""
    series, date = keys
    s = staged.select(series, date, norm.alias("__k")).distinct()
    t = stored.select(series, date, norm.alias("__k")).distinct()
    both = s.withColumn("__s", F.lit(1)).unionByName(t.withColumn("__s", F.lit(0)))
    per = both.groupBy("__k", series, date).agg(F.max("__s").alias("staged"), F.min("__s").alias("lo"))
    per = per.withColumn("known", (F.col("lo") == 0) & (F.col("staged") == 1))
    of_series = both.groupBy("__k", series).agg(F.count_if(F.col("__s") == 0).alias("n_spelt"))
    of_norm = of_series.groupBy("__k").agg(F.sum("n_spelt").alias("n_norm"))
    j = per.filter("staged = 1").join(of_series, ["__k", series]).join(of_norm, "__k")
    return j.agg(F.count(F.lit(1)).alias("n_staged"), F.count_if("known").alias("n_known"), F.count_if(~F.col("known") & (F.col("n_spelt") > 0)).alias("n_extended"),
                 F.count_if((F.col("n_spelt") == 0) & (F.col("n_norm") > 0)).alias("n_respelled"), F.count_if(F.col("n_norm") == 0).alias("n_unknown"))


def rebuild_refusals(old: DataFrame, new: DataFrame, cutoff: str, allowed: list[str] = (), floor_bp: int = 50, keys: list[str] = KEYS) -> list[str]:
    """Why a row-replacing rebuild must not be published: rows before ``cutoff`` differ, the tail is empty, a series
    vanishes, or more than ``floor_bp`` ten-thousandths of the old tail are lost. An empty list means it may."""
    from ..functions.hashing import content_fingerprint

    cols = [c for c in old.columns if c in new.columns]
    below = F.col(keys[1]) < F.lit(cutoff).cast("date")
    a, b = (d.filter(below).agg(content_fingerprint(cols)).first()[0] for d in (old, new))
    old_tail, new_tail = old.filter(~below), new.filter(~below)
    n_old, n_new = old_tail.count(), new_tail.count()
    lost = tail_gain_loss(old_tail, new_tail, list(keys)).first()["lost"] or 0
    gone = dropped_series(old_tail, new_tail, keys[0], list(allowed)).limit(5).collect()
    checks = [(a != b, "rows before the window differ"), (n_new == 0, "the new tail is empty"), (bool(gone), f"series vanish: {[r[0] for r in gone]}"), (lost > n_old * floor_bp // 10_000, f"{lost} of {n_old} tail rows are lost")]
    return [why for bad, why in checks if bad]


def key_runs(df: DataFrame, keys: list[str] = KEYS, order: str = "row_no") -> DataFrame:
    """Rows numbered by run of equal keys in key order: ``run`` (from 0) and ``last`` (the last row of its run). Null equals
    null. Runs are numbered within the first key, so that no window spans the table."""
    from pyspark.sql import Window

    w = Window.partitionBy(keys[0]).orderBy(*[F.col(k).asc_nulls_last() for k in keys[1:]], order)
    before, after = F.lag("__k").over(w), F.lead("__k").over(w)
    out = df.withColumn("__k", F.struct(*keys)).withColumn("__new", (before.isNull() | ~before.eqNullSafe(F.col("__k"))).cast("int")).withColumn("last", after.isNull() | ~after.eqNullSafe(F.col("__k")))
    return out.withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).drop("__k", "__new")
