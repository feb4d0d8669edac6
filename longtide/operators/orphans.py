"""References to records that do not exist (problem 4).

Composite keys may hold nulls in part. References are grouped by null mask; each mask is anti-joined on its non-null
columns, and the declared match semantics decides what a partly null key means. A target holds on a day from its
first day (included) to its last (excluded)."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import BROADCAST_ROWS, fits_broadcast, spread


@dataclass(frozen=True)
class Reference:
    """``columns`` of a child table refer to ``target_columns`` of a parent.

    match: ``simple`` (a key with a null refers to nothing), ``full`` (all null refers to nothing, a mixture is an orphan)
    or ``partial`` (the non-null columns must be found together). ``day``: the child's column with the day on which
    the target had to hold; without it, any time will do."""

    field: str
    columns: list[str]
    target: DataFrame = field(repr=False)
    target_columns: list[str]
    day: str | None = None
    holds_from: str | None = None
    holds_to: str | None = None
    match: str = "simple"


def blank_as_null(c: Column) -> Column:
    """Null for a text of nothing but white space; other types as they are."""
    return F.when(~c.rlike(r"^[\s  -​　]*$"), c)


def orphans(child: DataFrame, ref: Reference, keep: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``child`` whose reference finds no target that holds on their day: columns ``keep`` (prefixed ``k_``
    inside, so that names may clash with the parent's), once per row of ``child``.

    Blank texts in reference columns count as null; otherwise keys are compared exactly. A child without a day has
    its reference checked as if nothing held then. A target without ``holds_from`` never holds; one without ``holds_to``
    still does. Parents are broadcast only if measured to have at most ``broadcast_rows`` rows; beyond that, hot keys are salted."""
    if ref.match not in ("simple", "full", "partial"):
        raise ValueError(f"unknown match semantics: {ref.match}")
    n = len(ref.columns)
    kinds = dict(child.dtypes)
    key = [blank_as_null(F.col(c)) if kinds[c] == "string" else F.col(c) for c in ref.columns]
    day = F.col(ref.day).cast("date") if ref.day else F.lit(None).cast("date")
    rows = child.select(*[k.alias(f"c{i}") for i, k in enumerate(key)], day.alias("day"), *[F.col(c).alias(f"k_{c}") for c in keep])
    start = F.col(ref.holds_from).cast("date") if ref.holds_from else F.lit(None).cast("date")
    end = F.col(ref.holds_to).cast("date") if ref.holds_to else F.lit(None).cast("date")
    parent = ref.target.select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(ref.target_columns)], start.alias("start"), end.alias("end"))
    if ref.holds_from:
        parent = parent.filter(F.col("start").isNotNull())
    parent = parent.distinct()
    small = broadcast_rows > 0 and fits_broadcast(parent, broadcast_rows)
    found = []
    for mask in product((True, False), repeat=n):  # which columns are set; 2 ** n masks of a declared key
        on = [i for i in range(n) if mask[i]]
        of = rows.filter(_all(F.col(f"c{i}").isNotNull() if mask[i] else F.col(f"c{i}").isNull() for i in range(n)))
        if not on or (len(on) < n and ref.match == "simple"):
            continue
        if len(on) < n and ref.match == "full":
            found.append(of)
            continue
        found.append(_anti(of, parent, on, bool(ref.day and ref.holds_from), small))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep])


def _anti(rows: DataFrame, parent: DataFrame, on: list[int], dated: bool, small: bool) -> DataFrame:
    ps = [f"p{i}" for i in on]
    if small:
        right, cond = F.broadcast(parent), F.lit(True)
        left = rows
    else:
        keyed = parent.select(*[F.col(f"p{i}").alias(f"c{i}") for i in on], "start", "end")
        left, right = spread(rows, keyed, [f"c{i}" for i in on])
        right = right.select(*[F.col(f"c{i}").alias(f"p{i}") for i in on], "start", "end", F.col("__salt").alias("salt"))
        cond = F.col("__salt") == F.col("salt")
    for i, p in zip(on, ps, strict=True):
        cond = cond & (F.col(f"c{i}") == F.col(p))
    if dated:
        cond = cond & (F.col("start") <= F.col("day")) & (F.col("end").isNull() | (F.col("day") < F.col("end")))
    return left.join(right, cond, "left_anti").drop("__salt")


def _all(conds) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def orphan_report(child: DataFrame, refs: list[Reference], table: str) -> DataFrame:
    """Orphans counted per table, field and month: ``table_name``, ``ref_field``, ``month`` (first day; null without a
    day), ``n_orphans`` (rows of the child)."""
    parts = [
        orphans(child, r, [r.day] if r.day else [])
        .groupBy(F.trunc(F.col(r.day), "month").alias("month") if r.day else F.lit(None).cast("date").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_orphans"))
        .select(F.lit(table).alias("table_name"), F.lit(r.field).alias("ref_field"), "month", "n_orphans")
        for r in refs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
