"""Differences between two copies of data (problem 5).

Both copies are normalised and compared as bags: one exchange counts every normalised row on both sides, which is EXCEPT
ALL in either direction at once. The two residues are then joined in full by key to list one-sided rows and the fields
that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bag_counts(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Every distinct row over ``cols`` with ``n_left`` and ``n_right``, how often each side holds it. Nulls, NaN and
    zeros of either sign are equal among themselves. Repeated rows are combined before the exchange."""
    side = lambda df, one: df.select(*cols, F.lit(one).cast("bigint").alias("l"), F.lit(1 - one).cast("bigint").alias("r"))
    return side(left, 1).unionByName(side(right, 0)).groupBy(*cols).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def except_all(left: DataFrame, right: DataFrame, cols: list[str], *, distinct: bool = False) -> tuple[DataFrame, DataFrame]:
    """The residues of EXCEPT ALL in both directions: ``cols`` and ``n``, how many copies are left over. With
    ``distinct``, repeated rows of a side count once. Both come from one counted exchange."""
    counts = bag_counts(left, right, cols)
    l, r = (F.least(F.col(c), F.lit(1)) if distinct else F.col(c) for c in ("n_left", "n_right"))
    counts = counts.filter(l != r)
    return (counts.filter(l > r).select(*cols, (l - r).alias("n")), counts.filter(r > l).select(*cols, (r - l).alias("n")))


def keyed_differences(left: DataFrame, right: DataFrame, key: str, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One case per key and differing field of two keyed tables: ``row_key``, ``field`` (``missing_right``: only left,
    ``missing_left``: only right, or the field's name).

    ``fields``: name -> (normalised column of the left, of the right). Identical repeated rows count once. Null equals
    null only. Where both sides hold several different rows of a key, the bags of the field's values are compared; where the rows of
    one are among those of the other, the extra ones are reported as missing.
    A null key is a key like any other. Empty sides give one-sided rows or nothing; other columns are ignored."""
    names = list(fields)
    cols = ["key", *[f"f{i}" for i in range(len(names))]]
    norm = lambda df, side: df.select(F.col(key).alias("key"), *[fields[n][side].alias(f"f{i}") for i, n in enumerate(names)])
    l, r = except_all(norm(left, 0), norm(right, 1), cols, distinct=True)
    l, r = _per_key(l, cols[1:], "l"), _per_key(r, cols[1:], "r")
    both = l.join(r, F.col("lkey").eqNullSafe(F.col("rkey")), "full")
    differs = [F.when(~F.col(f"l{c}").eqNullSafe(F.col(f"r{c}")), F.lit(n)) for c, n in zip(cols[1:], names, strict=True)]
    field = F.when(F.col("rhere").isNull(), F.array(F.lit("missing_right"))).when(F.col("lhere").isNull(), F.array(F.lit("missing_left"))).otherwise(F.array_compact(F.array(*differs)))
    return both.select(F.coalesce("lkey", "rkey").alias("row_key"), F.explode(field).alias("field"))


def _per_key(residue: DataFrame, cols: list[str], side: str) -> DataFrame:
    """One row per key. A field of a key with one row is that value; of several, the sorted bag stands as a fingerprint
    (least, greatest and an order-free sum of hashes), so that no key is gathered into a list."""
    aggs = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(F.lit(1)).alias("n"), F.count(c).alias("set"), F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias("h")).alias(f"{side}{c}") for c in cols]
    return residue.groupBy(F.col("key").alias(f"{side}key")).agg(F.lit(1).alias(f"{side}here"), *aggs)


def group_differences(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Bags of values compared per group: ``key`` and ``field``, ``missing_right`` or ``missing_left`` for a group that
    only one side holds, ``value`` where both hold it but not the same values equally often.

    Null keys form groups of their own. The residues of both EXCEPT ALL directions are brought together by key in one
    exchange with the sizes of the groups: a full join, done as a co-grouping of rows that were combined before."""
    counts = bag_counts(left, right, [*key, value])
    over = lambda a, b: F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0)))
    per = counts.groupBy(*key).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"), over("n_left", "n_right").alias("left_over"), over("n_right", "n_left").alias("right_over"))
    field = F.when(F.col("n_right") == 0, "missing_right").when(F.col("n_left") == 0, "missing_left").otherwise("value")
    return per.filter((F.col("left_over") > 0) | (F.col("right_over") > 0)).select(*key, field.alias("field"))


_INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def comparable(column: str, left: str, right: str) -> tuple[Column, Column]:
    """A column of two copies, of types ``left`` and ``right``, as text that is equal where the values are: two integers exactly, a number
    beside a floating one as double (zeros equal), a date beside a timestamp as timestamp, bytes as hex, all else as it prints. A text that
    is no number or time beside one that is counts as null."""
    pair = {left, right}
    number = lambda t: t in _INTEGERS or t in ("float", "double") or t.startswith("decimal")
    c = F.col(column)
    if pair <= _INTEGERS:
        as_text = c.cast("bigint").cast("string")
    elif pair & {"float", "double"} or any(map(number, pair)) and left != right:
        as_text = (c.try_cast("double") + 0.0).cast("string")
    elif pair & {"date", "timestamp", "timestamp_ntz"}:
        as_text = c.try_cast("timestamp_ntz").cast("string")
    elif "binary" in pair:
        as_text = F.hex(c)
    else:
        as_text = c.cast("string")
    return as_text, as_text


def comparable_fields(left: DataFrame, right: DataFrame, key: str) -> dict[str, tuple[Column, Column]]:
    """``fields`` for ``keyed_differences`` of two copies whose types have drifted apart; columns that one side lacks are left out."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return {c: comparable(c, a[c], b[c]) for c in left.columns if c in b and c != key}


def same_json(text: Column) -> Column:
    """A text that is equal for texts that parse to the same JSON value: keys sorted, escapes and blanks undone. A text
    that does not parse stands for itself, marked so that it equals no parsed one."""
    parsed = F.to_json(F.try_parse_json(text))
    return F.when(text.isNull(), None).otherwise(F.coalesce(parsed, F.concat(F.lit("\x00"), text)))


def catalogue_row_hash(columns: list[str]) -> Column:
    """Lower-case hex SHA-256 of a row: for each column its name, byte 00, the value in UTF-8 (or byte FF for null), byte
    01."""
    zero, one, none = (F.unhex(F.lit(x)) for x in ("00", "01", "FF"))
    parts = [x for c in columns for x in (F.lit(c).cast("binary"), zero, F.coalesce(F.col(c).cast("string").cast("binary"), none), one)]
    return F.sha2(F.concat(*parts), 256)
