"""Finding, filtering and shaping series."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import NotFound, UnsupportedFilter

# Aggregate codes that stand for income groups.
GEO_CODES = {"XD": "HIC", "XM": "LIC", "XN": "LMC", "XT": "UMC"}


def exact(key: str, native: str) -> Column:
    """The series with exactly this key."""
    return F.col(key) == F.lit(native)


def grain(key: str, native: str, separator: str = ":") -> Column:
    """The series itself, and all whose key goes on after a separator; the separator keeps AB from meeting ABC."""
    return (F.col(key) == F.lit(native)) | F.col(key).startswith(native + separator)


def id_range(key: str, prefix: str) -> Column:
    """Keys with a prefix, as a range that scans can use."""
    return (F.col(key) >= prefix) & (F.col(key) < prefix[:-1] + chr(ord(prefix[-1]) + 1)) if prefix else F.lit(True)


@dataclass(frozen=True)
class Resolution:
    """Where a series is found, and how its rows become tidy. ``native``: the rows are those whose key is this one or goes on from it after
    ``separator``, so that many series can be found by one join; else ``predicate`` tells them."""

    path: str
    key: str
    predicate: Column | None = None
    stamp: str | None = None
    row_id: list[str] = field(default_factory=list)
    dedup: list[str] | None = None
    native: str | None = None
    separator: str = ":"


class Registry:
    """A rule per source that turns a native id into a ``Resolution``, and a general one for the rest."""

    def __init__(self, default: Callable[[str, str], Resolution]):
        self.rules: dict[str, Callable[[str, str], Resolution]] = {}
        self.default = default

    def rule(self, source: str):
        def add(f):
            self.rules[source] = f
            return f

        return add

    def resolve(self, series_id: str) -> Resolution:
        source, _, native = series_id.partition(":")
        if not native:
            raise NotFound(f"no native key in {series_id!r}")
        return self.rules.get(source, self.default)(source, native)

    def sources(self) -> list[str]:
        return sorted(self.rules)


def by_grain(store: DataFrame, natives: DataFrame, key: str, separator: str = ":") -> DataFrame:
    """The rows of all series in ``natives`` (column ``native``), as ``grain`` finds them for one: a semi join on the key's own prefixes, which are
    made once per different key."""
    parts = F.split(F.col(key), "[" + separator + "]")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), separator))
    keys = store.select(key).distinct().withColumn("native", F.explode(prefixes)).join(natives.select("native").distinct(), "native", "left_semi").select(key).distinct()
    return store.join(keys, key, "left_semi")


def longest_prefix(ids: DataFrame, names: DataFrame, id_col: str, name_col: str, separator: str = ".") -> DataFrame:
    """For each id, the longest name that is the id or a prefix of it up to a separator (null if none). An equi-join on the
    id's own prefixes, of which there are as many as it has parts."""
    parts = F.split(F.col(id_col), "[" + separator + "]")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), separator))
    return ids.select(id_col).distinct().withColumn("__p", F.explode(prefixes)).join(names.select(F.col(name_col).alias("__p"), F.col(name_col)).distinct(), "__p", "left").groupBy(id_col).agg(F.max_by(name_col, F.length(name_col)).alias(name_col))


def date_window(df: DataFrame, start: str | None = None, end: str | None = None, date: str = "obs_date") -> DataFrame:
    """Rows from ``start`` to ``end``, both included; either may be missing."""
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    return df if end is None else df.filter(F.col(date) <= F.lit(end).cast("date"))


def geo_projection(df: DataFrame, geo: str, key: str = "series_key") -> DataFrame:
    """Rows whose key ends with this geography."""
    return df.filter(F.substring_index(F.col(key), ":", -1) == geo)


def geo_alias(series_id: Column) -> Column:
    """A three-part id as its two-part canonical id and geography: struct ``canonical``, ``geo`` (null unless the last part
    is a code of two or three capitals or digits, both before and after mapping)."""
    parts = F.split(series_id, ":")
    last = F.when(F.size(parts) == 3, F.get(parts, F.lit(2)))
    mapped = F.coalesce(F.create_map(*[F.lit(x) for kv in GEO_CODES.items() for x in kv])[last], last)
    ok = last.rlike("^[A-Z0-9]{2,3}$") & mapped.rlike("^[A-Z0-9]{2,3}$")
    return F.struct(F.when(ok, F.concat_ws(":", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).alias("canonical"), F.when(ok, mapped).alias("geo"))


def mask(catalogue: DataFrame, provider: str, dataset: str | None = None, **filters: list | None) -> DataFrame:
    """Ids of a provider's series, sorted, with the given values in each field. A dataset is an id, a prefix of ids or a
    category. An empty list of values matches nothing; an unknown field is refused."""
    out = catalogue.filter(F.col("series_id").startswith(provider + ":"))
    if dataset is not None:
        base = f"{provider}:{dataset}"
        out = out.filter((F.col("series_id") == base) | F.col("series_id").startswith(base + ":") | F.coalesce(F.col("category") == dataset, F.lit(False)))
    for name, values in filters.items():
        if name not in ("frequency", "geography", "unit", "category"):
            raise UnsupportedFilter(name)
        if values is not None:
            out = out.filter(F.col(name).isin(list(values)) if values else F.lit(False))
    return out.select("series_id").distinct().orderBy("series_id")


def tidy(df: DataFrame, source: str, key: str = "series_key", stamp: str | None = None, dedup: list[str] | None = None, position: str | None = None) -> DataFrame:
    """Exactly ``series_id``, ``source``, ``obs_date``, ``value``: the key or a constant stamp as id, values coerced to
    numbers (null where they are none). ``dedup``: keep the first row of these keys, by ``position``."""
    if dedup:
        from .merge import first_wins

        df = first_wins(df, dedup, position)
    sid = F.lit(stamp) if stamp else F.concat(F.lit(source + ":"), F.col(key))
    return df.select(sid.alias("series_id"), F.lit(source).alias("source"), "obs_date", F.col("value").try_cast("double").alias("value"))


def row_id(base: str, columns: list[str]) -> Column:
    """``base|NAME=value|...`` with nothing for a null."""
    return F.concat(F.col(base), *[x for c in columns for x in (F.lit(f"|{c}="), F.coalesce(F.col(c).cast("string"), F.lit("")))])


def dimension_key(columns: list[str]) -> Column:
    """``DIM=value:DIM=value`` without empty dimensions."""
    return F.concat_ws(":", *[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(c + "="), F.col(c).cast("string"))) for c in columns])


def wide(df: DataFrame, ids: list[str], key: str = "series_id") -> DataFrame:
    """One row per date, one column per listed series, the last value of each cell, nothing filled in. ``ids`` come from a
    resolved mask, so they bound the columns."""
    pos = F.struct("value") if "row_no" not in df.columns else F.col("row_no")
    return df.groupBy("obs_date").pivot(key, ids).agg(F.max_by("value", pos))


def melt(df: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    """Wide columns as rows ``variable``, ``value``; only finite values."""
    out = df.select(*ids, *[F.col(c).try_cast("double").alias(c) for c in values]).unpivot(ids, values, "variable", "value")
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))


def latest_gate(catalogue: DataFrame, sources: DataFrame, licenses: DataFrame) -> DataFrame:
    """Every catalogued id with its gate: ``open``, ``closed``, or ``unknown``, which is never taken for open."""
    lic = licenses.filter(F.col("removed_on").isNull()).groupBy("license_id").agg(F.max("reservable").alias("reservable"))
    src = sources.filter(F.col("removed_on").isNull()).groupBy("source_id").agg(F.max("license_id").alias("source_license"))
    j = catalogue.join(src, "source_id", "left").withColumn("lic", F.coalesce(F.nullif(F.trim("license_id"), F.lit("")), F.nullif(F.trim("source_license"), F.lit(""))))
    j = j.join(lic.withColumnRenamed("license_id", "lic"), "lic", "left")
    return j.select("series_id", F.when(F.col("reservable") == 1, "open").when(F.col("reservable") == 0, "closed").otherwise("unknown").alias("gate")).distinct()


def advanced(new: Column, old: Column) -> Column:
    """Has a source moved on? Two orderable dates: later; two others: different; a mixture: no. Nothing new: no; nothing
    old: yes."""
    ok = lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}") & F.substring(c, 1, 10).between("1500-01-01", "2200-01-01")
    blank = lambda c: c.isNull() | (c == "")
    return F.when(blank(new), False).when(blank(old), True).when(ok(new) & ok(old), F.substring(new, 1, 10) > F.substring(old, 1, 10)).when(~ok(new) & ~ok(old), new != old).otherwise(False)


def sane_since(stored: Column, today: Column, horizon: int = 400) -> Column:
    """A stored maximum that may serve as a start: null if it is unreadable or more than ``horizon`` days ahead."""
    d = F.substring(stored, 1, 10).try_cast("date")
    return F.when(d <= F.date_add(today, horizon), d)


def revision_since(last: Column, days: int | Column = 45) -> Column:
    """Where a fetch that may find revisions starts: ``days`` back, not before 1900."""
    return F.greatest(F.date_sub(last, days), F.lit("1900-01-01").cast("date"))
