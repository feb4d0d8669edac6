"""Coverage, grain and convention rollups over long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import SchemaRefusal
from ..functions.hashing import content_fingerprint, portable_fingerprint
from ..functions.periods import frequency_of_gap
from ..session import staged
from .skew import fits_broadcast


def bilateral_totals(flows: DataFrame, a: str, b: str, year: str, measures: dict[str, str], codes: DataFrame | None = None) -> DataFrame:
    """Totals of each measure per pair and year, as rows ``series_key`` (a.b.measure), ``obs_date`` (the year's last day),
    ``value``; a null sum gives no row. ``codes`` (one column, ``code``): codes that are not in it are refused."""
    sums = flows.groupBy(a, b, year).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    if codes is not None:
        used = sums.select(F.explode(F.array(a, b)).alias("code")).distinct()
        if unknown := [r[0] for r in used.join(codes.select("code").distinct(), "code", "left_anti").limit(5).collect()]:
            raise SchemaRefusal(f"codes without a mapping: {unknown}")
    long = sums.unpivot([a, b, year], list(measures), "measure", "value").filter(F.col("value").isNotNull())
    return long.select(F.concat_ws(".", a, b, "measure").alias("series_key"), F.make_date(F.col(year).cast("int"), F.lit(12), F.lit(31)).alias("obs_date"), "value")


def coverage(df: DataFrame, key: str = "series_key", date: str = "obs_date", *extra: Column) -> DataFrame:
    """First and last date and rows of every series."""
    return df.groupBy(key).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(F.lit(1)).alias("n_obs"), *extra)


def table_grain(df: DataFrame, separator: str, depth: int, key: str = "series_key", date: str = "obs_date") -> DataFrame:
    """Per key prefix: ``table_key``, ``n_series``, ``first_date``, ``last_date``, ``n_obs``. Counted over series first, so
    that the distinct count never sees all rows of a prefix."""
    per = coverage(df.filter(F.col(key).isNotNull()), key, date)
    return per.groupBy(F.substring_index(F.col(key), separator, depth).alias("table_key")).agg(
        F.count(F.lit(1)).alias("n_series"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("n_obs").alias("n_obs"))


def depth_census(df: DataFrame, separator: str, depths: list[int], key: str = "series_key") -> DataFrame:
    """How many different prefixes of each depth there are: ``depth``, ``n_prefixes``."""
    keys = df.filter(F.col(key).isNotNull()).select(key).distinct()
    pre = keys.select(F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.substring_index(F.col(key), separator, d).alias("p")) for d in depths])).alias("x")).select("x.*").distinct()
    return pre.groupBy("depth").agg(F.count(F.lit(1)).alias("n_prefixes"))


#: Relative standard error of approximate distinct counts.
HLL_ERROR = 0.02


def distinct_census(df: DataFrame, by: str, key: str, ceiling: int | None = None) -> DataFrame:
    """Distinct keys per group, and by which ``method``: exact up to ``ceiling`` rows of a group, HyperLogLog beyond (null:
    always exact). An approximate count says so and must not be used to call a key missing."""
    exact = df.groupBy(by, key).agg(F.count(F.lit(1)).alias("c")).groupBy(by).agg(F.count(key).alias("n_exact"), F.sum("c").alias("n_rows"))
    if ceiling is None:
        return exact.select(by, F.col("n_exact").alias("n_keys"), F.lit("exact").alias("method"), "n_rows")
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct(key, HLL_ERROR).alias("n_hll"))
    few = sizes.filter(F.col("n_rows") <= ceiling).select(F.col(by).alias("__by"))
    small = df.join(F.broadcast(few) if fits_broadcast(few) else few, F.col(by).eqNullSafe(F.col("__by")), "left_semi").groupBy(by, key).agg(F.lit(1)).groupBy(F.col(by).alias("__by")).agg(F.count(key).alias("n_exact"))
    return sizes.join(small, F.col(by).eqNullSafe(F.col("__by")), "left").select(by, F.coalesce("n_exact", "n_hll").alias("n_keys"), F.when(F.col("n_exact").isNull(), "hll").otherwise("exact").alias("method"), "n_rows")


# How a source stamps its periods: the days that nearly all (more than SURE) of its dates fall on, in how many months at
# most, and its name, in the order in which they are tried; days of the month from which dates are daily.
SURE, DAILY_DAYS = 0.95, 20
STAMPS = (
    ("first of year", 12, "annual START"), ("last of year", 12, "annual END"), ("first of month", 4, "quarterly START"), ("last of month", 4, "quarterly END"), ("first of month", 12, "monthly START"), ("last of month", 12, "monthly END"),
)


def convention(df: DataFrame, by: str, date: str = "obs_date") -> DataFrame:
    """How each source stamps its periods, from its histogram of month and day: ``convention``, ``n_obs``."""
    day = F.date_format(date, "MM-dd")
    hist = df.filter(F.col(date).isNotNull()).groupBy(by, day.alias("md")).agg(F.count(F.lit(1)).alias("c"))
    month_end = F.date_format(F.last_day(F.concat(F.lit("2000-"), F.substring("md", 1, 2), F.lit("-01")).cast("date")), "MM-dd")
    falls = {"first of year": F.col("md") == "01-01", "last of year": F.col("md") == "12-31", "first of month": F.col("md").endswith("-01"), "last of month": F.col("md") == month_end}
    seen = hist.groupBy(by).agg(F.sum("c").alias("n_obs"), F.countDistinct(F.substring("md", 1, 2)).alias("in_months"), F.countDistinct(F.substring("md", 4, 2)).alias("on_days"), *[F.sum(F.when(on, F.col("c")).otherwise(0)).alias(what) for what, on in falls.items()])
    named = F.coalesce(*[F.when((F.col("in_months") <= months) & (F.col(what) / F.col("n_obs") > SURE), name) for what, months, name in STAMPS], F.when(F.col("on_days") > DAILY_DAYS, "daily"), F.lit("MIXED"))
    return seen.select(by, named.alias("convention"), "n_obs")


def median_gaps(df: DataFrame, key: str = "series_key", date: str = "obs_date") -> DataFrame:
    """Median days between different dates of every series, and their frequency bucket (``sparse`` under three dates)."""
    d = df.filter(F.col(date).isNotNull()).select(key, date).distinct()
    g = d.withColumn("gap", F.datediff(date, F.lag(date).over(Window.partitionBy(key).orderBy(date))))
    a = g.groupBy(key).agg(F.count(F.lit(1)).alias("n_dates"), F.median("gap").alias("median_gap"))
    return a.withColumn("frequency", F.when(F.col("n_dates") < 3, "sparse").otherwise(frequency_of_gap(F.col("median_gap"))))


def partition_profile(df: DataFrame, key: str = "series_key") -> DataFrame:
    """Groups of series by the names of their dimensions: ``dimensions``, ``n_series``."""
    names = F.regexp_replace(F.col(key), "=[^:]*", "")
    return df.filter(F.col(key).contains("=")).select(key).distinct().groupBy(names.alias("dimensions")).agg(F.count(F.lit(1)).alias("n_series"))


def vintage_profile(df: DataFrame, key: str = "series_key", dim: str = "GEO") -> DataFrame:
    """Series by the vintage of the geography that their key names (GEO=2024-DEP-...): ``vintage`` (null: none named), ``n_series``."""
    code = F.regexp_extract(F.col(key), f"(?:^|:){dim}=([^:]*)", 1)
    year = F.nullif(F.regexp_extract(code, r"^((?:19|20)\d{2})-", 1), F.lit(""))
    return df.filter(F.col(key).isNotNull()).select(key).distinct().groupBy(year.alias("vintage")).agg(F.count(F.lit(1)).alias("n_series"))


def split_choice(df: DataFrame, dims: list[str], max_rows: int, least: int = 2, most: int = 2000) -> DataFrame:
    """How each dimension would split a flow: ``dim``, ``n_parts``, ``largest``, ``fits`` and ``chosen``, the coarsest that
    fits. One pass over the table for all dimensions."""
    counted = df.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("part")) for d in dims])).alias("x")).select("x.*").groupBy("dim", "part").agg(F.count(F.lit(1)).alias("c"))
    per = counted.groupBy("dim").agg(F.count(F.lit(1)).alias("n_parts"), F.max("c").alias("largest"))
    per = per.withColumn("fits", F.col("n_parts").between(least, most) & (F.col("largest") <= max_rows))
    best = per.filter("fits").agg(F.min(F.struct("n_parts", "dim")).alias("b"))
    return per.crossJoin(F.broadcast(best)).select("dim", "n_parts", "largest", "fits", F.coalesce(F.col("b.dim") == F.col("dim"), F.lit(False)).alias("chosen"))


# Lengths to which codes of the widest dimension may be truncated, and the most parts of a split by one and by two.
PREFIXES, ONE_PARTS, PAIR_PARTS = (3, 4, 5, 6), 2_000, 20_000


def split_plan(df: DataFrame, dims: list[str], max_rows: int) -> DataFrame:
    """How to split a flow so that no part has more than ``max_rows`` rows: ``dims`` (one, or two joined by +), ``prefix`` (0: whole codes),
    ``n_parts``, ``largest``. One dimension, coarsest first; else prefixes of the widest, shortest first; else pairs, coarsest first (no code of
    which holds a ~). No row if nothing fits: the flow is refused. Every candidate is counted by one grouping with map-side combine."""
    t = df.select(*[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in dims])

    def counted(parts: list[tuple[str, int, Column]]) -> DataFrame:
        x = F.explode(F.array(*[F.struct(F.lit(n).alias("dims"), F.lit(p).alias("prefix"), c.alias("part")) for n, p, c in parts]))
        per = t.select(x.alias("x")).select("x.*").groupBy("dims", "prefix", "part").agg(F.count(F.lit(1)).alias("c"))
        return per.groupBy("dims", "prefix").agg(F.count(F.lit(1)).alias("n_parts"), F.max("c").alias("largest"))

    def first(found: DataFrame, most: int, *order: str) -> DataFrame:
        return found.filter(F.col("n_parts").between(2, most) & (F.col("largest") <= max_rows)).orderBy(*order).limit(1)

    ones = counted([(d, 0, F.col(d)) for d in dims])
    card = {r["dims"]: r["n_parts"] for r in ones.collect()}  # one per dimension
    if not card:
        return ones.limit(0)
    if not (best := first(ones, ONE_PARTS, "n_parts", "dims")).isEmpty():
        return best
    widest = max(sorted(card), key=card.get)
    if not (best := first(counted([(widest, n, F.substring(widest, 1, n)) for n in PREFIXES]), ONE_PARTS, "prefix")).isEmpty():
        return best
    usable = sorted((n, d) for d, n in card.items() if n >= 2)
    pairs = sorted((m * n, a, b) for i, (m, a) in enumerate(usable) for n, b in usable[i + 1 :] if m * n <= PAIR_PARTS)
    if not pairs:
        return ones.limit(0)
    tilde = t.agg(*[F.coalesce(F.bool_or(F.col(d).contains("~")), F.lit(False)).alias(d) for d in dims]).first()
    rank = {f"{a}+{b}": n for n, a, b in pairs if not tilde[a] and not tilde[b]}
    both = counted([(f"{a}+{b}", 0, F.concat(F.col(a), F.lit("~"), F.col(b))) for _, a, b in pairs if f"{a}+{b}" in rank]) if rank else ones.limit(0)
    product = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])[F.col("dims")] if rank else F.lit(0)
    return first(both.withColumn("product", product), PAIR_PARTS, "product", "dims").drop("product")


def fingerprints(df: DataFrame, by: str, cols: list[str], portable: bool = False) -> DataFrame:
    """Order-free fingerprint of each group's rows; repeated rows and nulls count. ``portable``: one that other engines can
    compute too."""
    return df.groupBy(by).agg((portable_fingerprint if portable else content_fingerprint)(cols).alias("fingerprint"), F.count(F.lit(1)).alias("n_rows"))


def crosswalk(left: DataFrame, right: DataFrame, key: str = "series_key", date: str = "obs_date", value: str = "value", digits: int = 9, fanout: int = 50, least: int = 8, top: int = 50) -> DataFrame:
    """Which series of one store is which of another, by the values that they share per date: per left series ``match`` (null
    unless MATCHED), ``n_agree``, ``verdict`` (MATCHED, AMBIGUOUS, UNMATCHED, NO-OVERLAP, TOO-SHORT).

    A value that more than ``fanout`` series of a side share on a date is common. Rare values propose pairs, and so do the
    first and last series of a common value; what a pair agrees on is then counted over all values. A pair that agrees on
    common values alone has at most as many of them as its left series holds; where so many could decide a verdict, the
    series is also looked up by as many of its least common ones as such a pair cannot miss. Verdict and match are thus exact;
    ``n_agree`` of a series that is neither MATCHED nor AMBIGUOUS may leave out pairs that share common values only."""
    norm = lambda d: d.filter(F.col(key).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(key).alias("k"), F.col(date).alias("d"), F.round(value, digits).alias("v")).distinct()
    l, r = norm(left), norm(right)
    held = l.groupBy("d", "v").agg(F.count(F.lit(1)).alias("cl")).join(r.groupBy("d", "v").agg(F.count(F.lit(1)).alias("c"), F.min("k").alias("first"), F.max("k").alias("last")), ["d", "v"])
    held = held.withColumn("common", F.greatest("cl", "c") > fanout)
    rare, common = (held.filter(F.col("common") == x).drop("cl", "common") for x in (False, True))
    common = staged(common, "common-values")
    thin = l.join(rare.select("d", "v"), ["d", "v"]).join(r.withColumnRenamed("k", "k2"), ["d", "v"]).groupBy("k", "k2").agg(F.count(F.lit(1)).alias("n_rare"))
    lc, rc = l.join(common, ["d", "v"]), r.join(common.select("d", "v"), ["d", "v"], "left_semi").withColumnRenamed("k", "k2")

    def scored(pairs: DataFrame) -> DataFrame:
        more = pairs.join(lc.select("k", "d", "v"), "k").join(rc, ["k2", "d", "v"]).groupBy("k", "k2").agg(F.count(F.lit(1)).alias("n_common"))
        return pairs.join(more, ["k", "k2"], "left").select("k", "k2", (F.col("n_rare") + F.coalesce("n_common", F.lit(0))).alias("n_agree"))

    ends = lc.select("k", F.explode(F.array("first", "last")).alias("k2"), F.lit(0).cast("bigint").alias("n_rare"))
    pairs = staged(scored(thin.union(ends).groupBy("k", "k2").agg(F.max("n_rare").alias("n_rare"))), "pairs")
    sizes = l.groupBy("k").agg(F.count(F.lit(1)).alias("n"))

    def ranked(pairs: DataFrame) -> DataFrame:
        w = Window.partitionBy("k").orderBy(F.col("n_agree").desc(), "k2")
        best = pairs.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top)
        return best.groupBy("k").agg(F.max_by("k2", -F.col("rn")).alias("m"), F.max("n_agree").alias("n_agree"), F.max(F.when(F.col("rn") == 2, F.col("n_agree"))).alias("second"))

    # what a pair must agree on to be the best one or its rival: 0.95 of the best so far, and 0.95 of 0.8 of all
    least_agree = F.ceil(F.greatest(0.95 * F.col("n_agree"), 0.76 * F.col("n")) - 1e-6)
    settled = (F.col("n_agree") == F.col("n")) & (F.coalesce("second", F.lit(0)) >= 0.95 * F.col("n"))
    open_ = lc.groupBy("k").agg(F.count(F.lit(1)).alias("n_common")).join(sizes, "k").join(ranked(pairs), "k").withColumn("probes", F.col("n_common") - least_agree + 1).filter((F.col("probes") > 0) & ~settled)
    at = F.row_number().over(Window.partitionBy("k").orderBy("c", "d", "v"))
    probes = lc.join(open_.select("k", "probes"), "k").withColumn("at", at).filter(F.col("at") <= F.col("probes")).select("k", "d", "v")
    missed = probes.join(rc, ["d", "v"]).select("k", "k2").distinct().join(pairs, ["k", "k2"], "left_anti").withColumn("n_rare", F.lit(0).cast("bigint"))
    best = ranked(pairs.union(scored(missed)))
    j = sizes.join(best, "k", "left")
    share = F.col("n_agree") / F.col("n")
    verdict = F.when(F.col("n") < least, "TOO-SHORT").when(F.col("n_agree").isNull(), "NO-OVERLAP").when(share < 0.8, "UNMATCHED").when(F.col("second") >= 0.95 * F.col("n_agree"), "AMBIGUOUS").otherwise("MATCHED")
    return j.select(F.col("k").alias(key), F.when(verdict == "MATCHED", F.col("m")).alias("match"), F.coalesce("n_agree", F.lit(0)).alias("n_agree"), verdict.alias("verdict"))
