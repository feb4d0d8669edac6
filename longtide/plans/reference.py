"""Queries of the general operators over the test tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as P
from ..operators import audits, catalogue, merge, rollups, series, timejoin
from ..operators import freshness as fresh
from ..session import table
from .views import LINE_OBS, RUNS, delivery, delivery_sql, line_obs, nan_apart, nan_apart_sql, runs, stored, stored_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- series ---------------------------------------------------------------------------------------------------------


@query(f"SELECT 'line:' || series_key AS series_id, 'line' AS source, obs_date, value FROM {LINE_OBS} WHERE series_key = 'LI:A' OR series_key LIKE 'LI:A:%'")
def series_fetch(spark, d):
    return series.tidy(line_obs(spark, d).filter(series.grain("series_key", "LI:A")), "line")


@query(f"SELECT series_key, obs_date, value FROM {LINE_OBS} WHERE series_key = 'LI:A:F:7'")
def series_exact(spark, d):
    return line_obs(spark, d).filter(series.exact("series_key", "LI:A:F:7")).drop("row_no")


@query(f"SELECT series_key, obs_date, value FROM {LINE_OBS} WHERE obs_date >= DATE '1998-01-01' AND obs_date <= DATE '1998-06-30'")
def date_window(spark, d):
    return series.date_window(line_obs(spark, d), "1998-01-01", "1998-06-30").drop("row_no")


@query(f"SELECT series_key, obs_date, value FROM {LINE_OBS} WHERE split_part(series_key, ':', -1) = '7'")
def geo_projection(spark, d):
    return series.geo_projection(line_obs(spark, d), "7").drop("row_no")


@query("""SELECT series_id, CASE WHEN ok THEN split_part(x, ':', 1) || ':' || split_part(x, ':', 2) END AS canonical, CASE WHEN ok THEN geo END AS geo FROM (
  SELECT series_id, x, CASE WHEN regexp_matches(last, '^[A-Z0-9]{2,3}$') AND regexp_matches(geo, '^[A-Z0-9]{2,3}$') THEN true ELSE false END AS ok, geo FROM (
  SELECT series_id, x, last, CASE last WHEN 'XD' THEN 'HIC' WHEN 'XM' THEN 'LIC' WHEN 'XN' THEN 'LMC' WHEN 'XT' THEN 'UMC' ELSE last END AS geo FROM (
  SELECT DISTINCT series_id, source_id || ':' || coalesce(category, '') || ':' || coalesce(geography, '') AS x, CASE WHEN len(string_split(source_id || ':' || coalesce(category, '') || ':' || coalesce(geography, ''), ':')) = 3 THEN split_part(source_id || ':' || coalesce(category, '') || ':' || coalesce(geography, ''), ':', 3) END AS last FROM series WHERE source_id IS NOT NULL)))""")
def geo_alias(spark, d):
    s = table(spark, d, "series").filter("source_id IS NOT NULL").select("series_id", F.concat_ws(":", "source_id", F.coalesce("category", F.lit("")), F.coalesce("geography", F.lit(""))).alias("x")).distinct()
    return s.select("series_id", series.geo_alias(F.col("x")).alias("a")).select("series_id", "a.canonical", "a.geo")


@query("SELECT DISTINCT series_id FROM series WHERE starts_with(series_id, 'lantern_so:') AND frequency IN ('M', 'Q') AND category IN ('prices', 'labour')")
def mask_resolve(spark, d):
    return series.mask(table(spark, d, "series"), "lantern_so", frequency=["M", "Q"], category=["prices", "labour"])


@query(f"SELECT series_key || '|row_no=' || CAST(row_no AS VARCHAR) || '|value=' || coalesce(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), '') AS series_id FROM {LINE_OBS}")
def composite_row_id(spark, d):
    return line_obs(spark, d).withColumn("value", F.floor("value").cast("bigint")).select(series.row_id("series_key", ["row_no", "value"]).alias("series_id"))


@query("SELECT concat_ws(':', CASE WHEN coalesce(frequency, '') <> '' THEN 'frequency=' || frequency END, CASE WHEN coalesce(unit, '') <> '' THEN 'unit=' || unit END, CASE WHEN coalesce(category, '') <> '' THEN 'category=' || category END) AS dims, count(*) AS n FROM series GROUP BY ALL")
def dimension_keys(spark, d):
    return table(spark, d, "series").groupBy(series.dimension_key(["frequency", "unit", "category"]).alias("dims")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT obs_date, {', '.join(f"max(value) FILTER (WHERE series_key = '{k}' AND rn = 1) AS \"{k}\"" for k in ('LI:A:F:1', 'LI:R:F:2', 'LI:N:O:3'))} FROM (
  SELECT *, row_number() OVER (PARTITION BY series_key, obs_date ORDER BY row_no DESC, value DESC) AS rn FROM {LINE_OBS}) WHERE series_key IN ('LI:A:F:1', 'LI:R:F:2', 'LI:N:O:3') GROUP BY obs_date""")
def wide_pivot(spark, d):
    ids = ["LI:A:F:1", "LI:R:F:2", "LI:N:O:3"]
    last = line_obs(spark, d).filter(F.col("series_key").isin(ids)).groupBy("series_key", "obs_date").agg(F.max_by("value", F.struct("row_no", "value")).alias("value"))
    return series.wide(last, ids, "series_key")


@query("SELECT l_orderkey, l_linenumber, variable, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME variable VALUE value) WHERE isfinite(value)")
def melt_long(spark, d):
    return series.melt(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("""WITH l AS (SELECT license_id, max(reservable) AS reservable FROM license WHERE removed_on IS NULL GROUP BY 1), s AS (SELECT source_id, max(license_id) AS sl FROM source_list WHERE removed_on IS NULL GROUP BY 1)
  SELECT DISTINCT c.series_id, CASE WHEN l.reservable = 1 THEN 'open' WHEN l.reservable = 0 THEN 'closed' ELSE 'unknown' END AS gate
  FROM series c LEFT JOIN s ON c.source_id = s.source_id LEFT JOIN l ON l.license_id = coalesce(nullif(trim(c.license_id), ''), nullif(trim(s.sl), ''))""")
def license_gate(spark, d):
    return series.latest_gate(table(spark, d, "series"), table(spark, d, "source_list"), table(spark, d, "license"))


@query("""SELECT series_id, max(p) AS prefix FROM (SELECT s.series_id, n.p FROM (SELECT DISTINCT replace(series_id, ':', '.') AS series_id FROM series) s
  LEFT JOIN (SELECT DISTINCT source_id AS p FROM source_list UNION SELECT DISTINCT source_id || '.' || frequency FROM series WHERE source_id IS NOT NULL AND frequency IS NOT NULL) n ON s.series_id = n.p OR starts_with(s.series_id, n.p || '.')) GROUP BY 1""")
def longest_prefix(spark, d):
    s = table(spark, d, "series")
    names = table(spark, d, "source_list").select(F.col("source_id").alias("prefix")).unionByName(s.filter("source_id IS NOT NULL AND frequency IS NOT NULL").select(F.concat_ws(".", "source_id", "frequency").alias("prefix"))).distinct()
    return series.longest_prefix(s.select(F.replace("series_id", F.lit(":"), F.lit(".")).alias("series_id")), names, "series_id", "prefix")


@query("""SELECT series_id, CASE WHEN end_date IS NULL OR end_date = '' THEN false WHEN start_date IS NULL OR start_date = '' THEN true
  WHEN regexp_matches(end_date, '^\\d{4}-\\d{2}-\\d{2}') AND substr(end_date, 1, 10) BETWEEN '1500-01-01' AND '2200-01-01' AND regexp_matches(start_date, '^\\d{4}-\\d{2}-\\d{2}') AND substr(start_date, 1, 10) BETWEEN '1500-01-01' AND '2200-01-01' THEN substr(end_date, 1, 10) > substr(start_date, 1, 10)
  WHEN NOT (regexp_matches(end_date, '^\\d{4}-\\d{2}-\\d{2}') AND substr(end_date, 1, 10) BETWEEN '1500-01-01' AND '2200-01-01') AND NOT (regexp_matches(start_date, '^\\d{4}-\\d{2}-\\d{2}') AND substr(start_date, 1, 10) BETWEEN '1500-01-01' AND '2200-01-01') THEN end_date <> start_date ELSE false END AS advanced FROM series""")
def advanced_dates(spark, d):
    return table(spark, d, "series").select("series_id", series.advanced(F.col("end_date"), F.col("start_date")).alias("advanced"))


@query("""SELECT series_id, CASE WHEN try_cast(substr(end_date, 1, 10) AS DATE) <= DATE '2024-01-01' + 400 THEN try_cast(substr(end_date, 1, 10) AS DATE) END AS since,
  greatest(try_cast(substr(end_date, 1, 10) AS DATE) - 45, DATE '1900-01-01') AS revision_since FROM series WHERE try_cast(substr(end_date, 1, 10) AS DATE) IS NOT NULL""")
def fetch_since(spark, d):
    s = table(spark, d, "series").withColumn("e", F.substring("end_date", 1, 10).try_cast("date")).filter("e IS NOT NULL")
    return s.select("series_id", series.sane_since(F.col("end_date"), F.lit("2024-01-01").cast("date")).alias("since"), series.revision_since(F.col("e")).alias("revision_since"))


# --- merge and comparison ----------------------------------------------------------------------------------------------------

_MERGED = f"(SELECT *, 0 AS side FROM {delivery_sql(1)} UNION ALL SELECT *, 1 AS side FROM {delivery_sql(2)})"


@query(nan_apart_sql(f"SELECT series_key, obs_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_key, obs_date ORDER BY side DESC, row_no DESC) AS rn FROM {_MERGED}) WHERE rn = 1"))
def merge_keep_last(spark, d):
    a, b = (delivery(spark, d, n).drop("source_id") for n in (1, 2))
    return nan_apart(merge.merge_keep_last(a, b, position="row_no"))


@query(f"""WITH m AS (SELECT *, row_number() OVER (PARTITION BY series_key, obs_date ORDER BY side DESC, row_no DESC) AS rn, row_number() OVER (PARTITION BY series_key, obs_date, side ORDER BY row_no DESC) AS rs FROM {_MERGED}),
  g AS (SELECT series_key, obs_date, count(*) FILTER (WHERE side = 0) AS n_old, max(value) FILTER (WHERE rn = 1) AS now, max(value) FILTER (WHERE side = 0 AND rs = 1) AS was FROM m GROUP BY ALL)
  SELECT series_key, max(obs_date) AS last_changed FROM g WHERE n_old = 0 OR was IS DISTINCT FROM now GROUP BY series_key""")
def merge_changed_keys(spark, d):
    a, b = (delivery(spark, d, n).drop("source_id") for n in (1, 2))
    return merge.changed_keys(a, b, position="row_no")


@query(f"SELECT sum(o)::BIGINT AS n_existing, sum(n)::BIGINT AS n_incoming, count(*) AS n_merged, max(obs_date) AS last_date FROM (SELECT series_key, obs_date, count(*) FILTER (WHERE side = 0) AS o, count(*) FILTER (WHERE side = 1) AS n FROM {_MERGED} GROUP BY ALL)")
def merge_counts(spark, d):
    a, b = (delivery(spark, d, n).drop("source_id") for n in (1, 2))
    return merge.merge_counts(a, b, position="row_no")


@query(nan_apart_sql(f"SELECT series_key, obs_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_key, obs_date ORDER BY row_no) AS rn FROM {delivery_sql(3)}) WHERE rn = 1"))
def read_first_wins(spark, d):
    return nan_apart(merge.first_wins(delivery(spark, d, 3).drop("source_id"), ["series_key", "obs_date"], "row_no"))


@query(f"SELECT split_part(series_key, ':', 2) AS table_key, obs_date, max(value) AS value FROM {LINE_OBS} GROUP BY ALL")
def grain_max_wins(spark, d):
    return merge.max_wins(line_obs(spark, d).withColumn("table_key", F.element_at(F.split("series_key", ":"), 2)), ["table_key", "obs_date"])


_KC = f"(SELECT series_key, obs_date, count(*) FILTER (WHERE side = 0) AS o, count(*) FILTER (WHERE side = 1) AS n FROM {_MERGED} GROUP BY ALL)"


@query(f"SELECT coalesce(sum(greatest(o - n, 0)), 0)::BIGINT AS lost_rows, count(*) FILTER (WHERE o > n) AS lost_keys FROM {_KC}")
def multiset_loss(spark, d):
    return merge.multiset_loss(delivery(spark, d, 1), delivery(spark, d, 2))


_FULL = f"(SELECT coalesce(a.series_key, b.series_key) AS series_key, a.obs_date AS da, b.obs_date AS db, a.value AS va, b.value AS vb, a.x AS xa, b.x AS xb FROM (SELECT *, 1 AS x FROM {stored_sql(1)}) a FULL JOIN (SELECT *, 1 AS x FROM {stored_sql(2)}) b ON a.series_key IS NOT DISTINCT FROM b.series_key AND a.obs_date IS NOT DISTINCT FROM b.obs_date)"


@query(f"SELECT series_key, max(db) AS last_changed FROM {_FULL} WHERE xa IS NULL OR xb IS NULL OR va IS DISTINCT FROM vb GROUP BY series_key")
def full_outer_changes(spark, d):
    return merge.revised_series(stored(spark, d, 1), stored(spark, d, 2))


@query(f"SELECT year(obs_date) AS year, sum(greatest(n - o, 0))::BIGINT AS gained, sum(greatest(o - n, 0))::BIGINT AS lost FROM {_KC} WHERE obs_date >= DATE '2015-01-01' GROUP BY 1")
def tail_gain_loss(spark, d):
    a, b = (series.date_window(delivery(spark, d, n), "2015-01-01") for n in (1, 2))
    return merge.tail_gain_loss(a, b, ["series_key", "obs_date"], F.year("obs_date").alias("year"))


@query(f"SELECT DISTINCT series_key FROM {delivery_sql(1)} EXCEPT SELECT series_key FROM {delivery_sql(2)}")
def dropped_series(spark, d):
    return merge.dropped_series(delivery(spark, d, 1), delivery(spark, d, 2), "series_key")


@query(f"SELECT count(*) FILTER (WHERE xa = 1 AND xb = 1) AS matched, count(*) FILTER (WHERE xa = 1 AND xb = 1 AND va IS DISTINCT FROM vb) AS revised, count(*) FILTER (WHERE xb IS NULL) AS only_old, count(*) FILTER (WHERE xa IS NULL) AS only_new FROM {_FULL}")
def key_overlap(spark, d):
    return merge.key_overlap(stored(spark, d, 1), stored(spark, d, 2))


@query(nan_apart_sql("""WITH g AS (SELECT metric, obs_date, value, vintage_date, sum(a) AS a, sum(b) AS b FROM (SELECT metric, obs_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value, vintage_date, 1 AS a, 0 AS b FROM facts UNION ALL SELECT metric, obs_date, CASE WHEN value = 0 THEN 0.0 ELSE value END, vintage_date, 0, 1 FROM facts_mirror) GROUP BY ALL)
  SELECT metric, obs_date, value, vintage_date FROM (SELECT metric, obs_date, value, vintage_date, unnest(range(greatest(a, b)::BIGINT)) AS i FROM g)"""))
def multiset_union(spark, d):
    return nan_apart(merge.multiset_union(table(spark, d, "facts"), table(spark, d, "facts_mirror"), ["metric", "obs_date", "value", "vintage_date"]))


@query("SELECT count(*) AS n_lost FROM (SELECT metric, obs_date, value, vintage_date FROM facts EXCEPT ALL SELECT metric, obs_date, value, vintage_date FROM facts_mirror)")
def multiset_except(spark, d):
    from ..operators.copies import except_all

    l, _ = except_all(table(spark, d, "facts"), table(spark, d, "facts_mirror"), ["metric", "obs_date", "value", "vintage_date"])
    return l.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lost"))


@query("SELECT series_id FROM series INTERSECT SELECT series_id FROM sent")
def intersect_keys(spark, d):
    return table(spark, d, "series").select("series_id").intersect(table(spark, d, "sent").select("series_id"))


@query(nan_apart_sql(f"SELECT series_key, obs_date, value FROM {stored_sql(2)} UNION ALL SELECT o.* FROM {stored_sql(1)} o WHERE NOT EXISTS (SELECT 1 FROM {stored_sql(2)} n WHERE lower(n.series_key) IS NOT DISTINCT FROM lower(o.series_key) AND n.obs_date IS NOT DISTINCT FROM o.obs_date)"))
def supersede(spark, d):
    return nan_apart(merge.supersede(stored(spark, d, 1), stored(spark, d, 2), F.lower("series_key")))


@query(nan_apart_sql(f"SELECT coalesce(series_key) AS series_key, coalesce(db, da) AS obs_date, CASE WHEN xb = 1 THEN vb ELSE va END AS value FROM {_FULL}"))
def keep_served(spark, d):
    return nan_apart(merge.keep_served(stored(spark, d, 1), stored(spark, d, 2)))


_NORM = "regexp_replace(upper(series_key), '[^A-Z0-9]', '', 'g')"


@query(f"""WITH s AS (SELECT DISTINCT CASE WHEN row_no % 3 = 0 THEN lower(series_key) ELSE series_key END AS series_key, obs_date FROM {delivery_sql(2)} WHERE series_key IS NOT NULL),
  t AS (SELECT DISTINCT series_key, obs_date FROM {delivery_sql(1)} WHERE series_key IS NOT NULL),
  c AS (SELECT s.*, EXISTS (SELECT 1 FROM t WHERE t.series_key = s.series_key AND t.obs_date IS NOT DISTINCT FROM s.obs_date) AS known, s.series_key IN (SELECT series_key FROM t) AS spelt, {_NORM} IN (SELECT {_NORM} FROM t) AS norm FROM s)
  SELECT count(*) AS n_staged, count(*) FILTER (WHERE known) AS n_known, count(*) FILTER (WHERE NOT known AND spelt) AS n_extended, count(*) FILTER (WHERE NOT spelt AND norm) AS n_respelled, count(*) FILTER (WHERE NOT norm) AS n_unknown FROM c""")
def merge_split(spark, d):
    b = delivery(spark, d, 2).filter("series_key IS NOT NULL").withColumn("series_key", F.when(F.col("row_no") % 3 == 0, F.lower("series_key")).otherwise(F.col("series_key")))
    a = delivery(spark, d, 1).filter("series_key IS NOT NULL")
    return merge.respelled_split(a, b, F.regexp_replace(F.upper("series_key"), "[^A-Z0-9]", ""))


# --- rollups --------------------------------------------------------------------------------------------------------------------

_FLOWS = "(SELECT ns.n_name AS exporter, nc.n_name AS importer, year(l_shipdate) AS y, round(l_extendedprice * 100)::BIGINT AS cents, l_quantity::BIGINT AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ns ON s_nationkey = ns.n_nationkey JOIN nation nc ON c_nationkey = nc.n_nationkey)"


@query(f"""SELECT exporter || '.' || importer || '.' || m AS series_key, make_date(y, 12, 31) AS obs_date, v AS value FROM (
  SELECT exporter, importer, y, 'tv' AS m, sum(cents)::BIGINT AS v FROM {_FLOWS} GROUP BY ALL UNION ALL SELECT exporter, importer, y, 'tq', sum(qty)::BIGINT FROM {_FLOWS} GROUP BY ALL)""")
def bilateral_totals(spark, d):
    l, o, c, s, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "supplier", "nation"))
    f = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(s, l.l_suppkey == s.s_suppkey)
    f = f.join(n.select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("exporter")), F.col("s_nationkey") == F.col("a")).join(n.select(F.col("n_nationkey").alias("b"), F.col("n_name").alias("importer")), F.col("c_nationkey") == F.col("b"))
    f = f.select("exporter", "importer", F.year("l_shipdate").alias("y"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"), F.col("l_quantity").cast("bigint").alias("qty"))
    return rollups.bilateral_totals(f, "exporter", "importer", "y", {"tv": "cents", "tq": "qty"})


@query(f"SELECT series_key, min(obs_date) AS first_date, max(obs_date) AS last_date, count(*) AS n_obs FROM {LINE_OBS} GROUP BY 1")
def series_coverage(spark, d):
    return rollups.coverage(line_obs(spark, d))


@query(f"SELECT array_to_string(string_split(series_key, ':')[1:3], ':') AS table_key, count(DISTINCT series_key) AS n_series, min(obs_date) AS first_date, max(obs_date) AS last_date, count(*)::BIGINT AS n_obs FROM {LINE_OBS} GROUP BY 1")
def table_grain_rollup(spark, d):
    return rollups.table_grain(line_obs(spark, d), ":", 3)


@query(f"SELECT k AS depth, count(DISTINCT array_to_string(string_split(series_key, ':')[1:k], ':')) AS n_prefixes FROM {LINE_OBS}, (VALUES (1), (2), (3), (4)) v(k) GROUP BY 1")
def depth_census(spark, d):
    return rollups.depth_census(line_obs(spark, d), ":", [1, 2, 3, 4])


@query("SELECT source_id, count(DISTINCT series_key) AS n_keys, 'exact' AS method, count(*) AS n_rows FROM obs_snapshots GROUP BY 1")
def distinct_census(spark, d):
    return rollups.distinct_census(table(spark, d, "obs_snapshots"), "source_id", "series_key").withColumn("n_rows", F.col("n_rows").cast("bigint"))


@query("SELECT source_id, CASE WHEN count(*) <= 5000 THEN 'exact' ELSE 'hll' END AS method, count(*) AS n_rows, true AS within_bound FROM obs_snapshots GROUP BY 1")
def approx_distinct(spark, d):
    """Approximate counts within three standard errors of the exact ones, those of small groups exact."""
    t = table(spark, d, "obs_snapshots")
    some = rollups.distinct_census(t, "source_id", "series_key", ceiling=5_000)
    exact = rollups.distinct_census(t, "source_id", "series_key").select(F.col("source_id").alias("s"), F.col("n_keys").alias("n_exact"))
    off = F.abs(F.col("n_keys") - F.col("n_exact")) <= F.when(F.col("method") == "hll", 3 * rollups.HLL_ERROR * F.col("n_exact")).otherwise(0)
    return some.join(exact, F.col("source_id").eqNullSafe(F.col("s"))).select("source_id", "method", "n_rows", off.alias("within_bound"))


@query(f"SELECT series_key, strftime(max(obs_date), '%Y-%m-%d') AS last_date FROM {delivery_sql(6)} WHERE series_key IS NOT NULL AND obs_date IS NOT NULL GROUP BY 1")
def max_date_per_key(spark, d):
    t = delivery(spark, d, 6).filter("series_key IS NOT NULL AND obs_date IS NOT NULL")
    return t.groupBy("series_key").agg(F.date_format(F.max("obs_date"), "yyyy-MM-dd").alias("last_date"))


@query("SELECT source_id, title FROM (SELECT source_id, title, row_number() OVER (PARTITION BY source_id ORDER BY length(title) DESC, encode(title) DESC) AS rn FROM series WHERE title IS NOT NULL) WHERE rn = 1")
def longest_title(spark, d):
    t = table(spark, d, "series").filter("title IS NOT NULL")
    return t.groupBy("source_id").agg(F.max_by("title", F.struct(F.char_length("title"), F.col("title"))).alias("title"))


_HIST = f"(SELECT source_id, month(obs_date) AS m, day(obs_date) AS d, day(last_day(make_date(2000, month(obs_date), 1))) AS l FROM {delivery_sql(6)} WHERE obs_date IS NOT NULL)"


@query(f"""SELECT source_id, CASE WHEN j / n > 0.95 THEN 'annual START' WHEN e / n > 0.95 THEN 'annual END' WHEN mm <= 4 AND f / n > 0.95 THEN 'quarterly START' WHEN mm <= 4 AND l / n > 0.95 THEN 'quarterly END'
  WHEN f / n > 0.95 THEN 'monthly START' WHEN l / n > 0.95 THEN 'monthly END' WHEN dd > 20 THEN 'daily' ELSE 'MIXED' END AS convention, n::BIGINT AS n_obs FROM (
  SELECT source_id, count(*)::DOUBLE AS n, count(DISTINCT m) AS mm, count(DISTINCT d) AS dd, count(*) FILTER (WHERE d = 1) AS f, count(*) FILTER (WHERE d = l) AS l, count(*) FILTER (WHERE m = 1 AND d = 1) AS j, count(*) FILTER (WHERE m = 12 AND d = 31) AS e FROM {_HIST} GROUP BY 1)""")
def date_convention(spark, d):
    return rollups.convention(delivery(spark, d, 6), "source_id")


@query("SELECT source_id, count(*) AS n_rows, count(DISTINCT series_id) AS n_series, sum(CASE WHEN frequency = 'M' THEN 1 ELSE 0 END)::BIGINT AS n_monthly, max(CASE WHEN license_id IS NULL THEN 1 ELSE 0 END) AS any_unlicensed FROM series GROUP BY 1")
def conditional_rollup(spark, d):
    return table(spark, d, "series").groupBy("source_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("series_id").alias("n_series"), F.sum(F.when(F.col("frequency") == "M", 1).otherwise(0)).alias("n_monthly"), F.max(F.when(F.col("license_id").isNull(), 1).otherwise(0)).alias("any_unlicensed"))


@query("SELECT source_id, max(try_cast(end_date AS DATE)) FILTER (WHERE try_cast(end_date AS DATE) < DATE '2900-01-01') AS data_through, count(DISTINCT series_id) AS n_series FROM series GROUP BY 1")
def data_through(spark, d):
    return catalogue.data_through(table(spark, d, "series"))


_PRINTED = "CASE WHEN isnan(value) THEN 'NaN' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END"
_PRINT_TEXT = " || ".join(f"CASE WHEN {c} IS NULL THEN '~' ELSE '=' || CAST({c} AS VARCHAR) END || chr(31)" for c in ("metric", "obs_date", "value", "vintage_date"))


@query(f"SELECT metric, CAST(sum(CAST(CAST('0x' || substr(md5({_PRINT_TEXT}), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS fingerprint, count(*) AS n_rows FROM (SELECT metric, obs_date, {_PRINTED} AS value, vintage_date FROM facts) GROUP BY 1")
def content_fingerprint(spark, d):
    """Fingerprints that other engines can compute too; values count in hundredths."""
    t = table(spark, d, "facts").withColumn("value", F.when(F.isnan("value"), "NaN").otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string")))
    return rollups.fingerprints(t, "metric", ["metric", "obs_date", "value", "vintage_date"], portable=True).withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query(f"SELECT count(*)::BIGINT AS n_rows, count(DISTINCT (series_key, obs_date)) AS n_keys, count(*) = count(DISTINCT (series_key, obs_date)) AS is_unique FROM {LINE_OBS}")
def uniqueness_check(spark, d):
    return audits.is_unique(line_obs(spark, d), ["series_key", "obs_date"])


_DUPV = f"(SELECT series_key, obs_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value, count(*) AS c FROM {delivery_sql(4)} GROUP BY ALL)"


@query(f"SELECT sum(c)::BIGINT AS n_rows, count(*) AS n_keys, sum(v)::BIGINT AS n_key_values FROM (SELECT sum(c) AS c, count(*) AS v FROM {_DUPV} GROUP BY series_key, obs_date)")
def duplicate_measures(spark, d):
    return audits.duplicate_measures(delivery(spark, d, 4), ["series_key", "obs_date"], "value")


@query(f"SELECT series_key, obs_date, count(*) AS n_values FROM {_DUPV} GROUP BY ALL HAVING count(*) > 1")
def conflicting_groups(spark, d):
    return audits.conflicting_groups(delivery(spark, d, 4), ["series_key", "obs_date"], "value")


@query("SELECT series_key, count(DISTINCT coalesce(source_id, '~')) AS n_groups FROM obs_snapshots WHERE series_key IS NOT NULL GROUP BY 1 HAVING count(DISTINCT coalesce(source_id, '~')) > 1")
def spanning_keys(spark, d):
    return audits.spanning_keys(table(spark, d, "obs_snapshots").withColumn("source_id", F.coalesce("source_id", F.lit("~"))), "series_key", "source_id")


@query("""SELECT k AS key, CASE WHEN l = 1 THEN 'missing' ELSE 'orphaned' END AS side FROM (SELECT k, max(l) AS l, max(r) AS r FROM (SELECT lower(trim(series_id)) AS k, 1 AS l, 0 AS r FROM series UNION ALL SELECT lower(trim(series_id)), 0, 1 FROM sent) GROUP BY 1) WHERE l <> r""")
def key_parity(spark, d):
    return audits.parity(table(spark, d, "series"), table(spark, d, "sent"), "series_id", F.lower(F.trim("series_id")))


@query("""SELECT source_id, sum(c)::BIGINT AS n_rows, count(DISTINCT series_key) AS n_first, count(*) AS n_tuples FROM (SELECT source_id, series_key, obs_date, count(*) AS c FROM obs_snapshots GROUP BY ALL) GROUP BY 1""")
def key_census(spark, d):
    return audits.key_census(table(spark, d, "obs_snapshots"), ["source_id"], ["series_key", "obs_date"])


@query(f"SELECT source_id, min(obs_date) AS first_date, max(obs_date) AS last_date, count(obs_date) AS n_dates FROM {delivery_sql(5)} GROUP BY 1")
def table_dates(spark, d):
    return audits.table_dates(delivery(spark, d, 5), "source_id")


@query("""SELECT source_id, n_keys, n_found, CASE WHEN n_found / n_keys >= 0.99 THEN 'REDUNDANT' WHEN n_found > 0 THEN 'MIXED' ELSE 'NO KEY OVERLAP' END AS verdict FROM (
  SELECT source_id, count(*) AS n_keys, count(*) FILTER (WHERE series_id IN (SELECT series_id FROM sent)) AS n_found FROM (SELECT DISTINCT source_id, series_id FROM series WHERE series_id IS NOT NULL) GROUP BY 1)""")
def dark_redundancy(spark, d):
    return audits.redundancy(table(spark, d, "series"), table(spark, d, "sent"), "series_id", "source_id")


@query("""WITH g AS (SELECT metric, obs_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value, vintage_date, sum(a) AS a, sum(b) AS b FROM (SELECT metric, obs_date, value, vintage_date, 1 AS a, 0 AS b FROM facts UNION ALL SELECT metric, obs_date, value, vintage_date, 0, 1 FROM facts_mirror) GROUP BY ALL)
  SELECT metric, CASE WHEN sum(b) = 0 THEN 'only_left' WHEN sum(a) = 0 THEN 'only_right' WHEN bool_or(a <> b) THEN 'different' ELSE 'same' END AS verdict FROM g GROUP BY 1""")
def content_check(spark, d):
    norm = lambda n: table(spark, d, n).withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))
    return audits.content_check(norm("facts"), norm("facts_mirror"), "metric", ["metric", "obs_date", "value", "vintage_date"])


@query("SELECT source_id, count(*) FILTER (WHERE try_cast(end_date AS DATE) > DATE '2024-01-01') AS n_impossible, max(CASE WHEN try_cast(end_date AS DATE) > DATE '2024-01-01' THEN try_cast(end_date AS DATE) END) AS worst FROM series GROUP BY 1")
def impossible_dates(spark, d):
    return audits.impossible_dates(table(spark, d, "series").withColumn("e", F.col("end_date").try_cast("date")), "source_id", "e", "2024-01-01")


@query("SELECT regexp_replace(series_id, '=[^:]*', '', 'g') AS dimensions, count(DISTINCT series_id) AS n_series FROM series WHERE contains(series_id, '=') GROUP BY 1")
def partition_profile(spark, d):
    return rollups.partition_profile(table(spark, d, "series"), "series_id")


@query("SELECT source_id, array_to_string(list_sort(list(DISTINCT series_id))[1:3], ' ') AS examples FROM series WHERE source_id IS NOT NULL GROUP BY 1")
def sorted_examples(spark, d):
    s = table(spark, d, "series").filter("source_id IS NOT NULL").select("source_id", "series_id").distinct()
    from pyspark.sql import Window

    top = s.withColumn("rn", F.row_number().over(Window.partitionBy("source_id").orderBy("series_id"))).filter("rn <= 3")
    return top.groupBy("source_id").agg(F.array_join(F.sort_array(F.collect_list("series_id")), " ").alias("examples"))


@query(f"""WITH x AS (SELECT DISTINCT series_key, obs_date FROM {LINE_OBS}), g AS (SELECT series_key, obs_date - lag(obs_date) OVER (PARTITION BY series_key ORDER BY obs_date) AS gap FROM x),
  a AS (SELECT series_key, count(*) AS n_dates, median(gap)::DOUBLE AS median_gap FROM g GROUP BY 1)
  SELECT *, CASE WHEN n_dates < 3 THEN 'sparse' WHEN median_gap <= 3.5 THEN 'daily' WHEN median_gap <= 10 THEN 'weekly' WHEN median_gap <= 45 THEN 'monthly' WHEN median_gap <= 135 THEN 'quarterly' WHEN median_gap <= 550 THEN 'annual' ELSE 'multi-year' END AS frequency FROM a""")
def freq_bucket(spark, d):
    return rollups.median_gaps(line_obs(spark, d))


@query("""SELECT metric, min(obs_date) AS first_end, coalesce(max(CASE WHEN obs_date <= vintage_date THEN obs_date END), max(CASE WHEN obs_date <= DATE '2024-01-01' THEN obs_date END), max(obs_date)) AS last_end FROM facts GROUP BY 1""")
def coverage_span(spark, d):
    e = F.col("obs_date")
    return table(spark, d, "facts").groupBy("metric").agg(F.min(e).alias("first_end"), F.coalesce(F.max(F.when(e <= F.col("vintage_date"), e)), F.max(F.when(e <= F.lit("2024-01-01").cast("date"), e)), F.max(e)).alias("last_end"))


@query("SELECT license_id, name FROM (SELECT license_id, name, row_number() OVER (PARTITION BY license_id ORDER BY added_on, name) AS rn FROM license) WHERE rn = 1")
def distinct_licences(spark, d):
    return table(spark, d, "license").groupBy("license_id").agg(F.min_by("name", F.struct("added_on", "name")).alias("name"))


@query("SELECT source_id, CASE WHEN bool_and(frequency = 'Q') THEN 'Q' WHEN bool_and(frequency = 'A') THEN 'A' ELSE 'irregular' END AS hint FROM series WHERE frequency IS NOT NULL GROUP BY 1")
def frequency_hint(spark, d):
    return table(spark, d, "series").filter("frequency IS NOT NULL").groupBy("source_id").agg(F.when(F.bool_and(F.col("frequency") == "Q"), "Q").when(F.bool_and(F.col("frequency") == "A"), "A").otherwise("irregular").alias("hint"))


@query("SELECT source_id, frequency FROM (SELECT source_id, frequency, row_number() OVER (PARTITION BY source_id ORDER BY count(*) DESC, frequency) AS rn FROM series WHERE frequency IS NOT NULL GROUP BY 1, 2) WHERE rn = 1")
def dominant_frequency(spark, d):
    c = table(spark, d, "series").filter("frequency IS NOT NULL").groupBy("source_id", "frequency").agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy("source_id").agg(F.min(F.struct(-F.col("c"), F.col("frequency").alias("f"))).alias("x")).select("source_id", F.col("x.f").alias("frequency"))


_PARTS = " UNION ALL ".join(f"SELECT '{c}' AS dim, CAST({c} AS VARCHAR) AS part FROM lineitem" for c in ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_partkey"))


@query(f"""WITH p AS (SELECT dim, count(*) AS n_parts, max(c) AS largest FROM (SELECT dim, part, count(*) AS c FROM ({_PARTS}) GROUP BY ALL) GROUP BY 1),
  q AS (SELECT *, n_parts BETWEEN 2 AND 2000 AND largest <= (SELECT count(*) // 5 FROM lineitem) AS fits FROM p)
  SELECT dim, n_parts, largest, fits, fits AND row_number() OVER (PARTITION BY fits ORDER BY n_parts, dim) = 1 AS chosen FROM q""")
def split_cardinality(spark, d):
    t = table(spark, d, "lineitem")
    return rollups.split_choice(t, ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_partkey"], t.count() // 5)


@query(f"""WITH m AS (SELECT series_key, obs_date, value, 'X' || series_key AS k2 FROM {stored_sql(1)} WHERE series_key IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
  l AS (SELECT DISTINCT series_key AS k, obs_date AS d, round(value, 9) AS v FROM m), r AS (SELECT DISTINCT 'X' || series_key AS k, obs_date AS d, round(value, 9) AS v FROM {stored_sql(2)} WHERE series_key IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
  lt AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY d, v) AS c FROM l) WHERE c <= 50), rt AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY d, v) AS c FROM r) WHERE c <= 50),
  p AS (SELECT lt.k, rt.k AS k2, count(*) AS n_agree FROM lt JOIN rt ON lt.d = rt.d AND lt.v = rt.v GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n_agree DESC, k2) AS rn FROM p),
  b AS (SELECT k, max(k2) FILTER (WHERE rn = 1) AS m, max(n_agree) AS a, max(n_agree) FILTER (WHERE rn = 2) AS s FROM o GROUP BY 1), z AS (SELECT k, count(*) AS n FROM l GROUP BY 1)
  SELECT z.k AS series_key, CASE WHEN n >= 8 AND a IS NOT NULL AND a / n >= 0.8 AND NOT coalesce(s >= 0.95 * a, false) THEN m END AS "match", coalesce(a, 0) AS n_agree,
  CASE WHEN n < 8 THEN 'TOO-SHORT' WHEN a IS NULL THEN 'NO-OVERLAP' WHEN a / n < 0.8 THEN 'UNMATCHED' WHEN s >= 0.95 * a THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS verdict FROM z LEFT JOIN b ON z.k = b.k""")
def crosswalk(spark, d):
    r = stored(spark, d, 2).withColumn("series_key", F.concat(F.lit("X"), "series_key"))
    return rollups.crosswalk(stored(spark, d, 1), r)


# --- time -----------------------------------------------------------------------------------------------------------------------

_CODES = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"


@query(f"""SELECT d AS day, make_date(year(d), 12, 31) AS a, CAST(date_trunc('month', d) AS DATE) AS m, CAST(date_trunc('quarter', d) AS DATE) AS q, make_date(year(d), CASE WHEN month(d) <= 6 THEN 1 ELSE 7 END, 1) AS h,
  CAST(date_trunc('week', d) AS DATE) AS w, d AS dd, make_date(year(d), 12, 31) AS split, NULL::DATE AS bad, CAST(date_trunc('week', d) AS DATE) AS sdmx_w, make_date(year(d), 1, 1) AS tsv_a, 'Q' AS tsv_freq FROM {_CODES}""")
def period_parse(spark, d):
    days = line_obs(spark, d).select(F.col("obs_date").alias("day")).distinct()
    y, fmt = F.date_format("day", "yyyy"), lambda p: F.date_format("day", p)
    iso = F.extract(F.lit("YEAROFWEEK"), F.col("day")).cast("string")
    wk = F.lpad(F.weekofyear("day").cast("string"), 2, "0")
    half = F.when(F.month("day") <= 6, "1").otherwise("2")
    tsv = P.tsv_period(F.concat(y, F.lit("-Q"), F.quarter("day").cast("string")))
    return days.select(
        "day", P.table_period(y).alias("a"), P.table_period(fmt("yyyy'M'MM")).alias("m"), P.table_period(F.concat(y, F.lit("K"), F.quarter("day").cast("string"))).alias("q"), P.table_period(F.concat(y, F.lit("H"), half)).alias("h"),
        P.table_period(F.concat(iso, F.lit("W"), wk)).alias("w"), P.table_period(fmt("yyyy'M'MM'D'dd")).alias("dd"), P.table_period(F.concat(y, F.lit("-"), (F.year("day") + 1).cast("string"))).alias("split"),
        P.table_period(F.concat(y, F.lit("-"), (F.year("day") + 5).cast("string"))).alias("bad"), P.sdmx_period(F.concat(iso, F.lit("-W"), wk)).alias("sdmx_w"), P.tsv_period(y)["date"].alias("tsv_a"), tsv["freq"].alias("tsv_freq"))


@query(f"""SELECT d AS label, CAST(d AS DATE) AS day_start, d + 1 AS day_end, CAST(d + 1 - INTERVAL 7 DAY AS DATE) AS week_start, CAST(d + INTERVAL 1 MONTH AS DATE) AS month_end, CAST(d + 1 - INTERVAL 3 MONTH AS DATE) AS quarter_start, CAST(d + INTERVAL 12 MONTH AS DATE) AS year_end FROM {_CODES}""")
def span_compute(spark, d):
    days = line_obs(spark, d).select(F.col("obs_date").alias("label")).distinct()
    s = lambda g, st: timejoin.span(F.col("label"), g, st)
    return days.select("label", s("daily", "date")["start"].alias("day_start"), s("daily", "date")["end"].alias("day_end"), s("weekly", "end")["start"].alias("week_start"), s("monthly", "start")["end"].alias("month_end"), s("quarterly", "end")["start"].alias("quarter_start"), s("annual", "start")["end"].alias("year_end"))


@query(f"""WITH o AS (SELECT series_key, obs_date, row_no FROM {LINE_OBS}), r AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, max(round(o_totalprice * 100)::BIGINT) AS v FROM orders GROUP BY 1)
  SELECT series_key, obs_date, row_no, r.v AS period_value FROM o LEFT JOIN r ON CAST(date_trunc('month', o.obs_date) AS DATE) = r.m""")
def same_period_join(spark, d):
    right = table(spark, d, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("obs_date"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("value"))
    return timejoin.same_period(line_obs(spark, d).drop("value"), right, left_grain="daily", left_stamp="date", right_grain="monthly", right_stamp="start")


@query(nan_apart_sql("""SELECT read_id, metric, known_value FROM (SELECT r.read_id, r.metric, f.value AS known_value, row_number() OVER (PARTITION BY r.read_id ORDER BY f.vintage_date DESC NULLS LAST, f.obs_date DESC NULLS LAST, f.fact_id DESC NULLS LAST) AS rn
  FROM asof_reads r LEFT JOIN facts f ON r.metric = f.metric AND f.vintage_date + INTERVAL 16 HOUR <= r.read_at AT TIME ZONE 'UTC') WHERE rn = 1""", "known_value"))
def as_known_join(spark, d):
    f = table(spark, d, "facts").withColumn("known_at", (F.unix_seconds(F.col("vintage_date").cast("timestamp")) + 16 * 3600).cast("timestamp"))
    return nan_apart(timejoin.last_known(table(spark, d, "asof_reads").select("read_id", "metric", "read_at"), f, on=["metric"], row_at="read_at", known_at="known_at", order=["obs_date", "fact_id"]).select("read_id", "metric", "known_value"), "known_value")


# --- catalogue ----------------------------------------------------------------------------------------------------------------------

_TOK = "list_filter(list_distinct(regexp_split_to_array(lower(coalesce(title, '') || ' ' || coalesce(geography, '')), '[^\\p{L}\\p{N}]+')), lambda w: w <> '')"


@query(f"SELECT DISTINCT series_id, title FROM series WHERE list_has_all({_TOK}, ['hotel', 'average'])")
def catalog_search(spark, d):
    return catalogue.match_all(table(spark, d, "series"), "Hotel average").select("series_id", "title").distinct()


@query(f"SELECT DISTINCT series_id, title FROM series WHERE list_has_all({_TOK}, ['job']) AND len(list_filter({_TOK}, lambda w: starts_with(w, 'vaca'))) > 0")
def catalog_prefix(spark, d):
    return catalogue.match_prefix(table(spark, d, "series"), "job vaca").select("series_id", "title").distinct()


@query("SELECT DISTINCT series_id, title FROM series WHERE source_id = 'lantern_so' AND (title ILIKE '%gross%' OR series_id ILIKE '%gross%')")
def catalog_like(spark, d):
    return catalogue.match_like(table(spark, d, "series"), "gross", "lantern_so").select("series_id", "title").distinct()


@query("SELECT DISTINCT series_id FROM series WHERE source_id = 'lantern_so' ORDER BY encode(series_id) LIMIT 50 OFFSET 20")
def catalog_browse(spark, d):
    return catalogue.page(table(spark, d, "series").filter("source_id = 'lantern_so'").select("series_id").distinct(), "series_id", 50, 20)


@query(f"SELECT term, count(*) AS n_series FROM (SELECT DISTINCT series_id, unnest({_TOK}) AS term FROM series) GROUP BY 1")
def term_index(spark, d):
    return catalogue.inverted_index(table(spark, d, "series")).groupBy("term").agg(F.count(F.lit(1)).alias("n_series"))


@query("SELECT least(n, 500) AS total, n > 500 AS total_is_lower_bound FROM (SELECT count(*) AS n FROM series WHERE frequency = 'M')")
def capped_count(spark, d):
    return catalogue.capped_count(table(spark, d, "series").filter("frequency = 'M'"), 500)


@query("SELECT DISTINCT series_id, coalesce(nullif(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.titles.es') END, ''), title) AS title FROM series")
def localised_title(spark, d):
    return table(spark, d, "series").select("series_id", catalogue.localised_title("es").alias("title")).distinct()


@query("""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY license_id ORDER BY added_on DESC) AS rn FROM license WHERE removed_on IS NULL) WHERE rn = 1),
  s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY added_on DESC) AS rn FROM source_list WHERE removed_on IS NULL) WHERE rn = 1),
  t AS (SELECT source_id, max(try_cast(end_date AS DATE)) FILTER (WHERE try_cast(end_date AS DATE) < DATE '2900-01-01') AS data_through, count(DISTINCT series_id) AS n_series FROM series GROUP BY 1)
  SELECT s.source_id, s.name, s.homepage, s.license_id, l.name AS license_name, l.reservable, t.data_through, t.n_series FROM s LEFT JOIN l ON s.license_id = l.license_id LEFT JOIN t ON s.source_id = t.source_id""")
def sources_nested(spark, d):
    n = catalogue.sources_nested(table(spark, d, "source_list"), table(spark, d, "license"), catalogue.data_through(table(spark, d, "series")))
    return n.select("source_id", "name", "homepage", "license.license_id", F.col("license.name").alias("license_name"), "license.reservable", "freshness.data_through", "freshness.n_series")


@query("SELECT DISTINCT series_id FROM series WHERE coalesce(source_id, '') NOT IN ('lantern_so', 'granite_li') AND NOT (starts_with(series_id, 'larch_tr:') OR series_id = 'larch_tr') AND series_id NOT IN (SELECT series_id FROM sent)")
def carve_outs(spark, d):
    return catalogue.carve_outs(table(spark, d, "series"), ["lantern_so", "granite_li"], ["larch_tr"], table(spark, d, "sent")).select("series_id").distinct()


_REASONS = f"""(WITH a AS (SELECT DISTINCT series_id FROM (SELECT series_id FROM series_served UNION ALL SELECT series_id FROM sent)), c AS (SELECT series_id, max(source_id) AS source_id FROM series GROUP BY 1), g AS (SELECT series_id, max(gate) AS gate FROM ({ORACLE['license_gate']}) GROUP BY 1)
  SELECT a.series_id, c.source_id, CASE WHEN g.gate <> 'open' THEN 'gate' WHEN h.series_id IS NOT NULL THEN 'withheld' WHEN c.series_id IS NULL THEN 'not_found' WHEN a.series_id NOT IN (SELECT series_id FROM series_served) THEN 'not_migrated' ELSE 'ok' END AS reason FROM a LEFT JOIN c ON a.series_id = c.series_id LEFT JOIN g ON a.series_id = g.series_id LEFT JOIN (SELECT DISTINCT series_id FROM series_served WHERE frequency = 'W') h ON a.series_id = h.series_id)"""


@query(f"SELECT source_id, reason, series_id, count(*) OVER (PARTITION BY source_id, reason) AS n_series FROM {_REASONS}")
def bundle_manifest(spark, d):
    s, served = table(spark, d, "series"), table(spark, d, "series_served")
    asked = served.select("series_id").unionByName(table(spark, d, "sent").select("series_id"))
    r = catalogue.bundle_reasons(asked, s, license_gate(spark, d), served.filter("frequency = 'W'"), served)
    return catalogue.manifest(r)


@query("""WITH a AS (SELECT source_id, count(DISTINCT series_key) AS x FROM obs_snapshots WHERE series_key IS NOT NULL GROUP BY 1), b AS (SELECT source_id, count(DISTINCT series_id) AS y FROM series WHERE series_id IS NOT NULL GROUP BY 1)
  SELECT coalesce(a.source_id, b.source_id) AS source_id, coalesce(x, 0) AS n_store, coalesce(y, 0) AS n_catalogue, CASE WHEN coalesce(x, 0) = coalesce(y, 0) THEN 'MATCH' WHEN x IS NULL THEN 'MISSING' WHEN y IS NULL THEN 'ORPHAN' ELSE 'DRIFT' END AS verdict FROM a FULL JOIN b ON a.source_id = b.source_id""")
def grain_audit(spark, d):
    return catalogue.grain_audit(table(spark, d, "obs_snapshots"), table(spark, d, "series"))


# --- runs and freshness -------------------------------------------------------------------------------------------------------------

_NOW = "2024-02-01 12:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp")


@query(f"""WITH r AS (SELECT * FROM {RUNS}), t AS (SELECT source_id, coalesce(max(dur_s), 0) AS cost FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY id DESC) AS rn FROM r WHERE status <> 'window_stopped') WHERE rn <= 5 GROUP BY 1),
  f AS (SELECT source_id, dur_s AS fl FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY id DESC) AS rn FROM r WHERE status IN ('ok', 'no_change', 'partial', 'killed_external')) WHERE rn = 1)
  SELECT t.source_id, greatest(cost, fl) AS cost_s FROM t LEFT JOIN f ON t.source_id = f.source_id""")
def run_cost_estimate(spark, d):
    return fresh.run_cost(runs(spark, d))


@query(f"""WITH r AS (SELECT *, max(CASE WHEN status IN ('ok', 'no_change') THEN id END) OVER (PARTITION BY unit_id) AS good FROM {RUNS} WHERE status NOT IN ('window_stopped', 'partial'))
  SELECT unit_id, count(*) AS n_fails, min(ts) AS first_fail, max(ts) AS last_fail FROM r WHERE status = 'transient_fail' AND (good IS NULL OR id > good) GROUP BY 1 HAVING count(*) >= 2""")
def failure_streak(spark, d):
    return fresh.failure_streak(runs(spark, d), ["unit_id"], ["transient_fail"], ["window_stopped", "partial"], least=2, hours=0)


@query(f"""WITH r AS (SELECT *, max(CASE WHEN status <> 'window_stopped' THEN id END) OVER (PARTITION BY unit_id) AS l FROM {RUNS}) SELECT unit_id, count(*) AS n_stops, sum(dur_s) / 60 AS minutes FROM r WHERE status = 'window_stopped' AND id > coalesce(l, -1) GROUP BY 1""")
def stop_streak(spark, d):
    return fresh.stop_streak(runs(spark, d), ["unit_id"])


@query(f"""WITH r AS (SELECT unit_id, id, row_number() OVER (PARTITION BY unit_id ORDER BY id DESC) AS rn, unnest(list_distinct(['t' || CAST(id % 2 AS VARCHAR), 'a', 't' || CAST(id % 3 AS VARCHAR)])) AS token FROM (SELECT * FROM {RUNS} WHERE status <> 'window_stopped')),
  k AS (SELECT *, row_number() OVER (PARTITION BY unit_id, token ORDER BY rn) AS k FROM r) SELECT unit_id, token, count(*) AS n_runs FROM k WHERE k = rn GROUP BY ALL""")
def sub_unit_streak(spark, d):
    tok = F.array(F.concat(F.lit("t"), (F.col("id") % 2).cast("string")), F.lit("a"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")))
    return fresh.token_streak(runs(spark, d), tok, ["unit_id"], ["window_stopped"])


_UNITS = f"(SELECT unit_id, max(ts) FILTER (WHERE status IN ('ok', 'no_change')) AS last_success, max(ts) AS last_attempt, arg_max(status, id) AS status, ['daily', 'weekly', 'monthly', 'quarterly', 'odd'][1 + length(unit_id) % 5] AS cadence, max(dur_s) AS cost FROM {RUNS} GROUP BY 1)"


def _units(spark, d):
    r = runs(spark, d)
    names = F.array(*map(F.lit, ["daily", "weekly", "monthly", "quarterly", "odd"]))
    return r.groupBy("unit_id").agg(F.max(F.when(F.col("status").isin("ok", "no_change"), F.col("ts"))).alias("last_success"), F.max("ts").alias("last_attempt"), F.max_by("status", "id").alias("status"), F.max("dur_s").alias("cost")).withColumn("cadence", F.get(names, F.length("unit_id") % 5))


_DAYS = "CASE cadence WHEN 'daily' THEN 1.0 WHEN 'weekly' THEN 7.0 WHEN 'monthly' THEN 30.0 WHEN 'quarterly' THEN 91.0 WHEN 'annual' THEN 365.0"


def _age(c: str) -> str:
    return f"((epoch_us(TIMESTAMP '{_NOW}') - epoch_us(CAST({c} AS TIMESTAMP))) / 86400e6)"


@query(f"""SELECT unit_id, CASE WHEN last_success IS NOT NULL THEN {_age('last_success')} >= {_DAYS} ELSE 7.0 END * 0.9 WHEN status = 'partial' THEN {_age('last_attempt')} >= least({_DAYS} ELSE 7.0 END, 3.0) * 0.9 ELSE true END AS due FROM {_UNITS}""")
def cadence_due(spark, d):
    return _units(spark, d).select("unit_id", fresh.is_due(F.col("cadence"), F.col("last_success"), F.col("status"), F.col("last_attempt"), _now()).alias("due"))


@query(f"""SELECT unit_id, band, row_number() OVER (ORDER BY band, k, unit_id) AS turn FROM (SELECT unit_id, CASE WHEN cost IS NULL OR cost < 10 THEN 0 WHEN cost < 20 THEN 1 ELSE 2 END AS band, CASE WHEN last_success IS NULL THEN '-infinity'::DOUBLE ELSE -({_age('last_success')} / {_DAYS} ELSE 30.0 END) END AS k FROM {_UNITS})""")
def overdue_order(spark, d):
    band = F.when(F.col("cost").isNull() | (F.col("cost") < 10), 0).when(F.col("cost") < 20, 1).otherwise(2)
    key = fresh.overdue_key(F.col("last_success"), F.col("cadence"), _now())
    return fresh.turn_order(_units(spark, d), band, key).select("unit_id", "band", "turn")


@query(f"""WITH x AS (SELECT id, ts, greatest(0, {_age('ts')}) AS age FROM {RUNS}) SELECT id, round(greatest(0, age - (SELECT count(*) FROM range(CAST(CAST(ts AS DATE) AS TIMESTAMP), TIMESTAMP '2024-02-01', INTERVAL 1 DAY) t(q) WHERE isodow(q) >= 6)), 6) AS business_age FROM x""")
def business_age(spark, d):
    return runs(spark, d).select("id", fresh.business_age_days(F.col("ts"), _now()).alias("business_age"))


@query("""WITH a AS (SELECT source_id, max(e) AS frontier, max(e) FILTER (WHERE e <= DATE '2024-06-30') AS seen, count(*) AS n, count(*) FILTER (WHERE e <= DATE '2024-06-30') AS past FROM (SELECT source_id, try_cast(end_date AS DATE) AS e FROM series) WHERE e IS NOT NULL GROUP BY 1)
  SELECT source_id, frontier, CASE WHEN frontier > DATE '2024-06-30' AND past * 2 < n AND DATE '2024-06-30' - seen > 730 THEN NULL ELSE seen END AS newest FROM a""")
def recency_signal(spark, d):
    s = table(spark, d, "series").withColumn("e", F.col("end_date").try_cast("date"))
    return fresh.recency(s, "source_id", "e", F.lit("2024-06-30").cast("date"))


@query(f"""SELECT unit_id, CASE WHEN unit_id LIKE '%3' THEN 'ok' WHEN unit_id LIKE '%4' THEN 'paused' WHEN unit_id LIKE '%5' THEN 'retired' WHEN status IN ('ok', 'no_change') AND cadence <> 'odd' AND {_age('last_success')} > {_DAYS} END * 0.1 AND unit_id NOT LIKE '%6' THEN 'late' ELSE s END AS label FROM (SELECT *, CASE WHEN unit_id LIKE '%3' THEN 'ok' ELSE status END AS s FROM {_UNITS})""")
def freshness_label(spark, d):
    u = _units(spark, d).withColumn("stored", F.when(F.col("unit_id").endswith("3"), "ok").otherwise(F.col("status")))
    end = lambda x: F.col("unit_id").endswith(x)
    return u.select("unit_id", fresh.freshness_label(F.col("stored"), end("3"), end("4"), ~end("5"), F.col("cadence"), F.col("last_success"), end("6"), _now(), ["ok", "no_change"], tolerance=0.1).alias("label"))


@query(f"""SELECT unit_id, CASE WHEN last_success IS NULL AND unit_id LIKE '%1' THEN 'PENDING' WHEN last_success IS NULL THEN 'RED-UNRUN' WHEN unit_id LIKE '%2' AND {_age('last_success')} > 20 THEN 'ROTATING' WHEN {_age('last_success')} > 20 THEN 'RED-SLA' WHEN {_age('last_attempt')} > 10 THEN 'RED-DATA' WHEN status = 'partial' THEN 'ATTENTION' ELSE 'OK' END AS verdict FROM {_UNITS}""")
def health_verdict(spark, d):
    end = lambda x: F.col("unit_id").endswith(x)
    age = lambda c: fresh.age_days(F.col(c), _now())
    return _units(spark, d).select("unit_id", fresh.health_verdict(age("last_success"), F.lit(20.0), age("last_attempt"), F.lit(10.0), F.col("last_success").isNotNull(), end("2"), end("1"), F.coalesce(F.col("status") == "partial", F.lit(False))).alias("verdict"))


@query("SELECT source_id, count(*) AS n_queued, min(ts) AS oldest, sum(CASE WHEN dur_s IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_unknown FROM " + RUNS + " WHERE status = 'transient_fail' GROUP BY 1")
def retry_backlog(spark, d):
    return runs(spark, d).filter("status = 'transient_fail'").groupBy("source_id").agg(F.count(F.lit(1)).alias("n_queued"), F.min("ts").alias("oldest"), F.sum(F.when(F.col("dur_s").isNull(), 1).otherwise(0)).alias("n_unknown"))


@query("""WITH c AS (SELECT series_id AS flow_id, max(end_date) AS vintage, min(start_date) AS position FROM series GROUP BY 1), s AS (SELECT series_id AS flow_id, max(end_date) AS vintage, CASE WHEN max(frequency) = 'M' THEN 'partial' ELSE 'ok' END AS status FROM series_served GROUP BY 1),
  j AS (SELECT c.flow_id, CASE WHEN s.flow_id IS NULL THEN 'new' WHEN c.vintage IS DISTINCT FROM s.vintage THEN 'changed' WHEN status IN ('partial', 'failed') THEN 'redo' END AS reason FROM c LEFT JOIN s ON c.flow_id = s.flow_id),
  o AS (SELECT flow_id, reason, row_number() OVER (ORDER BY (reason = 'redo')::INT, encode(flow_id)) AS place, count(*) OVER () AS n FROM j WHERE reason IS NOT NULL) SELECT flow_id, reason, place, n > 100 AS capped FROM o WHERE place <= 100""")
def flow_selection(spark, d):
    c = table(spark, d, "series").groupBy(F.col("series_id").alias("flow_id")).agg(F.max("end_date").alias("vintage")).withColumn("position", F.col("flow_id"))
    s = table(spark, d, "series_served").groupBy(F.col("series_id").alias("flow_id")).agg(F.max("end_date").alias("vintage"), F.when(F.max("frequency") == "M", "partial").otherwise("ok").alias("status"))
    return fresh.select_flows(c, s, ["partial", "failed"], 100)


@query(f"SELECT series_id, CASE frequency WHEN 'D' THEN e + 1 WHEN 'W' THEN e + 7 WHEN 'M' THEN e + 30 WHEN 'Q' THEN e + 91 WHEN 'A' THEN e + 365 END AS next_update FROM (SELECT DISTINCT series_id, frequency, try_cast(end_date AS DATE) AS e FROM series)")
def next_update(spark, d):
    s = table(spark, d, "series").select("series_id", "frequency", F.col("end_date").try_cast("date").alias("e")).distinct()
    return s.select("series_id", fresh.next_update(F.col("e"), F.col("frequency")).alias("next_update"))


@query("""WITH a AS (SELECT source_id, count(*) AS n, max(end_date) AS m FROM series GROUP BY 1), b AS (SELECT source_id, count(*) AS n, max(end_date) AS m FROM series_served GROUP BY 1)
  SELECT a.source_id, CASE WHEN b.n > a.n OR b.m > a.m THEN 'ahead' WHEN b.n < a.n OR b.m < a.m THEN 'behind' ELSE 'same' END AS state FROM a JOIN b ON a.source_id = b.source_id""")
def footer_classify(spark, d):
    g = lambda t, p: table(spark, d, t).groupBy("source_id").agg(F.count(F.lit(1)).alias(f"{p}n"), F.max("end_date").alias(f"{p}m"))
    return g("series", "a").join(g("series_served", "b"), "source_id").select("source_id", fresh.footer_class(F.col("an"), F.col("bn"), F.col("am"), F.col("bm")).alias("state"))
