"""Further queries: catalogue lookups, lists, samples, time axes, delivery and intraday measures, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_label_of_gap
from ..operators import catalogue, delivery, intraday, merge, rollups, timejoin
from ..operators import freshness as fresh
from ..session import table
from ..sources import formats
from ..streaming.upsert import windowed_activity
from .reference import _NOW, _UNITS, _units
from .views import LINE_OBS, RUNS, line_obs, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT DISTINCT source_id, name FROM source_list s WHERE EXISTS (SELECT 1 FROM series x WHERE x.source_id = s.source_id)")
def sources_with_series(spark, d):
    return table(spark, d, "source_list").join(table(spark, d, "series").select("source_id").distinct(), "source_id", "left_semi").select("source_id", "name").distinct()


@query("SELECT DISTINCT series_id, row_hash FROM sent WHERE series_id IN (SELECT unnest(json_extract_string(j, '$[*]')) FROM (SELECT to_json(list(series_id)) AS j FROM series WHERE frequency = 'W'))")
def in_list(spark, d):
    ids = table(spark, d, "series").filter("frequency = 'W'").select("series_id").distinct()
    return table(spark, d, "sent").join(ids, "series_id", "left_semi").select("series_id", "row_hash")


@query(f"SELECT u.unit_id, u.status, u.last_attempt, s.n_units FROM {_UNITS} u LEFT JOIN (SELECT status, count(*) AS n_units FROM {_UNITS} GROUP BY 1) s ON u.status = s.status")
def last_updates(spark, d):
    u = _units(spark, d)
    return u.join(u.groupBy("status").agg(F.count(F.lit(1)).alias("n_units")), "status", "left").select("unit_id", "status", "last_attempt", "n_units")


@query("""WITH k AS (SELECT DISTINCT substr(series_id, 12) || ':X1.Y2' AS series_key FROM series WHERE source_id = 'lantern_so' AND starts_with(series_id, 'lantern_so:') UNION SELECT DISTINCT substr(series_id, 12) FROM series_served WHERE source_id = 'lantern_so' AND starts_with(series_id, 'lantern_so:')),
  h AS (SELECT k.series_key, i.series_id FROM k LEFT JOIN (SELECT DISTINCT series_id FROM series WHERE source_id = 'lantern_so') i ON 'lantern_so:' || k.series_key = i.series_id OR starts_with('lantern_so:' || k.series_key, i.series_id || ':') OR starts_with('lantern_so:' || k.series_key, i.series_id || '.')),
  m AS (SELECT series_key, arg_max(series_id, length(series_id)) AS series_id FROM h GROUP BY 1) SELECT series_key, series_id, CASE WHEN series_id IS NULL THEN 'none' WHEN series_id = 'lantern_so:' || series_key THEN 'exact' ELSE 'grain' END AS how FROM m""")
def catalogue_lookup(spark, d):
    own = lambda t: table(spark, d, t).filter("source_id = 'lantern_so' AND startswith(series_id, 'lantern_so:')").select(F.expr("substr(series_id, 12)").alias("series_key"))
    changed = own("series").select(F.concat("series_key", F.lit(":X1.Y2")).alias("series_key")).union(own("series_served")).distinct()
    return catalogue.catalogue_ids(changed, table(spark, d, "series"), "lantern_so")


@query("SELECT l.source_id, l.n, m.name FROM (SELECT source_id, count(*) AS n FROM series GROUP BY 1) l LEFT JOIN (SELECT source_id, max(name) AS name FROM source_list GROUP BY 1) m ON l.source_id = m.source_id")
def label_join(spark, d):
    n = table(spark, d, "series").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    return catalogue.label_join(n, table(spark, d, "source_list"), "source_id", "name", strict=False)


@query(f"SELECT source_id, row_number() OVER (ORDER BY CASE WHEN source_id <= 's3' THEN 1 ELSE 0 END, source_id) AS place FROM (SELECT DISTINCT source_id FROM {RUNS})")
def rotation(spark, d):
    return fresh.rotate_after(runs(spark, d).select("source_id").distinct(), "source_id", "source_id", "s3")


@query(f"SELECT id, row_number() OVER (ORDER BY id % 3, ts, id) AS place FROM {RUNS} WHERE status = 'transient_fail'")
def retry_order(spark, d):
    q = runs(spark, d).filter("status = 'transient_fail'").select("id", (F.col("id") % 3).alias("attempts"), F.col("ts").alias("enqueued"))
    return fresh.retry_order(q).select("id", "place")


@query(f"""WITH f AS (SELECT id, ts, CASE WHEN status = 'transient_fail' THEN 'failed' WHEN status = 'partial' THEN 'redo' ELSE 'fresh' END AS class, 1 + id % 9 AS fails FROM {RUNS}),
  g AS (SELECT *, class = 'failed' AND (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(ts)) / 3600e6 >= least(12 * pow(2, least(fails - 1, 10)), 384) AS due FROM f), r AS (SELECT *, row_number() OVER (PARTITION BY due ORDER BY ts, id) AS rn FROM g)
  SELECT id AS flow_id, CASE WHEN due AND rn <= 40 THEN 'retry' WHEN due THEN 'waiting' WHEN class = 'failed' THEN 'backed_off' ELSE class END AS plan FROM r""")
def retry_plan(spark, d):
    r = runs(spark, d)
    kind = F.when(F.col("status") == "transient_fail", "failed").when(F.col("status") == "partial", "redo").otherwise("fresh")
    f = r.select(F.col("id").alias("flow_id"), kind.alias("class"), (1 + F.col("id") % 9).alias("fails"), F.col("ts").alias("failed_at"), F.col("id").alias("position"))
    return fresh.retry_plan(f, F.lit(_NOW).cast("timestamp"), 40)


@query(f"SELECT series_key FROM (SELECT DISTINCT series_key FROM {LINE_OBS}) ORDER BY md5(series_key), series_key LIMIT 100")
def key_sample(spark, d):
    """A hundred keys in the order of a hash: the same ones for the same table. Sampling is the feature."""
    return line_obs(spark, d).select("series_key").distinct().orderBy(F.md5(F.col("series_key").cast("binary")), "series_key").limit(100)


@query(f"""WITH x AS (SELECT series_key, obs_date, row_no, coalesce(obs_date = lag(obs_date) OVER w, false) AS same, coalesce(obs_date = lead(obs_date) OVER w, false) AS more FROM {LINE_OBS} WINDOW w AS (PARTITION BY series_key ORDER BY obs_date, row_no))
  SELECT series_key, obs_date, row_no, CAST(sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY series_key ORDER BY obs_date, row_no ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS run, NOT more AS last FROM x""")
def key_runs(spark, d):
    return merge.key_runs(line_obs(spark, d).drop("value"))


@query("""WITH c AS (SELECT 't' || CAST(l_linenumber AS VARCHAR) AS table_id, unnest(['part', 'tid', 'kind']) AS dim, unnest([CAST(l_partkey AS VARCHAR), strftime(l_shipdate, '%YM%m'), l_returnflag]) AS code FROM lineitem),
  a AS (SELECT table_id, dim, avg(CASE WHEN regexp_matches(code, '^\\d{4}M(0[1-9]|1[0-2])$') OR regexp_matches(code, '^(1[5-9]\\d\\d|20\\d\\d|2100)$') OR regexp_matches(code, '^(1[5-9]\\d\\d|20\\d\\d|2100)(0[1-9]|1[0-2])$') THEN 1.0 ELSE 0.0 END) AS rate FROM c GROUP BY ALL)
  SELECT table_id, dim AS time_dim, rate, 'rate' AS rule FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY rate DESC) AS rn FROM a WHERE rate >= 0.6) WHERE rn = 1""")
def time_axis(spark, d):
    t = table(spark, d, "lineitem")
    s = lambda n, c: F.struct(F.lit(n).alias("dim"), c.alias("code"))
    c = t.select(F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("table_id"), F.explode(F.array(s("part", F.col("l_partkey").cast("string")), s("tid", F.date_format("l_shipdate", "yyyy'M'MM")), s("kind", F.col("l_returnflag")))).alias("x")).select("table_id", "x.*")
    return formats.resolve_time(c)


@query(f"""WITH x AS (SELECT DISTINCT series_key, obs_date FROM {LINE_OBS}), g AS (SELECT *, obs_date - lag(obs_date) OVER (PARTITION BY series_key ORDER BY obs_date) AS gap FROM x), m AS (SELECT series_key, median(gap) AS med FROM g GROUP BY 1)
  SELECT x.series_key, x.obs_date, CASE WHEN med >= 200 THEN strftime(obs_date, '%Y') WHEN med >= 60 THEN strftime(obs_date, '%Y') || 'Q' || CAST(quarter(obs_date) AS VARCHAR) WHEN med >= 20 THEN strftime(obs_date, '%Y-%m') ELSE strftime(obs_date, '%Y-%m-%d') END AS period FROM x JOIN m ON x.series_key = m.series_key""")
def period_label(spark, d):
    o = line_obs(spark, d)
    g = rollups.median_gaps(o).select("series_key", "median_gap")
    return o.select("series_key", "obs_date").distinct().join(g, "series_key").select("series_key", "obs_date", period_label_of_gap(F.col("obs_date"), F.col("median_gap")).alias("period"))


@query("""WITH r AS (SELECT source_id, try_cast(start_date AS DATE) AS s, try_cast(end_date AS DATE) AS l, CASE WHEN source_id LIKE '%o' THEN DATE '2015-06-30' END AS t FROM series WHERE try_cast(start_date AS DATE) IS NOT NULL AND try_cast(end_date AS DATE) IS NOT NULL AND source_id IS NOT NULL),
  m AS (SELECT source_id, max(s) AS ms, max(t) AS t FROM r WHERE t IS NULL OR s <= t GROUP BY 1) SELECT m.source_id, max(r.l) <= m.t AS complete FROM m JOIN r ON r.source_id = m.source_id AND r.s = m.ms GROUP BY m.source_id, m.t""")
def completeness(spark, d):
    s = table(spark, d, "series").filter("source_id IS NOT NULL").select("source_id", F.col("start_date").try_cast("date").alias("s"), F.col("end_date").try_cast("date").alias("l"), F.when(F.col("source_id").endswith("o"), F.lit("2015-06-30").cast("date")).alias("t")).filter("s IS NOT NULL AND l IS NOT NULL")
    one = s.groupBy("source_id", "s", "t").agg(F.max("l").alias("l"))  # a start day once, with its last end
    return timejoin.last_complete(one, by="source_id", start="s", last_day="l", through="t")


@query("""WITH l AS (SELECT license_id, max(name) AS name, max(commercial_ok) AS c, max(no_modify) AS m FROM license GROUP BY 1), s AS (SELECT source_id, max(name) AS name, max(terms_url) AS terms, max(license_id) AS license_id FROM source_list GROUP BY 1), x AS (SELECT DISTINCT series_id, source_id FROM series)
  SELECT x.series_id, concat_ws(chr(10), '# series: ' || x.series_id, '# source: ' || s.name, '# licence: ' || l.name, CASE WHEN l.c = 0 THEN '# NOTE: NON-COMMERCIAL use only' END, CASE WHEN l.license_id LIKE 'sharealike%' THEN '# NOTE: SHARE-ALIKE' END, CASE WHEN l.m = 1 THEN '# NOTE: NO DERIVATIVES' END, CASE WHEN s.terms <> '' THEN '# terms: ' || s.terms END) AS head
  FROM x LEFT JOIN s ON x.source_id = s.source_id LEFT JOIN l ON s.license_id = l.license_id""")
def citation_head(spark, d):
    lic = table(spark, d, "license").groupBy("license_id").agg(F.max("name").alias("lname"), F.max("commercial_ok").alias("c"), F.max("no_modify").alias("m")).withColumn("lid", F.col("license_id"))
    src = table(spark, d, "source_list").groupBy("source_id").agg(F.max("name").alias("sname"), F.max("terms_url").alias("terms"), F.max("license_id").alias("license_id"))
    j = table(spark, d, "series").select("series_id", "source_id").distinct().join(src, "source_id", "left").join(lic, "license_id", "left")
    lines = delivery.citation_lines(F.col("series_id"), F.col("sname"), F.col("lname"), F.col("terms"), F.col("c") == 0, F.col("lid").startswith("sharealike"), F.col("m") == 1)
    return j.select("series_id", F.array_join(lines, "\n").alias("head"))


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def windowed_events(spark, d):
    return windowed_activity(table(spark, d, "events"), "ts", "1 hour", "2 hours", ["event_type"]).withColumn("total", F.round("total", 4))


_BARS = "(SELECT event_type AS ticker, date_trunc('minute', ts) AS ts, arg_min(value + 1, ts) AS open, max(value + 1) AS high, min(value + 1) AS low, arg_max(value + 1, ts) AS close, sum(user_id)::BIGINT AS volume FROM events GROUP BY 1, 2)"


def _bars(spark, d):
    return intraday.minute_bars(table(spark, d, "events").withColumn("p", F.col("value") + 1), "event_type", "ts", "p", F.col("user_id"))


def _rounded(df: DataFrame, places: int = 7) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _returns_sql(minutes: int) -> str:
    bucket = f"CAST(floor(epoch(ts) / {60 * minutes}) AS BIGINT)"
    return f"(SELECT ticker, day, i, ln(close / lag(close) OVER (PARTITION BY ticker, day ORDER BY i)) AS r FROM (SELECT ticker, CAST(ts AS DATE) AS day, {bucket} AS i, arg_max(close, ts) AS close FROM {_BARS} WHERE close > 0 GROUP BY ALL))"


@query(f"""WITH o AS (SELECT *, lag(r) OVER (PARTITION BY ticker, day ORDER BY i) AS p FROM {_returns_sql(1)} WHERE r IS NOT NULL), f AS (SELECT *, lag(r) OVER w AS p, lag(r, 2) OVER w AS pp FROM {_returns_sql(5)} WHERE r IS NOT NULL WINDOW w AS (PARTITION BY ticker, day ORDER BY i)),
  t AS (SELECT ticker, day, var_samp(r) AS v10 FROM {_returns_sql(10)} WHERE r IS NOT NULL GROUP BY ALL),
  a AS (SELECT ticker, day, sum(r * r) AS rv1, covar_samp(r, p) AS cov, corr(r, p) AS ac1, var_samp(r) AS v1, stddev_samp(r) AS sd FROM o GROUP BY ALL),
  b AS (SELECT ticker, day, sum(r * r) AS rv5, pi() / 2 * sum(abs(r) * abs(p)) AS bv5, count(*) AS m, sum(pow(abs(r) * abs(p) * abs(pp), 4.0 / 3)) AS q, var_samp(r) AS v5 FROM f GROUP BY ALL),
  z AS (SELECT *, sqrt(m) * (1 - bv5 / rv5) / sqrt({intraday.THETA} * greatest(1.0, m * {intraday.MU43**-3} * q / (bv5 * bv5))) AS z FROM a LEFT JOIN b USING (ticker, day) LEFT JOIN t USING (ticker, day))
  SELECT ticker, day, round(rv5, 7) AS rv5, round(rv1, 7) AS rv1, round(bv5, 7) AS bv5, round(z, 7) AS bns_z, (z > 2.326)::INT AS jump_1, (z > 1.645)::INT AS jump_5, round(CASE WHEN cov < 0 THEN 2 * sqrt(-cov) * 10000 END, 7) AS roll_bp, round(CASE WHEN NOT isnan(ac1) THEN ac1 END, 7) AS ac1, round(v5 / (5 * v1), 7) AS vr5, round(v10 / (10 * v1), 7) AS vr10, round(sd, 7) AS ret_std FROM z""")
def intraday_returns(spark, d):
    return _rounded(intraday.return_measures(_bars(spark, d)))


@query(f"""WITH b AS (SELECT *, CAST(ts AS DATE) AS day, (epoch(ts) - epoch(lag(ts) OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts))) / 60 - 1 AS gap FROM {_BARS}),
  d AS (SELECT ticker, day, arg_min(open, ts) AS o, max(high) AS h, min(low) AS l, arg_max(close, ts) AS c, sum(close * volume) AS dv, sum(volume)::BIGINT AS sv, count(*) FILTER (WHERE volume > 0) AS tb, coalesce(max(gap), 0) AS lg FROM b GROUP BY ALL),
  e AS (SELECT *, lag(c) OVER w AS c0, lag(h) OVER w AS h0, lag(l) OVER w AS l0 FROM d WINDOW w AS (PARTITION BY ticker ORDER BY day)),
  g AS (SELECT *, pow(ln(h / l), 2) + pow(ln(h0 / l0), 2) AS be, pow(ln(greatest(h, h0) / least(l, l0)), 2) AS ga FROM e), k AS (SELECT *, (sqrt(2 * be) - sqrt(be)) / (3 - 2 * sqrt(2)) - sqrt(ga / (3 - 2 * sqrt(2))) AS al FROM g)
  SELECT ticker, day, round(pow(ln(h / l), 2) / (4 * ln(2)), 7) AS parkinson, round(ln(h / o) * ln(h / c) + ln(l / o) * ln(l / c), 7) AS rogers_satchell, round(CASE WHEN h0 IS NOT NULL THEN greatest(0, 2 * (exp(al) - 1) / (1 + exp(al))) END, 7) AS corwin_schultz, round(abs(ln(c / c0)) / nullif(dv, 0), 7) AS amihud, round(dv, 7) AS dollar_volume, sv AS share_volume, tb AS traded_bars,
    round(1 - least(tb, 390) / 390, 7) AS gap_rate, round(lg, 7) AS longest_gap, round(ln(c / o), 7) AS open_close, round(ln(o / c0), 7) AS overnight, round(ln(h / l), 7) AS high_low FROM k""")
def intraday_days(spark, d):
    return _rounded(intraday.day_measures(_bars(spark, d)))
