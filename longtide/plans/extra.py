"""Queries of further operators: conflicts, splits, drifting types, lookups, search stages, leases, fetching through rules, and what is refused, each
beside its SQL."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import update
from ..errors import LongtideError
from ..library import Library
from ..operators import audits, catalogue, copies, merge, rollups, series, timejoin
from ..operators import freshness as fresh
from ..session import put_bytes, scratch, table
from ..sources import formats
from .reference import _TOK
from .views import LINE_OBS, delivery, delivery_sql, line_obs, nan_apart, nan_apart_sql, stored, stored_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# --- comparing ----------------------------------------------------------------------------------------------------------

_NULL_SAFE = "o.series_key IS NOT DISTINCT FROM c.series_key AND o.obs_date IS NOT DISTINCT FROM c.obs_date"


@query(nan_apart_sql(f"""SELECT o.source_id, o.series_key, o.obs_date, o.value, o.row_no FROM {delivery_sql(4)} o WHERE EXISTS (SELECT 1 FROM (
  SELECT series_key, obs_date FROM (SELECT DISTINCT series_key, obs_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM {delivery_sql(4)}) GROUP BY ALL HAVING count(*) > 1) c WHERE {_NULL_SAFE})"""))
def conflicting_rows(spark, d):
    return nan_apart(audits.conflicting_rows(delivery(spark, d, 4), ["series_key", "obs_date"], "value"))


@query("""WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, CAST(l_shipdate AS TIMESTAMP) AS t FROM lineitem)
  SELECT DISTINCT * FROM (SELECT CAST(k AS VARCHAR) AS row_key, 'l_extendedprice' AS field FROM l WHERE l_partkey % 97 = 0 AND k % 11 <> 3 UNION ALL SELECT CAST(k AS VARCHAR), 'l_shipdate' FROM l WHERE t <> date_trunc('day', t) AND k % 11 <> 3
  UNION ALL SELECT CAST(k AS VARCHAR), 'missing_right' FROM l WHERE k % 11 = 3)""")
def copies_drifting_types(spark, d):
    """A copy whose integers became doubles, whose amounts became text and whose timestamps lost their time."""
    left = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("k"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    price = F.when(F.col("l_partkey") % 97 == 0, F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice"))
    right = left.filter(F.col("k").cast("bigint") % 11 != 3).select("k", F.col("l_partkey").cast("double").alias("l_partkey"), F.col("l_suppkey").cast("int").alias("l_suppkey"), F.col("l_quantity").cast("int").alias("l_quantity"),
                                                                        price.cast("string").alias("l_extendedprice"), "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate"))
    return copies.keyed_differences(left, right, "k", copies.comparable_fields(left, right, "k"))


@query(f"SELECT series_key, obs_date, CASE WHEN row_no % 2 = 0 THEN row_no END AS extra FROM {LINE_OBS}")
def permissive_union(spark, d):
    """Rows with a column that stored ones lack: null for these."""
    o = line_obs(spark, d)
    old, new = o.filter("row_no % 2 <> 0").select("series_key", "obs_date"), o.filter("row_no % 2 = 0").select("series_key", "obs_date", F.col("row_no").alias("extra"))
    return merge.tagged(old, new).select("series_key", "obs_date", "extra")


@query("SELECT * FROM (VALUES ('head', 'rows before the window differ'), ('tail', 'the new tail is empty'), ('none', '-'), ('loss', 'tail rows are lost')) v(\"case\", reason)")
def rebuild_refusals(spark, d):
    """Why a rebuild of a store from 1998 on must not be published."""
    o = line_obs(spark, d).select("series_key", "obs_date", "value")
    early = F.col("obs_date") < F.lit("1998-01-01").cast("date")
    cases = {"head": o.withColumn("value", F.when(early, F.col("value") + 1).otherwise(F.col("value"))), "tail": o.filter(early), "none": o, "loss": o.filter(early | (F.dayofmonth("obs_date") % 5 != 0))}
    out = []
    for name, new in cases.items():
        why = merge.rebuild_refusals(o, new, "1998-01-01", allowed=[r[0] for r in o.select("series_key").distinct().collect()] if name == "tail" else [])
        text = " ".join(why) or "-"
        out.append((name, next((x for x in ("rows before the window differ", "the new tail is empty", "tail rows are lost") if x in text), text)))
    return spark.createDataFrame(out, "case string, reason string")


_NORM = "regexp_replace(upper(series_key), '[^A-Z0-9]', '', 'g')"


@query(f"""WITH s AS (SELECT DISTINCT CASE WHEN row_no % 3 = 0 THEN lower(series_key) ELSE series_key END AS series_key, obs_date FROM {delivery_sql(2)} WHERE series_key IS NOT NULL), t AS (SELECT DISTINCT series_key FROM {delivery_sql(1)} WHERE series_key IS NOT NULL),
  c AS (SELECT s.*, s.series_key IN (SELECT series_key FROM t) AS spelt, {_NORM} IN (SELECT {_NORM} FROM t) AS norm FROM s) SELECT count(*) FILTER (WHERE NOT spelt AND norm) AS n_respelled, count(*) FILTER (WHERE NOT spelt AND norm) > 0.05 * count(*) FILTER (WHERE norm) AS held FROM c""")
def respelled_hold(spark, d):
    """A delivery in which a third of the keys comes in small letters is held."""
    b = delivery(spark, d, 2).filter("series_key IS NOT NULL").withColumn("series_key", F.when(F.col("row_no") % 3 == 0, F.lower("series_key")).otherwise(F.col("series_key")))
    a = delivery(spark, d, 1).filter("series_key IS NOT NULL")
    return merge.respelled_held(merge.respelled_split(a, b, F.regexp_replace(F.upper("series_key"), "[^A-Z0-9]", ""))).select("n_respelled", "held")


# --- rollups ------------------------------------------------------------------------------------------------------------

_SPLIT_DIMS = ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey")


@query("""WITH n AS (SELECT count(*) AS n FROM lineitem), one AS (SELECT 'l_linenumber' AS d, count(DISTINCT l_linenumber) AS c FROM lineitem UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem),
  p AS (SELECT 'l_linestatus+l_returnflag' AS dims, 0 AS prefix, l_linestatus || '~' || l_returnflag AS part FROM lineitem UNION ALL SELECT 'l_linestatus+l_linenumber', 0, l_linestatus || '~' || CAST(l_linenumber AS VARCHAR) FROM lineitem UNION ALL SELECT 'l_returnflag+l_linenumber', 0, l_returnflag || '~' || CAST(l_linenumber AS VARCHAR) FROM lineitem),
  g AS (SELECT dims, prefix, count(*) AS n_parts, max(c) AS largest FROM (SELECT dims, prefix, part, count(*) AS c FROM p GROUP BY ALL) GROUP BY ALL)
  SELECT dims, prefix, n_parts, largest FROM g, n WHERE largest <= n // 8 ORDER BY n_parts LIMIT 1""")
def split_pairs(spark, d):
    """No single dimension splits the order lines finely enough, nor a prefix; a pair does."""
    t = table(spark, d, "lineitem")
    return rollups.split_plan(t, ["l_returnflag", "l_linestatus", "l_linenumber"], t.count() // 8)


@query("""WITH k AS (SELECT 'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS p FROM lineitem), c AS (SELECT 6 AS prefix, substr(p, 1, 6) AS part, count(*) AS n FROM k GROUP BY ALL)
  SELECT 'code' AS dims, prefix, count(*) AS n_parts, max(n) AS largest FROM c GROUP BY prefix HAVING count(*) BETWEEN 2 AND 2000 AND max(n) <= (SELECT count(*) FROM lineitem)""")
def split_prefix(spark, d):
    """Codes too many to split by are cut to a prefix that leaves more than one part."""
    t = table(spark, d, "lineitem").select(F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("code"), F.lit("x").alias("same"))
    wide = t.withColumn("code", F.concat("code", F.lit("-"), F.monotonically_increasing_id().cast("string")))
    return rollups.split_plan(wide, ["code", "same"], wide.count())


@query("SELECT * FROM (VALUES (0)) v(n_plans)")
def split_refused(spark, d):
    """A flow that nothing splits finely enough is refused: no plan."""
    return rollups.split_plan(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], 1).agg(F.count(F.lit(1)).cast("int").alias("n_plans"))


@query("SELECT CASE WHEN n_regionkey < 3 THEN CAST(2020 + n_regionkey AS VARCHAR) END AS vintage, count(*) AS n_series FROM nation GROUP BY 1")
def vintage_profile(spark, d):
    year = F.concat((2020 + F.col("n_regionkey")).cast("string"), F.lit("-DEP-"))
    n = table(spark, d, "nation").select(F.concat(F.lit("FREQ=A:GEO="), F.when(F.col("n_regionkey") < 3, year).otherwise("DEP-"), "n_name", F.lit(":SEX=T")).alias("series_key"))
    return rollups.vintage_profile(n)


@query(f"SELECT series_key, max(c) AS cursor FROM (SELECT series_key, strftime(obs_date, '%Y-%m-%d') AS c FROM {delivery_sql(1)} UNION ALL SELECT series_key, strftime(obs_date, '%Y-%m-%d') FROM {delivery_sql(2)}) WHERE series_key IS NOT NULL AND c IS NOT NULL GROUP BY 1 ORDER BY cursor DESC, encode(series_key) LIMIT 300")
def cursor_map(spark, d):
    """The cursors of two deliveries, the later of each series; of them the latest 300, as the map is kept."""
    return update.merge_cursors(update.cursors(delivery(spark, d, 1)), update.cursors(delivery(spark, d, 2)), 300)


# --- time ---------------------------------------------------------------------------------------------------------------


@query(f"""WITH o AS (SELECT series_key, obs_date, row_no, obs_date - 6 AS s, obs_date + 1 AS e FROM {LINE_OBS}), r AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS s, max(round(o_totalprice * 100)::BIGINT) AS v FROM orders GROUP BY 1)
  SELECT series_key, obs_date, row_no, r.v AS period_value FROM o LEFT JOIN r ON r.s <= o.s AND o.e <= CAST(r.s + INTERVAL 1 MONTH AS DATE)""")
def containing_period(spark, d):
    """Weeks beside months that run from the 15th to the 14th: a week that crosses the border has no value."""
    right = table(spark, d, "orders").select(F.date_add(F.to_date(F.date_trunc("month", "o_orderdate")), 14).alias("obs_date"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("value"))
    return timejoin.containing_period(line_obs(spark, d).drop("value"), right, left_grain="weekly", left_stamp="end", right_grain="monthly", right_stamp="start")


@query("WITH r AS (SELECT name, row_number() OVER (ORDER BY name) AS i FROM (SELECT DISTINCT 's' || CAST(user_id % 17 AS VARCHAR) AS name FROM events)) SELECT name, row_number() OVER (ORDER BY (i - 1 - 19754 % n + n) % n) AS place FROM r, (SELECT count(*) AS n FROM r)")
def daily_ring(spark, d):
    e = table(spark, d, "events").select(F.concat(F.lit("s"), (F.col("user_id") % 17).cast("string")).alias("name")).distinct()
    return fresh.daily_ring(e, "name", 19754)


_LEASES = "(SELECT 'k' || CAST(event_id AS VARCHAR) AS key, 'o' || CAST(user_id % 5 AS VARCHAR) AS owner, ts AS expires FROM events WHERE event_id % 3 <> 0)"


@query(f"""WITH a AS (SELECT 'k' || CAST(event_id AS VARCHAR) AS key, 'o' || CAST(event_id % 5 AS VARCHAR) AS owner FROM events WHERE event_id % 2 = 0), j AS (SELECT coalesce(l.key, a.key) AS key, l.owner AS held, l.expires, a.owner AS want FROM {_LEASES} l FULL JOIN a ON l.key = a.key),
  w AS (SELECT *, coalesce(want IS NOT NULL AND (held IS NULL OR expires < TIMESTAMP '2024-01-15' OR held = want), false) AS claimed FROM j)
  SELECT key, CASE WHEN claimed THEN want ELSE held END AS owner, CASE WHEN claimed THEN TIMESTAMP '2024-01-15 01:00:00' ELSE expires END AS expires, claimed FROM w""")
def lease_claims(spark, d):
    """Events as leases; every second key is asked for on 15 January."""
    e = table(spark, d, "events")
    key, owner = F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("key"), lambda c: F.concat(F.lit("o"), (F.col(c) % 5).cast("string")).alias("owner")
    held = e.filter("event_id % 3 <> 0").select(key, owner("user_id"), F.col("ts").cast("timestamp").alias("expires"))
    out = fresh.claim_leases(held, e.filter("event_id % 2 = 0").select(key, owner("event_id")), F.lit("2024-01-15").cast("timestamp"))
    return out.withColumn("expires", F.col("expires").cast("timestamp_ntz"))


# --- catalogue ----------------------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT series_id, title FROM series WHERE list_has_all({_TOK}, ['hotel', 'average'])")
def catalog_index_search(spark, d):
    """The written index, joined back to the catalogue."""
    s = table(spark, d, "series")
    path = scratch(spark, "index")
    catalogue.inverted_index(s).repartitionByRange("term").sortWithinPartitions("term").write.parquet(path)
    return catalogue.match_index(spark.read.parquet(path), s, "Hotel average").select("series_id", "title").distinct()


_FLAT = "' ' || array_to_string(list_filter(regexp_split_to_array(lower(coalesce(title, '') || ' ' || coalesce(geography, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''), ' ') || ' '"


@query(f"SELECT DISTINCT series_id, title FROM series WHERE contains({_FLAT}, ' monthly average ') AND contains({_FLAT}, ' hotel ')")
def catalog_phrases(spark, d):
    return catalogue.match_phrases(table(spark, d, "series"), 'hotel "monthly average"').select("series_id", "title").distinct()


@query("SELECT * FROM (VALUES ('lantern_so', 'source'), ('lantern_so:', 'id'), ('hotel average', 'terms'), ('hotel \"monthly average\"', 'phrases'), ('job vaca', 'prefix'), ('zzzz qqqq', 'none')) v(q, stage)")
def catalog_ladder(spark, d):
    """Which stage of the ladder answers each query."""
    s = table(spark, d, "series")
    asked = ["lantern_so", "lantern_so:", "hotel average", 'hotel "monthly average"', "job vaca", "zzzz qqqq"]
    return spark.createDataFrame([(q, catalogue.search(s, q)[1]) for q in asked], "q string, stage string")


@query("""WITH h AS (SELECT DISTINCT series_id, 0 AS shard FROM series WHERE frequency = 'Q' UNION ALL SELECT DISTINCT series_id, 1 FROM series_served WHERE frequency = 'D') SELECT series_id FROM h ORDER BY shard, encode(series_id) LIMIT 120 OFFSET 30""")
def catalog_shards(spark, d):
    """One page over the hits of two catalogues."""
    a, b = (table(spark, d, t).filter(F.col("frequency") == f).select("series_id").distinct() for t, f in (("series", "Q"), ("series_served", "D")))
    return catalogue.merge_shards([a, b], limit=120, offset=30)


@query("SELECT DISTINCT source_id || ':FREQ=M' AS series_key, series_id FROM (SELECT DISTINCT source_id FROM series WHERE source_id IS NOT NULL) k JOIN (SELECT DISTINCT series_id FROM series) i ON i.series_id = k.source_id || ':FREQ=M' OR starts_with(i.series_id, k.source_id || ':FREQ=M:') OR starts_with(i.series_id, k.source_id || ':FREQ=M.')")
def catalogue_expansion(spark, d):
    """A flow that changed: all catalogued series of it, over all sources."""
    s = table(spark, d, "series")
    changed = s.filter("source_id IS NOT NULL").select(F.concat("source_id", F.lit(":FREQ=M")).alias("series_key")).distinct()
    return catalogue.catalogue_expansions(changed, s)


@query("""WITH a AS (SELECT source_id, count(DISTINCT series_key) AS x, count(DISTINCT CAST(snapshot_no AS VARCHAR) || ':' || series_key) AS y FROM obs_snapshots WHERE series_key IS NOT NULL GROUP BY 1), b AS (SELECT source_id, count(DISTINCT series_id) AS c FROM series WHERE series_id IS NOT NULL GROUP BY 1),
  j AS (SELECT coalesce(a.source_id, b.source_id) AS source_id, coalesce(x, 0) AS x, y, coalesce(c, 0) AS c FROM a FULL JOIN b ON a.source_id IS NOT DISTINCT FROM b.source_id), q AS (SELECT *, coalesce(x < c AND abs(y - c) < abs(x - c), false) AS qualified FROM j), n AS (SELECT source_id, c, qualified, CASE WHEN qualified THEN y ELSE x END AS n FROM q)
  SELECT source_id, n AS n_store, c AS n_catalogue, qualified, CASE WHEN n = c THEN 'MATCH' WHEN n = 0 THEN 'MISSING' WHEN c = 0 THEN 'ORPHAN' WHEN source_id LIKE '%so' THEN 'GRAIN' ELSE 'DRIFT' END AS verdict FROM n""")
def grain_audit_qualified(spark, d):
    """Counted again by shard where the bare keys are too few; some sources are catalogued at another grain on purpose."""
    o = table(spark, d, "obs_snapshots")
    grains = table(spark, d, "series").filter("source_id LIKE '%so'").select("source_id", F.lit("flow").alias("grain")).distinct()
    return catalogue.grain_audit(o, table(spark, d, "series"), shard="snapshot_no", declared=grains)


# --- fetching through rules ---------------------------------------------------------------------------------------------


@query(f"""SELECT 'line:' || series_key AS series_id, 'line' AS source, obs_date, value FROM {LINE_OBS} WHERE split_part(series_key, ':', 2) = 'A' UNION ALL SELECT 'dot:' || replace(series_key, ':', '.'), 'dot', obs_date, value FROM {LINE_OBS} WHERE starts_with(series_key, 'LI:R:F:')
  UNION ALL SELECT 'range:' || series_key, 'range', obs_date, value FROM {LINE_OBS} WHERE starts_with(series_key, 'LI:N:O:1') UNION ALL SELECT 'totals', 'flat', obs_date, value FROM {LINE_OBS} WHERE series_key = 'LI:A:F:7'""")
def fetch_by_rules(spark, d):
    """Series found by the general rule, by a dot grain, by an id range and by a file whose name is the id."""
    root = scratch(spark, "rules")
    o = line_obs(spark, d).drop("row_no")
    o.write.parquet(f"{root}/line.parquet")
    o.withColumn("series_key", F.replace("series_key", F.lit(":"), F.lit("."))).write.parquet(f"{root}/dot.parquet")
    o.filter("series_key = 'LI:A:F:7'").drop("series_key").withColumn("k", F.lit("x")).write.parquet(f"{root}/totals.parquet")
    reg = series.Registry(lambda s, n: series.Resolution(f"{root}/{s}.parquet", "series_key", series.grain("series_key", n), native=n))
    reg.rule("dot")(lambda s, n: series.Resolution(f"{root}/dot.parquet", "series_key", series.grain("series_key", n, "."), native=n, separator="."))
    reg.rule("range")(lambda s, n: series.Resolution(f"{root}/line.parquet", "series_key", series.id_range("series_key", n)))
    reg.rule("flat")(lambda s, n: series.Resolution(f"{root}/{n}.parquet", "k", stamp=n))
    lib = Library(spark, root, table(spark, d, "series"), table(spark, d, "source_list"), table(spark, d, "license"), reg)
    return lib.fetch_ids(["line:LI:A", "dot:LI.R.F", "range:LI:N:O:1", "flat:totals"])[0]


@query(f"SELECT series_id, 'lantern_so' AS source, obs_date, value FROM (SELECT 'lantern_so:' || series_key AS series_id, obs_date, value FROM (SELECT DISTINCT substr(series_id, 12) AS series_key, DATE '2020-01-01' AS obs_date, length(series_id)::DOUBLE AS value FROM series WHERE starts_with(series_id, 'lantern_so:'))) WHERE series_id IN (SELECT series_id FROM ({{gate}}) WHERE gate = 'open') AND series_id IN (SELECT series_id FROM series WHERE frequency = 'M')")
def fetch_provider(spark, d):
    """All monthly series of a provider that are open, by one join of its store with their ids."""
    s = table(spark, d, "series")
    root = scratch(spark, "provider")
    store = s.filter("startswith(series_id, 'lantern_so:')").select(F.expr("substr(series_id, 12)").alias("series_key"), F.lit("2020-01-01").cast("date").alias("obs_date"), F.char_length("series_id").cast("double").alias("value")).distinct()
    store.write.parquet(f"{root}/lantern_so.parquet")
    return Library(spark, root, s, table(spark, d, "source_list"), table(spark, d, "license")).fetch("lantern_so", frequency=["M"]).frame


from .reference import ORACLE as _R  # noqa: E402

ORACLE["fetch_provider"] = ORACLE["fetch_provider"].replace("{gate}", _R["license_gate"])


@query("SELECT * FROM (VALUES ('unknown filter', 'UnsupportedFilter'), ('language', 'UnsupportedFilter'), ('mixed grain', 'GrainRefusal'), ('stamp without span', 'GrainRefusal'), ('finer side', 'GrainRefusal'), ('unknown label', 'UnsupportedFilter'), ('no native key', 'NotFound'), ('served twice', 'SchemaRefusal')) v(\"case\", refused)")
def refusals(spark, d):
    """What is refused instead of being ignored."""
    s, o = table(spark, d, "series"), line_obs(spark, d)
    day = F.col("obs_date")
    cases: dict[str, Callable] = {
        "unknown filter": lambda: series.mask(s, "lantern_so", colour=["red"]), "language": lambda: catalogue.localised_title("xx"), "mixed grain": lambda: timejoin.span(day, "mixed", "start"), "stamp without span": lambda: timejoin.span(day, "monthly", "date"),
        "finer side": lambda: timejoin.same_period(o, o, left_grain="monthly", left_stamp="start", right_grain="daily", right_stamp="date"),
        "unknown label": lambda: catalogue.label_join(s.select(F.lit("nowhere").alias("source_id")), table(spark, d, "source_list"), "source_id", "name"),
        "no native key": lambda: series.Registry(lambda a, b: None).resolve("nothing"), "served twice": lambda: merge.keep_served(o.unionByName(o), o),
    }
    out = []
    for name, f in cases.items():
        try:
            f()
            out.append((name, "none"))
        except LongtideError as e:
            out.append((name, type(e).__name__))
    return spark.createDataFrame(out, "case string, refused string")


@query(nan_apart_sql(f"SELECT coalesce(o.series_key, n.series_key) AS series_key, CASE WHEN n.x = 1 THEN n.value ELSE o.value END AS value FROM (SELECT *, 1 AS x FROM {stored_sql(3)}) o FULL JOIN (SELECT *, 1 AS x FROM {stored_sql(4)}) n ON o.series_key IS NOT DISTINCT FROM n.series_key AND o.obs_date IS NOT DISTINCT FROM n.obs_date"))
def keep_served_later(spark, d):
    return nan_apart(merge.keep_served(stored(spark, d, 3), stored(spark, d, 4)).select("series_key", "value"))


# --- further sources ----------------------------------------------------------------------------------------------------


@query("SELECT 'nation.txt' AS member, CAST(n_nationkey AS INTEGER) AS line, n_name AS value FROM nation UNION ALL SELECT 'region.txt', CAST(r_regionkey AS INTEGER), r_name FROM region")
def source_tar(spark, d):
    """The members of a compressed archive, line by line."""
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w:gz") as t:
        for name, key, text in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name")):
            body = "\n".join(r[0] for r in table(spark, d, name).orderBy(key).select(text).collect()).encode()  # as many rows at every scale
            info = tarfile.TarInfo(f"{name}.txt")
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    path = scratch(spark, "tar") + "/n.tgz"
    put_bytes(spark, path, packed.getvalue())
    return formats.read_tar_members(spark, path, ".txt").select("member", "line", "value")


@query("SELECT CAST(n_nationkey AS INTEGER) AS column, r_name || ' / ' || n_name AS head FROM nation JOIN region ON n_regionkey = r_regionkey")
def source_merged_heads(spark, d):
    """A sheet with two head rows, the upper of merged cells: regions over nations."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").select("r_name", "n_name").collect()  # as many at every scale
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    name = lambda i: chr(65 + i)
    cell = lambda i, r, v: f'<c r="{name(i)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    upper = "".join(cell(i, 1, r[0]) for i, r in enumerate(rows) if i == 0 or rows[i - 1][0] != r[0])
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1">{upper}</row><row r="2">{"".join(cell(i, 2, r[1]) for i, r in enumerate(rows))}</row></sheetData></worksheet>')
    path = scratch(spark, "heads") + "/h.xlsx"
    put_bytes(spark, path, packed.getvalue())
    return formats.forward_filled(formats.read_xlsx_rows(spark, path), 2).select("column", "head")
