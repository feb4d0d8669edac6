"""Queries of the general training-data problems (1, 3, 4, 5) over the whole tables of a data folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import as_known
from ..operators.copies import catalogue_row_hash, group_differences, keyed_differences, same_json
from ..operators.orphans import Reference, orphan_report, orphans
from ..operators.snapshots import observation_changes
from ..session import table
from .views import _DAY, nan_apart, nan_apart_sql

#: The twelve string columns of a catalogue row, in the order in which they are hashed.
CATALOGUE = ["series_id", "source_id", "title", "frequency", "unit", "geography", "category", "license_id", "start_date", "end_date", "last_updated", "metadata"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return as_known(table(spark, d, "asof_reads"), table(spark, d, "facts"))


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """The figure that each read got."""
    return nan_apart(as_known(table(spark, d, "asof_reads"), table(spark, d, "facts"), event_columns=["read_id", "metric", "reader"], fact_columns=["fact_id", "value", "vintage_date"]))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return observation_changes(table(spark, d, "obs_snapshots"))


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many observations each delivery added, removed and changed."""
    return p3_found(spark, d).groupBy("snapshot_no", "change").agg(F.count(F.lit(1)).alias("n_cases"))


def _references(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, str, list[Reference]]]:
    sources, licenses = table(spark, d, "source_list"), table(spark, d, "license")
    to_source = lambda day: Reference("source_id", ["source_id"], sources, ["source_id"], day, "added_on", "removed_on")
    to_license = lambda day: Reference("license_id", ["license_id"], licenses, ["license_id"], day, "added_on", "removed_on")
    return {
        "series": (table(spark, d, "series"), "series_id", [to_source("catalogued_on"), to_license("catalogued_on")]),
        "source_list": (sources, "source_id", [to_license("added_on")]),
    }


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, (child, key, refs) in _references(spark, d).items():
        for r in refs:
            part = orphans(child, r, [key]).select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), F.lit(r.field).alias("ref_field"))
            out = part if out is None else out.unionByName(part)
    return out.distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, field and month; exact duplicates of a row count once."""
    out = None
    for name, (child, _, refs) in _references(spark, d).items():
        part = orphan_report(child.distinct(), refs, name)
        out = part if out is None else out.unionByName(part)
    return out


def _pairs(spark: SparkSession, d: str, match: str) -> DataFrame:
    child = table(spark, d, "series").select("series_id", "source_id", "license_id").distinct()
    ref = Reference("source_id,license_id", ["source_id", "license_id"], table(spark, d, "source_list"), ["source_id", "license_id"], match=match)
    return orphans(child, ref, ["series_id"]).select(F.lit(match).alias("match"), F.col("series_id").alias("row_key"))


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A composite reference, partly null: series whose publisher and licence together are no row of ``source_list``, under each of the
    declared semantics. All four null masks occur."""
    return _pairs(spark, d, "simple").unionByName(_pairs(spark, d, "full")).unionByName(_pairs(spark, d, "partial"))


def p4_salted(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows that the manifest of what was sent lacks: a parent that is never broadcast, joined with hot keys spread over salts."""
    child = table(spark, d, "series_served").select("series_id", "source_id").distinct()
    ref = Reference("series_id", ["series_id"], table(spark, d, "sent"), ["series_id"])
    return orphans(child, ref, ["series_id", "source_id"], broadcast_rows=0)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    series, served, sent = (table(spark, d, t) for t in ("series", "series_served", "sent"))
    plain = {c: (F.col(c), F.col(c)) for c in CATALOGUE[1:-1]} | {"metadata": (same_json(F.col("metadata")), same_json(F.col("metadata")))}
    a = keyed_differences(series, served, "series_id", plain).select(F.lit("series_served").alias("compared"), "row_key", "field")
    b = keyed_differences(series, sent, "series_id", {"row_hash": (catalogue_row_hash(CATALOGUE), F.col("row_hash"))}).select(F.lit("sent").alias("compared"), "row_key", "field")
    facts, mirror = (table(spark, d, t).filter(F.col("metric").isNotNull()) for t in ("facts", "facts_mirror"))
    groups = group_differences(facts, mirror, ["metric", "obs_date", "vintage_date"], "value")
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    c = groups.select(F.lit("facts_mirror").alias("compared"), F.concat("metric", F.lit("|"), day("obs_date"), F.lit("|"), day("vintage_date")).alias("row_key"), "field")
    return a.unionByName(b).unionByName(c)


def p5_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of each copy differ, by field."""
    return p5_found(spark, d).groupBy("compared", "field").agg(F.count(F.lit(1)).alias("n_cases"))


QUERIES = {"p1_found": p1_found, "p1_values": p1_values, "p3_found": p3_found, "p3_summary": p3_summary, "p4_found": p4_found, "p4_report": p4_report, "p4_pairs": p4_pairs, "p4_salted": p4_salted, "p5_found": p5_found, "p5_summary": p5_summary}

_KNOWN = """
  SELECT * FROM (
    SELECT r.read_id, r.metric, r.reader, f.fact_id, f.value, f.vintage_date,
           row_number() OVER (PARTITION BY r.read_id, r.metric, r.obs_date, r.read_at, r.reader ORDER BY f.vintage_date DESC, f.fact_id DESC) AS rn
    FROM asof_reads r JOIN facts f ON r.metric = f.metric AND r.obs_date = f.obs_date AND f.vintage_date < CAST(r.read_at AT TIME ZONE 'UTC' AS DATE)
  ) WHERE rn = 1"""

_CHANGES = f"""
  WITH t AS MATERIALIZED (SELECT obs_date, {_DAY} AS d FROM (SELECT DISTINCT obs_date FROM obs_snapshots)),
  b AS MATERIALIZED (SELECT snapshot_no, series_key, d, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM (
    SELECT o.snapshot_no, o.series_key, t.d, o.value, row_number() OVER (PARTITION BY o.snapshot_no, o.series_key, t.d ORDER BY o.row_no DESC) AS rn
    FROM obs_snapshots o JOIN t ON o.obs_date = t.obs_date WHERE o.series_key IS NOT NULL AND t.d IS NOT NULL) WHERE rn = 1),
  w AS (SELECT *, lag(snapshot_no) OVER x AS before, lag(value) OVER x AS was, lead(snapshot_no) OVER x AS after FROM b WINDOW x AS (PARTITION BY series_key, d ORDER BY snapshot_no)),
  e AS (SELECT snapshot_no, series_key, d, CASE WHEN before = snapshot_no - 1 AND value IS DISTINCT FROM was THEN 'changed' WHEN coalesce(before, 0) < snapshot_no - 1 AND snapshot_no > 1 THEN 'added' END AS change FROM w
    UNION ALL SELECT snapshot_no + 1, series_key, d, 'removed' FROM w WHERE snapshot_no < (SELECT max(snapshot_no) FROM obs_snapshots) AND (after IS NULL OR after > snapshot_no + 1))
  SELECT snapshot_no, series_key, strftime(d, '%Y-%m-%d') AS obs_day, change FROM e WHERE change IS NOT NULL"""

_ORPHANS = """
  WITH refs AS (
    SELECT DISTINCT 'series' AS table_name, series_id AS row_key, 'source_id' AS ref_field, source_id AS k, catalogued_on AS d FROM series
    UNION ALL SELECT DISTINCT 'series', series_id, 'license_id', license_id, catalogued_on FROM series
    UNION ALL SELECT DISTINCT 'source_list', source_id, 'license_id', license_id, added_on FROM source_list),
  held AS (SELECT 'source_id' AS f, source_id AS k, added_on, removed_on FROM source_list UNION ALL SELECT 'license_id', license_id, added_on, removed_on FROM license)
  SELECT table_name, row_key, ref_field, d FROM refs r WHERE k IS NOT NULL AND trim(k) <> '' AND NOT EXISTS (
    SELECT 1 FROM held h WHERE h.f = r.ref_field AND h.k = r.k AND h.added_on <= r.d AND (h.removed_on IS NULL OR r.d < h.removed_on))"""


_BLANK = lambda c: f"CASE WHEN NOT regexp_full_match({c}, '\\s*') THEN {c} END"
_PAIRS = f"""
  WITH c AS (SELECT DISTINCT series_id, {_BLANK('source_id')} AS s, {_BLANK('license_id')} AS l FROM (SELECT DISTINCT series_id, source_id, license_id FROM series)), p AS (SELECT DISTINCT source_id AS s, license_id AS l FROM source_list)
  SELECT 'simple' AS match, series_id AS row_key FROM c WHERE s IS NOT NULL AND l IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.s = c.s AND p.l = c.l)
  UNION ALL SELECT 'full', series_id FROM c WHERE (s IS NULL) <> (l IS NULL) OR s IS NOT NULL AND l IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.s = c.s AND p.l = c.l)
  UNION ALL SELECT 'partial', series_id FROM c WHERE (s IS NOT NULL OR l IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM p WHERE (c.s IS NULL OR p.s = c.s) AND (c.l IS NULL OR p.l = c.l))"""


def _json_sql(x: str) -> str:
    one = lambda o: f"list_transform(list_sort(json_keys({o})), lambda k: k || '=' || coalesce(CASE WHEN json_type({o}, '$.\"' || k || '\"') = 'OBJECT' THEN 'object' ELSE json_extract_string({o}, '$.\"' || k || '\"') END, 'null'))"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN json_valid({x}) AND json_type({x}) = 'OBJECT' THEN {one(x)}::VARCHAR || coalesce({one(f'json_extract({x}, ' + chr(39) + '$.titles' + chr(39) + ')')}::VARCHAR, '') ELSE 'text:' || {x} END"


_HASHED = " || ".join(f"'{c}'::BLOB || '\\x00'::BLOB || coalesce(encode({c}), '\\xFF'::BLOB) || '\\x01'::BLOB" for c in CATALOGUE)
_FIELDS = " UNION ALL ".join(
    f"SELECT 'series_served' AS compared, l.series_id AS row_key, '{c}' AS field FROM l JOIN r ON l.series_id = r.series_id WHERE l.{c} IS DISTINCT FROM r.{c}" for c in CATALOGUE[1:])
_COPIES = f"""
  WITH l AS (SELECT DISTINCT {', '.join(CATALOGUE[:-1])}, {_json_sql('metadata')} AS metadata FROM series),
  r AS (SELECT DISTINCT {', '.join(CATALOGUE[:-1])}, {_json_sql('metadata')} AS metadata FROM series_served),
  h AS (SELECT DISTINCT series_id, sha256({_HASHED}) AS row_hash FROM series),
  fa AS (SELECT metric, obs_date, vintage_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM facts WHERE metric IS NOT NULL),
  fb AS (SELECT metric, obs_date, vintage_date, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM facts_mirror WHERE metric IS NOT NULL),
  g AS (SELECT metric, obs_date, vintage_date, value, sum(a) AS a, sum(b) AS b FROM (SELECT *, 1 AS a, 0 AS b FROM fa UNION ALL SELECT *, 0, 1 FROM fb) GROUP BY ALL),
  k AS (SELECT metric, obs_date, vintage_date, sum(a) AS a, sum(b) AS b, bool_or(a <> b) AS x FROM g GROUP BY ALL)
  {_FIELDS}
  UNION ALL SELECT 'series_served', series_id, 'missing_right' FROM l WHERE series_id NOT IN (SELECT series_id FROM r)
  UNION ALL SELECT 'series_served', series_id, 'missing_left' FROM r WHERE series_id NOT IN (SELECT series_id FROM l)
  UNION ALL SELECT 'sent', h.series_id, 'row_hash' FROM h JOIN sent s ON h.series_id = s.series_id WHERE h.row_hash IS DISTINCT FROM s.row_hash
  UNION ALL SELECT 'sent', series_id, 'missing_right' FROM h WHERE series_id NOT IN (SELECT series_id FROM sent)
  UNION ALL SELECT 'sent', series_id, 'missing_left' FROM sent WHERE series_id NOT IN (SELECT series_id FROM h)
  UNION ALL SELECT 'facts_mirror', metric || '|' || coalesce(strftime(obs_date, '%Y-%m-%d'), '') || '|' || coalesce(strftime(vintage_date, '%Y-%m-%d'), ''),
    CASE WHEN b = 0 THEN 'missing_right' WHEN a = 0 THEN 'missing_left' ELSE 'value' END FROM k WHERE x"""

ORACLE = {
    "p1_found": f"SELECT read_id, fact_id FROM ({_KNOWN})",
    "p1_values": nan_apart_sql(f"SELECT read_id, metric, reader, fact_id, value, vintage_date FROM ({_KNOWN})"),
    "p3_found": _CHANGES,
    "p3_summary": f"SELECT snapshot_no, change, count(*) AS n_cases FROM ({_CHANGES}) GROUP BY ALL",
    "p4_found": f"SELECT DISTINCT table_name, row_key, ref_field FROM ({_ORPHANS})",
    "p4_report": f"SELECT table_name, ref_field, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS n_orphans FROM ({_ORPHANS}) GROUP BY ALL",
    "p4_pairs": _PAIRS,
    "p4_salted": "SELECT DISTINCT series_id, source_id FROM series_served s WHERE series_id IS NOT NULL AND trim(series_id) <> '' AND NOT EXISTS (SELECT 1 FROM sent t WHERE t.series_id = s.series_id)",
    "p5_found": _COPIES,
    "p5_summary": f"SELECT compared, field, count(*) AS n_cases FROM ({_COPIES}) GROUP BY ALL",
}
