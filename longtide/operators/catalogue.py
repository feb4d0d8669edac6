"""Searching and browsing the catalogue. Results are ordered by id, as nothing here ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import UnsupportedFilter
from .skew import fits_broadcast

# Languages of localised titles.
LANGUAGES = ("en", "ar", "es", "fr", "ru", "zh")
LIMIT, MAX_LIMIT, MAX_OFFSET = 50, 500, 100_000
WORDS = r"[^\p{L}\p{N}]+"


def terms(query: str) -> list[str]:
    """Words of a query, lower case."""
    import regex

    return [w.lower() for w in regex.findall(r"[\p{L}\p{N}]+", query)]


def tokens(*cols: str) -> Column:
    """The different words of text columns, lower case, as an array."""
    text = F.lower(F.replace(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in cols]), F.lit("İ"), F.lit("i")))
    return F.array_distinct(F.filter(F.split(text, WORDS), lambda w: w != ""))


def inverted_index(catalogue: DataFrame, id_col: str = "series_id", cols: tuple[str, ...] = ("title", "geography")) -> DataFrame:
    """``term``, ``id``: one row per word and series, to be written once and looked up by term."""
    return catalogue.select(F.col(id_col).alias("id"), F.explode(tokens(*cols)).alias("term")).distinct()


def match_all(catalogue: DataFrame, query: str, cols: tuple[str, ...] = ("title", "geography")) -> DataFrame:
    """Series that hold every word of the query; none for a query without words."""
    ws = terms(query)
    if not ws:
        return catalogue.limit(0)
    return catalogue.withColumn("__t", tokens(*cols)).filter(F.forall(F.array(*map(F.lit, ws)), lambda w: F.array_contains("__t", w))).drop("__t")


def match_prefix(catalogue: DataFrame, query: str, least: int = 3, cols: tuple[str, ...] = ("title", "geography")) -> DataFrame:
    """All words but the last whole, the last as a beginning of at least ``least`` letters."""
    ws = terms(query)
    if not ws or len(ws[-1]) < least:
        return catalogue.limit(0)
    ok = F.exists("__t", lambda w: w.startswith(ws[-1]))
    for w in ws[:-1]:
        ok = ok & F.array_contains("__t", w)
    return catalogue.withColumn("__t", tokens(*cols)).filter(ok).drop("__t")


def match_like(catalogue: DataFrame, query: str, source: str) -> DataFrame:
    """Within one source: the query stands in the title or id, whatever the case of ASCII letters."""
    q = query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    like = lambda c: F.coalesce(F.col(c).ilike(f"%{q}%"), F.lit(False))
    return catalogue.filter((F.col("source_id") == source) & (like("title") | like("series_id")))


def bare_codes(catalogue: DataFrame, sources: DataFrame, code: str) -> DataFrame:
    """Series named ``source:CODE``, as typed or in capitals, of any served source; an equi-join on the ids so made."""
    forms = F.array_distinct(F.array(F.lit(code), F.lit(code.upper())))
    ids = sources.select(F.explode(F.transform(forms, lambda c: F.concat(F.col("source_id"), F.lit(":"), c))).alias("series_id")).distinct()
    return catalogue.join(ids, "series_id", "left_semi")


def match_index(index: DataFrame, catalogue: DataFrame, query: str) -> DataFrame:
    """Series that hold every word of the query, by a written ``inverted_index``: only the query's words are read from it."""
    ws = sorted(set(terms(query)))
    if not ws:
        return catalogue.limit(0)
    ids = index.filter(F.col("term").isin(ws)).groupBy("id").agg(F.count_distinct("term").alias("__n")).filter(F.col("__n") == len(ws))
    return catalogue.join(ids.select(F.col("id").alias("series_id")), "series_id", "left_semi")


def match_phrases(catalogue: DataFrame, query: str, cols: tuple[str, ...] = ("title", "geography")) -> DataFrame:
    """Series in which the words of each quoted part of the query stand side by side, and its other words anywhere; none for a query
    without quotes."""
    import regex

    quoted = [terms(x) for x in regex.findall(r'"([^"]+)"', query)]
    if not any(quoted):
        return catalogue.limit(0)
    rest = terms(regex.sub(r'"[^"]+"', " ", query))
    text = F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in cols])), WORDS), lambda w: w != ""), " "), F.lit(" "))
    ok = F.lit(True)
    for ws in [*[q for q in quoted if q], *[[w] for w in rest]]:
        ok = ok & F.contains(text, F.lit(f" {' '.join(ws)} "))
    return catalogue.filter(ok)


def merge_shards(shards: list[DataFrame], order: str = "series_id", limit: int = LIMIT, offset: int = 0) -> DataFrame:
    """One page over the hits of several catalogues, those of an earlier one first, each in order. Every shard is cut to the page's
    end before they meet. The limit is the feature."""
    limit, offset = min(max(limit, 1), MAX_LIMIT), min(max(offset, 0), MAX_OFFSET)
    parts = [s.withColumn("__shard", F.lit(i)).orderBy(order).limit(offset + limit) for i, s in enumerate(shards)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("__shard", order).offset(offset).limit(limit).drop("__shard")


def search(catalogue: DataFrame, query: str, source: str | None = None, limit: int = LIMIT, offset: int = 0) -> tuple[DataFrame, str]:
    """The first stage of the ladder with any match, and its name. Within a source: all words, else LIKE. Over all: the name
    of a source, an id prefix, quoted parts as phrases, all words, a bare code, the last word as a prefix; never LIKE."""
    if source is not None:
        scoped = catalogue.filter(F.col("source_id") == source)
        stages = [("terms", match_all(scoped, query)), ("like", match_like(catalogue, query, source))]
    else:
        named = catalogue.filter(F.lower("source_id") == query.lower())
        ids = catalogue.filter(F.col("series_id").startswith(query)) if ":" in query else catalogue.limit(0)
        stages = [("source", named), ("id", ids), ("phrases", match_phrases(catalogue, query)), ("terms", match_all(catalogue, query)), ("code", bare_codes(catalogue, catalogue.select("source_id").distinct(), query)), ("prefix", match_prefix(catalogue, query))]
    for name, df in stages:
        if not df.isEmpty():
            return page(df, "series_id", limit, offset), name
    return page(catalogue.limit(0), "series_id", limit, offset), "none"


def page(df: DataFrame, order: str, limit: int = LIMIT, offset: int = 0) -> DataFrame:
    """One page in order; ``limit`` 1 to 500, ``offset`` up to 100,000. The limit is the feature."""
    return df.orderBy(order).offset(min(max(offset, 0), MAX_OFFSET)).limit(min(max(limit, 1), MAX_LIMIT))


def capped_count(df: DataFrame, cap: int) -> DataFrame:
    """``total``, and whether it is only a lower bound: counting stops behind ``cap``. The cap is the feature."""
    return df.limit(cap + 1).agg(F.count(F.lit(1)).alias("n")).select(F.least("n", F.lit(cap)).alias("total"), (F.col("n") > cap).alias("total_is_lower_bound"))


def localised_title(lang: str, metadata: str = "metadata", title: str = "title") -> Column:
    """The title in a language, else the plain one; an unsupported language is refused."""
    if lang not in LANGUAGES:
        raise UnsupportedFilter(f"language {lang!r}")
    return F.coalesce(F.nullif(F.get_json_object(metadata, f"$.titles.{lang}"), F.lit("")), F.col(title))


def current(df: DataFrame, key: str) -> DataFrame:
    """The entry of each key that still holds (the one added last, if several do)."""
    rest = [c for c in df.columns if c != key]
    return df.filter(F.col("removed_on").isNull()).groupBy(key).agg(F.max(F.struct("added_on", *[c for c in rest if c != "added_on"])).alias("x")).select(key, "x.*")


def sources_nested(sources: DataFrame, licenses: DataFrame, data_through: DataFrame) -> DataFrame:
    """Each current source with its licence and freshness as nested objects."""
    lic = current(licenses, "license_id").select("license_id", F.col("name").alias("license_name"), "reservable", "commercial_ok", "url")
    j = current(sources, "source_id").join(lic, "license_id", "left").join(data_through, "source_id", "left")
    return j.select("source_id", "name", "homepage", F.struct("license_id", F.col("license_name").alias("name"), "reservable", "commercial_ok", "url").alias("license"), F.struct("data_through", "n_series").alias("freshness"))


def data_through(catalogue: DataFrame) -> DataFrame:
    """Per source, the latest end date before the year 2900, and how many series there are."""
    d = F.col("end_date").try_cast("date")
    return catalogue.groupBy("source_id").agg(F.max(F.when(d < F.lit("2900-01-01").cast("date"), d)).alias("data_through"), F.countDistinct("series_id").alias("n_series"))


def carve_outs(catalogue: DataFrame, sources: list[str] = (), prefixes: list[str] = (), ids: DataFrame | None = None) -> DataFrame:
    """The catalogue without listed sources, id prefixes and withheld ids (an anti-join, which nulls do not upset)."""
    out = catalogue.filter(~F.coalesce(F.col("source_id").isin(list(sources)), F.lit(False))) if sources else catalogue
    for p in prefixes:
        out = out.filter(~(F.col("series_id").startswith(p + ":") | (F.col("series_id") == p)))
    return out.join(ids.select("series_id").distinct(), "series_id", "left_anti") if ids is not None else out


def bundle_reasons(asked: DataFrame, catalogue: DataFrame, gates: DataFrame, withheld: DataFrame | None, served: DataFrame) -> DataFrame:
    """Each asked id with its source and the first reason that keeps it out of a bundle: gate, withheld, not_found,
    not_migrated, or none (``ok``). A list of withheld ids that cannot be read (None) closes everything."""
    flag = lambda df, n: df.select("series_id").distinct().withColumn(n, F.lit(True))
    j = asked.select("series_id").distinct().join(catalogue.groupBy("series_id").agg(F.max("source_id").alias("source_id"), F.lit(True).alias("found")), "series_id", "left")
    j = j.join(gates.groupBy("series_id").agg(F.max("gate").alias("gate")), "series_id", "left").join(flag(served, "served"), "series_id", "left")
    j = j.join(flag(withheld, "held"), "series_id", "left") if withheld is not None else j.withColumn("held", F.lit(True))
    reason = F.when(F.col("gate") != "open", "gate").when(F.col("held"), "withheld").when(F.col("found").isNull(), "not_found").when(F.col("served").isNull(), "not_migrated").otherwise("ok")
    return j.select("series_id", "source_id", reason.alias("reason"))


def manifest(reasons: DataFrame) -> DataFrame:
    """The ids as rows, each with how many its source and reason have. The counts are joined on, so that no source is gathered in
    one task."""
    n = reasons.groupBy(F.col("source_id").alias("__s"), F.col("reason").alias("__r")).agg(F.count(F.lit(1)).alias("n_series"))
    n = F.broadcast(n) if fits_broadcast(n) else n
    return reasons.join(n, F.col("source_id").eqNullSafe(F.col("__s")) & (F.col("reason") == F.col("__r"))).select("source_id", "reason", "series_id", "n_series")


def grain_audit(store: DataFrame, catalogue: DataFrame, by: str = "source_id", shard: str | None = None, declared: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Distinct keys of a store against those of the catalogue per source: ``n_store``, ``n_catalogue``, ``verdict`` (MATCH; MISSING: nothing
    stored; ORPHAN: nothing catalogued; DRIFT). ``shard``: a column with which a source's keys are counted again, qualified by it, where
    the bare ones are fewer than the catalogue's; the count that is nearer stands, and ``qualified`` says so. ``declared`` (``by``,
    ``grain``): sources that are catalogued at another grain on purpose (GRAIN instead of DRIFT). ``approximate``: store counts are estimates,
    which may not assert that keys are missing (DRIFT becomes UNSURE where the store has fewer)."""

    def count(df: DataFrame, key: str, name: str) -> DataFrame:
        keys = df.filter(F.col(key).isNotNull())
        if approximate and name != "n_catalogue":
            return keys.groupBy(F.col(by).alias(f"__{name}")).agg(F.approx_count_distinct(key, 0.02).alias(name))
        return keys.select(by, key).distinct().groupBy(F.col(by).alias(f"__{name}")).agg(F.count(F.lit(1)).alias(name))

    j = count(store, "series_key", "n_store").join(count(catalogue, "series_id", "n_catalogue"), F.col("__n_store").eqNullSafe(F.col("__n_catalogue")), "full")
    j = j.select(F.coalesce("__n_store", "__n_catalogue").alias(by), F.coalesce("n_store", F.lit(0)).alias("a"), F.coalesce("n_catalogue", F.lit(0)).alias("b"))
    if shard is not None:
        q = count(store.filter(F.col("series_key").isNotNull()).withColumn("series_key", F.concat_ws(":", shard, "series_key")), "series_key", "n_qualified")
        j = j.join(q, F.col(by).eqNullSafe(F.col("__n_qualified")), "left").drop("__n_qualified")
        nearer = (F.col("a") < F.col("b")) & (F.abs(F.col("n_qualified") - F.col("b")) < F.abs(F.col("a") - F.col("b")))
        j = j.withColumn("qualified", F.coalesce(nearer, F.lit(False))).withColumn("a", F.when(F.col("qualified"), F.col("n_qualified")).otherwise(F.col("a"))).drop("n_qualified")
    j = j.join(declared.select(F.col(by).alias("__by"), "grain"), F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by") if declared is not None else j.withColumn("grain", F.lit(None).cast("string"))
    a, b = F.col("a"), F.col("b")
    verdict = F.when(a == b, "MATCH").when(a == 0, "MISSING").when(b == 0, "ORPHAN").when(F.col("grain").isNotNull(), "GRAIN").when(F.lit(approximate) & (a < b), "UNSURE").otherwise("DRIFT")
    return j.select(by, a.alias("n_store"), b.alias("n_catalogue"), *(["qualified"] if shard is not None else []), verdict.alias("verdict"))


def catalogue_ids(changed: DataFrame, catalogue: DataFrame, source: str, separators: tuple[str, ...] = (":", "."), key: str = "series_key") -> DataFrame:
    """Which catalogue ids changed store keys belong to: the id itself, or an id that the key goes on from after a separator
    (a flow or table of which it is a part). ``series_key``, ``series_id`` (null: no id), ``how`` (exact, grain or none). An
    equi-join on the key's own prefixes, of which there are as many as it has parts; the longest one wins."""
    parts = F.lit(source + ":")
    full = F.concat(parts, F.col(key))
    pattern = "[" + "".join("\\" + x for x in separators) + "]"
    words = F.split(F.col(key), pattern)
    ends = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.char_length(F.array_join(F.slice(words, 1, n), "-")) + len(source) + 1)
    p = changed.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("__p", F.explode(F.transform(ends, lambda e: F.substring(full, F.lit(1), e))))
    ids = catalogue.filter(F.col("source_id") == source).select(F.col("series_id").alias("__p")).distinct().withColumn("series_id", F.col("__p"))
    hit = p.join(ids, "__p", "left").groupBy(key).agg(F.max_by("series_id", F.char_length("series_id")).alias("series_id"))
    how = F.when(F.col("series_id").isNull(), "none").when(F.col("series_id") == full, "exact").otherwise("grain")
    return hit.select(key, "series_id", how.alias("how"))


def catalogue_expansions(changed: DataFrame, catalogue: DataFrame, source: str | None = None, separators: tuple[str, ...] = (":", "."), key: str = "series_key") -> DataFrame:
    """The other direction: all catalogue ids that a changed key (a flow or table) is a part of at its beginning: ``series_key``, ``series_id``; one to
    many. The key itself is among them if it is catalogued. An equi-join on the ids' own prefixes, of which each has as many as parts."""
    pattern = "[" + "".join("\\" + x for x in separators) + "]"
    ids = catalogue.filter(F.col("series_id").isNotNull()) if source is None else catalogue.filter(F.col("source_id") == source)
    words = F.split(F.col("series_id"), pattern)
    ends = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.char_length(F.array_join(F.slice(words, 1, n), "-")))
    own = ids.select("series_id").distinct().withColumn("__p", F.explode(F.transform(ends, lambda e: F.substring(F.col("series_id"), F.lit(1), e))))
    return changed.filter(F.col(key).isNotNull()).select(key).distinct().join(own, F.col(key) == F.col("__p")).select(key, "series_id")


def label_join(measures: DataFrame, labels: DataFrame, code: str, label: str, strict: bool = True) -> DataFrame:
    """Measures with the label of their code (the greatest of several); codes without one are refused if ``strict``."""
    one = labels.groupBy(code).agg(F.max(label).alias(label))
    if strict and (bad := [r[0] for r in measures.select(code).distinct().join(one, code, "left_anti").limit(5).collect()]):
        raise UnsupportedFilter(f"codes without a label: {bad}")
    return measures.join(one, code, "left")
