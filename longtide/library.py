"""The library's front: find series, fetch them tidy or wide, hand them out, and report on sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import LongtideError, NotFound, UnsupportedFilter
from .operators import catalogue as C
from .operators import delivery, series
from .session import staged
from .sources.stores import read_store


def _any(conds: list) -> Column:
    """The conditions or-ed in pairs, so that the expression is as deep as the logarithm of their number."""
    while len(conds) > 1:
        conds = [conds[i] | conds[i + 1] if i + 1 < len(conds) else conds[i] for i in range(0, len(conds), 2)]
    return conds[0]


class LicenceRefusal(LongtideError):
    """The licence of a series does not allow it to be handed out, or is not known."""


@dataclass
class Fetched:
    """A frame, and the ids that are not in it and why."""

    frame: DataFrame
    unresolved: list[str] = field(default_factory=list)
    closed: list[str] = field(default_factory=list)


class Library:
    """``root``: folder of the stores. ``catalogue``, ``sources``, ``licenses``: the three catalogue tables. ``registry``: the
    rules by which a source's series are found; the general one takes ``<root>/<source>.parquet`` and the native key or
    what it begins."""

    def __init__(self, spark: SparkSession, root: str, catalogue: DataFrame, sources: DataFrame, licenses: DataFrame, registry: series.Registry | None = None, withheld: DataFrame | None = None):
        self.spark, self.root = spark, root
        self.catalogue, self.sources, self.licenses, self.withheld = catalogue, sources, licenses, withheld
        self.registry = registry or series.Registry(lambda s, n: series.Resolution(f"{root}/{s}.parquet", "series_key", series.grain("series_key", n), native=n))

    # --- finding ---

    def search(self, query: str, source: str | None = None, limit: int = C.LIMIT, offset: int = 0) -> DataFrame:
        return C.search(self.catalogue, query, source, limit, offset)[0]

    def get_series(self, series_id: str, lang: str = "en") -> dict:
        return self._one(self.catalogue.withColumn("title", C.localised_title(lang)).filter(F.col("series_id") == series_id), series_id)

    def get_source(self, source_id: str) -> dict:
        return self._one(C.current(self.sources, "source_id").filter(F.col("source_id") == source_id), source_id)

    def get_license(self, license_id: str) -> dict:
        return self._one(C.current(self.licenses, "license_id").filter(F.col("license_id") == license_id), license_id)

    def supported_sources(self) -> list[str]:
        return self.registry.sources()

    def list_sources(self) -> DataFrame:
        return C.sources_nested(self.sources, self.licenses, C.data_through(self.catalogue))

    @staticmethod
    def _one(df: DataFrame, what: str) -> dict:
        row = df.limit(1).collect()
        if not row:
            raise NotFound(what)
        return row[0].asDict()

    # --- fetching ---

    def gates(self) -> DataFrame:
        return series.latest_gate(self.catalogue, self.sources, self.licenses)

    def fetch(self, provider: str, dataset: str | None = None, *, wide: bool = False, **filters) -> Fetched:
        """The tidy rows of all series of a provider (a dataset of it, with these values of frequency, geography, unit,
        category). Closed ids, and those whose licence is unknown, are left out and named. A provider without a rule of its own is read
        by one join of its store with the open ids, however many they are; one with a rule, id by id. One scan per store."""
        ids = series.mask(self.catalogue, provider, dataset, **filters)
        gated = staged(ids.join(self.gates().groupBy("series_id").agg(F.max("gate").alias("gate")), "series_id", "left"), "gated")
        closed = gated.filter(~F.coalesce(F.col("gate") == "open", F.lit(False))).select("series_id")
        open_ids = gated.filter("gate = 'open'").select("series_id")
        one = open_ids.first()
        if one is None or provider in self.registry.rules or self.registry.resolve(one[0]).native is None:
            frame, unresolved = self.fetch_ids([r[0] for r in open_ids.collect()])  # a rule is Python, one call per id
        else:
            frame, unresolved = self._join_ids(provider, open_ids, self.registry.resolve(one[0]))
        if wide:
            frame = series.wide(frame, sorted(r[0] for r in frame.select("series_id").distinct().collect()))  # the columns asked for
        return Fetched(frame, unresolved, sorted(r[0] for r in closed.toLocalIterator()))

    def _join_ids(self, provider: str, ids: DataFrame, r: series.Resolution) -> tuple[DataFrame, list[str]]:
        try:
            store = read_store(self.spark, r.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            empty = self.spark.createDataFrame([], "series_id string, source string, obs_date date, value double")
            return empty, sorted(x[0] for x in ids.toLocalIterator())
        natives = ids.select(F.substring("series_id", len(provider) + 2, 10_000).alias("native"))
        return series.tidy(series.by_grain(store, natives, r.key, r.separator), provider, r.key, r.stamp, r.dedup), []

    def fetch_ids(self, ids: list[str]) -> tuple[DataFrame, list[str]]:
        """Tidy rows of these ids, and the ids of which no store holds any. Ids that are known by their native key are found by one join per
        store; rules of other kinds are or-ed as a balanced tree."""
        by_path: dict[tuple[str, str, str | None, str], list[tuple[str, series.Resolution]]] = {}
        for i in ids:
            r = self.registry.resolve(i)
            by_path.setdefault((r.path, r.key, r.stamp, i.partition(":")[0]), []).append((i, r))
        frame, unresolved = None, []
        for (path, key, stamp, source), group in by_path.items():
            try:
                store = read_store(self.spark, path)
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                unresolved += [i for i, _ in group]
                continue
            if len(group) > 1 and all(r.native is not None and r.separator == group[0][1].separator for _, r in group):
                found = series.by_grain(store, self.spark.createDataFrame([(r.native,) for _, r in group], "native string"), key, group[0][1].separator)
            else:
                found = store.filter(_any([r.predicate if r.predicate is not None else F.lit(True) for _, r in group]))
            part = series.tidy(found, source, key, stamp, group[0][1].dedup)
            frame = part if frame is None else frame.unionByName(part)
        frame = frame if frame is not None else self.spark.createDataFrame([], "series_id string, source string, obs_date date, value double")
        return frame, sorted(unresolved)

    # --- handing out ---

    def series_csv(self, series_id: str, start: str | None = None, end: str | None = None, geo: str | None = None, **other) -> tuple[list[str], DataFrame]:
        """Head lines and CSV lines of one series, by the order of refusals: licence, not found, unsupported filter, no rows.
        The last head line tells how many rows there are."""
        gate = self.gates().filter(F.col("series_id") == series_id).agg(F.max("gate")).first()[0]
        if gate is not None and gate != "open":
            raise LicenceRefusal(series_id)
        if gate is None or (self.withheld is not None and not self.withheld.filter(F.col("series_id") == series_id).isEmpty()):
            raise NotFound(series_id)
        if other:
            raise UnsupportedFilter(", ".join(other))
        frame, missing = self.fetch_ids([series_id])
        if geo is not None:
            frame = series.geo_projection(frame, geo, "series_id")
        frame = series.date_window(frame, start, end)
        n = frame.count()
        if missing or not n:
            raise NotFound(f"{series_id} has no rows")
        src = self.get_source(series_id.split(":")[0])
        return [f"# series: {series_id}", f"# source: {src['name']}", f"{delivery.COMPLETE}{n}"], delivery.csv_text(frame.drop("source")).orderBy("series_id", "obs_date")

    def bundle(self, ids: list[str], path: str, snapshot: str | None = None) -> dict:
        """Open, known ids as native files with a manifest; the reasons of the others stand in it."""
        asked = self.spark.createDataFrame([(i,) for i in ids], "series_id string")
        held = self.withheld if self.withheld is not None else asked.limit(0)
        why = C.bundle_reasons(asked, self.catalogue, self.gates(), held, self.catalogue.select("series_id")).collect()
        frame, missing = self.fetch_ids([r["series_id"] for r in why if r["reason"] == "ok"])
        return delivery.write_bundle(self.spark, frame, path, [r["series_id"] for r in why if r["reason"] != "ok"] + missing, snapshot)

    def pull(self, path: str) -> DataFrame:
        return delivery.pull_bundle(self.spark, path)
