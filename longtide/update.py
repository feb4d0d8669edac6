"""Updating stores: units with a cadence and a strategy, run in order of cost and need, with their state and run log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import LongtideError
from .operators.freshness import BANDS, CADENCE_DAYS, DUE_SLACK, select_flows
from .operators.merge import merge_and_write

REVISION_DAYS = 45


@dataclass
class Unit:
    """``fetch(since)`` gives new rows; ``vintage()`` a token of what the publisher offers now (None: not known). A source of many flows has
    ``flows()``, which gives its catalogue, the state of its flows and how many one pass may take, and ``fetch_flow(id)``."""

    source_id: str
    unit_id: str
    path: str
    strategy: str
    fetch: Callable[[date | None], DataFrame]
    vintage: Callable[[], str | None] = lambda: None
    cadence: str = "monthly"
    revision_days: int = REVISION_DAYS
    flows: Callable[[], tuple[DataFrame, DataFrame, int]] | None = None
    fetch_flow: Callable[[str], DataFrame] | None = None


@dataclass
class State:
    """What is known of a unit."""

    status: str | None = None
    vintage: str | None = None
    last_success: datetime | None = None
    last_attempt: datetime | None = None
    last_date: date | None = None
    rows: int = 0


@dataclass
class Result:
    status: str
    rows: int = 0
    last_date: date | None = None
    vintage: str | None = None
    changed: DataFrame | None = field(default=None, repr=False)
    error: str | None = None


def _moved(unit: Unit, state: State) -> tuple[bool, str | None]:
    now = unit.vintage()
    return now is None or now != state.vintage, now


def _merge(spark: SparkSession, unit: Unit, rows: DataFrame, mode: str, vintage: str | None) -> Result:
    n, last, changed = merge_and_write(spark, unit.path, rows, mode=mode, report_changed=mode == "merge")
    return Result("ok", n, last, vintage, changed)


def extend_by_date(spark: SparkSession, unit: Unit, state: State) -> Result:
    """Rows since the last date, less a stretch in which revisions may come."""
    since = max(state.last_date - timedelta(days=unit.revision_days), date(1900, 1, 1)) if state.last_date else None
    rows = unit.fetch(since)
    return Result("no_change", state.rows, state.last_date, state.vintage) if rows.isEmpty() else _merge(spark, unit, rows, "merge", None)


def overwrite_if_changed(spark: SparkSession, unit: Unit, state: State) -> Result:
    """The whole table anew when its vintage has moved."""
    moved, now = _moved(unit, state)
    return _merge(spark, unit, unit.fetch(None), "overwrite", now) if moved else Result("no_change", state.rows, state.last_date, now)


def bulk_snapshot_if_changed(spark: SparkSession, unit: Unit, state: State) -> Result:
    """A full delivery, merged so that nothing stored is lost, when its vintage has moved."""
    moved, now = _moved(unit, state)
    return _merge(spark, unit, unit.fetch(None), "merge", now) if moved else Result("no_change", state.rows, state.last_date, now)


def sdmx_delta(spark: SparkSession, unit: Unit, state: State) -> Result:
    """What the publisher changed since the last success."""
    rows = unit.fetch(state.last_success.date() if state.last_success else None)
    return Result("no_change", state.rows, state.last_date, state.vintage) if rows.isEmpty() else _merge(spark, unit, rows, "merge", None)


def manual_vintage(spark: SparkSession, unit: Unit, state: State) -> Result:
    """A release that somebody declares: nothing happens until its token is set and differs."""
    now = unit.vintage()
    return _merge(spark, unit, unit.fetch(None), "merge", now) if now is not None and now != state.vintage else Result("no_change", state.rows, state.last_date, state.vintage)


def giant_changed_units(spark: SparkSession, unit: Unit, state: State) -> Result:
    """A source of thousands of flows. Nothing happens while the token of its catalogue stands still; else the flows that are new, have another
    vintage or have to be done again are selected (``unit.flows``: catalogue, state and cap, see ``operators.freshness.select_flows``), fetched
    and merged flow by flow. ``partial`` if more flows were due than the cap, or one failed; a failed flow does not stop the others."""
    moved, now = _moved(unit, state)
    if not moved or unit.flows is None:
        return Result("no_change", state.rows, state.last_date, state.vintage) if not moved else extend_by_date(spark, unit, state)
    catalogue, flow_state, cap = unit.flows()
    due_flows = select_flows(catalogue, flow_state, ["partial", "failed", "empty"], cap).orderBy("place").collect()  # at most ``cap``
    rows, last, failed, changed = state.rows, state.last_date, 0, None
    for f in due_flows:
        try:
            part = unit.fetch_flow(f["flow_id"])
            if part.isEmpty():
                failed += 1
                continue
            n, at, hit = merge_and_write(spark, f"{unit.path}/{f['flow_id']}", part, report_changed=True)
            rows, last = rows + n, max(x for x in (last, at) if x is not None) if last or at else None
            changed = hit if changed is None else changed.unionByName(hit)
        except LongtideError:
            failed += 1
    if not due_flows:
        return Result("no_change", state.rows, state.last_date, now)
    whole = not failed and not due_flows[0]["capped"]
    return Result("ok" if whole else "partial", rows, last, now if whole else state.vintage, changed)


STRATEGIES = {f.__name__: f for f in (extend_by_date, overwrite_if_changed, bulk_snapshot_if_changed, sdmx_delta, manual_vintage, giant_changed_units)}


def due(unit: Unit, state: State, now: datetime, partial_cap: float = 3.0) -> bool:
    """Is it time? The row-wise twin of ``operators.freshness.is_due``."""
    days = CADENCE_DAYS.get(unit.cadence, 7.0)
    after = lambda d, t: (now - t).total_seconds() >= d * 86_400 * DUE_SLACK
    if state.last_success:
        return after(days, state.last_success)
    if state.status == "partial" and state.last_attempt:
        return after(min(days, partial_cap), state.last_attempt)
    return True


def order(units: list[Unit], states: dict[str, State], costs: dict[str, float], now: datetime) -> list[Unit]:
    """Cheap ones first, within a band the most overdue."""

    def key(u: Unit):
        cost, s = costs.get(u.source_id), states.get(u.unit_id, State())
        band = 0 if cost is None else sum(cost >= b for b in BANDS)
        late = float("-inf") if s.last_success is None else -((now - s.last_success).total_seconds() / 86_400 / CADENCE_DAYS.get(u.cadence, 30.0))
        return band, late, u.unit_id

    return sorted(units, key=key)


def run_once(spark: SparkSession, units: list[Unit], states: dict[str, State], now: datetime, costs: dict[str, float] | None = None, force: bool = False) -> tuple[dict[str, State], DataFrame]:
    """Runs what is due, one unit after the other; one that fails does not stop the others. Returns the new states and the
    log of the pass."""
    log, out = [], dict(states)
    for u in order(units, states, costs or {}, now):
        s = out.get(u.unit_id, State())
        if not force and not due(u, s, now):
            continue
        try:
            r = STRATEGIES[u.strategy](spark, u, s)
        except LongtideError as e:
            r = Result("refused", s.rows, s.last_date, s.vintage, error=f"{type(e).__name__}: {e}")
        except Exception as e:
            r = Result("transient_fail", s.rows, s.last_date, s.vintage, error=str(e)[:500])
        good = r.status in ("ok", "no_change")
        out[u.unit_id] = State(r.status, r.vintage if good else s.vintage, now if good else s.last_success, now, r.last_date, r.rows)
        n_changed = r.changed.count() if r.changed is not None else None
        log.append((len(log) + 1, now, u.source_id, u.unit_id, r.status, r.rows, n_changed, r.error))
    return out, spark.createDataFrame(log, "id bigint, ts timestamp, source_id string, unit_id string, status string, rows bigint, n_changed bigint, note string")


def cursors(df: DataFrame, key: str = "series_key", date_col: str = "obs_date", cap: int | None = None) -> DataFrame:
    """The last date of every series, as text; with ``cap``, those of the latest ``cap`` series, as a cursor map is kept."""
    c = df.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull()).groupBy(key).agg(F.date_format(F.max(date_col), "yyyy-MM-dd").alias("cursor"))
    return c if cap is None else c.orderBy(F.col("cursor").desc(), key).limit(cap)


def merge_cursors(old: DataFrame, new: DataFrame, cap: int | None = None) -> DataFrame:
    """The later cursor of each series."""
    c = old.unionByName(new).groupBy("series_key").agg(F.max("cursor").alias("cursor"))
    return c if cap is None else c.orderBy(F.col("cursor").desc(), "series_key").limit(cap)
