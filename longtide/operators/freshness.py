"""Run log, cadence and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered

# Days of a cadence.
CADENCE_DAYS = {"daily": 1.0, "weekly": 7.0, "monthly": 30.0, "quarterly": 91.0, "annual": 365.0}
# Cost bands in seconds.
BANDS = (120.0, 600.0, 3600.0)
STALE_DAYS = 730
DUE_SLACK = 0.9


def _us(c: Column | str) -> Column:
    """Microseconds of a timestamp with or without a zone."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def cadence_days(cadence: Column, default: float) -> Column:
    """Days of a cadence; ``default`` for an unknown one."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in CADENCE_DAYS.items() for x in kv])[F.lower(F.trim(cadence))], F.lit(default))


def age_days(stamp: Column, now: Column) -> Column:
    """Days since a stamp; the future counts as now; null for none."""
    return F.when(stamp.isNotNull(), F.greatest(F.lit(0.0), (_us(now) - _us(stamp)) / 86_400e6))


def business_age_days(stamp: Column, now: Column) -> Column:
    """Age without Saturdays and Sundays, the hours of a weekend day that is under way included; to six places."""
    today, first = F.to_date(now), F.to_date(stamp)
    gap = F.greatest(F.datediff(today, first), F.lit(0))
    # whole weekend days in [first, today): full weeks have two, the rest is at most six days long
    weeks, rest = F.floor(gap / 7), gap % 7
    dow = F.weekday(first)  # Monday is 0
    hit = lambda day: F.when((F.lit(day) - dow + 7) % 7 < rest, 1).otherwise(0)
    weekend = weeks * 2 + hit(5) + hit(6)
    part = F.when(F.weekday(now) >= 5, (_us(now) - _us(today.cast("timestamp"))) / 86_400e6).otherwise(0.0)
    return F.when(stamp.isNotNull(), F.round(F.greatest(F.lit(0.0), age_days(stamp, now) - weekend - part), 6))


def is_due(cadence: Column, last_success: Column, status: Column, last_attempt: Column, now: Column, partial_cap: float = 3.0) -> Column:
    """Is it time to run a unit again? Nine tenths of its cadence after its last success; one that never succeeded but whose
    last pass was partial waits for its cadence or ``partial_cap`` days, whichever is less; else at once."""
    days = cadence_days(cadence, 7.0)
    after = lambda d, s: (_us(now) - _us(s)) / 86_400e6 >= d * DUE_SLACK
    return F.when(last_success.isNotNull(), after(days, last_success)).when((status == "partial") & last_attempt.isNotNull(), after(F.least(days, F.lit(partial_cap)), last_attempt)).otherwise(True)


def overdue_key(last: Column, cadence: Column, now: Column) -> Column:
    """Sort key, most overdue first: minus age over cadence; never run is first of all."""
    age = (_us(now) - _us(last)) / 86_400e6
    return F.when(last.isNull(), float("-inf")).otherwise(-(age / cadence_days(cadence, 30.0)))


def turn_order(units: DataFrame, band: Column, key: Column, unit: str = "unit_id") -> DataFrame:
    """Units in the order of their turn: by cost band, then most overdue first, then by name. Adds ``band`` and ``turn``."""
    return numbered(units.withColumn("band", band).withColumn("__k", key), "turn", "band", "__k", unit).drop("__k")


def cost_band(cost: Column) -> Column:
    """Band of a cost: 0 for unknown and cheap ones, up to 3."""
    return F.when(cost.isNull() | (cost < BANDS[0]), 0).when(cost < BANDS[1], 1).when(cost < BANDS[2], 2).otherwise(3)


def run_cost(runs: DataFrame, by: str = "source_id", sample: int = 5) -> DataFrame:
    """What a run costs: the dearest of the last ``sample`` runs that are no window stops, and at least the newest run that got
    somewhere. Bounded per source before anything is gathered (a rank limit, applied before the exchange too)."""
    w = Window.partitionBy(by).orderBy(F.col("id").desc())
    top = runs.filter(F.coalesce(F.col("status"), F.lit("")) != "window_stopped").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= sample).groupBy(by).agg(F.coalesce(F.max("dur_s"), F.lit(0.0)).alias("cost"))
    real = runs.filter(F.col("status").isin("ok", "no_change", "partial", "killed_external")).groupBy(by).agg(F.max_by("dur_s", "id").alias("floor"))
    return top.join(real, by, "left").select(by, F.greatest("cost", "floor").alias("cost_s"))


def failure_streak(runs: DataFrame, by: list[str], fails: list[str], neutral: list[str], least: int = 3, hours: float = 24.0) -> DataFrame:
    """Units that fail again and again: the failures since the last run that neither failed nor is neutral; at least ``least``
    of them over at least ``hours``. ``n_fails``, ``first_fail``, ``last_fail``. One aggregate for the last good run and a join
    on it, so no unit's log is gathered into one task."""
    r = runs.filter(~F.coalesce(F.col("status").isin(neutral), F.lit(False)))
    good = r.filter(~F.coalesce(F.col("status").isin(fails), F.lit(False))).groupBy(*by).agg(F.max(F.struct("ts", "id")).alias("good"))
    bad = r.filter(F.col("status").isin(fails)).join(good, by, "left").filter(F.col("good").isNull() | (F.struct("ts", "id") > F.col("good")))
    s = bad.groupBy(*by).agg(F.count(F.lit(1)).alias("n_fails"), F.min("ts").alias("first_fail"), F.max("ts").alias("last_fail"))
    return s.filter((F.col("n_fails") >= least) & (_us("last_fail") - _us("first_fail") >= F.lit(int(hours * 3_600_000_000))))


def stop_streak(runs: DataFrame, by: list[str]) -> DataFrame:
    """Window stops since a unit's last run of another status: ``n_stops``, ``minutes``."""
    other = F.coalesce(F.col("status"), F.lit("")) != "window_stopped"
    last = runs.groupBy(*by).agg(F.coalesce(F.max(F.when(other, F.col("id"))), F.lit(-1)).alias("__last"))
    j = runs.join(last, by).filter(~other & (F.col("id") > F.col("__last")))
    return j.groupBy(*by).agg(F.count(F.lit(1)).alias("n_stops"), (F.coalesce(F.sum("dur_s"), F.lit(0.0)) / 60).alias("minutes"))


def token_streak(runs: DataFrame, token: Column, by: list[str], blind: list[str]) -> DataFrame:
    """For each token that runs name (``token``: an array per run), in how many of a unit's latest runs on end it stands; runs
    of a ``blind`` status are passed over. ``token``, ``n_runs``."""
    r = runs.filter(~F.coalesce(F.col("status").isin(blind), F.lit(False))).select(*by, "id", token.alias("__t"))
    ranked = r.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("id").desc())))
    e = ranked.select(*by, "rn", F.explode(F.array_distinct("__t")).alias("token"))
    e = e.withColumn("k", F.row_number().over(Window.partitionBy(*by, "token").orderBy("rn")))
    return e.filter("k = rn").groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n_runs"))


def recency(cursors: DataFrame, by: str, date: str, today: Column, claimed: Column | None = None) -> DataFrame:
    """``frontier``: the latest date, projections included. ``newest``: the latest up to today, but null where the frontier lies
    ahead, only a minority of dates is past, and the latest of those is older than two years (dead series beside
    projections), unless ``claimed``."""
    a = cursors.filter(F.col(date).isNotNull()).groupBy(by).agg(F.max(date).alias("frontier"), F.max(F.when(F.col(date) <= today, F.col(date))).alias("seen"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(date) <= today).alias("past"))
    dead = (F.col("frontier") > today) & (F.col("past") * 2 < F.col("n")) & (F.datediff(today, "seen") > STALE_DAYS)
    if claimed is not None:
        dead = dead & ~claimed
    return a.select(by, "frontier", F.when(~F.coalesce(dead, F.lit(False)), F.col("seen")).alias("newest"))


def freshness_label(stored: Column, discontinued: Column, paused: Column, run_by: Column, cadence: Column, newest_success: Column, exempt: Column, now: Column, late_from: list[str], tolerance: float = 2.0) -> Column:
    """The label of a source: a discontinued one keeps its own; then paused; retired if nobody runs it; late if its newest
    success is older than ``tolerance`` cadences and it is not exempt; else what is stored."""
    days = F.create_map(*[F.lit(x) for kv in CADENCE_DAYS.items() for x in kv])[cadence]
    late = stored.isin(late_from) & days.isNotNull() & ((_us(now) - _us(newest_success)) / 86_400e6 > days * tolerance) & ~exempt
    return F.when((stored == "discontinued") | discontinued, stored).when(paused, "paused").when(~run_by, "retired").when(F.coalesce(late, F.lit(False)), "late").otherwise(stored)


def health_verdict(age: Column, sla: Column, data_age: Column, data_sla: Column, ever_run: Column, rotating: Column, pending: Column, warn: Column) -> Column:
    """Verdict of a source by the first rule that holds."""
    return (F.when(~ever_run & pending, "PENDING").when(~ever_run, "RED-UNRUN").when(rotating & (age > sla), "ROTATING").when(age > sla, "RED-SLA").when(data_age > data_sla, "RED-DATA").when(warn, "ATTENTION").otherwise("OK"))


def next_update(last: Column, frequency: Column) -> Column:
    """When the next update may be expected; null for other frequencies."""
    return F.when(frequency == "D", F.date_add(last, 1)).when(frequency == "W", F.date_add(last, 7)).when(frequency == "M", F.date_add(last, 30)).when(frequency == "Q", F.date_add(last, 91)).when(frequency == "A", F.date_add(last, 365))


def retry_wait_hours(fails: Column, base: float = 12.0, cap_days: float = 16.0) -> Column:
    """Hours to wait after a failure: 12, 24, 48 and so on, at most 16 days."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), F.least(fails - 1, F.lit(10))), F.lit(cap_days * 24))


def select_flows(catalogue: DataFrame, state: DataFrame, redo: list[str], cap: int) -> DataFrame:
    """Which flows to fetch: new ones and those with another vintage first, then those to redo, each in catalogue order; the
    first ``cap``. ``flow_id``, ``reason``, ``place``, ``capped`` (more were due). The cap is the feature."""
    st = state.select("flow_id", F.col("vintage").alias("old_vintage"), F.col("status").alias("old_status"), F.lit(True).alias("known"))
    j = catalogue.join(st, "flow_id", "left")
    reason = F.when(F.col("known").isNull(), "new").when(~F.col("vintage").eqNullSafe(F.col("old_vintage")), "changed").when(F.col("old_status").isin(redo), "redo")
    due = j.withColumn("reason", reason).filter(F.col("reason").isNotNull()).withColumn("late", (F.col("reason") == "redo").cast("int"))
    n = due.agg(F.count(F.lit(1)).alias("n_due"))
    top = due.orderBy("late", "position").limit(cap)
    w = Window.orderBy("late", "position")
    return top.withColumn("place", F.row_number().over(w)).crossJoin(F.broadcast(n)).select("flow_id", "reason", "place", (F.col("n_due") > cap).alias("capped"))


def rotate_after(items: DataFrame, name: str, position: str, bookmark: str | None) -> DataFrame:
    """Items begun after the bookmarked one and around to it: ``place``, from 1. Without a bookmark, or with one that no item
    bears, they keep their order. The first of several items of that name counts."""
    at = items.filter(F.col(name) == F.lit(bookmark)).agg(F.min(position).alias("__at"))  # one row
    turn = F.coalesce((F.col(position) <= F.col("__at")).cast("int"), F.lit(0))
    turned = items.crossJoin(F.broadcast(at)).withColumn("__turn", turn).drop("__at")
    return numbered(turned, "place", "__turn", position).drop("__turn")


def daily_ring(items: DataFrame, name: str, day: int, ring: DataFrame | None = None) -> DataFrame:
    """Items in the order of a ring whose pointer moves on by one each day, so that every item leads once per round: ``place``, from 1. ``ring``
    (column ``name``): all that may take part, the items among them; it keeps the order stable when items come and go."""
    members = numbered((items.select(name) if ring is None else items.select(name).unionByName(ring.select(name))).distinct(), "__i", name)
    n = members.agg(F.count(F.lit(1)).alias("__n"))  # one row
    turn = F.pmod(F.col("__i") - 1 - F.pmod(F.lit(day), F.col("__n")), F.col("__n"))
    turned = items.join(members, name).crossJoin(F.broadcast(n)).withColumn("__turn", turn).drop("__i", "__n")
    return numbered(turned, "place", "__turn", name).drop("__turn")


def claim_leases(leases: DataFrame, asked: DataFrame, now: Column, seconds: int = 3600) -> DataFrame:
    """The lease table after claims (``key``, ``owner``): a free, expired or own lease goes to the claimant until ``seconds`` from now, any other
    stays; of several claimants of a key the first by name wins. ``key``, ``owner``, ``expires``, ``claimed``."""
    one = asked.filter(F.col("key").isNotNull() & F.col("owner").isNotNull()).groupBy("key").agg(F.collect_set("owner").alias("who"))
    j = leases.select("key", F.col("owner").alias("held"), "expires").join(one, "key", "full")
    own = F.array_contains("who", F.col("held"))
    wins = F.col("who").isNotNull() & (F.col("held").isNull() | (F.col("expires") < now) | own)
    owner = F.when(wins & own & (F.col("expires") >= now), F.col("held")).when(wins, F.array_min("who")).otherwise(F.col("held"))
    until = F.when(wins, (F.unix_seconds(now) + seconds).cast("timestamp")).otherwise(F.col("expires"))
    return j.select("key", owner.alias("owner"), until.alias("expires"), F.coalesce(wins, F.lit(False)).alias("claimed"))


def retry_order(queue: DataFrame) -> DataFrame:
    """A queue of retries, least tried first, then oldest: adds ``place``."""
    return numbered(queue, "place", "attempts", "enqueued", "id")


def retry_plan(flows: DataFrame, now: Column, slice_size: int) -> DataFrame:
    """What becomes of each flow: ``retry`` (failed, its wait is over, among the ``slice_size`` whose failure is oldest),
    ``waiting`` (past that slice), ``backed_off``, or its own class. ``flow_id``, ``class`` (fresh, redo, failed, too_big),
    ``fails``, ``failed_at``, ``position``. The slice is the feature."""
    due = F.col("failed_at").isNull() | ((_us(now) - _us("failed_at")) / 3600e6 >= retry_wait_hours(F.col("fails")))
    f = flows.withColumn("__due", (F.col("class") == "failed") & due)
    rank = numbered(f.filter("__due"), "__r", F.col("failed_at").asc_nulls_first(), "position").select("flow_id", "__r")
    plan = F.when(F.col("__r") <= slice_size, "retry").when(F.col("__r").isNotNull(), "waiting").when(F.col("class") == "failed", "backed_off").otherwise(F.col("class"))
    return f.join(rank, "flow_id", "left").select("flow_id", plan.alias("plan"))


def footer_class(old_rows: Column, new_rows: Column, old_max: Column, new_max: Column) -> Column:
    """How a copy stands to the store by row count and last date: behind, ahead or same; a mixture is ahead."""
    more, less = (new_rows > old_rows) | (new_max > old_max), (new_rows < old_rows) | (new_max < old_max)
    return F.when(more, "ahead").when(less, "behind").otherwise("same")
