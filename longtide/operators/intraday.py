"""Intraday measures per ticker and trading day, from one-minute bars (ticker, ts, open, high, low, close, volume).

Definitions are those of the published papers. Windows never span more than a day of one ticker, or the days of one
ticker, so no partition holds more than a session's bars."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THETA = math.pi**2 / 4 + math.pi - 5
#: E|Z|^(4/3) ** -3 of the tri-power quarticity.
MU43 = 2 ** (2 / 3) * math.gamma(7 / 6) / math.gamma(0.5)
SESSION_BARS = 390


def minute_bars(trades: DataFrame, ticker: str, ts: str, price: str, volume: Column) -> DataFrame:
    """Bars of one minute with at least one trade."""
    t = trades.select(F.col(ticker).alias("ticker"), F.date_trunc("minute", ts).alias("ts"), F.col(ts).alias("__at"), F.col(price).alias("__p"), volume.alias("__v"))
    return t.groupBy("ticker", "ts").agg(F.min_by("__p", "__at").alias("open"), F.max("__p").alias("high"), F.min("__p").alias("low"), F.max_by("__p", "__at").alias("close"), F.sum("__v").alias("volume"))


def _sampled(bars: DataFrame, minutes: int) -> DataFrame:
    """Log returns between the last closes of consecutive occupied buckets of a day: ``ticker``, ``day``, ``i``, ``r``."""
    b = bars.filter(F.col("close") > 0)
    if minutes > 1:
        bucket = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (60 * minutes))
        b = b.groupBy("ticker", F.to_date("ts").alias("day"), bucket.alias("i")).agg(F.max_by("close", "ts").alias("close"))
    else:
        b = b.select("ticker", F.to_date("ts").alias("day"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("i"), "close")
    w = Window.partitionBy("ticker", "day").orderBy("i")
    return b.select("ticker", "day", "i", F.log(F.col("close") / F.lag("close").over(w)).alias("r")).filter("r IS NOT NULL")


def return_measures(bars: DataFrame) -> DataFrame:
    """``rv5``, ``rv1``, ``bv5``, ``bns_z``, ``jump_1``, ``jump_5``, ``roll_bp``, ``ac1``, ``vr5``, ``vr10``, ``ret_std``."""
    w = Window.partitionBy("ticker", "day").orderBy("i")
    one = _sampled(bars, 1).withColumn("p", F.lag("r").over(w))
    five = _sampled(bars, 5).withColumn("p", F.lag("r").over(w)).withColumn("pp", F.lag("r", 2).over(w))
    a1 = one.groupBy("ticker", "day").agg(F.sum(F.col("r") ** 2).alias("rv1"), F.covar_samp("r", "p").alias("cov"), F.corr("r", "p").alias("ac1"), F.var_samp("r").alias("v1"), F.stddev_samp("r").alias("ret_std"))
    tri = lambda c: F.pow(F.abs(c), F.lit(4 / 3))
    a5 = five.groupBy("ticker", "day").agg(
        F.sum(F.col("r") ** 2).alias("rv5"), (F.lit(math.pi / 2) * F.sum(F.abs("r") * F.abs("p"))).alias("bv5"), F.count(F.lit(1)).alias("m"),
        F.sum(tri("r") * tri("p") * tri("pp")).alias("q"), F.var_samp("r").alias("v5"))
    a10 = _sampled(bars, 10).groupBy("ticker", "day").agg(F.var_samp("r").alias("v10"))
    j = a1.join(a5, ["ticker", "day"], "left").join(a10, ["ticker", "day"], "left")
    tq = F.col("m") * F.lit(MU43**-3) * F.col("q")
    z = F.sqrt("m") * (1 - F.try_divide(F.col("bv5"), F.col("rv5"))) / F.sqrt(F.lit(THETA) * F.greatest(F.lit(1.0), F.try_divide(tq, F.col("bv5") ** 2)))
    return j.select(
        "ticker", "day", "rv5", "rv1", "bv5", z.alias("bns_z"), (z > 2.326).cast("int").alias("jump_1"), (z > 1.645).cast("int").alias("jump_5"), F.when(F.col("cov") < 0, 2 * F.sqrt(-F.col("cov")) * 10_000).alias("roll_bp"), "ac1",
        F.try_divide(F.col("v5"), 5 * F.col("v1")).alias("vr5"), F.try_divide(F.col("v10"), 10 * F.col("v1")).alias("vr10"), "ret_std")


def day_measures(bars: DataFrame, session_bars: int = SESSION_BARS) -> DataFrame:
    """``parkinson``, ``rogers_satchell``, ``corwin_schultz``, ``amihud``, ``dollar_volume``, ``share_volume``, ``traded_bars``,
    ``gap_rate``, ``longest_gap``, ``open_close``, ``overnight``, ``high_low``."""
    w = Window.partitionBy("ticker", "day").orderBy("ts")
    b = bars.filter((F.col("low") > 0) & (F.col("open") > 0) & (F.col("close") > 0)).withColumn("day", F.to_date("ts"))
    b = b.withColumn("gap", (F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lag("ts").over(w).cast("timestamp"))) / 60 - 1)
    d = b.groupBy("ticker", "day").agg(
        F.min_by("open", "ts").alias("o"), F.max("high").alias("h"), F.min("low").alias("l"), F.max_by("close", "ts").alias("c"), F.sum(F.col("close") * F.col("volume")).alias("dollar_volume"), F.sum("volume").alias("share_volume"),
        F.count_if(F.col("volume") > 0).alias("traded_bars"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("longest_gap"))
    days = Window.partitionBy("ticker").orderBy("day")
    hl = F.log(F.col("h") / F.col("l"))
    d = d.withColumn("c0", F.lag("c").over(days)).withColumn("h0", F.lag("h").over(days)).withColumn("l0", F.lag("l").over(days))
    beta = hl**2 + F.log(F.col("h0") / F.col("l0")) ** 2
    gamma = F.log(F.greatest("h", "h0") / F.least("l", "l0")) ** 2
    k = 3 - 2 * math.sqrt(2)
    alpha = (F.sqrt(2 * beta) - F.sqrt(beta)) / k - F.sqrt(gamma / k)
    ln = lambda a, c: F.log(F.col(a) / F.col(c))
    return d.select(
        "ticker", "day", (hl**2 / (4 * math.log(2))).alias("parkinson"), (ln("h", "o") * ln("h", "c") + ln("l", "o") * ln("l", "c")).alias("rogers_satchell"),
        F.when(F.col("h0").isNotNull(), F.greatest(F.lit(0.0), 2 * (F.exp(alpha) - 1) / (1 + F.exp(alpha)))).alias("corwin_schultz"), F.try_divide(F.abs(ln("c", "c0")), F.col("dollar_volume")).alias("amihud"), "dollar_volume", "share_volume",
        "traded_bars", (1 - F.least(F.col("traded_bars"), F.lit(session_bars)) / session_bars).alias("gap_rate"), "longest_gap", ln("c", "o").alias("open_close"), F.log(F.col("o") / F.col("c0")).alias("overnight"), hl.alias("high_low"))
