"""Rolling indicators expressed as window columns over (entity, date) bars.

Each function takes bars (entity, date, open, high, low, close, volume) and returns the same rows
with ``idx`` (zero-based bar number) and the indicator columns.  All windows share one
partitioning, so stacking indicators costs one exchange and one sort.  Warm-up rows carry the
neutral values stated per function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import before, position, prev, run_length, series, so_far, trailing


def indexed(bars: DataFrame) -> DataFrame:
    return bars if "idx" in bars.columns else bars.withColumn("idx", position())


def price_source(name: str) -> Column:
    """close, open, high, low, hl2, hlc3 or ohlc4."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return {"open": o, "high": h, "low": l, "close": c, "hl2": (h + l) / 2, "hlc3": (h + l + c) / 3,
            "ohlc4": (o + h + l + c) / 4}[name]


def sma(c: str, p: int) -> Column:
    """Mean of the last ``p`` rows; shorter at the start of the series."""
    return F.avg(c).over(trailing(p))


def wma(c: str, p: int) -> Column:
    """Linearly weighted mean, newest row heaviest; shorter at the start of the series."""
    n = F.least(F.col("idx") + 1, F.lit(p)).cast("double")
    num = F.col(c) * n
    for k in range(1, p):
        num = num + F.coalesce(prev(c, k) * (n - k), F.lit(0.0))
    return num / (n * (n + 1) / 2)


def moving_averages(bars: DataFrame, p: int = 20, source: str = "close") -> DataFrame:
    """Simple, weighted and Hull moving averages of the chosen price source."""
    df = indexed(bars).withColumn("src", price_source(source))
    df = df.select("*", sma("src", p).alias("sma"), wma("src", p).alias("wma"), wma("src", max(p // 2, 1)).alias("_half"))
    df = df.withColumn("_raw", 2 * F.col("_half") - F.col("wma"))
    return df.withColumn("hma", wma("_raw", max(int(math.sqrt(p) + 0.5), 1))).drop("_half", "_raw")


def bollinger(bars: DataFrame, p: int = 20, k: float = 2.0, source: str = "close") -> DataFrame:
    """Bands of ``k`` population standard deviations; %B is 0.5 while the band is flat."""
    df = indexed(bars).withColumn("src", price_source(source))
    df = df.select("*", F.avg("src").over(trailing(p)).alias("middle"), F.stddev_pop("src").over(trailing(p)).alias("_sd"))
    up, lo = F.col("middle") + k * F.col("_sd"), F.col("middle") - k * F.col("_sd")
    df = df.withColumns({"upper": up, "lower": lo})
    width = F.col("upper") - F.col("lower")
    return df.select(
        *[c for c in df.columns if c != "_sd"],
        F.when(F.col("middle") > 0, width / F.col("middle")).otherwise(0.0).alias("bandwidth"),
        F.when(width > 1e-12, (F.col("close") - F.col("lower")) / width).otherwise(0.5).alias("percent_b"),
    )


def obv(bars: DataFrame, ma: int = 20, anchor: str | None = None) -> DataFrame:
    """On-balance volume from ``anchor`` (or the first bar) and its moving average."""
    df = bars if anchor is None else bars.filter(F.col("date") >= F.lit(anchor).cast("date"))
    df = indexed(df)
    step = F.signum(F.col("close") - prev("close")) * F.col("volume")
    df = df.withColumn("_step", F.coalesce(step, F.lit(0.0)))
    df = df.withColumn("obv", F.sum("_step").over(so_far())).drop("_step")
    return df.withColumn("obv_ma", F.avg("obv").over(trailing(ma)))


def cci(bars: DataFrame, p: int = 20, c: float = 0.015) -> DataFrame:
    """Commodity channel index on hlc3; 0 in warm-up and when the mean deviation is 0."""
    df = indexed(bars).withColumn("tp", price_source("hlc3"))
    df = df.withColumn("_m", F.avg("tp").over(trailing(p)))
    md = F.abs(F.col("tp") - F.col("_m"))
    for k in range(1, p):
        md = md + F.abs(prev("tp", k) - F.col("_m"))
    df = df.withColumn("_md", md / p)
    live = (F.col("idx") >= p - 1) & (F.col("_md") > 0)
    return df.withColumn("cci", F.when(live, (F.col("tp") - F.col("_m")) / (c * F.col("_md"))).otherwise(0.0)).drop("_m", "_md")


def coppock(bars: DataFrame, long: int = 14, short: int = 11, p: int = 10) -> DataFrame:
    """Weighted mean of the sum of two rates of change, in percent."""
    df = indexed(bars)

    def roc(n: int) -> Column:
        was = prev("close", n)
        return F.when(was == 0, 0.0).otherwise((F.col("close") - was) / was * 100)

    df = df.withColumn("_roc", F.when(F.col("idx") >= max(long, short), roc(long) + roc(short)).otherwise(0.0))
    num = F.col("_roc") * p
    for k in range(1, p):
        num = num + prev("_roc", k) * (p - k)
    return df.withColumn("coppock", F.when(F.col("idx") >= p - 1, num / (p * (p + 1) / 2)).otherwise(0.0)).drop("_roc")


def _extent(df: DataFrame, p: int, hi: str, lo: str) -> DataFrame:
    return df.withColumns({hi: F.max("high").over(trailing(p)), lo: F.min("low").over(trailing(p))})


def donchian(bars: DataFrame, p: int = 20) -> DataFrame:
    """Highest high, lowest low and their midpoint; the bar itself during warm-up."""
    df = _extent(indexed(bars), p, "_h", "_l")
    live = F.col("idx") >= p - 1
    return df.select(
        *bars.columns, *([] if "idx" in bars.columns else ["idx"]),
        F.when(live, F.col("_h")).otherwise(F.col("high")).alias("upper"),
        F.when(live, (F.col("_h") + F.col("_l")) / 2).otherwise(F.col("close")).alias("middle"),
        F.when(live, F.col("_l")).otherwise(F.col("low")).alias("lower"),
    )


def ichimoku(bars: DataFrame, tenkan: int = 9, kijun: int = 26, senkou: int = 52, shift: int = 26,
             with_chikou: bool = False) -> DataFrame:
    """Midpoint lines and the displaced cloud.  ``chikou`` looks ahead, hence only on request."""
    df = indexed(bars)
    here = (F.col("high") + F.col("low")) / 2

    def mid(n: int) -> Column:
        full = (F.max("high").over(trailing(n)) + F.min("low").over(trailing(n))) / 2
        return F.when(F.col("idx") >= n - 1, full).otherwise(here)

    df = df.withColumns({"tenkan": mid(tenkan), "kijun": mid(kijun), "_b": mid(senkou)})
    df = df.withColumn("_a", (F.col("tenkan") + F.col("kijun")) / 2)
    df = df.withColumns({"senkou_a": F.coalesce(prev("_a", shift), F.col("_a")),
                         "senkou_b": F.coalesce(prev("_b", shift), F.col("_b"))}).drop("_a", "_b")
    df = df.withColumn("cloud", F.signum(F.col("senkou_a") - F.col("senkou_b")).cast("int"))
    if with_chikou:
        df = df.withColumn("chikou", F.coalesce(F.lead("close", shift).over(series()), F.col("close")))
    return df


def mfi(bars: DataFrame, p: int = 14) -> DataFrame:
    """Money flow index; 0 for the first ``p`` bars, 50 when there was no flow at all."""
    df = indexed(bars).withColumn("tp", price_source("hlc3"))
    df = df.withColumn("_was", prev("tp"))
    flow = F.col("tp") * F.col("volume")
    df = df.withColumns({"_up": F.when(F.col("tp") > F.col("_was"), flow).otherwise(0.0),
                         "_dn": F.when(F.col("tp") < F.col("_was"), flow).otherwise(0.0)})
    df = df.withColumns({"_u": F.sum("_up").over(trailing(p)), "_d": F.sum("_dn").over(trailing(p))})
    value = (F.when(F.col("idx") < p, 0.0).when(F.col("_d") > 0, 100 - 100 / (1 + F.col("_u") / F.col("_d")))
             .when(F.col("_u") > 0, 100.0).otherwise(50.0))
    return df.withColumn("mfi", value).drop("_was", "_up", "_dn", "_u", "_d")


def vwap(bars: DataFrame, anchor: str, source: str = "hlc3") -> DataFrame:
    """Volume-weighted price from ``anchor`` on, with bands of one and two deviations."""
    df = indexed(bars).withColumn("tp", price_source(source))
    on = F.col("date") >= F.lit(anchor).cast("date")
    v = F.when(on, F.greatest(F.col("volume"), F.lit(0))).otherwise(0)
    df = df.withColumns({"_v": v, "_pv": F.col("tp") * v, "_p2v": F.col("tp") * F.col("tp") * v})
    df = df.withColumns({f"_c{c}": F.sum(c).over(so_far()) for c in ("_v", "_pv", "_p2v")})
    df = df.withColumn("vwap", F.when(on & (F.col("_c_v") > 0), F.col("_c_pv") / F.col("_c_v")).otherwise(F.col("tp")))
    var = F.when(on & (F.col("_c_v") > 0), F.greatest(F.col("_c_p2v") / F.col("_c_v") - F.col("vwap") * F.col("vwap"), F.lit(0.0)))
    df = df.withColumn("sd", F.coalesce(F.sqrt(var), F.lit(0.0)))
    return df.drop("_v", "_pv", "_p2v", "_c_v", "_c_pv", "_c_p2v")


def williams_r(bars: DataFrame, p: int = 14) -> DataFrame:
    df = _extent(indexed(bars), p, "_h", "_l")
    live = (F.col("idx") >= p - 1) & (F.col("_h") > F.col("_l"))
    value = F.when(live, (F.col("_h") - F.col("close")) / (F.col("_h") - F.col("_l")) * -100).otherwise(0.0)
    return df.withColumn("williams_r", value).drop("_h", "_l")


def true_range(bars: DataFrame) -> DataFrame:
    was = prev("close")
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - was), F.abs(F.col("low") - was))
    return indexed(bars).withColumn("tr", tr)


def stochastic_raw(bars: DataFrame, p: int = 9) -> DataFrame:
    """Raw stochastic value: position of the close in the recent range, 50 when flat."""
    df = _extent(indexed(bars), p, "_h", "_l")
    width = F.col("_h") - F.col("_l")
    return df.withColumn("rsv", F.when(width > 1e-9, (F.col("close") - F.col("_l")) / width * 100).otherwise(50.0)).drop("_h", "_l")


def pct_change(c: str, n: int = 1, absent: float | None = None) -> Column:
    """Percent change from ``n`` rows ago; ``absent`` when the base is missing or not positive."""
    was = prev(c, n)
    return F.when(was > 0, (F.col(c) - was) / was * 100).otherwise(F.lit(absent))


def volatility(bars: DataFrame, n: int = 252, min_obs: int = 2, log: bool = False) -> DataFrame:
    """Simple (or log) returns and their sample standard deviation over the last ``n`` returns."""
    was = prev("close")
    r = F.when(was > 0, F.log(F.col("close") / was) if log else F.col("close") / was - 1)
    df = indexed(bars).withColumn("ret", r)
    return df.withColumn("vol", F.when(F.count("ret").over(trailing(n)) >= min_obs, F.stddev_samp("ret").over(trailing(n))))


def commodity_macro(prices: DataFrame, n: int = 60, min_obs: int = 10, flat_pct: float = 0.05) -> DataFrame:
    """Return against the last known price, its z-score against the past, and the momentum streak.

    Expects (entity, date, price) with gaps as null.
    """
    last = F.last("price", ignorenulls=True).over(series().rowsBetween(Window.unboundedPreceding, -1))
    df = prices.withColumn("idx", position())
    df = df.withColumn("_was", last)
    df = df.withColumn("return_pct", F.when((F.col("_was") > 0) & F.col("price").isNotNull(), (F.col("price") - F.col("_was")) / F.col("_was") * 100))
    w = before(n)
    df = df.withColumn("_sd", F.stddev_pop("return_pct").over(w))  # named, as a window is evaluated as often as it is written
    z = F.when((F.count("return_pct").over(w) >= min_obs) & (F.col("_sd") > 1e-12), (F.col("return_pct") - F.avg("return_pct").over(w)) / F.col("_sd"))
    state = F.when(F.col("return_pct") > flat_pct, "up").when(F.col("return_pct") < -flat_pct, "down").otherwise("neutral")
    df = df.withColumns({"zscore": z, "momentum": state})
    for s in ("up", "down", "neutral"):
        df = df.withColumn(f"_{s}", run_length(F.col("momentum") == s))
    return df.withColumn("streak", F.greatest("_up", "_down", "_neutral").cast("int")).drop("_was", "_sd", "_up", "_down", "_neutral")


def index_trend(bars: DataFrame, ma: int = 60, min_obs: int = 10) -> DataFrame:
    """Volume z-score against the past, side of the long average, one-bar slope of the 20-bar average.

    A close nearer to its average than sums round (1e-12 of it) is flat, whatever the order of adding.
    """
    df = indexed(bars)
    w = before(ma)
    df = df.withColumns({"_sd": F.stddev_pop("volume").over(w), "_mean": F.avg("volume").over(w), "ma20": F.avg("close").over(trailing(20)), "ma_long": F.avg("close").over(trailing(ma))})
    z = F.when((F.col("idx") >= min_obs) & (F.col("_sd") > 0), (F.col("volume") - F.col("_mean")) / F.col("_sd")).otherwise(0.0)
    df = df.withColumn("volume_z", z).drop("_sd", "_mean")
    return df.withColumns({
        "trend": F.when(F.abs(F.col("close") - F.col("ma_long")) <= F.abs("ma_long") * 1e-12, "flat").when(F.col("close") > F.col("ma_long"), "up").when(F.col("close") < F.col("ma_long"), "down").otherwise("flat"),
        "slope": F.col("ma20") - prev("ma20"),
    })


def ratio_momentum(df: DataFrame, c: str, n: int) -> DataFrame:
    """Current value minus the mean of the ``n`` values ahead of it; 0 until they exist."""
    df = indexed(df)
    return df.withColumn("momentum", F.when(F.col("idx") >= n, F.col(c) - F.avg(F.coalesce(c, F.lit(0.0))).over(before(n))).otherwise(0.0))
