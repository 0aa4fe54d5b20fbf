"""The indicators by name, with their columns, event rules and declared warm-up.

A warm-up of n bars promises that values from a day on are the same whether the whole series is read or only the n
bars before that day: exactly where the window is finite, up to 1e-6 of the value's scale where the indicator is
recursive. ``compute(since=)`` and incremental runs rely on it, the tests hold every entry to it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.events import Rule
from tidemark.functions.events import detect as detect_events
from tidemark.operators import detection as D
from tidemark.operators import indicators as I
from tidemark.operators import recursive as R


@dataclass(frozen=True)
class Indicator:
    compute: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]
    warmup: int
    exact: bool = True
    rules: tuple[Rule, ...] = ()


INDICATORS = {
    "moving_averages": Indicator(I.moving_averages, ("sma", "wma", "hma"), 25),
    "bollinger": Indicator(I.bollinger, ("upper", "middle", "lower", "bandwidth", "percent_b"), 20, rules=tuple(D.BOLLINGER_RULES)),
    "cci": Indicator(I.cci, ("cci",), 20, rules=tuple(D.CCI_RULES)),
    "coppock": Indicator(I.coppock, ("coppock",), 24),
    "donchian": Indicator(I.donchian, ("upper", "middle", "lower"), 20, rules=tuple(D.DONCHIAN_RULES)),
    "ichimoku": Indicator(I.ichimoku, ("tenkan", "kijun", "senkou_a", "senkou_b"), 78, rules=tuple(D.ICHIMOKU_RULES)),
    "mfi": Indicator(I.mfi, ("mfi",), 15, rules=tuple(D.MFI_RULES)),
    "williams_r": Indicator(I.williams_r, ("williams_r",), 14, rules=tuple(D.WILLIAMS_RULES)),
    "exponential_averages": Indicator(R.exponential_averages, ("ema", "dema", "tema"), 260, False),
    "macd": Indicator(R.macd, ("macd", "signal", "histogram"), 324, False),
    "rsi": Indicator(R.rsi, ("rsi",), 280, False, tuple(D.RSI_RULES)),
    "kd": Indicator(R.kd, ("k", "d"), 130, False),
    "adx": Indicator(R.adx, ("plus_di", "minus_di", "adx"), 340, False),
    "atr": Indicator(R.atr, ("tr", "atr", "atr_pct"), 280, False, tuple(D.ATR_RULES)),
    "keltner": Indicator(R.keltner, ("upper", "middle", "lower"), 260, False),
}


def known(name: str) -> Indicator:
    if name not in INDICATORS:
        raise ValueError(f"no indicator {name!r}; known are {', '.join(sorted(INDICATORS))}")
    return INDICATORS[name]


def with_warmup(bars: DataFrame, since: str, n: int) -> DataFrame:
    """Rows from ``since`` on and the ``n`` before them, of entities that have any from then on."""
    w = Window.partitionBy("entity").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, 0)
    new = F.col("date") >= F.lit(since).cast("date")
    df = bars.withColumns({"_new": F.count_if(new).over(w), "_all": F.count("*").over(w)})
    return df.filter((F.col("_new") > 0) & (F.col("_all") - F.col("_new") <= n)).drop("_new", "_all")


def compute(name: str, bars: DataFrame, since: str | None = None) -> DataFrame:
    """``entity, date`` and the indicator's columns, of all bars or from ``since`` on with its warm-up only."""
    ind = known(name)
    if since is None:
        return ind.compute(bars).select("entity", "date", *ind.columns)
    df = ind.compute(with_warmup(bars, since, ind.warmup))
    return df.filter(F.col("date") >= F.lit(since).cast("date")).select("entity", "date", *ind.columns)


def events(name: str, bars: DataFrame) -> DataFrame:
    """Events of the indicator's rules over whole series; spacing and streaks remember more than a warm-up holds."""
    ind = known(name)
    if not ind.rules:
        raise ValueError(f"{name} has no event rules of its own")
    return detect_events(ind.compute(bars), list(ind.rules))
