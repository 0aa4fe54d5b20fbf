"""Recursive indicators as scans: the results of ``recursive.py`` without a walk per series.

``recursive.py`` streams a whole series through one task, which suits daily bars.  These forms cut
each series into blocks (``functions/scans.py``) and stay in built-in expressions, which suits long
series (minute bars with days as blocks) and a key with most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scans import BLOCK, ROWS, affine, dealt, doubles, entering, in_blocks, located, packed, scan
from tidemark.operators.recursive import KALMAN_HORIZONS
from tidemark.session import cut


def exponential_averages(bars: DataFrame, p: int = 20, source: str = "close", block: Column | None = None, longest: int = 366) -> DataFrame:
    """EMA, double and triple form from one scan.

    Three filters in a row are a triangular system with equal diagonals, so the matrix of any number
    of steps is given by three numbers, and matrices multiply like polynomials cut at degree two.
    """
    alpha, beta = 2.0 / (p + 1.0), 1.0 - 2.0 / (p + 1.0)
    x = F.col(source).cast("double")

    def mapped(f, e):
        return {"e1": f["m0"] * e["e1"] + f["e1"], "e2": f["m1"] * e["e1"] + f["m0"] * e["e2"] + f["e2"],
                "e3": f["m2"] * e["e1"] + f["m1"] * e["e2"] + f["m0"] * e["e3"] + f["e3"]}

    def compose(f, g):
        return doubles(m0=g["m0"] * f["m0"], m1=g["m0"] * f["m1"] + g["m1"] * f["m0"],
                       m2=g["m0"] * f["m2"] + g["m1"] * f["m1"] + g["m2"] * f["m0"], **mapped(g, f))

    step = doubles(m0=beta, m1=alpha * beta, m2=alpha * alpha * beta, e1=alpha * x, e2=alpha ** 2 * x, e3=alpha ** 3 * x)
    df = scan(in_blocks(bars, "date", block), step, doubles(m0=1.0, m1=0.0, m2=0.0, e1=0.0, e2=0.0, e3=0.0), compose,
              lambda e, f: doubles(**mapped(f, e)), doubles(e1=x, e2=x, e3=x), "_e", longest=longest)
    e1, e2, e3 = (F.col("_e")[k] for k in ("e1", "e2", "e3"))
    return df.withColumns({"ema": e1, "dema": 2 * e1 - e2, "tema": 3 * e1 - 3 * e2 + e3}).drop("_e", BLOCK)


def rsi(bars: DataFrame, p: int = 14, block: Column | None = None, longest: int = 366) -> DataFrame:
    """Wilder RSI; gains and losses share one scan, warm-up sums included."""
    df = cut(located(in_blocks(bars, "date", block), {"was": "close"}))
    first = F.least(F.lit(p), F.col("n") - 1)
    move = F.coalesce(F.col("close") - F.col("was"), F.lit(0.0))
    warm = F.col("idx") <= first
    weight = F.when(warm, 1.0 / F.nullif(first, F.lit(0))).otherwise(1.0 / p)
    zero = F.lit(0.0)
    df = affine(df, F.when(warm, 1.0).otherwise(1 - 1.0 / p), {"_g": F.greatest(move, zero) * weight, "_l": F.greatest(-move, zero) * weight}, {"_g": zero, "_l": zero}, longest=longest)
    value = F.when((F.col("idx") < first) | (F.col("n") < 2), 0.0).when(F.col("_l") < 1e-12, 100.0).otherwise(100.0 - 100.0 / (1.0 + F.col("_g") / F.nullif(F.col("_l"), zero)))
    return df.withColumn("rsi", value).drop("_g", "_l", "was", "n", BLOCK)


def atr(bars: DataFrame, p: int = 14, block: Column | None = None, longest: int = 366) -> DataFrame:
    """Wilder ATR; its growing mean is the same recursion with a weight that falls with the bar number."""
    df = cut(located(in_blocks(bars, "date", block), {"was": "close"}))
    df = df.withColumn("tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("was")), F.abs(F.col("low") - F.col("was"))))
    weight = F.when(F.col("idx") < p, 1.0 / (F.col("idx") + 1)).otherwise(1.0 / p)
    df = affine(df, 1.0 - weight, {"atr": F.col("tr") * weight}, {"atr": F.lit(0.0)}, longest=longest)
    return df.withColumn("atr_pct", F.when(F.col("close") > 0, F.col("atr") / F.col("close") * 100).otherwise(0.0)).drop("was", "n", BLOCK)


def kalman(bars: DataFrame, noise: float = 0.01, block: Column | None = None, longest: int = 366) -> DataFrame:
    """Local-level Kalman filter per (entity, horizon), noise from the mean close so far.

    The variance after a bar is a fraction of linear terms of the one before, and such fractions compose as 2 x 2 matrices; with
    the gains known, the level is an affine recursion. A bar is shuffled to its block once and carries its horizons in one row:
    sums, variances and levels are folded per block in turn, each from what enters it, and horizons are laid out at the end.
    """
    by, levels = ["entity", BLOCK], list(KALMAN_HORIZONS.items())
    bars = dealt(in_blocks(bars.select("entity", "date", "close"), "date", block))
    along = Window.partitionBy("entity").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce(F.col("close"), F.lit(0.0))
    # dates are counted, not rows, so that the shuffle of ``blocks`` serves here too
    sums = bars.groupBy(*by).agg(F.count("date").alias("_n"), F.sum(known).alias("_s"))
    enters = sums.select(*by, *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(c) for c in ("_n", "_s")])
    # in their block, rows number themselves and add up their closes
    w = Window.partitionBy(*by).orderBy("date")
    blocks = packed(bars.withColumns({"idx": F.row_number().over(w), "sum": F.sum(known).over(w.rowsBetween(Window.unboundedPreceding, 0))}), ["close", "idx", "sum"], longest=longest)

    def entered(enters: DataFrame) -> DataFrame:
        def located(x):
            n = F.col("_n") + x["idx"]
            return F.struct(x["date"].alias("date"), x["close"].alias("close"), F.coalesce(x["close"], F.lit(0.0)).alias("z"), (n - 1).alias("idx"), F.pow(noise * (F.col("_s") + x["sum"]) / n, 2).alias("r"))

        return blocks.join(enters, by).withColumn(ROWS, F.transform(ROWS, located))

    def matrices(f, x):
        """The map of a row after that of the rows before: (m11, m12; m21, 1), scaled so, which changes no fraction and keeps numbers small."""
        r, q = x["r"], f["q"]
        low = f["m12"] + (q + r)
        return doubles(q=q, m11=r * (f["m11"] + q * f["m21"]) / low, m12=r * (f["m12"] + q) / low, m21=(f["m11"] + (q + r) * f["m21"]) / low)

    def gain(f, x):
        return (f["v"] + f["q"]) / (f["v"] + f["q"] + x["r"])

    def variance(f, x):
        return x["r"] * gain(f, x)

    df = entered(enters)
    zero = F.array(*[doubles(q=q, m11=1.0, m12=0.0, m21=0.0) for _, (q, _, _) in levels])
    totals = df.select(*by, "_n", "_s", F.aggregate(ROWS, zero, lambda a, x: F.transform(a, lambda f: matrices(f, x))).alias("_m"), F.array_repeat(F.col(ROWS)[0]["r"], len(levels)).alias("_r"))
    enters = entering(totals, F.col("_m"), F.col("_r"), lambda s, m: F.zip_with(s, m, lambda v, f: (f["m11"] * v + f["m12"]) / (f["m21"] * v + 1.0)), "_v").drop("_m", "_r")

    df = entered(enters)
    start = F.array(*[doubles(q=q, v=F.col("_v")[i], a=1.0, b=0.0) for i, (_, (q, _, _)) in enumerate(levels)])
    affine_ = lambda f, x: doubles(q=f["q"], v=variance(f, x), a=(1 - gain(f, x)) * f["a"], b=(1 - gain(f, x)) * f["b"] + gain(f, x) * x["z"])
    totals = df.select(*by, "_n", "_s", "_v", F.aggregate(ROWS, start, lambda a, x: F.transform(a, lambda f: affine_(f, x))).alias("_m"), F.array_repeat(F.col(ROWS)[0]["z"], len(levels)).alias("_z"))
    enters = entering(totals, F.col("_m"), F.col("_z"), lambda s, m: F.zip_with(s, m, lambda y, f: f["a"] * y + f["b"]), "_y").drop("_m", "_z")

    # states of all rows of a block, each read from the one before it
    df = entered(enters)
    start = F.array(*[doubles(q=q, v=F.col("_v")[i], y=F.col("_y")[i], dy=0.0) for i, (_, (q, _, _)) in enumerate(levels)])
    step = lambda f, x: doubles(q=f["q"], v=variance(f, x), y=f["y"] + gain(f, x) * (x["z"] - f["y"]), dy=gain(f, x) * (x["z"] - f["y"]))
    states = F.aggregate(ROWS, F.array(start), lambda a, x: F.concat(a, F.array(F.transform(F.element_at(a, -1), lambda f: step(f, x)))))
    df = df.select("entity", ROWS, states.alias("_states"))
    df = df.select("entity", F.inline(F.zip_with(ROWS, F.slice("_states", 2, F.size(ROWS)), lambda x, s: F.struct(x["date"].alias("date"), x["idx"].alias("idx"), x["close"].alias("close"), s.alias("_s")))))
    cells = [F.struct(F.lit(k).alias("horizon"), F.lit(q).alias("q"), F.lit(t).alias("threshold"), F.lit(n).alias("min_run"), F.col("_s")[i]["y"].alias("smoothed"),
                      F.sqrt(F.col("_s")[i]["v"]).alias("uncertainty"), F.when(F.col("close").isNotNull(), F.col("_s")[i]["dy"]).alias("velocity")) for i, (k, (q, t, n)) in enumerate(levels)]
    return df.select("entity", "date", "idx", "close", F.inline(F.array(*cells)))
