"""Scalar column functions: labels, signs, decays, quantile helpers, losses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity labels.
SEVERITY = {1: "info", 2: "notable", 3: "warning", 4: "critical"}


def severity_label(c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[c.cast("int")]


def severity_number(c: Column) -> Column:
    return F.create_map(*[x for k, v in SEVERITY.items() for x in (F.lit(v), F.lit(k))])[c]


def first_match(col: str, keywords: dict[str, str], default: str | None = None) -> Column:
    """Label of the first keyword contained in the text."""
    out = F.lit(default)
    for kw, label in reversed(list(keywords.items())):
        out = F.when(F.col(col).contains(kw), label).otherwise(out)
    return out


def exclusion_reason(keywords: dict[str, str]) -> Column:
    """Why an entity takes no part in rankings (null when it does)."""
    return F.when(F.col("delisting_date").isNotNull(), "delisted").otherwise(first_match("industry", keywords))


def event_value(meta: Column, names: list[str]) -> Column:
    """First numeric metadata field among ``names`` of a variant column."""
    return F.coalesce(*[F.try_variant_get(meta, f"$.{n}", "double") for n in names])


def decay(days: Column, scale: float = 14.0) -> Column:
    return F.exp(-days / scale)


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def _poly(coef: list[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + c, coef[1:], F.lit(coef[0]))


# Coefficients of the rational approximation of the inverse normal distribution (Acklam).
_A = [-3.969683028665376e1, 2.209460984245205e2, -2.759285104469687e2, 1.383577518672690e2, -3.066479806614716e1, 2.506628277459239]
_B = [-5.447609879822406e1, 1.615858368580409e2, -1.556989798598866e2, 6.680131188771972e1, -1.328068155288572e1, 1.0]
_C = [-7.784894002430293e-3, -3.223964580411365e-1, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
_D = [7.784695709041462e-3, 3.224671290700398e-1, 2.445134137142996, 3.754408661907416, 1.0]
_TAIL = 0.02425


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution as a pure column expression."""
    r = p - 0.5
    middle = _poly(_A, r * r) * r / _poly(_B, r * r)
    low = F.sqrt(-2 * F.log(p))
    high = F.sqrt(-2 * F.log(1 - p))
    return (F.when(p < _TAIL, _poly(_C, low) / _poly(_D, low)).when(p > 1 - _TAIL, -_poly(_C, high) / _poly(_D, high)).otherwise(middle))


def two_sided_z(confidence: Column) -> Column:
    return inverse_normal(0.5 + confidence / 2)


def pinball(y: Column, q: Column, tau: Column) -> Column:
    return F.when(y >= q, tau * (y - q)).otherwise((tau - 1) * (y - q))


def interval_pinball(y: Column, lower: Column, upper: Column, confidence: Column) -> Column:
    """Mean pinball loss of the two interval ends."""
    lo = (1 - confidence) / 2
    return (pinball(y, lower, lo) + pinball(y, upper, 1 - lo)) / 2


def hit(y: Column, lower: Column, upper: Column) -> Column:
    return (y >= lower) & (y <= upper)


def label_by_limits(c: Column, limits: list[tuple[float, str]], default: str) -> Column:
    """Label of the first limit that ``c`` reaches (limits from high to low)."""
    out = F.lit(default)
    for lim, name in reversed(limits):
        out = F.when(c >= lim, name).otherwise(out)
    return out


# Ratings by signed strength.
RATINGS = {3: "strong_bullish", 2: "bullish", 1: "slight_bullish", 0: "neutral", -1: "slight_bearish", -2: "bearish", -3: "strong_bearish"}


def _rated(c: Column, of: dict, default) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[c], F.lit(default))


def power_rating(power: Column) -> Column:
    """Name of a signed strength from -3 to 3; other and missing strengths are neutral."""
    return _rated(power, RATINGS, "neutral")


def rating_strength(rating: Column) -> Column:
    return _rated(rating, {v: abs(k) for k, v in RATINGS.items()}, 0)


def rating_sign(rating: Column) -> Column:
    return _rated(rating, {v: (k > 0) - (k < 0) for k, v in RATINGS.items()}, 0)


def rating_direction(rating: Column) -> Column:
    """bullish, bearish or neutral."""
    return F.when(rating_sign(rating) > 0, "bullish").when(rating_sign(rating) < 0, "bearish").otherwise("neutral")


def pattern_family(pattern: Column) -> Column:
    """The first part of a nested pattern name (``flat_common`` is a ``flat``)."""
    return F.substring_index(pattern, "_", 1)


def wave_count(label: Column) -> Column:
    """The number in front of ``-wave`` in a structure label, 0 without one or when it is too long for an int."""
    return F.coalesce(F.regexp_extract(label, r"(\d+)-wave", 1).try_cast("int"), F.lit(0))
