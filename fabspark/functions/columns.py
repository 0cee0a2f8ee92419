"""Column expressions: ratios, labels, classes, calendar parts, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabspark import constants as K


def ident(name: str) -> str:
    """Quoted column name; sensor names are digits and would else be numbers."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal of an SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    return F.col(ident(name))


# Expressions over all sensors are given to Spark as one text. Built call by call,
# 590 sensors take seconds in the driver before the query starts.

def array_of(parts: Sequence[str]) -> Column:
    """Array of SQL expressions."""
    return F.expr(f"array({', '.join(parts)})")


def rounded(value: Column, digits: int) -> Column:
    """Round the scaled double, half away from zero.

    Plain ``round`` goes through the decimal text, so 0.575 becomes 0.58; the
    reference results round 57.49999... and give 0.57.
    """
    if digits == 0:
        return F.round(value, 0)
    return F.round(value * F.lit(10.0 ** digits), 0) / F.lit(10.0 ** digits)


def rounded_value(name: str, digits: int) -> Column:
    """``rounded`` of a double column to one digit or more, without a decimal for every value.

    ``rint`` differs from it only at halves, which doubles hold exactly, and in the sign of zero.
    """
    x = F.col(name) * F.lit(10.0 ** digits)
    near = F.rint(x)
    return (F.when(F.abs(x - near) == 0.5, x + F.signum(x) * 0.5).otherwise(near) + F.lit(0.0)) / F.lit(10.0 ** digits)


def ratio(part: Column, whole: Column, scale: float, digits: int | None = None) -> Column:
    """``part / whole * scale``; NULL when ``whole`` is zero."""
    r = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(float(scale))
    return r if digits is None else rounded(r, digits)


def clipped_ratio(part: Column, whole: Column, scale: float) -> Column:
    """``part / max(whole, 1) * scale``; a zero total gives zero, not NULL."""
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double") * F.lit(float(scale))


def scrap_rate(quarantined: Column, tested: Column) -> Column:
    return ratio(quarantined, tested + quarantined, 100, 2)


def wafer_status(label: Column) -> Column:
    return F.when(label == -1, "Pass").when(label == 1, "Fail").otherwise("Unknown")


def binary_label(label: Column) -> Column:
    """-1 becomes 0, 1 stays 1, anything else is no label."""
    return F.when(label == -1, 0).when(label == 1, 1)


def missing_count(sensors: Sequence[str]) -> Column:
    """NULL sensors in a row, as one flat expression however many sensors there are.

    ``array_remove`` is compiled; a lambda over 590 flags took six times as long.
    """
    return F.size(F.array_remove(array_of([f"{ident(s)} IS NULL" for s in sensors]), False))


def shift_of(ts: Column) -> Column:
    """Day 6-14, Swing 14-22, Night 22-6."""
    h = F.hour(ts)
    return F.when((h >= 6) & (h < 14), "Day").when((h >= 14) & (h < 22), "Swing").otherwise("Night")


def shift_order(shift: Column) -> Column:
    return (F.when(shift == "Day", 1).when(shift == "Swing", 2)
            .when(shift == "Night", 3).otherwise(4))


def at_least(value: Column, cuts: Sequence[tuple[float, str]], below: str) -> Column:
    """Name of the first cut that ``value`` reaches; NULL and NaN fall to ``below``."""
    clean = F.when(~F.isnan(value), value)
    out = None
    for cut, name in cuts:
        hit = clean >= F.lit(float(cut))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(below)


def band(value: Column, cuts: Sequence[tuple[float, str]], below: str) -> Column:
    """As ``at_least`` but a cut must be exceeded."""
    clean = F.when(~F.isnan(value), value)
    out = None
    for cut, name in cuts:
        hit = clean > F.lit(float(cut))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(below)


def oee_class(value: Column) -> Column:
    return at_least(value, [(85, "World Class"), (65, "Good"), (50, "Average")], "Poor")


def capability_class(cpk: Column) -> Column:
    return at_least(cpk, [(1.33, "Capable"), (1.0, "Marginal")], "Incapable")


def effect_strength(r: Column) -> Column:
    return at_least(F.abs(r), [(0.3, "Strong"), (0.1, "Moderate")], "Weak")


def effect_direction(r: Column) -> Column:
    clean = F.when(~F.isnan(r), r)
    return (F.when(clean > 0, K.DIRECTION_UP).when(clean < 0, K.DIRECTION_DOWN)
            .otherwise(K.DIRECTION_NONE))


def severity(rule_number: Column) -> Column:
    return F.when(rule_number == 1, "alarm").when(rule_number <= 3, "warn").otherwise("ok")


def dppm_band(dppm: Column) -> Column:
    return band(dppm, [(10000, "red"), (5000, "amber")], "teal")


def violation_band(total: Column) -> Column:
    return band(total.cast("double"), [(10, "red"), (3, "amber")], "teal")


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def month_day(ts: Column) -> Column:
    return F.date_format(ts, "MM-dd")


def key_text(c: Column, timestamp: bool = False) -> Column:
    """Text form used inside surrogate keys; timestamps keep all six digits."""
    t = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if timestamp else c.cast("string")
    return F.coalesce(t, F.lit(K.KEY_NULL_MARK))


def surrogate_key(*texts: Column) -> Column:
    return F.md5(F.concat_ws("-", *texts))


def mean(x: Column, over=None) -> Column:
    """Average, exact for a constant: a sum of 0.1 divided again need not give 0.1.

    One ulp of error would put every reading of a flat sensor on one side of its mean.
    """
    w = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    lo, hi = w(F.min(x)), w(F.max(x))
    return F.when(lo == hi, lo).otherwise(w(F.avg(x)))


def spread(x: Column, over=None) -> Column:
    """Sample standard deviation, exactly 0 for a constant; NULL under two readings.

    Merged partial moments leave about 1e-17 for some constants, which would pass
    every check against zero.
    """
    w = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    return F.when((w(F.min(x)) == w(F.max(x))) & (w(F.count(x)) > 1), F.lit(0.0)).otherwise(
        w(F.stddev_samp(x)))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both sides are present; NULL when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    varies = (F.min(px) != F.max(px)) & (F.min(py) != F.max(py))
    dev = F.stddev_pop(px) * F.stddev_pop(py)
    return F.when(varies, F.try_divide(F.covar_pop(px, py), F.nullif(dev, F.lit(0.0))))


def least_or_null(a: Column, b: Column) -> Column:
    """Smaller of two, NULL if either is NULL (``least`` alone skips NULL)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))
