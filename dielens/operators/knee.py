"""Knees and minima of curves held as rows (group, x, y).

After Satopää, Albrecht, Irwin and Raghavan, "Finding a 'Kneedle' in a Haystack"
(2011). A curve has one row per tried k, so windows per curve stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _unit(value: Column, over) -> Column:
    low, high = F.min(value).over(over), F.max(value).over(over)
    return F.try_divide(value - low, high - low)


def knee_point(
    df: DataFrame,
    groups: Sequence[str],
    x: str = "x",
    y: str = "y",
    curve: str = "convex",
    direction: str = "decreasing",
    sensitivity: float = 1.0,
    default: int = 1,
) -> DataFrame:
    """One row per curve: its knee, or ``default`` where there is none.

    Axes are normalised to [0, 1] and the curve is mirrored to concave-increasing; a
    local maximum of (y - x) is a knee when the difference falls below the maximum
    minus ``sensitivity`` mean steps before the next maximum. After a local minimum
    the threshold is 0. Flat curves have no knee.
    """
    if curve not in ("convex", "concave") or direction not in ("increasing", "decreasing"):
        raise ValueError(f"unknown curve shape {curve!r} / {direction!r}")
    by = [F.col(g) for g in groups] or [F.lit(1)]
    whole = Window.partitionBy(*by)
    # Convex-decreasing and concave-increasing are read left to right, the other two
    # right to left; convex ones have y mirrored.
    reverse = (curve, direction) in (("convex", "increasing"), ("concave", "decreasing"))
    order = whole.orderBy(F.desc(x) if reverse else F.asc(x))
    past = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    xn, yn = _unit(F.col(x), whole), _unit(F.col(y), whole)
    if reverse:
        xn = 1 - xn
    if curve == "convex":
        yn = 1 - yn
    gap = (
        df.withColumns({"_d": F.round(yn - xn, 12), "_step": F.try_divide(F.lit(1.0), F.count(F.lit(1)).over(whole) - 1)})
        .withColumns({"_prev": F.lag("_d").over(order), "_next": F.lead("_d").over(order)})
    )
    # An end point compares with itself on its open side.
    before, after = F.coalesce("_prev", "_d"), F.coalesce("_next", "_d")
    peak = (F.col("_d") >= before) & (F.col("_d") >= after)
    trough = (F.col("_d") <= before) & (F.col("_d") <= after)
    level = F.when(trough, F.lit(0.0)).when(peak, F.col("_d") - sensitivity * F.col("_step"))
    tracked = gap.withColumns(
        {
            "_level": F.last(level, ignorenulls=True).over(past),
            "_peak_x": F.last(F.when(peak, F.col(x)), ignorenulls=True).over(past),
        }
    )
    dropped = F.col("_peak_x").isNotNull() & (F.col("_next") < F.col("_level"))
    sign = -1 if reverse else 1
    first_drop = F.min_by(F.when(dropped, F.col("_peak_x")), F.when(dropped, F.col(x) * sign))
    return tracked.groupBy(*groups).agg(F.coalesce(first_drop, F.lit(default)).cast("int").alias("knee"))


def bic_choice(df: DataFrame, groups: Sequence[str], k: str = "k", bic: str = "bic") -> DataFrame:
    """Number of components per BIC curve, as (groups, first_minimum, knee, chosen_k).

    ``int(median(first interior local minimum, knee))``; the knee alone where the
    curve has no interior minimum. End points never count as minima.
    """
    by = [F.col(g) for g in groups] or [F.lit(1)]
    order = Window.partitionBy(*by).orderBy(k)
    interior = (F.col(bic) < F.lag(bic).over(order)) & (F.col(bic) < F.lead(bic).over(order))
    minima = (
        df.withColumn("_interior", interior)
        .groupBy(*groups)
        .agg(F.min(F.when(F.col("_interior"), F.col(k))).cast("int").alias("first_minimum"))
    )
    knees = knee_point(df, groups, k, bic)
    joined = minima.join(knees, list(groups)) if groups else minima.crossJoin(F.broadcast(knees))
    chosen = F.floor((F.coalesce("first_minimum", "knee") + F.col("knee")) / 2).cast("int")
    return joined.withColumn("chosen_k", chosen)
