"""Exact grouped quantiles that hold when one group has a third of all rows.

Spark's own ``percentile`` keeps every distinct value of a group in one task's
memory. Here values are counted first (map-side combined, shuffled on group *and*
value) and the counts are placed on a fixed lattice whose size does not depend on the
data. A lattice cell that holds a wanted rank and many values is cut again, twice, in
equal steps of its own range, and only the step that holds the rank is kept. A cell spans
0.1 % of its values, so equal steps are equal numbers of doubles, and what is ordered
value by value in the end are ``FEW`` values, or 2^18 of a range that is full of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.scalars import finite, named

# Lattice cells per unit of log1p(|v|): one cell spans about 0.1 % of a value.
CELLS_PER_LOG_UNIT = 1024
#: Distinct values of a cell that are ordered without cutting it.
FEW = 4096
#: Steps a cell is cut into, and how often.
STEPS, CUTS = 4096, 2
#: The key of rows that are one group.
_ALL = "_all"


def lattice_cell(value: Column) -> Column:
    """Order-preserving cell number of a value; the same for every group and run."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * CELLS_PER_LOG_UNIT)


def _cell(value: Column) -> Column:
    """As ``lattice_cell``, but relative to the value near zero too; zero has its own cell."""
    size = F.floor((F.log(F.abs(value)) + F.lit(746.0)) * CELLS_PER_LOG_UNIT)
    placed = F.when(value > 0, size).when(value < 0, -size)
    return F.coalesce(placed, F.lit(0).cast("bigint"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``_k`` (a struct of the keys), ``_v``, ``_n``: rows for each value, NULL for those that
    do not count (NULL, NaN, infinite)."""
    key = F.struct(*[named(k) for k in keys]) if keys else F.struct(F.lit(1).alias(_ALL))
    rows = df.select(key.alias("_k"), finite(named(value).cast("double")).alias("_v"))
    return rows.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    with_stats: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group of ``keys``.

    ``probabilities`` maps output column names to probabilities in [0, 1]. NULL, NaN
    and infinite values do not count; a group of these only has no row. With ``with_stats`` the
    row also has ``n_values``, ``min_value``, ``max_value`` and ``mean_value``.
    """
    counts = value_counts(df, keys, value).where(F.col("_v").isNotNull())
    return keys_of(quantiles_of_counts(counts, probabilities, with_stats), keys)


def keys_of(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys in ``_k`` as columns, then the others."""
    return found.select(*[F.col("_k").getField(k).alias(k) for k in keys], *[c for c in found.columns if c != "_k"])


def _hit(cells: DataFrame, ranks: Sequence[Column]) -> DataFrame:
    """The cells (``_before``, ``_in_cell``) that hold a wanted rank."""
    inside = [(r >= F.col("_before")) & (r < F.col("_before") + F.col("_in_cell")) for r in ranks]
    return cells.where(reduce(lambda a, b: a | b, inside, F.col("_total") == 0))


def _met(counts: DataFrame, hits: DataFrame) -> DataFrame:
    """Counts in the cells hit. Only the hits are ever the side held in memory: the size of held
    counts is guessed from their files, which are packed many times smaller than their rows, and
    Spark would send all of them through the driver."""
    one_group = counts.schema["_k"].dataType.names == [_ALL]
    return counts.join(F.broadcast(hits) if one_group else hits.hint("shuffle_hash"), ["_k", "_cell"])


def _inside(met: DataFrame) -> DataFrame:
    """Values within their stretch, and the empty groups. Without these Spark would move
    "is not NULL" below the counts of this use only, and count the rows for each use anew."""
    return met.where(F.col("_v").between(F.col("_lo"), F.col("_hi")) | (F.col("_total") == 0))


def cells_with_ranks(
    counts: DataFrame, ranks: Sequence[Column], stats: Sequence[str] = (), few: int = FEW
) -> DataFrame:
    """The few stretches of each ``_k`` that hold the wanted ranks: ``_cell``, ``_lo``, ``_hi``,
    ``_before`` (values below it), ``_total`` and the stats asked for. The ranks may use ``_total``.

    ``counts`` has ``_cell``. Each stretch has ``few`` distinct values, or 2^18 neighbours.
    """
    cell_sums = [
        F.sum("_n").alias("_in_cell"),
        F.count(F.lit(1)).alias("_values"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    ]
    whole = Window.partitionBy("_k")
    upto = lambda w, c: F.sum("_in_cell").over(w.orderBy(c).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = ["_total", *stats]
    total = {
        "_total": F.sum("_in_cell").over(whole),
        "_min": F.min("_lo").over(whole),
        "_max": F.max("_hi").over(whole),
        "_sum_all": F.sum("_sum").over(whole),
    }
    cells = (
        counts.groupBy("_k", "_cell")
        .agg(*cell_sums, F.sum(F.col("_v") * F.col("_n")).alias("_sum"))
        .withColumns({"_before": upto(whole, "_cell") - F.col("_in_cell"), **{s: total[s] for s in kept}})
        .drop("_sum")
    )
    hits, ready = _hit(cells, ranks), []
    for _ in range(CUTS):
        ready.append(hits.where(F.col("_values") <= few))
        large = hits.where(F.col("_values") > few).drop("_in_cell", "_values")
        step = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * STEPS)
        cut = _inside(_met(counts, large))
        place = ["_k", "_cell", "_from"]
        steps = (
            cut.withColumns({"_from": F.col("_lo"), "_step": F.least(step, F.lit(STEPS - 1).cast("bigint"))})
            .groupBy(*place, "_step")
            .agg(*cell_sums, F.first("_before").alias("_before"), *[F.first(s).alias(s) for s in kept])
            .withColumn("_before", F.col("_before") + upto(Window.partitionBy(*place), "_step") - F.col("_in_cell"))
        )
        hits = _hit(steps, ranks).select(*large.columns, "_in_cell", "_values")
    ready.append(hits)
    return reduce(DataFrame.unionByName, [h.drop("_in_cell", "_values") for h in ready])


def quantiles_of_counts(counts: DataFrame, probabilities: Mapping[str, float], with_stats: bool = False) -> DataFrame:
    """``exact_quantiles`` of counted values (``_k``, ``_v``, ``_n``), with ``_k`` as it is.

    Counts of a NULL value keep their group: with no other value its row has zero values
    and is NULL elsewhere.
    """
    counts = counts.withColumns(
        {"_n": F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0)), "_cell": _cell(F.col("_v"))}
    )

    def rank(p: float) -> tuple[Column, Column, Column]:
        position = F.lit(float(p)) * (F.col("_total") - 1)
        return position, F.floor(position), F.ceil(position)

    ranks = {name: rank(p) for name, p in probabilities.items()}
    wanted = [r for _, low, high in ranks.values() for r in (low, high)]
    stats = ["_min", "_max", "_sum_all"] if with_stats else []
    small = cells_with_ranks(counts, wanted, stats, FEW)
    stats = ["_total", *stats] if with_stats else []

    inside = Window.partitionBy("_k", "_cell", "_lo").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = (
        _inside(_met(counts, small))
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def value_at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("_start")) & (r < F.col("_end")), F.col("_v")))

    picks, outputs = [], []
    for i, (name, (position, low, high)) in enumerate(ranks.items()):
        picks += [
            value_at(low).alias(f"_low{i}"),
            value_at(high).alias(f"_high{i}"),
            F.first(position - low).alias(f"_part{i}"),
        ]
        low_value, high_value = F.col(f"_low{i}"), F.col(f"_high{i}")
        outputs.append((low_value + (high_value - low_value) * F.col(f"_part{i}")).alias(name))
    if with_stats:
        picks += [F.first(c).alias(c) for c in stats]
        outputs += [
            F.col("_total").alias("n_values"),
            F.col("_min").alias("min_value"),
            F.col("_max").alias("max_value"),
            F.try_divide(F.col("_sum_all"), F.col("_total")).alias("mean_value"),
        ]
    return placed.groupBy("_k").agg(*picks).select("_k", *outputs)
