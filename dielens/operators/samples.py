"""Repeatable samples and the tables behind scatter plots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.quantiles import lattice_cell
from dielens.functions.scalars import named

PLOT_ROWS = 9000
PLOT_REGISTERS = 5


def _uniform(*parts) -> Column:
    """A number in (0, 1) by hash, the same in every run."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def sample_per_cluster(
    df: DataFrame, cluster: str, columns: Sequence[str], max_rows: int = PLOT_ROWS, seed: int = 1
) -> DataFrame:
    """At most ``max_rows`` random rows of (cluster, columns) per cluster, repeatable.

    Equal rows are counted first. Each of the first ``max_rows`` copies of a row gets
    its random arrival time (the order statistics of its copies), so many copies
    neither pile up in one task nor crowd the sample. Arrivals are counted on a
    lattice, and only the cells up to the cut are ordered row by row.
    """
    names = [cluster, *columns]
    key = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(names)])
    copies = (
        df.select(named(cluster).alias("_cluster"), key.alias("_row"))
        .groupBy("_cluster", "_row")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("_n", F.lit(max_rows)))))
    )
    wait = -F.log(_uniform("_row", "_copy", F.lit(seed))) / (F.col("_n") - F.col("_copy") + 1)
    of_row = Window.partitionBy("_cluster", "_row").orderBy("_copy")
    arrivals = copies.withColumn(
        "_at", F.sum(wait).over(of_row.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("_cell", lattice_cell(-F.log("_at")) * -1)
    by_cell = Window.partitionBy("_cluster").orderBy("_cell")
    cells = (
        arrivals.groupBy("_cluster", "_cell")
        .agg(F.count(F.lit(1)).alias("_in_cell"))
        .withColumn("_before", F.sum("_in_cell").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.coalesce("_before", F.lit(0)) < max_rows)
        .groupBy("_cluster")
        .agg(F.max("_cell").alias("_last"))
    )
    near = arrivals.join(cells, arrivals["_cluster"].eqNullSafe(cells["_cluster"])).where("_cell <= _last").drop(cells["_cluster"])
    first = Window.partitionBy("_cluster").orderBy("_at", "_row", "_copy")
    return (
        near.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= max_rows)
        .select(*[F.col("_row").getField(f"c{i}").alias(c) for i, c in enumerate(names)])
    )


def plot_sample(df: DataFrame, cluster: str, pareto_registers: Sequence[str], max_rows: int = PLOT_ROWS) -> DataFrame:
    """The table behind a pair plot: the first five Pareto registers, sampled per cluster."""
    return sample_per_cluster(df, cluster, list(pareto_registers)[:PLOT_REGISTERS], max_rows)


def sample_counts(df: DataFrame, cluster: str, max_rows: int = PLOT_ROWS) -> DataFrame:
    """(cluster, rows the sample takes)."""
    return df.groupBy(named(cluster)).agg(F.least(F.count(F.lit(1)), F.lit(max_rows)).alias("sampled_rows"))


def pair_points(df: DataFrame, registers: Sequence[str], cluster: str, within: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every register pair i < j as points (keys, x_register, y_register, x, y, side).

    ``side`` tells points of cluster ``within`` from the others.
    """
    side = F.when(named(cluster) == within, F.lit("Within Cluster")).otherwise(F.lit("Outside Cluster"))
    points = [
        F.struct(
            F.lit(a).alias("x_register"), F.lit(b).alias("y_register"), named(a).alias("x"), named(b).alias("y")
        )
        for a, b in combinations(registers, 2)
    ]
    return df.select(*[named(k) for k in keys], side.alias("side"), F.inline(F.array(*points)))
