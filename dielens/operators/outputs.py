"""Shaping results for output: filled statistics, nested lists, merged labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named
from dielens.operators.stacked import POSITION, STATISTICS

SIGNATURE_CONTEXT = ("FAB", "DESIGN_ID", "cluster", "model", "stacked_item")
DIE_CONTEXT = ("FAB", "DESIGN_ID", "LOT_ID", "WAFER_ID", "lot_wafer", "DieX", "DieY")


def group_mean_fill(
    df: DataFrame, context: Sequence[str] = SIGNATURE_CONTEXT, columns: Sequence[str] = STATISTICS
) -> DataFrame:
    """Missing values take the mean of their context group.

    The means are aggregated (combined map-side) and joined back, so a large group is
    never gathered in one task.
    """
    means = df.groupBy(*[named(c) for c in context]).agg(
        *[F.avg(named(c)).alias(f"_mean{i}") for i, c in enumerate(columns)]
    )
    filled = {c: F.coalesce(named(c).cast("double"), F.col(f"_mean{i}")) for i, c in enumerate(columns)}
    joined = df.join(means, list(context), "left").withColumns(filled)
    return joined.drop(*[f"_mean{i}" for i in range(len(columns))])


def cluster_signature(
    df: DataFrame, context: Sequence[str] = SIGNATURE_CONTEXT, columns: Sequence[str] = STATISTICS
) -> DataFrame:
    """Per context: mean statistics and ``die_info``, the (DieX, DieY, median_value) list.

    A list holds one entry per die position of a design.
    """
    die = F.struct(*POSITION, "median_value")
    return df.groupBy(*[named(c) for c in context]).agg(
        *[F.avg(named(c)).alias(c) for c in columns], F.array_sort(F.collect_list(die)).alias("die_info")
    ).orderBy("model", "cluster", "stacked_item", "FAB", "DESIGN_ID")


def merge_labelled(
    unlabelled: DataFrame, models: Sequence[str], labelled: DataFrame | None = None, modes: Sequence[str] = ()
) -> DataFrame:
    """Clustered and labelled dies together, each distinct row once.

    A labelled die carries the last mode it shows in every model column.
    """
    context = [named(c) for c in DIE_CONTEXT]
    out = unlabelled.select(*context, *[named(m) for m in models])
    if labelled is not None and modes:
        last = F.coalesce(*[F.when(named(m) == 1, F.lit(m)) for m in reversed(modes)])
        out = out.unionByName(labelled.select(*context, *[last.alias(m) for m in models]))
    return out.distinct()


def wafer_association(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per wafer, model and cluster: its die positions and their number, largest first.

    ``df`` has distinct dies (``merge_labelled``), so a list is no longer than the wafer
    has positions times the label combinations of a die.
    """
    keys = [c for c in DIE_CONTEXT if c not in POSITION]
    long = df.unpivot([named(c) for c in DIE_CONTEXT], [named(m) for m in models], "model", "cluster")
    return (
        long.groupBy(*keys, "model", "cluster")
        .agg(
            F.array_sort(F.collect_list(F.struct(*POSITION))).alias("die_coordinates"),
            F.count(F.lit(1)).alias("wafer_die_count"),
        )
        .orderBy(F.desc("model"), F.desc("cluster"), F.desc("wafer_die_count"), *keys)
    )


def cluster_pareto_lists(pareto: DataFrame) -> DataFrame:
    """The cluster Pareto as three parallel lists per (model, cluster), largest first."""
    entry = F.struct("position", "register", "register_median", "cumpercentage")
    rows = pareto.groupBy("model", "cluster").agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    return rows.select(
        "model",
        "cluster",
        F.col("_rows.register").alias("register"),
        F.col("_rows.register_median").alias("register_median"),
        F.col("_rows.cumpercentage").alias("cumpercentage"),
    )
