"""Stacked wafer maps: cluster statistics and medians per die position over all wafers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.quantiles import exact_quantiles, keys_of, quantiles_of_counts, value_counts
from dielens.functions.scalars import named
from dielens.operators.registers import unpivot
from dielens.plans.hold import hold

PARETO_NUM = 10
POSITION = ("DieX", "DieY")
STATISTICS = (
    "num_wafers_in_cluster",
    "num_dies_in_cluster",
    "impact",
    "die_max_value",
    "die_mean_value",
    "die_median_value",
    "die_min_value",
)


@dataclass(frozen=True)
class Stack:
    """What a stacked map is made of."""

    registers: tuple[str, ...]  # medians per die position
    items: tuple[str, ...]  # stacked items: the probe column and the registers
    probe_column: str  # as in the dies
    probe_item: str  # as the user named it
    bin_column: str | None = None  # BIN_BIT or the bin step, when the probe item is a bin

    @classmethod
    def of(cls, registers: Sequence[str], probe_column: str, probe_item: str, bin_column: str | None = None):
        items = dict.fromkeys([probe_column, *registers])
        return cls(tuple(registers), tuple(items), probe_column, probe_item, bin_column)


Cluster = str | Sequence[str]  # the column, or columns, that name a cluster


def _names(cluster: Cluster) -> list[str]:
    return [cluster] if isinstance(cluster, str) else list(cluster)


def _group(cluster: Cluster) -> list[str]:
    return ["FAB", "DESIGN_ID", *_names(cluster)]


def _keys(cluster: Cluster) -> list:
    return [named(c) for c in _group(cluster)]


def die_totals(unlabelled: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row: ``total_dies`` of both frames, ``dies_per_wafer`` median of the unlabelled."""
    middle = exact_quantiles(unlabelled, [], "TOTAL_DIE", {"dies_per_wafer": 0.5}, with_stats=False)
    count = unlabelled.agg(F.count(F.lit(1)).alias("total_dies"))
    if labelled is not None:
        more = labelled.agg(F.count(F.lit(1)).alias("_more"))
        count = count.crossJoin(F.broadcast(more)).select((F.col("total_dies") + F.col("_more")).alias("total_dies"))
    # Both sides are single rows.
    return count.crossJoin(F.broadcast(middle))


def cluster_wafer_counts(df: DataFrame, cluster: Cluster, probe_column: str) -> DataFrame:
    """Per (FAB, DESIGN_ID, cluster): distinct wafers and the probe item's sum.

    Summed per wafer first, so a wafer's dies are combined before they meet.
    """
    wafers = df.groupBy(*_keys(cluster), "lot_wafer").agg(F.sum(named(probe_column)).alias("_bins"))
    return wafers.groupBy(*_keys(cluster)).agg(
        F.count("lot_wafer").alias("num_wafers_in_cluster"), F.sum("_bins").alias("total_bin_count")
    )


def item_counts(df: DataFrame, cluster: Cluster, items: Sequence[str], position: Sequence[str] = ()) -> DataFrame:
    """Rows for each value of each item, per group and position: one long form for all
    statistics. Counts per group are rolled up from those per position (``rolled_up``)."""
    keys = [*position, *_group(cluster)]
    return value_counts(unpivot(df, keys, items, "stacked_item", "value"), [*keys, "stacked_item"], "value")


def rolled_up(counts: DataFrame, cluster: Cluster) -> DataFrame:
    """Counts per group and item, of counts that are per position too."""
    key = F.struct(*[F.col("_k").getField(c).alias(c) for c in (*_group(cluster), "stacked_item")])
    return counts.select(key.alias("_k"), "_v", "_n").groupBy("_k", "_v").agg(F.sum("_n").alias("_n"))


def _item_stats(counts: DataFrame, cluster: Cluster) -> DataFrame:
    stats = quantiles_of_counts(counts, {"die_median_value": 0.5}, with_stats=True)
    return keys_of(stats, [*_group(cluster), "stacked_item"]).select(
        *_keys(cluster),
        "stacked_item",
        F.col("n_values").alias("num_dies_in_cluster"),
        F.col("max_value").alias("die_max_value"),
        F.col("min_value").alias("die_min_value"),
        F.col("mean_value").alias("die_mean_value"),
        "die_median_value",
    )


def cluster_item_stats(df: DataFrame, cluster: Cluster, items: Sequence[str]) -> DataFrame:
    """Per group and item: non-null count, max, min, mean and median; an item that is all
    NULL has count 0.

    One long form and one pre-aggregation serve all five. The counts are held (an action where a
    shared folder is set): they are read for every step to a median, and Spark may count anew.
    """
    return _item_stats(hold(item_counts(df, cluster, items)), cluster)


def cluster_impact(df: DataFrame, cluster: Cluster, stack: Stack, totals: DataFrame) -> DataFrame:
    """Item statistics with wafer counts, die loss and impact per group and item.

    impact = mean · count / total dies; for a bin item it is the die loss, the bin sum
    per wafer and die.
    """
    return _impact(df, cluster_item_stats(df, cluster, stack.items), cluster, stack, totals)


def _impact(df: DataFrame, stats: DataFrame, cluster: Cluster, stack: Stack, totals: DataFrame) -> DataFrame:
    counts = cluster_wafer_counts(df, cluster, stack.probe_column)
    die_loss = F.try_divide(
        F.try_divide(F.col("total_bin_count").cast("double"), F.col("num_wafers_in_cluster")), F.col("dies_per_wafer")
    )
    impact = F.try_divide(F.col("die_mean_value") * F.col("num_dies_in_cluster"), F.col("total_dies"))
    if stack.bin_column is not None:
        impact = F.when(F.col("stacked_item") == stack.bin_column, F.col("die_loss")).otherwise(impact)
    return (
        stats.join(counts, _group(cluster))
        .crossJoin(F.broadcast(totals))
        .withColumn("die_loss", die_loss)
        .withColumn("impact", impact)
        .drop("total_dies", "dies_per_wafer")
    )


def _die_medians(counts: DataFrame, cluster: Cluster) -> DataFrame:
    keys = [*POSITION, *_group(cluster), "stacked_item"]
    return keys_of(quantiles_of_counts(counts, {"median_value": 0.5}), keys)


def stacked_die_median(df: DataFrame, cluster: Cluster, items: Sequence[str]) -> DataFrame:
    """(DieX, DieY, FAB, DESIGN_ID, cluster, stacked_item, median_value); NULL where a position
    has no value of an item. The counts are held, as in ``cluster_item_stats``."""
    return _die_medians(hold(item_counts(df, cluster, items, POSITION)), cluster)


def die_medians(df: DataFrame, cluster: Cluster, items: Sequence[str]) -> DataFrame:
    """The same medians wide: one row per position and group, one column per item."""
    return _wide(stacked_die_median(df, cluster, items), cluster, items)


def _wide(medians: DataFrame, cluster: Cluster, items: Sequence[str]) -> DataFrame:
    keys = [*[named(c) for c in POSITION], *_keys(cluster)]
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("stacked_item") == i, F.col("median_value"))).alias(i) for i in items]
    )


def _cluster_columns(cluster: Cluster) -> list:
    """A single cluster column is called ``cluster`` in the map; several keep their names."""
    return [named(cluster).alias("cluster")] if isinstance(cluster, str) else [named(c) for c in cluster]


def stacked_map(df: DataFrame, cluster: Cluster, stack: Stack, totals: DataFrame) -> DataFrame:
    """One row per position, group and stacked item; all register medians on each row.

    Values are counted once, per position, and the counts held (an action where a shared
    folder is set); the counts per group are rolled up from these.
    The medians are computed once; the long rows are spread from the wide ones, so
    only the small group statistics are joined.
    """
    everything = list(dict.fromkeys([*stack.items, *stack.registers]))
    counts = hold(item_counts(df, cluster, everything, POSITION))
    wide = _wide(_die_medians(counts, cluster), cluster, everything)
    entries = [
        F.struct(F.lit(i).alias("stacked_item"), named(i).alias("median_value")) for i in stack.items
    ]
    registers = [named(r) for r in stack.registers]
    long = wide.select(*POSITION, *_keys(cluster), *registers, F.inline(F.array(*entries)))
    impact = _impact(df, _item_stats(rolled_up(counts, cluster), cluster), cluster, stack, totals)
    item = F.when(F.col("stacked_item") == stack.probe_column, F.lit(stack.probe_item)).otherwise(F.col("stacked_item"))
    return (
        long.join(impact, [*_group(cluster), "stacked_item"])
        .withColumn("stacked_item", item)
        .select(
            "FAB",
            "DESIGN_ID",
            *POSITION,
            *_cluster_columns(cluster),
            "stacked_item",
            "num_wafers_in_cluster",
            "num_dies_in_cluster",
            "impact",
            "median_value",
            *registers,
            "die_max_value",
            "die_mean_value",
            "die_median_value",
            "die_min_value",
        )
    )


KNOWN_MODE = "known failure mode"


def by_failure_mode(labelled: DataFrame, modes: Sequence[str]) -> DataFrame:
    """One row per die and failure mode it shows, in column ``failure_mode``."""
    rest = [named(c) for c in labelled.columns if c not in modes]
    shown = F.array_compact(F.array(*[F.when(named(m) == 1, F.lit(m)) for m in modes]))
    return labelled.select(*rest, F.explode(shown).alias("failure_mode"))


def by_model(unlabelled: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per die and cluster model, in columns ``model`` and ``cluster``."""
    rest = [named(c) for c in unlabelled.columns if c not in models]
    labels = [F.struct(F.lit(m).alias("model"), named(m).alias("cluster")) for m in models]
    return unlabelled.select(*rest, F.inline(F.array(*labels)))


def stacked_maps(
    unlabelled: DataFrame, models: Sequence[str], stack: Stack, labelled: DataFrame | None = None,
    modes: Sequence[str] = (),
) -> DataFrame:
    """Stacked maps of every cluster model; known failure modes count as clusters of each.

    All models and modes go through one plan, keyed by (model, cluster). The modes are
    the same for every model, so they are stacked once and repeated at the end.
    """
    needed = ["FAB", "DESIGN_ID", *POSITION, "lot_wafer", *dict.fromkeys([*stack.items, *stack.registers])]
    totals = die_totals(unlabelled, labelled)
    rows = by_model(unlabelled.select(*[named(c) for c in needed], *[named(m) for m in models]), models)
    if labelled is not None and modes:
        known = by_failure_mode(labelled.select(*[named(c) for c in needed], *[named(m) for m in modes]), modes)
        known = known.withColumnRenamed("failure_mode", "cluster").withColumn("model", F.lit(KNOWN_MODE))
        rows = rows.unionByName(known)
    out = stacked_map(rows, ["model", "cluster"], stack, totals)
    if labelled is not None and modes:
        every = F.array(*[F.lit(m) for m in models])
        spread = F.when(F.col("model") == KNOWN_MODE, every).otherwise(F.array("model"))
        out = out.withColumn("model", F.explode(spread))
    return out


def cluster_pareto(
    stacked: DataFrame, registers: Sequence[str], item: str | None = None, top: int = PARETO_NUM
) -> DataFrame:
    """(model, cluster, position, register, register_median, cumpercentage).

    Per cluster the median over positions of each register's die medians; the largest
    ones, with their running share of the kept sum. Ties go by name. Every stacked item
    repeats the same register medians, so naming one ``item`` reads fewer rows for the
    same result.
    """
    rows = stacked if item is None else stacked.where(F.col("stacked_item") == item)
    long = unpivot(rows, ["model", "cluster"], registers, "register", "value")
    medians = exact_quantiles(long, ["model", "cluster", "register"], "value", {"register_median": 0.5})
    whole = Window.partitionBy("model", "cluster")
    order = whole.orderBy(F.desc("register_median"), F.asc("register"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        medians.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top)
        .withColumn(
            "cumpercentage",
            F.try_divide(F.sum("register_median").over(running), F.sum("register_median").over(whole)) * 100,
        )
        .select("model", "cluster", "position", "register", "register_median", "cumpercentage")
    )


def full_die_map(stacked: DataFrame) -> DataFrame:
    """The stacked map on a complete grid: every known position of a design for every
    (model, cluster, item), empty where the cluster has no die there. An unreadable
    position is a position like others."""
    grid = stacked.select("FAB", "DESIGN_ID", *POSITION).distinct()
    layers = stacked.select("model", "cluster", "stacked_item").distinct()
    keys = ["FAB", "DESIGN_ID", *POSITION, "model", "cluster", "stacked_item"]
    # Per position one array of layers: tens of entries, exploded within the task.
    all_layers = layers.agg(F.collect_list(F.struct("model", "cluster", "stacked_item")).alias("_layers"))
    complete = grid.crossJoin(F.broadcast(all_layers)).select(
        "FAB", "DESIGN_ID", *POSITION, F.inline("_layers")
    )
    values = stacked.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    # Sorted and merged: a held map's files are far smaller than its rows, too many for the driver.
    return complete.join(values.hint("merge"), same, "left").drop(*[f"_{k}" for k in keys])
