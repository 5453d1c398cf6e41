"""Wafers as grids: dense values per position, scaling, equalising, clustering."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.quantiles import exact_quantiles
from dielens.functions.scalars import named
from dielens.operators.choose_k import cached, elbow_curves, two_curve_k
from dielens.operators.clusters import SEED, fit_and_label
from dielens.plans.hold import hold

# The task functions travel to the executors with the job; nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WAFER = ("LOT_ID", "WAFER_ID")
TOP_QUANTILE = 0.97
LEVELS = 256


def _extents(df: DataFrame, design: Sequence[str]) -> DataFrame:
    """Smallest coordinates and extent of the die grid, a row for each design."""
    return df.groupBy(*design).agg(
        F.min("DieX").alias("_x0"),
        F.min("DieY").alias("_y0"),
        (F.max("DieX") - F.min("DieX")).alias("_dx"),
        (F.max("DieY") - F.min("DieY")).alias("_dy"),
    )


def wafer_grid(df: DataFrame, value: str, order: Sequence[str], design: Sequence[str] = ()) -> DataFrame:
    """(design, LOT_ID, WAFER_ID, x, y, value): every position of the grid for every wafer.

    Positions start at 0; empty ones hold 0; a position measured again takes the value
    that comes last by ``order``. The grid is the extent of the dies of the wafer's design
    (of all dies, if no columns name one), so a stray coordinate grows the grids of its own
    design only. A wafer's values are one map, spread out within the task.
    """
    wafer = [*design, *WAFER]
    last = F.max_by(named(value), F.struct(*[named(c) for c in order]))
    measured = df.groupBy(*wafer, "DieX", "DieY").agg(last.alias("_v"))
    # one entry for each die position of a wafer, as in its dense grid
    wafers = measured.groupBy(*wafer).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("DieX", "DieY"), "_v"))).alias("_at"))
    extents = _extents(df, design)
    if design:
        named_apart = extents.withColumnsRenamed({c: f"_{c}" for c in design})
        placed = wafers.join(named_apart, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in design])
    else:
        placed = wafers.crossJoin(F.broadcast(extents))  # a single row
    spread = placed.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("_dx")))).withColumn(
        "y", F.explode(F.sequence(F.lit(0), F.col("_dy")))
    )
    there = F.struct((F.col("x") + F.col("_x0")).alias("DieX"), (F.col("y") + F.col("_y0")).alias("DieY"))
    return spread.select(*wafer, "x", "y", F.coalesce(F.try_element_at("_at", there), F.lit(0.0)).alias("value"))


def value_range(df: DataFrame, value: str, top: float = TOP_QUANTILE) -> DataFrame:
    """One row (low, high): the minimum and the ``top`` quantile of all values."""
    return exact_quantiles(df, [], value, {"high": top}, with_stats=True).select(
        F.col("min_value").alias("low"), "high"
    )


def minmax_scale(df: DataFrame, value: str, bounds: DataFrame, out: str = "scaled") -> DataFrame:
    """Adds ``out``: the value between ``low`` and ``high`` as 0..1, clamped; flat ranges are 0."""
    part = F.try_divide(named(value) - F.col("low"), F.col("high") - F.col("low"))
    scaled = F.when(named(value).isNotNull(), F.coalesce(F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)))
    return df.crossJoin(F.broadcast(bounds)).withColumn(out, scaled).drop("low", "high")


def equalise_levels(df: DataFrame, scaled: str = "scaled", keys: Sequence[str] = WAFER) -> DataFrame:
    """Adds ``level`` (0..255) and ``equalised``: levels spread by their cumulative count.

    The histogram has at most 256 rows per wafer and is joined back.
    """
    levelled = df.withColumn("level", F.floor(named(scaled) * (LEVELS - 1)).cast("int"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    histogram = (
        levelled.groupBy(*keys, "level")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_cdf": F.sum("_n").over(running), "_all": F.sum("_n").over(whole)})
        .withColumn("_first", F.min("_cdf").over(whole))
    )
    spread_out = F.try_divide((F.col("_cdf") - F.col("_first")) * (LEVELS - 1), F.col("_all") - F.col("_first"))
    # A wafer of one level keeps it.
    table = histogram.select(*keys, "level", F.coalesce(F.rint(spread_out), F.col("level")).cast("int").alias("equalised"))
    return levelled.join(table, [*keys, "level"])


def wafer_top_register(df: DataFrame, registers: Sequence[str]) -> DataFrame:
    """(LOT_ID, WAFER_ID, top_register): the register with the largest sum, first on a tie."""
    sums = df.groupBy(*WAFER).agg(*[F.sum(named(r)).alias(f"s{i}") for i, r in enumerate(registers)])
    totals = F.array(*[F.coalesce(F.col(f"s{i}"), F.lit(float("-inf"))) for i in range(len(registers))])
    names = F.array(*[F.lit(r) for r in registers])
    return sums.select(*WAFER, F.get(names, (F.array_position(totals, F.array_max(totals)) - 1).cast("int")).alias("top_register"))


def wafer_vectors(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """(LOT_ID, WAFER_ID, grid): each wafer's scaled, equalised grid as one array, row by row.

    An array has one entry per die position, whatever the number of dies tested.
    """
    scaled = minmax_scale(wafer_grid(df, value, order), "value", value_range(df, value))
    pixels = equalise_levels(scaled)
    ordered = F.array_sort(F.collect_list(F.struct("x", "y", F.col("equalised").cast("double").alias("v"))))
    return pixels.groupBy(*WAFER).agg(ordered.alias("_pixels")).select(*WAFER, F.col("_pixels.v").alias("grid"))


#: Extra directions and rounds of the subspace iteration.
OVERSAMPLED, ROUNDS = 10, 7
#: Positions whose sums travel together.
BLOCK = 1024


def _block_sums(vectors: DataFrame, columns: int, fold: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of ``fold`` of a batch of them (positions x columns), by blocks of
    positions: tasks add up their rows, Spark adds the tasks' blocks."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in stream:
            if batch.num_rows:
                part = fold(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                total = part if total is None else total + part
        if total is not None:
            cuts = [total[a : a + BLOCK].ravel().tolist() for a in range(0, len(total), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array(cuts, pa.list_(pa.float64()))], ["block", "sums"])

    parts = vectors.mapInArrow(task, "block int, sums array<double>")
    added = parts.groupBy("block").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    rows = sorted(added.collect(), key=lambda r: r["block"])
    return np.concatenate([r["sums"].toArray().reshape(-1, columns) for r in rows])


def leading_components(vectors: DataFrame, components: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(mean, components as columns) of the rows of an array column, largest spread first.

    Subspace iteration from random directions: a round is one job in which the tasks multiply
    their rows with the directions and back. The driver holds positions x directions, never
    positions x positions; signs are fixed by the largest entry.
    """
    n = vectors.count()
    mean = _block_sums(vectors, 1, lambda rows: rows.sum(0)[:, None])[:, 0] / n
    k = min(components, len(mean), n)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), min(k + OVERSAMPLED, len(mean), n))))[0]
    for _ in range(ROUNDS):
        current = basis
        product = _block_sums(vectors, current.shape[1], lambda rows: (rows - mean).T @ ((rows - mean) @ current))
        basis = np.linalg.qr(product)[0]
    spread = basis.T @ _block_sums(vectors, basis.shape[1], lambda rows: (rows - mean).T @ ((rows - mean) @ basis))
    values, turned = np.linalg.eigh((spread + spread.T) / 2)
    found = basis @ turned[:, np.argsort(-values)[:k]]
    return mean, found * np.sign(found[np.abs(found).argmax(0), np.arange(k)])


def wafer_clusters(
    df: DataFrame, value: str, order: Sequence[str], label: str, components: int = 10,
    ks: Sequence[int] = range(2, 30), seed: int = SEED,
) -> DataFrame:
    """Adds ``label`` to the dies: whole wafers clustered on their grids.

    Grids are reduced to their leading components, k comes from the two elbow curves, and the
    label of a wafer is joined to its dies.
    """
    with cached(wafer_vectors(df, value, order)) as wafers:
        mean, axes = leading_components(wafers.select("grid"), components, seed)
        names = [f"PC{i + 1}" for i in range(axes.shape[1])]

        @F.pandas_udf("array<double>")
        def scores(grids: pd.Series) -> pd.Series:
            return pd.Series(list((np.stack(grids.to_numpy()) - mean) @ axes))

        scored = wafers.select(*WAFER, scores("grid").alias("_scores"))
        with cached(scored.select(*WAFER, *[F.get("_scores", F.lit(i)).alias(n) for i, n in enumerate(names)])) as features:
            chosen = two_curve_k(elbow_curves(features, names, ks, seed))
            labelled, _ = fit_and_label(features, names, "kmeans", chosen, label, seed)
            # a row a wafer, kept while the features are
            held = hold(labelled.select(*WAFER, label))
            held.count()
    return df.join(held, list(WAFER), "left")
