"""Choosing the number of clusters: cost curves, BIC and silhouettes.

Every fit reads all rows, packed once. K-means, bisecting and mixture sweeps and silhouettes
share their scans (``sweeps``). What returns to the driver is a few numbers per k.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce
from statistics import median

from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named, squared_distance
from dielens.operators.clusters import SEED, VECTOR
from dielens.operators.knee import bic_choice, knee_point
from dielens.operators.sweeps import (
    GROUP,
    POINT,
    centre_labels,
    divided,
    group_sizes,
    grouped_points,
    held_blocks,
    kmeans_sweep,
    mixture_sweep,
    part_costs,
    silhouettes,
)


@contextmanager
def cached(df: DataFrame):
    """The frame kept for the block; spills to disk, recomputed when an executor is lost."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _curve(df: DataFrame, rows: list[tuple], names: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, names)


def _points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return grouped_points(df, F.lit(0), F.array(*[named(f).cast("double") for f in features]))


def kmeans_cost_sweep(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 20), seed: int = SEED, max_iter: int = 20
) -> DataFrame:
    """(k, cost): within-cluster sum of squares for each k; all k share each scan."""
    with held_blocks(_points(df, features)) as points:
        sizes = group_sizes(points)
        fits = kmeans_sweep(points, [(0, int(k)) for k in ks], sizes, seed, max_iter)
    return _curve(df, [(f.k, f.cost) for f in fits], "k int, cost double")


def bisecting_cost_sweep(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 20), seed: int = SEED,
    max_iter: int | None = None,
) -> DataFrame:
    """(k, cost) by bisecting k-means, level by level, the largest clusters first.

    All k share one tree: on each level they divide the same clusters, up to the number each
    still needs. A level's divisions share their scans of the one copy of the points.
    """
    with held_blocks(_points(df, features)) as points:
        sizes = group_sizes(points)
        whole = kmeans_sweep(points, [(0, 1)], sizes, seed, 1)[0].cost if sizes else 0.0
        nodes = {0: (sizes.get(0, 0), whole)}  # node: rows, cost; its parts are 2n + 1 and 2n + 2
        level, most, levels = points, max(ks), []
        bottom, leaves = [0], 1
        while leaves < most:
            able = sorted((n for n in bottom if nodes[n][0] > 1 and nodes[n][1] > 1e-12), key=lambda n: (-nodes[n][0], n))
            chosen = able[: most - leaves]
            if not chosen:
                break
            counts = {n: nodes[n][0] for n in chosen}
            fits = kmeans_sweep(level, [(n, 2) for n in chosen], counts, seed, max_iter or 20)
            parts = {f.group: {2 * f.group + 1: f.centres[0], 2 * f.group + 2: f.centres[1]} for f in fits}
            nodes.update(part_costs(level, parts))
            level = divided(level, parts)
            levels.append(chosen)
            bottom = [part for n in chosen for part in (2 * n + 1, 2 * n + 2) if part in nodes]
            leaves += len(bottom) - len(chosen)
    return _curve(df, [(int(k), _tree_cost(nodes, levels, int(k))) for k in ks], "k int, cost double")


def _tree_cost(nodes: dict, levels: list[list[int]], k: int) -> float:
    """Sum of the costs of the leaves when the tree has k of them (fewer, if it cannot)."""
    leaves = {0}
    for chosen in levels:
        for n in [n for n in chosen if n in leaves][: k - len(leaves)]:
            leaves.remove(n)
            leaves.update(part for part in (2 * n + 1, 2 * n + 2) if part in nodes)
    return float(sum(nodes[n][1] for n in leaves))


def elbow_k(curve: DataFrame, k: str = "k", cost: str = "cost") -> int:
    """The knee of a falling convex curve; 1 where there is none."""
    return knee_point(curve, [], k, cost).first()["knee"]


def one_cluster_costs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row (distortion, inertia) for k = 1, which the estimators refuse."""
    means = df.agg(*[F.avg(named(f)).alias(f"mu{i}") for i, f in enumerate(features)])
    squared = reduce(
        lambda a, b: a + b,
        [(named(f) - F.col(f"mu{i}")) * (named(f) - F.col(f"mu{i}")) for i, f in enumerate(features)],
    )
    return (
        df.select(*[named(f) for f in features])
        .crossJoin(F.broadcast(means))
        .agg(F.avg(F.sqrt(squared)).alias("distortion"), F.sum(squared).alias("inertia"))
    )


def elbow_curves(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(1, 20), seed: int = SEED, max_iter: int = 20
) -> DataFrame:
    """(k, distortion, inertia) for every k up to the number of rows.

    Distortion is the mean distance to the nearest centre, inertia the sum of squares.
    """
    with held_blocks(_points(df, features)) as points:
        sizes = group_sizes(points)
        wanted = [(0, int(k)) for k in ks if k <= sizes.get(0, 0)]
        fits = kmeans_sweep(points, wanted, sizes, seed, max_iter) if wanted else []
    return _curve(
        df, [(f.k, f.distortion, f.cost) for f in fits], "k int, distortion double, inertia double"
    )


def two_curve_k(curves: DataFrame) -> int:
    """``ceil(median(knees))`` of the distortion and the inertia curve."""
    return math.ceil(median([elbow_k(curves, cost="distortion"), elbow_k(curves, cost="inertia")]))


def mixture_bic(log_likelihood: float, k: int, d: int, n_rows: int) -> float:
    """Bayesian information criterion of a full-covariance mixture."""
    parameters = (k - 1) + k * d + k * d * (d + 1) / 2
    return -2.0 * log_likelihood + parameters * math.log(n_rows)


def mixture_aic(log_likelihood: float, k: int, d: int) -> float:
    """Akaike's criterion of the same mixture; reported, not used to choose."""
    return -2.0 * log_likelihood + 2.0 * ((k - 1) + k * d + k * d * (d + 1) / 2)


def gmm_bic_sweep(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(1, 10), seed: int = SEED, max_iter: int = 100
) -> DataFrame:
    """(k, bic, aic) per tried number of components; no rows when too few dies to split."""
    with held_blocks(_points(df, features)) as points:
        sizes = group_sizes(points)
        n_rows = sizes.get(0, 0)
        wanted = [(0, int(k)) for k in ks] if n_rows > max(ks) else []
        fits = mixture_sweep(points, wanted, sizes, seed, max_iter) if wanted else []
    d = len(features)
    rows = [
        (f.k, mixture_bic(f.log_likelihood, f.k, d, n_rows), mixture_aic(f.log_likelihood, f.k, d)) for f in fits
    ]
    return _curve(df, rows, "k int, bic double, aic double")


def bic_k(curve: DataFrame) -> int:
    """The k a BIC curve asks for; 1 for an empty curve."""
    row = bic_choice(curve, []).first()
    return (row["chosen_k"] if row is not None else None) or 1


def label_silhouette(labelled: DataFrame) -> float | None:
    """Mean silhouette by squared distances of labelled vectors; None for a single label."""
    if not labelled.agg(F.min("_prediction") != F.max("_prediction")).first()[0]:
        return None
    return float(ClusteringEvaluator(featuresCol=VECTOR, predictionCol="_prediction").evaluate(labelled))


def score_labels(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    """One row (silhouette) for labels given as a column."""
    vectors = F.array(*[named(f).cast("double") for f in features])
    labelled = df.select(array_to_vector(vectors).alias(VECTOR), label.cast("double").alias("_prediction"))
    return _curve(df, [(label_silhouette(labelled),)], "silhouette double")


def costs_of_centres(df: DataFrame, features: Sequence[str], sets: Sequence[Sequence[Sequence[float]]]) -> DataFrame:
    """(k, distortion, inertia) of given sets of centres, all in one scan."""
    point = [named(f) for f in features]
    sums = []
    for i, centres in enumerate(sets):
        nearest = F.array_min(F.array(*[squared_distance(point, centre) for centre in centres]))
        sums += [F.avg(F.sqrt(nearest)).alias(f"d{i}"), F.sum(nearest).alias(f"s{i}")]
    rows = [
        F.struct(F.lit(len(c)).alias("k"), F.col(f"d{i}").alias("distortion"), F.col(f"s{i}").alias("inertia"))
        for i, c in enumerate(sets)
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def silhouette_sweep(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 20), method: str = "kmeans",
    seed: int = SEED, max_iter: int | None = None,
) -> DataFrame:
    """(k, silhouette, cost) for k-means or a mixture; mixtures have no cost.

    The fits share their scans, and so do the scores of the labels of all k.
    """
    with held_blocks(_points(df, features)) as points:
        sizes = group_sizes(points)
        wanted = [(0, int(k)) for k in ks]
        if method == "kmeans":
            fits = kmeans_sweep(points, wanted, sizes, seed, max_iter or 20)
            labels = centre_labels([f.centres for f in fits])
        elif method == "gmm":
            fits = mixture_sweep(points, wanted, sizes, seed, max_iter or 100)
            labels = lambda rows: [f.labels(rows) for f in fits]
        else:
            raise ValueError(f"no silhouette sweep for method {method!r}")
        scores = silhouettes(points, [f.k for f in fits], labels)
    rows = [(f.k, score, f.cost if method == "kmeans" else None) for f, score in zip(fits, scores)]
    return _curve(df, rows, "k int, silhouette double, cost double")


def silhouette_k(curve: DataFrame) -> int:
    """First k of the best silhouette; with a cost curve, the upper median with its knee."""
    best = curve.agg(F.max_by("k", F.struct("silhouette", (-F.col("k")).alias("_first"))).alias("k")).first()["k"]
    costed = curve.where(F.col("cost").isNotNull())
    knee = best if costed.isEmpty() else elbow_k(costed)
    return math.ceil(median([best, knee]))
