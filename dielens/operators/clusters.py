"""Cluster labels, centres and representative rows, on Spark ML estimators."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named, squared_distance
from dielens.operators.sweeps import bisecting_rounds, densest, grouped_points, mixture_rounds

SEED = 1
VECTOR = "_vector"


def feature_frame(df: DataFrame, features: Sequence[str], keep: bool = True) -> DataFrame:
    """``df`` with its features as one vector column; only the vector when not ``keep``."""
    safe = [f"_f{i}" for i in range(len(features))]
    columns = [named(f).alias(s) for f, s in zip(features, safe)]
    base = df.select("*", *columns) if keep else df.select(*columns)
    return VectorAssembler(inputCols=safe, outputCol=VECTOR).transform(base).drop(*safe)


def estimator(method: str, k: int, seed: int = SEED, max_iter: int | None = None):
    """The Spark ML estimator behind a method name."""
    kinds = {"kmeans": KMeans, "bisecting_kmeans": BisectingKMeans, "gmm": GaussianMixture}
    if method not in kinds:
        raise ValueError(f"unknown cluster method {method!r}")
    made = kinds[method](k=k, seed=seed, featuresCol=VECTOR, predictionCol="_prediction")
    return made.setMaxIter(max_iter) if max_iter else made


def fit_and_label(
    df: DataFrame, features: Sequence[str], method: str, k: int, label: str, seed: int = SEED,
    max_iter: int | None = None,
):
    """(labelled frame, model). Labels start at 1, bisecting ones at 0.

    No features or k = 1 is a single cluster and no model.
    """
    first = 0 if method == "bisecting_kmeans" else 1
    if not features or k <= 1:
        return df.withColumn(label, F.lit(first).cast("int")), None
    if method == "gmm":
        model = fit_mixture(df, features, k, seed, max_iter)
        return df.withColumn(label, densest(model.weights, model.means, model.covariances, [named(f).cast("double") for f in features])), model
    if method == "bisecting_kmeans":
        tree = fit_bisecting(df, features, k, seed, max_iter)
        return df.withColumn(label, tree_label([named(f).cast("double") for f in features], tree).cast("int")), tree
    vectors = feature_frame(df, features)
    model = estimator(method, k, seed, max_iter).fit(vectors.select(VECTOR))
    scored = model.transform(vectors)
    out = scored.withColumn(label, (F.col("_prediction") + first).cast("int"))
    return out.drop(VECTOR, "_prediction", "probability"), model


@dataclass(frozen=True)
class Mixture:
    """A fitted Gaussian mixture with full covariances."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray


def fit_mixture(df: DataFrame, features: Sequence[str], k: int, seed: int = SEED, max_iter: int | None = None) -> Mixture:
    """Spark ML's Gaussian mixture: its estimator draws the first components, then its steps run
    on blocks of rows (``sweeps.mixture_rounds``), which takes a fraction of the time."""
    wanted = estimator("gmm", k, seed, max_iter)
    first = wanted.copy({wanted.maxIter: 0}).fit(feature_frame(df, features, keep=False))
    means, covariances = mixture_parts(first)
    points = grouped_points(df, F.lit(0), F.array(*[named(f).cast("double") for f in features]))
    start = np.array(first.weights), np.array(means), np.array(covariances)
    return Mixture(*mixture_rounds(points, *start, wanted.getMaxIter(), wanted.getTol()))


def fit_bisecting(df: DataFrame, features: Sequence[str], k: int, seed: int = SEED, max_iter: int | None = None) -> Tree:
    """The divisions of Spark ML's bisecting k-means, its labels numbered from left to right. Its estimator
    takes the first step; the others run on blocks of rows (``sweeps.bisecting_rounds``), where Spark ML
    keeps an object for each row. Of centred rows the first step is decided by how their mean is rounded:
    a division that leaves a part empty counts as one of the k - 1, and the next one is tried."""
    wanted, vectors = estimator("bisecting_kmeans", k, seed, max_iter), feature_frame(df, features, keep=False)
    for lost in range(k - 1):
        first = estimator("bisecting_kmeans", 2 + lost, seed, 1).fit(vectors).clusterCenters()
        if len(first) > 1:
            break
    else:
        return 0
    draws = df.sparkSession._jvm.java.util.Random(seed)
    noise = lambda d: np.array([draws.nextDouble() for _ in range(d)])
    noise(lost * len(features))
    points = grouped_points(df, F.lit(0), F.array(*[named(f).cast("double") for f in features]))
    centres = bisecting_rounds(points, k - lost, first, noise, wanted.getMaxIter())
    labels = itertools.count()

    def below(n: int) -> Tree:
        parts = [p for p in (2 * n + 1, 2 * n + 2) if p in centres]
        if not parts:
            return next(labels)
        if len(parts) == 1:
            return below(parts[0])
        left, right = (tuple(map(float, centres[p])) for p in parts)
        return left, below(parts[0]), right, below(parts[1])

    return below(0)


def cluster(
    df: DataFrame, method: str, k: int, features: Sequence[str], label: str, seed: int = SEED
) -> DataFrame:
    """One call for every method: ``df`` plus its label column."""
    return fit_and_label(df, features, method, k, label, seed)[0]


def log_density(point: Sequence[Column], mean: np.ndarray, covariance: np.ndarray) -> Column | None:
    """Normal log density as a column expression; None when the covariance is singular."""
    sign, log_det = np.linalg.slogdet(covariance)
    if sign <= 0 or not math.isfinite(log_det):
        return None
    precision = np.linalg.inv(covariance)
    shifted = [p - F.lit(float(m)) for p, m in zip(point, mean)]
    distance = F.lit(0.0)
    for i, a in enumerate(shifted):
        for j in range(i, len(shifted)):
            weight = float(precision[i, j]) * (1.0 if i == j else 2.0)
            distance = distance + F.lit(weight) * a * shifted[j]
    constant = len(shifted) * math.log(2 * math.pi) + float(log_det)
    return F.lit(-0.5) * (distance + F.lit(constant))


def component_representatives(
    df: DataFrame, features: Sequence[str], means: Sequence[np.ndarray], covariances: Sequence[np.ndarray]
) -> DataFrame:
    """(component, features...): the row where each component is densest, 1-based.

    One aggregate for all components. A singular covariance gives zeros.
    """
    point = [named(f) for f in features]
    row = F.struct(*[named(f).alias(f) for f in features])
    zeros = F.struct(*[F.lit(0.0).alias(f) for f in features])
    # Equal densities go to the smallest row, so that the pick is repeatable.
    picks = []
    for i, (mean, covariance) in enumerate(zip(means, covariances)):
        density = log_density(point, np.asarray(mean), np.asarray(covariance))
        best = (
            F.max(F.struct(density.alias("density"), row.alias("row"))).getField("row")
            if density is not None
            else F.first(zeros)
        )
        picks.append(best.alias(f"r{i}"))
    best_rows = df.agg(*picks)
    entries = [
        F.struct(
            F.lit(i + 1).alias("component"), *[F.col(f"r{i}").getField(f).alias(f) for f in features]
        )
        for i in range(len(picks))
    ]
    return best_rows.select(F.inline(F.array(*entries)))


def mixture_parts(model) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Means and covariances of a fitted Gaussian mixture (k small matrices)."""
    if isinstance(model, Mixture):
        return list(model.means), list(model.covariances)
    gaussians = model.gaussians
    return [g.mean.toArray() for g in gaussians], [g.cov.toArray() for g in gaussians]


def mixture_labels(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], means: Sequence, covariances: Sequence, label: str
) -> DataFrame:
    """Adds ``label``, the 1-based likeliest component of a mixture given by its parts; the
    first on a tie, and never one with a singular covariance."""
    point = [named(f) for f in features]
    scores = []
    for weight, mean, covariance in zip(weights, means, covariances):
        density = log_density(point, np.asarray(mean), np.asarray(covariance))
        scores.append(F.lit(float("-inf")) if density is None else density + F.lit(math.log(weight)))
    best = F.array_position(F.array(*scores), F.array_max(F.array(*scores)))
    return df.withColumn(label, best.cast("int"))


def mixture_log_likelihood(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], means: Sequence, covariances: Sequence
) -> DataFrame:
    """One row (rows, log_likelihood) of a mixture given by its parts; no singular covariance."""
    point = [named(f) for f in features]
    scores = F.array(
        *[
            log_density(point, np.asarray(m), np.asarray(c)) + F.lit(math.log(w))
            for w, m, c in zip(weights, means, covariances)
        ]
    )
    top = F.array_max(scores)
    mass = F.aggregate(scores, F.lit(0.0), lambda total, s: total + F.exp(s - top))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(top + F.log(mass)).alias("log_likelihood"))


#: A division of a cluster: the centres of its two parts, each a label or divided again.
Tree = int | tuple[tuple[float, ...], "Tree", tuple[float, ...], "Tree"]


def tree_label(point: Sequence[Column], tree: Tree) -> Column:
    """The label of a point under a tree of divisions: at each the nearer centre, the first
    on a tie."""
    if isinstance(tree, int):
        return F.lit(tree)
    left, below_left, right, below_right = tree
    nearer = squared_distance(point, left) <= squared_distance(point, right)
    return F.when(nearer, tree_label(point, below_left)).otherwise(tree_label(point, below_right))
