"""Outlier cuts, transforms, scaling and principal components."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.functions.quantiles import exact_quantiles, lattice_cell
from dielens.functions.scalars import named
from dielens.operators.gram import pair_sums
from dielens.plans.hold import hold

CUT_QUANTILE = 0.99999


def _cut(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    for column, limit in thresholds.items():
        df = df.where(named(column) <= F.lit(limit))
    return df


def _histograms(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[int, tuple[int, float, float]]]:
    """Per column: lattice cell -> (rows, smallest, largest value). Bounded by the lattice."""
    if not columns:
        return {}
    long = df.unpivot([], [named(c) for c in columns], "register", "value").where("value is not null")
    cells = long.groupBy("register", lattice_cell(F.col("value")).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    found: dict[str, dict] = {c: {} for c in columns}
    for r in cells.collect():
        found[r["register"]][r["cell"]] = (r["n"], r["lo"], r["hi"])
    return found


def _cell_at(cells: dict[int, tuple[int, float, float]], rank: int) -> int:
    seen = 0
    for cell in sorted(cells):
        seen += cells[cell][0]
        if rank < seen:
            return cell
    return max(cells)


def quantile_cut(
    df: DataFrame, columns: Sequence[str], probability: float = CUT_QUANTILE
) -> tuple[DataFrame, dict[str, float]]:
    """Cuts extreme values column by column, each quantile on the rows left so far.

    Action (cache ``df``): one scan counts all columns on the quantile lattice; a
    column that cut rows takes one selective scan to subtract them from the counts of
    the columns after it. A quantile inside a cell of several values is taken exactly
    from the rows left. The result is ``df`` with one literal filter per cut column.
    """
    thresholds: dict[str, float] = {}
    histograms = _histograms(df, columns)
    for i, column in enumerate(columns):
        cells = {c: v for c, v in histograms[column].items() if v[0] > 0}
        total = sum(n for n, _, _ in cells.values())
        if not total:
            continue
        top, mid = probability * (total - 1), 0.5 * (total - 1)
        needed = [_cell_at(cells, rank(p)) for p in (top, mid) for rank in (math.floor, math.ceil)]
        if all(cells[c][1] == cells[c][2] for c in needed):
            low, high, mid_low, mid_high = (cells[c][1] for c in needed)
            top_value = low + (high - low) * (top - math.floor(top))
            mid_value = mid_low + (mid_high - mid_low) * (mid - math.floor(mid))
        else:
            row = exact_quantiles(_cut(df, thresholds), [], column, {"top": probability, "mid": 0.5}).first()
            top_value, mid_value = row["top"], row["mid"]
        if top_value > mid_value:
            if any(hi > top_value for _, _, hi in cells.values()):
                gone = _cut(df, thresholds).where(named(column) > F.lit(top_value))
                for later, removed in _histograms(gone, columns[i + 1 :]).items():
                    for cell, (n, _, _) in removed.items():
                        kept, lo, hi = histograms[later][cell]
                        histograms[later][cell] = (kept - n, lo, hi)
            thresholds[column] = top_value
    return _cut(df, thresholds), thresholds


def quantile_cut_single_pass(
    df: DataFrame, columns: Sequence[str], probability: float = CUT_QUANTILE
) -> DataFrame:
    """The same cut with every quantile taken on all rows, in one lazy plan."""
    long = df.unpivot([], [named(c) for c in columns], "register", "value")
    cuts = exact_quantiles(long, ["register"], "value", {"top": probability, "mid": 0.5})
    limits = cuts.agg(
        *[
            F.max(F.when((F.col("register") == c) & (F.col("top") > F.col("mid")), F.col("top"))).alias(f"q{i}")
            for i, c in enumerate(columns)
        ]
    )
    kept = df.crossJoin(F.broadcast(limits))
    for i, c in enumerate(columns):
        kept = kept.where(F.col(f"q{i}").isNull() | (named(c) <= F.col(f"q{i}")))
    return kept.drop(*[f"q{i}" for i in range(len(columns))])


def label_wafer_outliers(
    df: DataFrame, items: Sequence[str], n_sigma: float = 3.0, label: str = "ooc_label"
) -> DataFrame:
    """Marks dies of wafers whose mean lies above median + n·sd of all wafer means.

    Items are taken in order; a wafer marked by one item does not count for the next.
    Action: the dies are aggregated once to a held frame of one row per wafer; each item
    then takes two small aggregates of it, and its limit goes into the plan as a literal.
    """
    wafers = hold(df.groupBy("lot_wafer").agg(*[F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(items)]))
    out = F.lit(False)
    for i in range(len(items)):
        normal = wafers.where(~out)
        middle = exact_quantiles(normal, [], f"m{i}", {"mid": 0.5}).first()
        spread = normal.agg(F.stddev_samp(f"m{i}")).first()[0]
        if middle is not None and spread is not None:
            limit = F.lit(middle["mid"]) + F.lit(float(n_sigma)) * F.lit(spread)
            out = out | F.coalesce(F.col(f"m{i}") > limit, F.lit(False))
    marked = wafers.where(out).select("lot_wafer", F.lit("outlier_map").alias(label))
    return df.join(marked, "lot_wafer", "left").withColumn(label, F.coalesce(F.col(label), F.lit("Normal")))


def split_wafer_outliers(df: DataFrame, items: Sequence[str], n_sigma: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(normal dies, outlier dies)."""
    labelled = label_wafer_outliers(df, items, n_sigma)
    return labelled.where("ooc_label = 'Normal'"), labelled.where("ooc_label = 'outlier_map'")


def norm_name(column: str) -> str:
    return f"{column}_norm"


def cube_root(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_norm``, the cube root."""
    return df.withColumns({norm_name(c): F.cbrt(named(c)) for c in columns})


def _means_and_spreads(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population sd per column. A constant column has sd 0 exactly: merged
    partial variances leave rounding noise, so its range decides."""
    return df.agg(
        *[F.avg(named(c)).alias(f"mu{i}") for i, c in enumerate(columns)],
        *[
            F.when(F.min(named(c)) < F.max(named(c)), F.stddev_pop(named(c))).otherwise(F.lit(0.0)).alias(f"sd{i}")
            for i, c in enumerate(columns)
        ],
    )


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_norm`` with mean 0 and population sd 1; a constant column is 0.

    Action: one aggregate; the two numbers per column go into the plan as literals.
    """
    row = _means_and_spreads(df, columns).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, spread = row[f"mu{i}"], row[f"sd{i}"]
        shifted = named(c) - F.lit(mean)
        flat = F.when(named(c).isNotNull(), F.lit(0.0))
        scaled[norm_name(c)] = shifted / F.lit(spread) if spread else flat
    return df.withColumns(scaled)


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, covariance) for a <= b in the given order; sample covariance.

    All pairs come from one scan (``gram.pair_sums``).
    """
    names = F.array(*[F.lit(c) for c in columns])
    between = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    return pair_sums(df, None, columns).select(
        F.get(names, F.col("i")).alias("column_a"),
        F.get(names, F.col("j")).alias("column_b"),
        F.when(F.col("n") > 1, F.try_divide(between, F.col("n") - 1)).alias("covariance"),
    )


@dataclass(frozen=True)
class Components:
    """Principal components found: output columns and their share of the variance."""

    columns: tuple[str, ...]
    shares: tuple[float, ...]


def _centred_vector(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[float]]:
    row = _means_and_spreads(df, columns).first()
    shifted = [(named(c) - F.lit(row[f"mu{i}"])).alias(f"_c{i}") for i, c in enumerate(columns)]
    names = [f"_c{i}" for i in range(len(columns))]
    assembler = VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="error")
    centred = assembler.transform(df.select("*", *shifted)).drop(*names)
    return centred, [row[f"sd{i}"] ** 2 for i in range(len(columns))]


def _spread_scores(df: DataFrame, scores: str, names: Sequence[str], divisors: Sequence[float]) -> DataFrame:
    values = vector_to_array(F.col(scores))
    columns = {n: F.get(values, F.lit(i)) / F.lit(d) for i, (n, d) in enumerate(zip(names, divisors))}
    return df.withColumns(columns).drop("_features", scores)


def pca_scores(df: DataFrame, columns: Sequence[str], max_components: int = 6) -> tuple[DataFrame, Components]:
    """Adds ``PC1..`` scores on centred columns, at most ``max_components`` of them."""
    k = min(max_components, len(columns))
    centred, _ = _centred_vector(df, columns)
    model = PCA(k=k, inputCol="_features", outputCol="_scores").fit(centred)
    names = [f"PC{i + 1}" for i in range(k)]
    out = _spread_scores(model.transform(centred), "_scores", names, [1.0] * k)
    return out, Components(tuple(names), tuple(model.explainedVariance.toArray()))


def pca_by_share(df: DataFrame, columns: Sequence[str], share: float) -> tuple[DataFrame, Components]:
    """The fewest components that explain ``share`` of the variance, scaled to unit variance."""
    centred, variances = _centred_vector(df, columns)
    n_rows = centred.count()
    model = PCA(k=len(columns), inputCol="_features", outputCol="_scores").fit(centred)
    shares = model.explainedVariance.toArray()
    reached = [i for i in range(len(shares)) if shares[: i + 1].sum() >= share - 1e-12]
    k = reached[0] + 1 if reached else len(shares)
    sample_variance = sum(variances) * n_rows / max(n_rows - 1, 1)
    spreads = [(s * sample_variance) ** 0.5 or 1.0 for s in shares[:k]]
    names = [f"PC{i + 1}" for i in range(k)]
    out = _spread_scores(model.transform(centred), "_scores", names, spreads)
    return out, Components(tuple(names), tuple(shares[:k]))


def project(
    df: DataFrame, columns: Sequence[str], means: Sequence[float], loadings: Sequence[Sequence[float]], spreads: Sequence[float]
) -> DataFrame:
    """Adds ``PC1..``: scores on components that are given, centred and divided by their spreads."""
    scores = {}
    for i, (weights, spread) in enumerate(zip(loadings, spreads)):
        total = F.lit(0.0)
        for c, m, w in zip(columns, means, weights):
            total = total + (named(c) - F.lit(float(m))) * F.lit(float(w))
        scores[f"PC{i + 1}"] = total / F.lit(float(spread))
    return df.withColumns(scores)
