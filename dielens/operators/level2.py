"""Level 2: split each cluster by a mixture on its strongest registers, then merge
the subgroups again by how alike their register-to-register slopes are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.quantiles import exact_quantiles
from dielens.functions.scalars import named, penalised_slope
from dielens.operators.choose_k import cached, elbow_curves, mixture_bic, two_curve_k
from dielens.operators.clusters import SEED, fit_and_label
from dielens.operators.gram import pair_sums
from dielens.operators.knee import bic_choice
from dielens.operators.sweeps import group_sizes, grouped_points, held_blocks, mixture_label, mixture_sweep
from dielens.operators.transform import cube_root, norm_name

TOP_FEATURES = 5
SAMPLE_PARTS = 10


def cluster_top_features(
    df: DataFrame, cluster: str, registers: Sequence[str], top: int = TOP_FEATURES
) -> DataFrame:
    """(cluster, position, register, importance): median over wafers of the wafer sums."""
    wafers = df.groupBy(named(cluster), "LOT_ID", "WAFER_ID").agg(
        *[F.sum(named(r)).alias(r) for r in registers]
    )
    long = wafers.unpivot([named(cluster)], [named(r) for r in registers], "register", "total")
    medians = exact_quantiles(long, [cluster, "register"], "total", {"importance": 0.5})
    order = Window.partitionBy(cluster).orderBy(F.desc("importance"), F.desc("register"))
    return (
        medians.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top)
        .select(cluster, "position", "register", "importance")
    )


def tenth_sample(df: DataFrame, columns: Sequence[str], parts: int = SAMPLE_PARTS) -> DataFrame:
    """A repeatable share of the rows by hash: one in ``parts``."""
    return df.where(F.pmod(F.xxhash64(*[named(c) for c in columns]), F.lit(parts)) == 0)


def _chain(cluster: str, cases: Sequence[tuple], default=None):
    chain = F
    for value, result in cases:
        chain = chain.when(named(cluster) == F.lit(value), result)
    return chain if default is None else chain.otherwise(default)


def level2_split(
    df: DataFrame, cluster: str, registers: Sequence[str], ks: Sequence[int] = range(1, 10),
    top: int = TOP_FEATURES, seed: int = SEED, max_iter: int = 100,
    sample_columns: Sequence[str] | None = None, subgroup: str = "Subgroup", parts: int = 1,
) -> DataFrame:
    """Adds ``Subgroup`` = ``<cluster>-<component>``; the label stays on the row.

    Each cluster uses its own strongest registers. k comes from the BIC curve on all rows
    of the cluster, or on one in ``parts`` by hash; k = 1 leaves it whole. All mixtures of
    all clusters are fitted in the same scans, so neither a large cluster nor many hurt.
    """
    df = cube_root(df, registers)
    strongest: dict = {}
    for row in cluster_top_features(df, cluster, registers, top).orderBy(cluster, "position").collect():
        strongest.setdefault(row[cluster], []).append(norm_name(row["register"]))
    number = _chain(cluster, [(c, F.lit(i)) for i, c in enumerate(strongest)])
    features = _chain(cluster, [(c, F.array(*[named(f) for f in fs])) for c, fs in strongest.items()])

    looked_at = df if parts == 1 else tenth_sample(df, list(sample_columns or df.columns), parts)
    with held_blocks(grouped_points(looked_at, number, features)) as points:
        sizes = group_sizes(points)
        wanted = [(g, int(k)) for g, n in sizes.items() if n > max(ks) for k in ks]
        fits = mixture_sweep(points, wanted, sizes, seed, max_iter) if wanted else []
    d = len(next(iter(strongest.values()), []))
    curves = [(f.group, f.k, mixture_bic(f.log_likelihood, f.k, d, sizes[f.group])) for f in fits]
    curve_frame = df.sparkSession.createDataFrame(curves, "i int, k int, bic double")
    chosen = {r["i"]: r["chosen_k"] for r in bic_choice(curve_frame, ["i"]).collect()}

    splits = {g: k for g, k in chosen.items() if k > 1}
    held: dict = {}
    if splits and parts == 1:  # the same rows, seeds and k: the sweep has fitted it already
        held = {f.group: f for f in fits if splits.get(f.group) == f.k}
    elif splits:
        with held_blocks(grouped_points(df, number, features).where(F.col("_group").isin(*splits))) as points:
            sizes = group_sizes(points)
            final = mixture_sweep(points, list(splits.items()), sizes, seed, max_iter)
        held = {f.group: f for f in final}
    part = mixture_label(held, number, features) if held else F.lit(1)
    return df.withColumn(subgroup, F.concat(named(cluster).cast("string"), F.lit("-"), part.cast("string")))


def pairwise_regression(df: DataFrame, group: str, registers: Sequence[str]) -> DataFrame:
    """(group, pair, x, y, slope, r2) for every register pair i < j, y regressed on x.

    All pairs come from one scan (``gram.pair_sums``). A constant x has no line and a constant
    y fits any (r2 = 1); the ranges decide that, because sums of a constant are not exact.
    """
    sums = pair_sums(df, group, registers).where("i < j")
    n = len(registers)
    pair = F.expr(f"i * {n} - i * (i + 1) div 2 + j - i - 1").cast("int")
    names = F.array(*[F.lit(r) for r in registers])
    about = lambda a, b, c: F.col("n") * F.col(a) - F.col(b) * F.col(c)
    xx, yy, xy = about("sxx", "sx", "sx"), about("syy", "sy", "sy"), about("sxy", "sx", "sy")
    line = F.col("x_varies") & (xx > 0)
    r2 = F.when(F.col("y_varies"), F.least(F.try_divide(xy * xy, xx * yy), F.lit(1.0))).otherwise(F.lit(1.0))
    return sums.select(
        named(group),
        pair.alias("pair"),
        F.get(names, F.col("i")).alias("x"),
        F.get(names, F.col("j")).alias("y"),
        F.when(line, F.try_divide(xy, xx)).alias("slope"),
        F.when(line, r2).alias("r2"),
    )


def slope_signature(df: DataFrame, group: str, registers: Sequence[str]) -> DataFrame:
    """(group, pair, x, y, penalised_slope): slope times r², 0 where undefined."""
    lines = pairwise_regression(df, group, registers)
    return lines.select(
        named(group), "pair", "x", "y", penalised_slope(F.col("slope"), F.col("r2")).alias("penalised_slope")
    )


def level2_merge(
    df: DataFrame, cluster: str, registers: Sequence[str], label: str, ks: Sequence[int] = range(1, 20),
    seed: int = SEED, max_iter: int = 20, subgroup: str = "Subgroup",
) -> DataFrame:
    """Adds ``label``: subgroups with similar slope signatures share a number.

    Nothing was split: the level-1 label stays. One register only: a single cluster.
    The signatures are one row per subgroup (clusters times tried k, at most), so this
    step is small whatever the size of ``df``.
    """
    with cached(df) as held:
        pairs = held.select(named(subgroup).alias("s"), named(cluster).alias("c")).distinct()
        subgroups = pairs.agg(F.count_distinct("s"), F.count_distinct("c")).first()
        if subgroups[0] == subgroups[1]:
            return df.withColumn(label, named(cluster).cast("int"))
        n_pairs = len(registers) * (len(registers) - 1) // 2
        if n_pairs == 0:
            return df.withColumn(label, F.lit(1))
        pairs = [f"p{i}" for i in range(n_pairs)]
        long = slope_signature(held, subgroup, registers)
        signatures = long.groupBy(named(subgroup)).agg(
            *[F.max(F.when(F.col("pair") == i, F.col("penalised_slope"))).alias(p) for i, p in enumerate(pairs)]
        )
        # One row per subgroup, at most clusters times tried k of them.
        with cached(signatures) as small:
            curves = elbow_curves(small, pairs, ks, seed, max_iter)
            k = two_curve_k(curves)
            numbered, _ = fit_and_label(small, pairs, "kmeans", k, label, seed)
            rows = [tuple(r) for r in numbered.select(named(subgroup), label).collect()]
    names = df.sparkSession.createDataFrame(rows, f"`{subgroup}` string, `{label}` int")
    return df.join(names, subgroup)
