"""The registered queries: every operator on the die table, whole tables only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dielens.functions import scalars
from dielens.functions.scalars import named
from dielens.operators import (
    choose_k,
    clean,
    clusters,
    knee,
    labelling,
    level2,
    outputs,
    registers,
    samples,
    stacked,
    transform,
    wafers,
)
from dielens.plans import end_to_end, given
from dielens.plans.dies import RULE_CLUSTER, die_spec, die_table, load
from dielens.plans.hold import hold
from dielens.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

SPEC = die_spec()
MEASURED = SPEC.measured
CLUSTER_COLUMNS = (
    "BITQ_V-t_ALL",
    "BITP_V-t_ALL",
    "BITD_V_ALL",
    "BITX_V_ALL",
    "BITM_V_ALL",
    "BITO_V_ALL",
    "BITS_V_ALL",
)
ROW = ("src_order", "src_line", "FID")
LOTS = ("L3", "L17", "L21", "L3")
MODES = {"HighQ": "`BITQ_V-t_ALL` > 45", "HighP": "`BITP_V-t_ALL` > 90"}
MODELS = ("kmeans", "gmm")
STACK = stacked.Stack.of(CLUSTER_COLUMNS, "__rdV", "rdV")
STACKED_COLUMNS = ("FAB", "DESIGN_ID", *stacked.POSITION, "lot_wafer", "TOTAL_DIE", "__rdV", *CLUSTER_COLUMNS)
HELD_COLUMNS = (
    *("FAB", "DESIGN_ID", "LOT_ID", "WAFER_ID", "lot_wafer", *stacked.POSITION, "FBD_REGION", "BIN_BIT"),
    *CLUSTER_COLUMNS,
    "BITK_V_ALL",
)
VALUE = "BITQ_V-t_ALL"
ORDER = ("src_order", "src_line", "FID", "BITP_V-t_ALL", VALUE)
CENTRES = ((5.0, 10.0, 2.0), (20.0, 40.0, 5.0), (45.0, 80.0, 8.0))
CENTRE_COLUMNS = ("BITQ_V-t_ALL", "BITP_V-t_ALL", "BITD_V_ALL")

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_registry)


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for comparing engines: bigint, doubles to six places, time as text."""
    out = []
    for f in df.schema.fields:
        c = named(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- frames the queries start from ---------------------------------------------------


def binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_position(clean.first_pass(clean.drop_unbinned(die_table(spark, sf_dir))))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.numeric_dies(binned(spark, sf_dir), MEASURED)


def differenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registers.dependent_difference(cleaned(spark, sf_dir), SPEC)[0]


def held_dies(spark: SparkSession, sf_dir: str, columns: Sequence[str] = HELD_COLUMNS) -> DataFrame:
    """The clean numeric columns asked for, kept for queries that read them in several jobs.

    Fits of Spark ML depend on the layout of their rows, which goes by the size of the files, so
    the queries that fit hold the same columns.
    """
    return hold(differenced(spark, sf_dir).select(*[named(c) for c in (*ROW, *columns)]))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differenced(spark, sf_dir).withColumn("cluster", F.expr(RULE_CLUSTER))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dies with two rule-made models and two rule-made failure-mode flags."""
    df = clustered(spark, sf_dir)
    second = F.concat(F.lit("cluster_"), (F.pmod(F.col("BITM_V_ALL").cast("int"), F.lit(2)) + 1).cast("string"))
    flags = {mode: F.expr(rule).cast("int") for mode, rule in MODES.items()}
    return df.withColumns({"kmeans": F.col("cluster"), "gmm": second, **flags})


def held_columns(df: DataFrame, *more: str) -> DataFrame:
    """What a stacked map reads, kept: totals, wafers and values each take a scan or more."""
    return hold(df.select(*[named(c) for c in (*STACKED_COLUMNS, *more)]))


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return labelling.split_labelled(flagged(spark, sf_dir), list(MODES))


def components(spark: SparkSession, sf_dir: str, held: Sequence[str] = HELD_COLUMNS) -> tuple[DataFrame, list[str]]:
    """Scaled principal components of the clean dies, as the cluster sweeps use them."""
    scaled = transform.standard_scale(held_dies(spark, sf_dir, held), CLUSTER_COLUMNS)
    out, found = transform.pca_scores(scaled, [transform.norm_name(c) for c in CLUSTER_COLUMNS])
    return out.select(*ROW, *[named(c) for c in CLUSTER_COLUMNS], *found.columns), list(found.columns)


# --- sources ---------------------------------------------------------------------------


@query
def scan_by_lot(spark, sf_dir):
    return comparable(tables.scan_by_lot(die_table(spark, sf_dir), LOTS, SPEC.scan_columns, site="Fab 15"))


@query
def scan_by_time(spark, sf_dir):
    return comparable(
        tables.scan_by_time(
            die_table(spark, sf_dir), "1996-02-01 08:00:00", "970131", SPEC.scan_columns, "fab10", "Z32M"
        )
    )


@query
def tall_to_wide(spark, sf_dir):
    names = [r.name for r in (*SPEC.main, *SPEC.dependent)]
    tall = registers.unpivot(die_table(spark, sf_dir), [*ROW], names, "register", "value")
    return comparable(tables.tall_to_wide(tall, ROW, names))


@query
def catalog_lookup(spark, sf_dir):
    """Catalog rows by rule from ``part``: brands are failure modes, names are features."""
    part = load(spark, sf_dir, "part")
    catalog = part.select(
        F.when(F.col("p_size") % 2 == 0, "15").otherwise("10").alias("FAB"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL", "MEDIUM"), "Z32M").otherwise("B47R").alias("DESIGN_ID"),
        F.when(F.col("p_size") % 3 == 0, "rdC").otherwise("rdV").alias("BIN"),
        F.col("p_brand").alias("Failure_Mode"),
        F.col("p_name").alias("Register"),
    )
    found = tables.catalog_lookup(catalog, "fab15", "Z32M", "rdV", "models/")
    return found.withColumn("features", F.array_join("features", "|"))


# --- scalar rules ----------------------------------------------------------------------


@query
def design_family(spark, sf_dir):
    dies = die_table(spark, sf_dir).withColumn("design_family", scalars.design_family(F.col("DESIGN_ID")))
    return comparable(dies.groupBy("DESIGN_ID", "design_family").agg(F.count(F.lit(1)).alias("dies")))


@query
def normalise_date(spark, sf_dir):
    """Three spellings of the event time by rule: two dates and one that is none."""
    spelled = (
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyMMdd"))
        .otherwise(F.col("event_type"))
    )
    events = load(spark, sf_dir, "events").select("event_id", spelled.alias("spelled"))
    return comparable(events.withColumn("day", scalars.normalise_date(F.col("spelled"))))


@query
def zone_code(spark, sf_dir):
    zone = F.col("FBD_REGION")
    dies = die_table(spark, sf_dir).select(
        zone.alias("zone"),
        scalars.zone_code(zone).alias("code"),
        scalars.zone_code(zone, None).cast("double").alias("code_or_null"),
    )
    return comparable(dies.groupBy("zone", "code", "code_or_null").agg(F.count(F.lit(1)).alias("dies")))


# --- rows ------------------------------------------------------------------------------


@query
def filter_unbinned(spark, sf_dir):
    return comparable(clean.drop_unbinned(die_table(spark, sf_dir)).select(*ROW, "BIN_BIT"))


@query
def filter_bin_step(spark, sf_dir):
    return comparable(clean.drop_void_steps(die_table(spark, sf_dir), "STEP_BIN").select(*ROW, "STEP_BIN"))


@query
def filter_first_pass(spark, sf_dir):
    return comparable(clean.first_pass(die_table(spark, sf_dir)).select(*ROW, "REPROBE"))


@query
def parse_fid(spark, sf_dir):
    dies = clean.with_position(die_table(spark, sf_dir))
    return comparable(dies.select("FID", "LotId", "WaferId", "DieX", "DieY", "lot_wafer"))


@query
def drop_failed_dies(spark, sf_dir):
    return comparable(cleaned(spark, sf_dir).select(*ROW, *[named(c) for c in MEASURED]))


@query
def count_failed_dies(spark, sf_dir):
    return comparable(clean.count_failed(binned(spark, sf_dir), MEASURED))


@query
def filter_target_bin(spark, sf_dir):
    return comparable(clean.keep_target_bin(binned(spark, sf_dir), "O").select(*ROW, "BIN_BIT"))


@query
def bin_indicator(spark, sf_dir):
    dies = binned(spark, sf_dir).select(
        *ROW,
        scalars.bin_indicator("A", "Fail_bin").alias("fails_bin"),
        scalars.bin_indicator("N", "STEP_BIN").alias("fails_step"),
    )
    return comparable(dies)


# --- registers -------------------------------------------------------------------------


@query
def register_cardinality(spark, sf_dir):
    return comparable(registers.register_cardinality(binned(spark, sf_dir), MEASURED))


@query
def informative_registers(spark, sf_dir):
    protected = [*SPEC.probe_columns, "BITB_V_ALL"]
    verdict = registers.dull_registers(binned(spark, sf_dir), MEASURED, protected=protected)
    return verdict.where(~F.col("dropped")).select("register")


@query
def dependent_difference(spark, sf_dir):
    return comparable(differenced(spark, sf_dir).select(*ROW, "`BITQ_V-t_ALL`", "`BITP_V-t_ALL`"))


@query
def register_pareto(spark, sf_dir):
    return comparable(registers.register_pareto(differenced(spark, sf_dir), CLUSTER_COLUMNS))


@query
def register_pareto_strict(spark, sf_dir):
    return comparable(
        registers.register_pareto(differenced(spark, sf_dir), CLUSTER_COLUMNS, registers.STRICT_PARETO)
    )


# --- outliers, transforms, components --------------------------------------------------

CUT_COLUMNS = ("BITQ_V-t_ALL", "BITP_V-t_ALL", "price")


def with_price(spark, sf_dir) -> DataFrame:
    """Clean dies plus a continuous column, so that the cut removes rows."""
    price = F.col("BITP_V_ALL") * 1000 + F.col("src_order") * 7 % 1000 + F.col("BITQ_V_ALL") / 64
    dies = cleaned(spark, sf_dir).withColumn("price", price)
    return registers.dependent_difference(dies, SPEC)[0]


@query
def quantile_cut(spark, sf_dir):
    dies = hold(with_price(spark, sf_dir).select(*ROW, *[named(c) for c in CUT_COLUMNS]))
    kept, _ = transform.quantile_cut(dies, CUT_COLUMNS, 0.999)
    return comparable(kept.select(*ROW, *[named(c) for c in CUT_COLUMNS]))


@query
def quantile_cut_single_pass(spark, sf_dir):
    kept = transform.quantile_cut_single_pass(with_price(spark, sf_dir), CUT_COLUMNS, 0.999)
    return comparable(kept.select(*ROW, *[named(c) for c in CUT_COLUMNS]))


@query
def wafer_outliers(spark, sf_dir):
    labelled = transform.label_wafer_outliers(differenced(spark, sf_dir), ["__rdV", VALUE], 0.5)
    counts = labelled.groupBy("lot_wafer", "ooc_label").agg(F.count(F.lit(1)).alias("dies"))
    return comparable(counts)


@query
def cbrt_transform(spark, sf_dir):
    dies = transform.cube_root(differenced(spark, sf_dir), CLUSTER_COLUMNS)
    return comparable(dies.select(*ROW, *[named(transform.norm_name(c)) for c in CLUSTER_COLUMNS]))


@query
def standard_scale(spark, sf_dir):
    columns = [*CLUSTER_COLUMNS, "BITK_V_ALL"]
    dies = transform.standard_scale(held_dies(spark, sf_dir, columns), columns)
    return comparable(dies.select(*ROW, *[named(transform.norm_name(c)) for c in columns]))


@query
def covariance_matrix(spark, sf_dir):
    return comparable(transform.covariance_matrix(differenced(spark, sf_dir), CLUSTER_COLUMNS))


@query
def pca_scores(spark, sf_dir):
    df, names = components(spark, sf_dir, CLUSTER_COLUMNS)
    return df.select(*ROW, *names)


@query
def pca_by_share(spark, sf_dir):
    columns = list(CLUSTER_COLUMNS)
    dies, found = transform.pca_by_share(held_dies(spark, sf_dir, columns), columns, 0.9)
    return dies.select(*ROW, *found.columns)


# --- choosing k ------------------------------------------------------------------------


@query
def kmeans_cost_sweep(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return choose_k.kmeans_cost_sweep(df, names)


@query
def bisecting_cost_sweep(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return choose_k.bisecting_cost_sweep(df, names)


def survival_curves(spark, sf_dir) -> DataFrame:
    """Per lot: how many dies have a squared register above 100x, for x = 1..24."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(24))).alias("x")
    dies = cleaned(spark, sf_dir).select("LOT_ID", F.col("BITQ_V_ALL").alias("v"), steps)
    return dies.groupBy("LOT_ID", "x").agg(
        F.sum((F.col("v") * F.col("v") > 100 * F.col("x")).cast("double")).alias("y")
    )


@query
def knee_point(spark, sf_dir):
    return comparable(knee.knee_point(survival_curves(spark, sf_dir), ["LOT_ID"]))


@query
def bic_choice(spark, sf_dir):
    """Curves by rule: per lot and k the register total of the dies with that remainder."""
    k = (F.col("src_order") % 9 + 1).cast("int")
    curves = cleaned(spark, sf_dir).groupBy("LOT_ID", k.alias("k")).agg(F.sum("BITQ_V_ALL").alias("bic"))
    return comparable(knee.bic_choice(curves, ["LOT_ID"]))


@query
def elbow_two_curves(spark, sf_dir):
    df, names = components(spark, sf_dir)
    curves = choose_k.elbow_curves(df, names)
    return curves.withColumn("chosen_k", F.lit(choose_k.two_curve_k(curves)))


@query
def gmm_bic_sweep(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return choose_k.gmm_bic_sweep(df, names)


@query
def silhouette_sweep(spark, sf_dir):
    df, names = components(spark, sf_dir)
    curve = choose_k.silhouette_sweep(df, names)
    return curve.withColumn("chosen_k", F.lit(choose_k.silhouette_k(curve)))


@query
def k1_inertia(spark, sf_dir):
    return comparable(choose_k.one_cluster_costs(differenced(spark, sf_dir), CLUSTER_COLUMNS))


# --- clusters --------------------------------------------------------------------------


@query
def kmeans_labels(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return clusters.cluster(df, "kmeans", 6, names, "kmeans").select(*ROW, "kmeans")


@query
def nearest_centre(spark, sf_dir):
    label = scalars.nearest_centre([named(c) for c in CENTRE_COLUMNS], CENTRES)
    dies = differenced(spark, sf_dir).select(*ROW, label.alias("label"), scalars.cluster_name(label).alias("cluster"))
    return comparable(dies)


@query
def gmm_labels(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return clusters.cluster(df, "gmm", 5, names, "gmm").select(*ROW, "gmm")


@query
def component_representative(spark, sf_dir):
    df, names = components(spark, sf_dir)
    _, model = clusters.fit_and_label(df, names, "gmm", 5, "gmm")
    return clusters.component_representatives(df, names, *clusters.mixture_parts(model))


@query
def bisecting_labels(spark, sf_dir):
    df, names = components(spark, sf_dir)
    return clusters.cluster(df, "bisecting_kmeans", 6, names, "bisecting").select(*ROW, "bisecting")


@query
def cluster_dies(spark, sf_dir):
    """Both cluster models of the clean dies, level 2 included."""
    return end_to_end.cluster_dies(held_dies(spark, sf_dir), CLUSTER_COLUMNS).select(*ROW, *MODELS)


# --- given models -----------------------------------------------------------------------


@query
def costs_given(spark, sf_dir):
    return comparable(choose_k.costs_of_centres(differenced(spark, sf_dir), given.COLUMNS, given.CENTRE_SETS))


@query
def mixture_bic_given(spark, sf_dir):
    """Log likelihood, BIC and AIC of given mixtures of the clean dies."""
    dies = hold(differenced(spark, sf_dir).select(*[named(c) for c in given.COLUMNS]))
    d, rows = len(given.COLUMNS), []
    for parts in given.MIXTURES:
        row, k = clusters.mixture_log_likelihood(dies, given.COLUMNS, *parts).first(), len(parts[0])
        bic = choose_k.mixture_bic(row["log_likelihood"], k, d, row["rows"])
        rows.append((k, row["log_likelihood"], bic, choose_k.mixture_aic(row["log_likelihood"], k, d)))
    found = spark.createDataFrame(rows, "k bigint, log_likelihood double, bic double, aic double")
    return found.select("k", *[F.round(c, 3).alias(c) for c in ("log_likelihood", "bic", "aic")])


@query
def gmm_given(spark, sf_dir):
    dies = clusters.mixture_labels(differenced(spark, sf_dir), given.COLUMNS, *given.MIXTURES[-1], "gmm")
    return comparable(dies.select(*ROW, "gmm"))


@query
def representative_given(spark, sf_dir):
    _, means, covariances = given.MIXTURES[-1]
    return comparable(clusters.component_representatives(differenced(spark, sf_dir), given.COLUMNS, means, covariances))


@query
def bisecting_given(spark, sf_dir):
    label = clusters.tree_label([named(c) for c in given.COLUMNS], given.TREE)
    return comparable(differenced(spark, sf_dir).select(*ROW, label.alias("bisecting")))


@query
def silhouette_given(spark, sf_dir):
    label = scalars.nearest_centre([named(c) for c in given.COLUMNS], given.CENTRE_SETS[1])
    return comparable(choose_k.score_labels(differenced(spark, sf_dir), given.COLUMNS, label))


@query
def components_given(spark, sf_dir):
    dies = transform.project(differenced(spark, sf_dir), given.COLUMNS, given.MEANS, given.LOADINGS, given.SPREADS)
    return comparable(dies.select(*ROW, "PC1", "PC2"))


@query
def forest_given(spark, sf_dir):
    return comparable(labelling.score_trees(differenced(spark, sf_dir), "HighQ", given.FOREST).select(*ROW, "HighQ"))


@query
def analysis(spark, sf_dir):
    """The whole analysis of one design's dies, from raw text to the register Pareto of every
    cluster of both models."""
    raw = end_to_end.requested(die_table(spark, sf_dir), SPEC, start="1990-01-01", end="2010-12-31", design="Z32M")
    result = end_to_end.analyse(raw, SPEC)
    return result.cluster_pareto


# --- level 2 ---------------------------------------------------------------------------


@query
def cluster_top_features(spark, sf_dir):
    return comparable(level2.cluster_top_features(clustered(spark, sf_dir), "cluster", CLUSTER_COLUMNS))


@query
def level2_split(spark, sf_dir):
    held = held_dies(spark, sf_dir).withColumn("cluster", F.expr(RULE_CLUSTER))
    dies = level2.level2_split(held, "cluster", CLUSTER_COLUMNS, sample_columns=ROW)
    return dies.select(*ROW, "cluster", "Subgroup")


def subgroups(spark, sf_dir) -> DataFrame:
    """Rule-made subgroups: the cluster and the wafer zone."""
    held = held_dies(spark, sf_dir, ["BIN_BIT", "FBD_REGION", *CLUSTER_COLUMNS, "BITK_V_ALL"])
    dies = held.withColumn("cluster", F.expr(RULE_CLUSTER))
    return dies.withColumn("Subgroup", F.concat("cluster", F.lit("-"), "FBD_REGION"))


@query
def pairwise_regression(spark, sf_dir):
    columns = [*CLUSTER_COLUMNS, "BITK_V_ALL"]
    return comparable(level2.pairwise_regression(subgroups(spark, sf_dir), "Subgroup", columns))


@query
def penalised_slope(spark, sf_dir):
    columns = ["BITK_V_ALL", *CLUSTER_COLUMNS]
    return comparable(level2.slope_signature(subgroups(spark, sf_dir), "Subgroup", columns))


@query
def level2_merge(spark, sf_dir):
    number = F.substring("cluster", 9, 3).cast("int")
    dies = subgroups(spark, sf_dir).withColumn("level1", number)
    return level2.level2_merge(dies, "level1", CLUSTER_COLUMNS, "merged").select(*ROW, "Subgroup", "merged")


# --- failure modes ---------------------------------------------------------------------


@query
def score_models(spark, sf_dir):
    """Forests trained on rule-made flags, then scored; one model lacks a feature."""
    dies = held_dies(spark, sf_dir).withColumn("FBD_REGION", scalars.zone_code(F.col("FBD_REGION")))
    wanted = {"HighQ": ["BITQ_V-t_ALL", "FBD_REGION"], "HighP": ["BITP_V-t_ALL", "BITD_V_ALL"]}
    models = [labelling.train_mode(dies, m, f, F.expr(MODES[m])) for m, f in wanted.items()]
    missing = labelling.StoredModel("Unknown", ("BITZ_V_ALL",), models[0].model)
    scored = labelling.score_models(dies, [*models, missing])
    return scored.dies.select(*ROW, *scored.modes)


@query
def split_labelled(spark, sf_dir):
    labelled, rest = split(spark, sf_dir)
    sides = labelled.withColumn("side", F.lit("labelled")).unionByName(rest.withColumn("side", F.lit("unlabelled")))
    return comparable(sides.select(*ROW, *MODES, "total", "side"))


@query
def round_scores(spark, sf_dir):
    dies = differenced(spark, sf_dir).withColumn("score", F.col("BITD_V_ALL") / 2)
    return comparable(labelling.round_scores(dies, {"score": "flag"}).select(*ROW, "score", "flag"))


# --- stacked maps ----------------------------------------------------------------------


@query
def cluster_wafer_counts(spark, sf_dir):
    return comparable(stacked.cluster_wafer_counts(clustered(spark, sf_dir), "cluster", "__rdV"))


@query
def cluster_item_stats(spark, sf_dir):
    return comparable(stacked.cluster_item_stats(clustered(spark, sf_dir), "cluster", STACK.items))


@query
def cluster_impact(spark, sf_dir):
    binary = clustered(spark, sf_dir).withColumn("BIN_BIT", scalars.bin_indicator("A", "Fail_bin"))
    dies = held_columns(binary, "BIN_BIT", "cluster")
    stack = stacked.Stack.of(CLUSTER_COLUMNS, "BIN_BIT", "A", "BIN_BIT")
    return comparable(stacked.cluster_impact(dies, "cluster", stack, stacked.die_totals(dies)))


@query
def stacked_die_median(spark, sf_dir):
    return comparable(stacked.stacked_die_median(clustered(spark, sf_dir), "cluster", STACK.items))


@query
def stacked_map(spark, sf_dir):
    dies = held_columns(clustered(spark, sf_dir), "cluster")
    return comparable(stacked.stacked_map(dies, "cluster", STACK, stacked.die_totals(dies)))


@query
def stacked_map_labelled(spark, sf_dir):
    labelled, rest = labelling.split_labelled(held_columns(flagged(spark, sf_dir), *MODELS, *MODES), list(MODES))
    return comparable(stacked.stacked_maps(rest, MODELS, STACK, labelled, list(MODES)))


def both_models(spark, sf_dir) -> DataFrame:
    """Held, because the complete grid reads it three times; one row per position and layer."""
    return hold(stacked.stacked_maps(held_columns(flagged(spark, sf_dir), *MODELS), MODELS, STACK))


@query
def cluster_pareto(spark, sf_dir):
    return comparable(stacked.cluster_pareto(both_models(spark, sf_dir), CLUSTER_COLUMNS, "rdV", top=5))


def map_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "FAB", "DESIGN_ID", "DieX", "DieY", "model", "cluster", "stacked_item", "median_value", *outputs.STATISTICS
    )


@query
def full_die_map(spark, sf_dir):
    full = map_columns(stacked.full_die_map(both_models(spark, sf_dir)))
    counts = ("num_wafers_in_cluster", "num_dies_in_cluster")
    return comparable(full.withColumns({c: F.col(c).cast("double") for c in counts}))


# --- outputs ---------------------------------------------------------------------------


@query
def group_mean_fill(spark, sf_dir):
    full = stacked.full_die_map(both_models(spark, sf_dir))
    return comparable(map_columns(outputs.group_mean_fill(full)))


def _number_text(c: Column) -> Column:
    return F.coalesce(F.round(c * 1000).cast("bigint").cast("string"), F.lit("null"))


@query
def cluster_signature(spark, sf_dir):
    full = stacked.full_die_map(both_models(spark, sf_dir))
    signature = outputs.cluster_signature(outputs.group_mean_fill(full))
    dies = F.transform(
        "die_info",
        lambda d: F.concat_ws(":", d["DieX"].cast("string"), d["DieY"].cast("string"), _number_text(d["median_value"])),
    )
    return comparable(signature.withColumn("die_info", F.array_join(dies, ",")))


@query
def wafer_association(spark, sf_dir):
    association = outputs.wafer_association(outputs.merge_labelled(flagged(spark, sf_dir), MODELS), MODELS)
    dies = F.transform("die_coordinates", lambda d: F.concat_ws(":", d["DieX"].cast("string"), d["DieY"].cast("string")))
    return comparable(association.withColumn("die_coordinates", F.array_join(dies, ",")))


@query
def cluster_pareto_lists(spark, sf_dir):
    pareto = stacked.cluster_pareto(both_models(spark, sf_dir), CLUSTER_COLUMNS, "rdV", top=5)
    lists = outputs.cluster_pareto_lists(pareto)
    return comparable(
        lists.select(
            "model",
            "cluster",
            F.array_join("register", ",").alias("register"),
            F.array_join(F.transform("register_median", _number_text), ",").alias("register_median"),
            F.array_join(F.transform("cumpercentage", _number_text), ",").alias("cumpercentage"),
        )
    )


@query
def merge_labelled(spark, sf_dir):
    labelled, rest = split(spark, sf_dir)
    return comparable(outputs.merge_labelled(rest, MODELS, labelled, list(MODES)))


# --- samples and plot tables -----------------------------------------------------------


@query
def sample_per_cluster(spark, sf_dir):
    dies = clustered(spark, sf_dir)
    return samples.plot_sample(dies, "cluster", registers.select_pareto(dies, CLUSTER_COLUMNS))


@query
def sample_counts(spark, sf_dir):
    return comparable(samples.sample_counts(clustered(spark, sf_dir), "cluster"))


@query
def pair_points(spark, sf_dir):
    dies = clustered(spark, sf_dir)
    first = registers.select_pareto(dies, CLUSTER_COLUMNS)[: samples.PLOT_REGISTERS]
    return comparable(samples.pair_points(dies, first, "cluster", "cluster_1", ROW))


# --- wafers ----------------------------------------------------------------------------

WAFER_COLUMNS = ("FAB", "DESIGN_ID", "LOT_ID", "WAFER_ID", "DieX", "DieY", "BITP_V-t_ALL", VALUE)


@query
def wafer_grid(spark, sf_dir):
    return comparable(wafers.wafer_grid(held_dies(spark, sf_dir, WAFER_COLUMNS), VALUE, ORDER, ("FAB", "DESIGN_ID")))


@query
def minmax_q97(spark, sf_dir):
    dies = held_dies(spark, sf_dir, [VALUE])
    scaled = wafers.minmax_scale(dies, VALUE, wafers.value_range(dies, VALUE))
    return comparable(scaled.select(*ROW, "scaled"))


@query
def equalise_levels(spark, sf_dir):
    dies = held_dies(spark, sf_dir, ["LOT_ID", "WAFER_ID", VALUE])
    scaled = wafers.minmax_scale(dies, VALUE, wafers.value_range(dies, VALUE))
    return comparable(wafers.equalise_levels(scaled).select(*ROW, "LOT_ID", "WAFER_ID", "level", "equalised"))


@query
def wafer_top_register(spark, sf_dir):
    return comparable(wafers.wafer_top_register(differenced(spark, sf_dir), CLUSTER_COLUMNS))


@query
def wafer_clusters(spark, sf_dir):
    dies = held_dies(spark, sf_dir)
    labelled = wafers.wafer_clusters(dies, VALUE, ORDER, "wafer_cluster")
    return labelled.select(*ROW, "LOT_ID", "WAFER_ID", "wafer_cluster")
