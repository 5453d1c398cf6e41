"""The whole analysis, from raw dies to stacked maps and output lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import bin_indicator, cluster_name, named
from dielens.operators import clean, outputs, registers, samples, stacked, transform
from dielens.operators.choose_k import elbow_k, kmeans_cost_sweep
from dielens.operators.clusters import SEED, fit_and_label
from dielens.operators.labelling import StoredModel, score_models, split_labelled
from dielens.operators.level2 import level2_merge, level2_split
from dielens.plans.hold import hold, keeping
from dielens.plans.methods import compiled_methods
from dielens.plans.stages import Stages
from dielens.sources import tables
from dielens.sources.sinks import Result
from dielens.spec import BIN_COLUMN, FAIL_BIN_STEP, ProbeSpec

CLUSTER_MODELS = ("kmeans", "gmm")


@dataclass(frozen=True)
class Settings:
    """Everything about an analysis that can be set; the defaults are the usual ones."""

    first_pass_only: bool = True
    max_dropped_cardinality: int = 2
    pareto: registers.ParetoRule = field(default_factory=registers.ParetoRule)
    with_pca: bool = True
    max_components: int = 6
    sweep_ks: Sequence[int] = tuple(range(2, 20))
    split_ks: Sequence[int] = tuple(range(1, 10))
    merge_ks: Sequence[int] = tuple(range(1, 20))
    seed: int = SEED
    mixture_iterations: int = 100


@dataclass(frozen=True)
class Prepared:
    """Clean numeric dies and the registers chosen for clustering, largest first."""

    dies: DataFrame
    spec: ProbeSpec
    registers: tuple[str, ...]
    dropped: tuple[str, ...]


def bin_column(spec: ProbeSpec) -> str | None:
    """The bin column stacked as an indicator, when the probe item is a bin."""
    return spec.probe_column if spec.probe_column in (BIN_COLUMN, spec.bin_step) else None


def prepare(
    raw: DataFrame, spec: ProbeSpec, settings: Settings = Settings(), decided: Mapping | None = None
) -> Prepared:
    """Filters, parsing, register selection, numbers, differences and Pareto selection.

    ``decided`` (``dropped``, ``registers``) is a selection made before, taken as it is.
    """
    rows = clean.prepare_rows(raw, spec, settings.first_pass_only)
    if decided is None:
        choice = registers.select_informative(rows, spec, settings.max_dropped_cardinality)
    else:
        choice = registers.Selection(registers.without(spec, decided["dropped"]), tuple(decided["dropped"]))
    numeric = clean.numeric_dies(rows, choice.spec.measured)
    dies, candidates = registers.dependent_difference(numeric, choice.spec)
    if decided is None:
        chosen = registers.select_pareto(dies, candidates, settings.pareto, choice.spec)
    else:
        chosen = decided["registers"]
    step = bin_column(spec)
    if step is not None:
        bin_step = FAIL_BIN_STEP if step == BIN_COLUMN else step
        dies = dies.withColumn(step, bin_indicator(spec.probe_item, bin_step))
    return Prepared(dies, choice.spec, tuple(chosen), choice.dropped)


def _features(df: DataFrame, columns: Sequence[str], settings: Settings) -> tuple[DataFrame, list[str]]:
    """Components of the scaled columns, or the scaled columns themselves."""
    scaled = [transform.norm_name(c) for c in columns]
    if not settings.with_pca:
        return df, scaled
    out, components = transform.pca_scores(df, scaled, settings.max_components)
    return out, list(components.columns)


def cluster_dies(df: DataFrame, columns: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """Adds the two cluster models: ``kmeans`` on scaled components, and ``gmm``, a mixture
    on cube-root components with the same k, split and merged at level 2."""
    base = [named(c) for c in df.columns]
    cut, _ = transform.quantile_cut(df, columns)

    scaled, features = _features(transform.standard_scale(cut, columns), columns, settings)
    k = elbow_k(kmeans_cost_sweep(scaled, features, settings.sweep_ks, settings.seed))
    labelled, _ = fit_and_label(scaled, features, "kmeans", k, "kmeans", settings.seed)
    labelled = labelled.select(*base, "kmeans")

    rooted, features = _features(transform.cube_root(labelled, columns), columns, settings)
    level1, _ = fit_and_label(rooted, features, "gmm", k, "gmm_L1", settings.seed, settings.mixture_iterations)
    level1 = hold(level1.select(*base, "kmeans", "gmm_L1"))
    split = level2_split(
        level1, "gmm_L1", columns, settings.split_ks, seed=settings.seed,
        max_iter=settings.mixture_iterations, sample_columns=["FID", *columns],
    )
    merged = level2_merge(split, "gmm_L1", columns, "gmm", settings.merge_ks, settings.seed)
    return merged.select(*base, *[cluster_name(named(m)).alias(m) for m in CLUSTER_MODELS])


def requested(
    dies: DataFrame, spec: ProbeSpec, lots: Sequence[str] | None = None, start: str | None = None,
    end: str | None = None, design: str | None = None, site: str | None = None,
) -> DataFrame:
    """The raw dies a request is about: lots, or a design in a time range; else an error."""
    if lots:
        return tables.scan_by_lot(dies, lots, spec.scan_columns, site=site)
    if start and end and design:
        return tables.scan_by_time(dies, start, end, spec.scan_columns, site, design)
    raise ValueError("a request names lots, or a start, an end and a design")


def analyse(
    raw: DataFrame, spec: ProbeSpec, models: Sequence[StoredModel] = (), settings: Settings = Settings(),
    stages: Stages | None = None,
) -> Result:
    """Runs every stage. Frames in the result are lazy; what they read is held until
    ``release``.

    With ``stages`` in a folder a broken or repeated analysis takes up the stages that are
    there: the registers chosen, the clean dies, the cluster labels and the stacked maps.
    """
    compiled_methods(raw.sparkSession)
    stages = stages or Stages(raw.sparkSession)
    with keeping() as held:
        def select() -> dict:
            prepared = prepare(clean.require_rows(raw), spec, settings)
            return {"dropped": list(prepared.dropped), "registers": list(prepared.registers)}

        prepared = prepare(raw, spec, settings, stages.value("registers", select))
        chosen = prepared.registers
        scored = score_models(stages.table("dies", lambda: prepared.dies), models)
        labelled, unlabelled = split_labelled(scored.dies, scored.modes)
        clustered = stages.table("clustered", lambda: cluster_dies(unlabelled, chosen, settings))

        stack = stacked.Stack.of(chosen, spec.probe_column, spec.probe_item, bin_column(spec))
        maps = stages.table("maps", lambda: stacked.stacked_maps(clustered, CLUSTER_MODELS, stack, labelled, scored.modes))
        pareto = stacked.cluster_pareto(maps, chosen, spec.probe_item)
        full = stacked.full_die_map(maps)
        dies = outputs.merge_labelled(clustered, CLUSTER_MODELS, labelled, scored.modes)
        return Result(
            dies=dies,
            stacked_map=full,
            cluster_pareto=pareto,
            signature=outputs.cluster_signature(outputs.group_mean_fill(full)),
            wafer_association=outputs.wafer_association(dies, CLUSTER_MODELS),
            pareto_lists=outputs.cluster_pareto_lists(pareto),
            scatter_samples={m: samples.plot_sample(clustered, m, chosen) for m in CLUSTER_MODELS},
            raw=raw,
            models=CLUSTER_MODELS,
            failure_modes=scored.modes,
            skipped_modes=scored.skipped,
            held=held,
        )
