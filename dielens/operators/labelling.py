"""Known failure modes: scoring stored models and splitting off what they recognise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named, round_score

_FEATURES = "_mode_features"


@dataclass(frozen=True)
class StoredModel:
    """A failure mode, the features it reads and its fitted classifier."""

    mode: str
    features: tuple[str, ...]
    model: RandomForestClassificationModel


@dataclass(frozen=True)
class Scored:
    """Scored dies, the modes used and why others were skipped."""

    dies: DataFrame
    modes: tuple[str, ...]
    skipped: dict[str, str]


def load_models(catalog_rows: Sequence[Mapping]) -> tuple[list[StoredModel], dict[str, str]]:
    """Models of catalog rows (Failure_Mode, features, model_path); unreadable paths are listed."""
    models, skipped = [], {}
    for row in catalog_rows:
        try:
            model = RandomForestClassificationModel.load(row["model_path"])
        except (Py4JJavaError, PySparkException) as error:
            skipped[row["Failure_Mode"]] = f"model not readable: {str(error).splitlines()[0]}"
            continue
        models.append(StoredModel(row["Failure_Mode"], tuple(row["features"]), model))
    return models, skipped


def score_models(df: DataFrame, models: Sequence[StoredModel]) -> Scored:
    """Adds one 0/1 column per model, all in one pass over the same rows, no join."""
    present = {c.lower() for c in df.columns}
    used, skipped = [], {}
    for stored in models:
        missing = [f for f in stored.features if f.lower() not in present]
        if missing:
            skipped[stored.mode] = f"features missing: {','.join(missing)}"
            continue
        safe = [f"_m{i}" for i in range(len(stored.features))]
        inputs = df.withColumns({s: named(f).cast("double") for s, f in zip(safe, stored.features)})
        vectors = VectorAssembler(inputCols=safe, outputCol=_FEATURES).transform(inputs).drop(*safe)
        # A copy per use: the caller's model keeps its own column names.
        model = stored.model.copy()
        model.setFeaturesCol(_FEATURES).setPredictionCol(stored.mode)
        model.setProbabilityCol("").setRawPredictionCol("")
        df = model.transform(vectors).drop(_FEATURES)
        used.append(stored.mode)
    return Scored(df, tuple(used), skipped)


def flag_total(modes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [named(m) for m in modes])


def split_labelled(df: DataFrame, modes: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """(dies some model recognises, the rest), both with ``total``; no modes: all are the rest."""
    if not modes:
        return None, df
    totalled = df.withColumn("total", flag_total(modes))
    return totalled.where("total > 0"), totalled.where("total = 0")


def round_scores(df: DataFrame, scores: Mapping[str, str]) -> DataFrame:
    """Regression scores to whole flags, ``{score column: flag name}``."""
    return df.withColumns({flag: round_score(named(score)) for score, flag in scores.items()})


def train_mode(
    df: DataFrame, mode: str, features: Sequence[str], flag: Column, trees: int = 5, seed: int = 1
) -> StoredModel:
    """Fits the forest of one failure mode from flagged dies; scoring only ever loads it."""
    safe = [f"_m{i}" for i in range(len(features))]
    inputs = df.select(*[named(f).cast("double").alias(s) for f, s in zip(features, safe)], flag.cast("double").alias("_flag"))
    vectors = VectorAssembler(inputCols=safe, outputCol=_FEATURES).transform(inputs)
    forest = RandomForestClassifier(featuresCol=_FEATURES, labelCol="_flag", numTrees=trees, seed=seed)
    return StoredModel(mode, tuple(features), forest.fit(vectors.select(_FEATURES, "_flag")))


#: A tree: a vote, or (feature, threshold, tree at most the threshold, tree above it).
Vote = int | tuple[str, float, "Vote", "Vote"]


def tree_vote(tree: Vote) -> Column:
    if isinstance(tree, int):
        return F.lit(tree)
    feature, threshold, low, high = tree
    return F.when(named(feature) <= F.lit(float(threshold)), tree_vote(low)).otherwise(tree_vote(high))


def score_trees(df: DataFrame, mode: str, trees: Sequence[Vote]) -> DataFrame:
    """Adds a 0/1 column by the majority of given trees, as plain expressions; a tie is 0."""
    votes = reduce(lambda a, b: a + b, [tree_vote(t) for t in trees])
    return df.withColumn(mode, (votes * 2 > len(trees)).cast("int"))
