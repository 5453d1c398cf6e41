"""A toxicity classifier that does not care which group a text mentions.

A logistic model over the words that stand in a text. For a labelled text that mentions
identity terms a counterfactual is made, each term swapped for another of its list, and
training penalises the squared change of the score between both. A group's name then
gains no weight of its own from the company it keeps in the labelled texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dielens.llm.common import remainder, slices, texts_of

WORD = re.compile(r"[^\W\d_]+")
#: Names of groups, by language, that can stand for one another.
IDENTITIES = (
    ("women", "men", "girls", "boys", "gays", "lesbians", "christians", "muslims", "jews", "hindus", "buddhists")
    + ("immigrants", "refugees", "africans", "asians", "europeans", "americans", "mexicans", "arabs"),
    ("woman", "man", "female", "male", "gay", "lesbian", "straight", "transgender", "christian", "muslim", "jewish")
    + ("hindu", "buddhist", "black", "white", "asian", "african", "european", "american", "mexican", "arab", "deaf", "blind"),
    ("frauen", "männer", "schwule", "lesben", "christen", "muslime", "juden", "migranten", "flüchtlinge", "türken", "araber"),
    ("femmes", "hommes", "homosexuels", "lesbiennes", "chrétiens", "musulmans", "juifs", "immigrés", "réfugiés", "arabes"),
    ("mujeres", "hombres", "homosexuales", "lesbianas", "cristianos", "musulmanes", "judíos", "inmigrantes", "refugiados"),
)


@dataclass(frozen=True)
class Settings:
    """`most_rows` bounds the labelled rows that training takes, by a hash of id, text and copy."""

    most_rows: int = 20_000
    least_texts: int = 10
    penalty: float = 10.0
    ridge: float = 1.0
    steps: int = 150
    threshold: float = 0.3
    identities: tuple[tuple[str, ...], ...] = field(default=IDENTITIES)


@dataclass(frozen=True)
class Model:
    """Weights by the crc32 of a word; without training rows every score is 0."""

    weights: dict[int, float]
    bias: float
    trained: bool

    def score(self, text: str) -> float:
        if not self.trained:
            return 0.0
        total = self.bias
        get, crc = self.weights.get, zlib.crc32
        for w in set(WORD.findall(text.lower())):
            total += get(crc(w.encode()), 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def features(words: Iterable[str]) -> list[int]:
    return sorted({zlib.crc32(w.encode()) for w in words})


def swapped(words: set[str], identities: Iterable[tuple[str, ...]]) -> set[str] | None:
    """The words with each identity term moved on in its list; None if there is none."""
    out = set(words)
    for terms in identities:
        mine = [i for i, t in enumerate(terms) if t in words]
        if mine:
            out -= {terms[i] for i in mine}
            out |= {terms[(i + 1 + zlib.crc32(terms[i].encode()) % (len(terms) - 1)) % len(terms)] for i in mine}
    return None if out == words else out


def training_rows(df: DataFrame, labels: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """(key, label, words, other, print): features of the bounded sample of labelled rows and of their
    counterfactuals. A document's label is 1 if any of its rows says so; null labels and
    ids do not count."""
    named = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    named = named.groupBy(F.col("doc_id").alias("key")).agg(F.max("toxic").alias("label"))
    text_print = F.xxhash64("key", "text")
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("print", text_print)
    # equal rows are counted, and only as many of them as the sample can hold take part
    counts = rows.select("key", "print").join(named, "key").groupBy("key", "label", "print").agg(F.count("*").alias("n"))
    most = F.least("n", F.lit(settings.most_rows).cast("long"))
    each = counts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), most)))
    chosen = each.orderBy(F.xxhash64("key", "print", "copy"), "key", "print", "copy").limit(settings.most_rows)
    sample = chosen.groupBy("key", "label", "print").agg(F.count("*").alias("copies"))
    once = rows.join(F.broadcast(sample), ["key", "print"]).groupBy("key", "label", "print", "copies")
    docs = once.agg(F.first("text").alias("text")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    docs = docs.select("key", "text", "label", "print")
    identities = settings.identities

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in slices(batches, "text"):
            found = [set(WORD.findall(t.lower())) for t in texts_of(batch)]
            others = [swapped(w, identities) for w in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("label").cast(pa.int32()),
                    pa.array([features(w) for w in found], type=kind),
                    pa.array([None if o is None else features(o) for o in others], type=kind),
                    batch.column("print"),
                ],
                names=["key", "label", "words", "other", "print"],
            )

    kind = df.schema[key].dataType.simpleString()
    return docs.mapInArrow(read, f"key {kind}, label int, words array<long>, other array<long>, print long")


def _flat(lists: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each feature that was chosen."""
    rows = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    values = _joined(lists)
    at = np.minimum(np.searchsorted(chosen, values), max(len(chosen) - 1, 0)).astype(np.int32)
    known = chosen[at] == values if len(chosen) else np.zeros(len(values), dtype=bool)
    return rows[known], at[known]


def _joined(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype=np.uint32), *lists], dtype=np.uint32, casting="unsafe")


def fit(words: list[np.ndarray], others: list[np.ndarray | None], label: np.ndarray, settings: Settings) -> Model:
    """Gradient descent with a step for each weight (Adam) on the penalised loss:
    mean log loss, plus penalty times the mean squared change of logits under swaps."""
    if not len(label):
        return Model({}, 0.0, False)
    values, texts = np.unique(_joined(words), return_counts=True)
    chosen = values[texts >= settings.least_texts]
    del values, texts
    pairs = [i for i, o in enumerate(others) if o is not None]
    terms = np.array(features(t for ts in settings.identities for t in ts), dtype=np.uint32)
    chosen = np.union1d(chosen, np.intersect1d(_joined([others[i] for i in pairs]), terms))
    n, width = len(label), len(chosen)
    row, column = _flat(words, chosen)
    pair_row, pair_column = _flat([words[i] for i in pairs], chosen)
    swap_row, swap_column = _flat([others[i] for i in pairs], chosen)
    logits = lambda w, r, c, m: np.bincount(r, weights=w[c], minlength=m)
    share = (label.sum() + 1) / (n + 2)
    weights = np.zeros(width + 1)
    weights[-1] = np.log(share / (1 - share))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, settings.steps + 1):
        w = weights[:-1]
        z = logits(w, row, column, n) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label) / n
        gradient = np.append(np.bincount(column, weights=error[row], minlength=width), error.sum())
        if pairs:
            change = logits(w, pair_row, pair_column, len(pairs)) - logits(w, swap_row, swap_column, len(pairs))
            change *= 2 * settings.penalty / n
            gradient[:-1] += np.bincount(pair_column, weights=change[pair_row], minlength=width)
            gradient[:-1] -= np.bincount(swap_column, weights=change[swap_row], minlength=width)
        gradient[:-1] += settings.ridge * w / n
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * (1 - 0.9 * step / settings.steps)
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(chosen.tolist(), weights[:-1].tolist(), strict=True)), float(weights[-1]), True)


def train(df: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> Model:
    """A model of the labelled rows of df, the same for the same rows in any order."""
    table = training_rows(df, labels, settings, key, text).toArrow()
    order = pc.sort_indices(table, [("key", "ascending"), ("print", "ascending")]).to_numpy()
    label = table.column("label").to_numpy().astype(np.float64)[order]

    def lists(name: str) -> list[np.ndarray | None]:
        """Views of one array a batch, in half the bytes: the driver makes no number an object and
        neither sorts nor joins the rows themselves."""
        found: list[np.ndarray | None] = []
        for column in table.column(name).chunks:
            ends, values = column.offsets.to_numpy(), column.values.to_numpy().astype(np.uint32)
            there = column.is_valid().to_numpy(zero_copy_only=False)
            found += [values[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], there, strict=True)]
        return [found[i] for i in order]

    words, others = lists("words"), lists("other")
    del table
    return fit(words, others, label, settings)


def scored(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns of df, and `score` and `predicted` (in place of columns of these names).

    Null and empty texts get the model's score for a text without words.
    """
    given = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4_000_000):
            scores = pa.array([given.value.score(t) for t in texts_of(batch, text)], type=pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])

    kept = df.drop("score", "predicted")
    found = kept.mapInArrow(score, StructType([*kept.schema.fields, StructField("score", DoubleType())]))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def training_fold(key: str = "doc_id"):
    """Rows that labels may be learnt from."""
    return remainder(key, 4) != 2


def score_documents(df: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of df with `held_out`, `score` and `predicted`."""
    model = train(df.where(training_fold(key)), labels, settings, key, text)
    return scored(df.withColumn("held_out", ~training_fold(key)), model, text, settings.threshold)
