"""A log-bilinear language model over word classes, trained by noise-contrastive estimation.

A word is a class of its own if it is among the most frequent ones; the others share
classes by their last two bytes, and within a class a word has its smoothed share of the
class's count. The model predicts a token's class from the two classes before it:
log-bilinear, a context's vector is the sum of its words' vectors, scaled by position,
and a class's score is its product with the class's own vector. Training never
normalises: it tells tokens from noise drawn from the class counts. Scoring does: with
two context classes all contexts fit in one batched matrix product, whose rows are
normalised once in each worker.

Word counts come from all training texts. Counts of the `COMMON` most frequent words go to
every task; all other words meet their counts in a join, so no vocabulary has to fit
anywhere. Each training pass reads all training texts; tasks train on their own texts and
Spark averages their parameters, weighted by tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import lower_words, remainder, slices, texts_of
from dielens.plans.hold import hold

#: Words with a class of their own, classes of all other words, dimensions of a vector.
HEAD, TAILS, WIDTH = 190, 64, 24
CLASSES = 1 + HEAD + TAILS
CONTEXT = 2
COMMON = 65_536
#: The end of a text in the table of counts; no word has a blank.
END = b"\n"


def tail_class(word: bytes) -> int:
    return 1 + HEAD + zlib.crc32(word[-2:]) % TAILS


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = number = len(self)
        return number


# --- counts ---------------------------------------------------------------------------------


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over whole texts, the end of a text counted too. Tasks combine first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in slices(batches, "text"):
            counts[END] += batch.num_rows
            for t in texts_of(batch):
                counts.update(lower_words(t))
            if len(counts) > 400_000:
                yield rows(counts)
                counts.clear()
        if counts:
            yield rows(counts)

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        words, n = pa.array(counts.keys(), type=pa.binary()), pa.array(counts.values(), type=pa.int64())
        return pa.RecordBatch.from_arrays([words, n], names=["word", "c"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(count, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What every task knows of the counts; its size does not grow with the corpus."""

    total: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray
    #: Denominators of words within each class, and the classes' counts.
    within: np.ndarray
    classes: np.ndarray
    name: str

    @property
    def base_log(self) -> float:
        return float(np.log10(self.total + 0.1 * (self.distinct + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Reads the bounded parts of a table of counts. Equal counts go by the word."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.where(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(COMMON).collect()
    words = [bytes(r["word"]) for r in top]
    head = words[:HEAD]
    tail = F.crc32(F.expr("substring(word, -2, 2)")) % TAILS
    rest = counts.where(F.col("word") != F.lit(END))
    by_tail = {r["t"]: (r["n"], r["v"]) for r in rest.groupBy(tail.alias("t")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    ends = total - sum(n for n, _ in by_tail.values())
    number, size = np.zeros(CLASSES), np.zeros(CLASSES)
    for t, (n, v) in by_tail.items():
        number[1 + HEAD + t], size[1 + HEAD + t] = n, v
    number[0] = ends
    for i, r in enumerate(top[:HEAD]):
        number[1 + i] = r["c"]
        number[tail_class(head[i])] -= r["c"]
        size[tail_class(head[i])] -= 1
    within = np.log10(number + 0.1 * (size + 1))
    return Vocabulary(total, distinct, words, np.array([r["c"] for r in top], dtype=np.int64), within, number, uuid4().hex)


class Reader:
    """Turns texts into word numbers, classes and known counts, a slice at a time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.known = {w: i for i, w in enumerate(vocabulary.words)}

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Word number of each token (-1: end), its text; and by word number: the words,
        their classes and their counts (-1: not known here)."""
        numbers = _Numbers()
        parts, end = [], np.array([-1], dtype=np.int32)
        for t in texts:
            parts += [np.fromiter(map(numbers.__getitem__, lower_words(t)), dtype=np.int32), end]
        lengths = np.array([len(p) + 1 for p in parts[::2]], dtype=np.int64)
        words, get = list(numbers), self.known.get
        places = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        classes = np.where(places < HEAD, places + 1, 0).astype(np.int64)
        for i in np.flatnonzero((places < 0) | (places >= HEAD)).tolist():
            classes[i] = tail_class(words[i])
        counts = np.append(self.v.counts, -1)[places]
        return np.concatenate(parts), np.repeat(np.arange(len(texts)), lengths), words, classes, counts


_readers: dict[str, Reader] = {}


def reader_of(vocabulary: Vocabulary) -> Reader:
    if vocabulary.name not in _readers:
        _readers.clear()
        _readers[vocabulary.name] = Reader(vocabulary)
    return _readers[vocabulary.name]


def with_context(classes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The CONTEXT classes before each token, nearest first; class 0 before a text begins."""
    out = np.zeros((len(classes), CONTEXT), dtype=np.int64)
    for i in range(1, CONTEXT + 1):
        inside = text[i:] == text[:-i]
        out[i:, i - 1] = np.where(inside, classes[:-i], 0)
    return out


# --- the model ------------------------------------------------------------------------------


class LogBilinear:
    """Context vectors, class vectors, scales by position, and a bias for each class."""

    SHAPES = ((CLASSES, WIDTH), (CLASSES, WIDTH), (CONTEXT, WIDTH), (CLASSES,))
    SIZE = sum(int(np.prod(s)) for s in SHAPES)

    def __init__(self, flat: np.ndarray) -> None:
        self.parts, at = [], 0
        for shape in self.SHAPES:
            n = int(np.prod(shape))
            self.parts.append(flat[at : at + n].reshape(shape).astype(np.float32))
            at += n

    @classmethod
    def start(cls, classes: np.ndarray, seed: int) -> np.ndarray:
        """Small random vectors; biases that give the classes their own frequencies."""
        rng = np.random.default_rng(seed)
        flat = rng.normal(0, 0.1, cls.SIZE)
        at = cls.SIZE - CLASSES
        flat[at - CONTEXT * WIDTH : at] = 1.0
        flat[at:] = np.log(noise_shares(classes))
        return flat

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts]).astype(np.float64)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        read, _, scale, _ = self.parts
        return sum(read[context[:, i]] * scale[i] for i in range(CONTEXT))

    def table(self) -> np.ndarray:
        """log10 P(class | context) for every context, nearest class first."""
        _, write, _, bias = self.parts
        out = np.empty((CLASSES**CONTEXT, CLASSES), dtype=np.float32)
        every = np.stack(np.unravel_index(np.arange(len(out)), (CLASSES,) * CONTEXT), axis=1)
        for a in range(0, len(out), 8192):
            scores = self.predicted(every[a : a + 8192]) @ write.T + bias
            scores -= scores.max(axis=1, keepdims=True)
            scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
            out[a : a + 8192] = scores / np.log(10)
        return out


def noise_shares(classes: np.ndarray) -> np.ndarray:
    return (classes + 1) / (classes + 1).sum()


def _sum_rows(into: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows summed by class, without a loop over them."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out = np.zeros((into, rows.shape[1]), dtype=np.float32)
    out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Trainer:
    """Adagrad on minibatches; noise is shared by a minibatch."""

    def __init__(self, start: np.ndarray, classes: np.ndarray, seed: int, rate: float = 0.1, batch: int = 4096, noise: int = 64) -> None:
        self.model, self.rate, self.batch, self.noise = LogBilinear(start), rate, batch, noise
        self.squares = [np.full_like(p, 0.1) for p in self.model.parts]
        self.shares = noise_shares(classes)
        self.expected = np.log(self.noise * self.shares).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def learn(self, target: np.ndarray, context: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        for a in range(0, len(order), self.batch):
            chosen = order[a : a + self.batch]
            self._step(target[chosen], context[chosen])

    def _step(self, target: np.ndarray, context: np.ndarray) -> None:
        read, write, scale, bias = self.model.parts
        drawn = self.rng.choice(CLASSES, self.noise, p=self.shares)
        predicted = self.model.predicted(context)
        real = (predicted * write[target]).sum(axis=1) + bias[target] - self.expected[target]
        false = predicted @ write[drawn].T + bias[drawn] - self.expected[drawn]
        n = np.float32(len(target))
        up = 1 / (1 + np.exp(np.clip(real, -30, 30))) / n
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30))) / n
        to_predicted = up[:, None] * write[target] + down @ write[drawn]
        g_write = _sum_rows(CLASSES, target, up[:, None] * predicted)
        np.add.at(g_write, drawn, down.T @ predicted)
        g_bias = np.bincount(target, weights=up, minlength=CLASSES) + np.bincount(drawn, weights=down.sum(axis=0), minlength=CLASSES)
        g_read, g_scale = np.zeros_like(read), np.zeros_like(scale)
        for i in range(CONTEXT):
            g_read += _sum_rows(CLASSES, context[:, i], to_predicted * scale[i])
            g_scale[i] = (to_predicted * read[context[:, i]]).sum(axis=0)
        for p, s, g in zip(self.model.parts, self.squares, (g_read, g_write, g_scale, g_bias.astype(np.float32)), strict=True):
            s += g * g * n  # gradients are means; their size does not depend on the batch
            p += self.rate * g * np.sqrt(n) / np.sqrt(s)


def train(df: DataFrame, vocabulary: Vocabulary, passes: int = 1, seed: int = 7, text: str = "text") -> np.ndarray:
    """The model's parameters after `passes` over all texts of df.

    A task starts from the common parameters, trains on all of its texts and gives its own
    parameters times its tokens; Spark sums them by parameter. Only the sums, as many as
    the model has parameters, come to the driver. No texts: the start parameters.
    """
    spark = df.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)
    flat = LogBilinear.start(vocabulary.classes, seed)
    for done in range(passes):
        start = spark.sparkContext.broadcast(flat)

        def learn(batches: Iterable[pa.RecordBatch], start=start, done=done) -> Iterator[pa.RecordBatch]:
            reader = reader_of(known.value)
            trainer, tokens = None, 0
            for batch in slices(batches, "text", 4_000_000):
                number, owner, _, classes, _ = reader.read(texts_of(batch))
                target = np.append(classes, 0)[number]
                trainer = trainer or Trainer(start.value, known.value.classes, seed + done)
                trainer.learn(target, with_context(target, owner))
                tokens += len(target)
            if tokens:
                values = trainer.model.flat * tokens
                columns = [np.arange(len(values), dtype=np.int32), values, np.full(len(values), tokens, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "value", "tokens"])

        learnt = df.select(F.col(text).alias("text")).mapInArrow(learn, "at int, value double, tokens long")
        means = learnt.groupBy("at").agg((F.sum("value") / F.sum("tokens")).alias("mean")).collect()
        if means:
            flat = np.array([m["mean"] for m in sorted(means, key=lambda m: m["at"])])
    return flat


_tables: dict[str, np.ndarray] = {}


def score(df: DataFrame, vocabulary: Vocabulary, counts: DataFrame, parameters: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: the key, `n_tokens`, `n_known`, `base_score`, `score`.

    Null and empty texts are their end alone. A null key stays null; repeated rows each
    give a row. Words that are common get their counts in the task. The others are sent to
    their counts by word, as many rows as a text has different such words; a word that is
    not in the table has count 0.
    """
    spark, name = df.sparkSession, uuid4().hex
    known, given = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(parameters)
    kind = df.schema[key].dataType.simpleString()

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, reader = known.value, reader_of(known.value)
        if name not in _tables:
            _tables.clear()
            _tables[name] = LogBilinear(given.value).table()
        table, at = _tables[name], TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text", 4_000_000):
            number, owner, words, classes, counts = reader.read(texts_of(batch))
            n = batch.num_rows
            classes = np.append(classes, 0)
            target = classes[number]
            context = np.ravel_multi_index(tuple(with_context(target, owner).T), (CLASSES,) * CONTEXT)
            own = np.append(np.where(counts < 0, 0.0, np.log10(np.maximum(counts, 0) + 0.1)), np.log10(v.classes[0] + 0.1))
            inner = np.where(classes > HEAD, own - v.within[classes], 0.0)
            inner[:-1][counts < 0] = -v.within[classes[:-1][counts < 0]]
            by_text = lambda x: np.bincount(owner, weights=x, minlength=n)
            rare = np.flatnonzero(np.append(counts < 0, False)[number])
            pairs, times = np.unique(owner[rare].astype(np.int64) << 32 | number[rare], return_counts=True)
            ends = np.searchsorted(pairs >> 32, np.arange(n + 1)).astype(np.int32)
            known_ = np.append(counts > 0, v.classes[0] > 0)[number]
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array([words[i] for i in (pairs & 0xFFFFFFFF).tolist()], type=pa.binary())),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(at, at + n)),
                    batch.column("key"),
                    pa.array(np.bincount(owner, minlength=n)),
                    pa.array(by_text(known_).astype(np.int64)),
                    pa.array(by_text(own[number])),
                    pa.array(by_text(table[context, target] + inner[number])),
                    *lists,
                ],
                names=["at", "key", "n_tokens", "n_known", "base", "score", "rare", "times"],
            )
            at += n

    shape = f"at long, key {kind}, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<int>"
    scored = hold(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(parts, shape))
    pairs = scored.select("at", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("at", "p.rare", "p.times")
    looked_up = pairs.join(counts.withColumnRenamed("word", "rare"), "rare", "left")
    c = F.coalesce("c", F.lit(0))
    rare = looked_up.groupBy("at").agg(
        F.sum(F.log10(c + 0.1) * F.col("times")).alias("logs"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    joined = scored.drop("rare", "times").join(rare, "at", "left")
    return joined.select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(vocabulary.base_log)).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def score_documents(df: DataFrame, folds: int = 10, passes: int = 1, key: str = "doc_id") -> DataFrame:
    """Learns from the rows whose fold is not 0 and scores all rows."""
    held_out = remainder(key, folds) == 0
    training = df.where(~held_out)
    counts = hold(word_counts(training))
    known = vocabulary(counts)
    scored = score(df, known, counts, train(training, known, passes), key)
    return scored.select(
        key, held_out.alias("held_out"), "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
