"""Mixture-controlled packing of token streams into sequences of one length.

Each source is a queue of tokens. A window takes from every queue the tokens that the
target proportions give it, deficit round-robin with a quantum of one token: a queue's
next token is served when its deficit is largest, that is at the virtual time
(served + 1/2) / weight. How many tokens each queue has given at a window's start is then
a function of the window's number alone, so any task can begin at any window with the
deficits that all windows before it carried over, whatever partition they are in. A queue
that runs empty leaves its share to the others.

Tokens are made once and kept in the shared folder with their places in the queue.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dielens.llm.common import give_back, slices, texts_of
from dielens.plans.hold import hold

#: Words whose ids a task remembers.
REMEMBERED = 500_000
#: Bytes of text encoded at once.
AT_ONCE = 4_000_000
#: Most bytes of the queues' places by block that are sent to every executor.
SENT = 16_000_000


class WordIds:
    """Token ids of texts word by word, as bytes, for a byte-level tokenizer that drops blanks
    and case and keeps runs of letters together.

    A word of small Latin-1 letters, with or without a rest that begins with another ASCII character,
    is encoded as these two: the tokenizer never joins a letter with such a character. Letters
    alone need no normalising and no splitting, so they go to the merges at once.
    """

    # in UTF-8 the bytes of this class only come together as a-z and the letters U+00DF to U+00FF
    STEM = re.compile(rb"([a-z\xc3\x9f-\xb6\xb8-\xbf]++)((?:[^a-z\x80-\xff].*)?)", re.DOTALL)

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.merge = self.tokenizer.model.tokenize
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = [chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha()]
        written = {chr(raw): char for x in letters for raw, char in zip(x.encode(), shown(x)[0][0], strict=True)}
        #: Bytes of such letters that the model does not write as Latin-1 does.
        self.shown = [(raw, char) for raw, char in written.items() if raw != char]
        self.tokenizer.encode_special_tokens = True  # in the parts of words; see `encode` for texts
        self.plain = Tokenizer.from_str(tokenizer_json)
        self.added = [t.content.lower() for t in self.plain.get_added_tokens_decoder().values()]
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.code = "H" if self.kind is np.uint16 else "I"
        self.known: dict[bytes, bytes]  # words and their stems
        self.others: dict[bytes, bytes]
        self.forget()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; Arrow finds the different words of the block, which are looked up once.
        A text that may have an added token's string goes to the tokenizer as a whole, which cuts at these."""
        whole = {i for i, t in enumerate(texts) if self._has_added(t)}
        lower = [b"" if i in whole else t.encode("utf-8", "surrogatepass").lower() for i, t in enumerate(texts)]
        split = pa.compute.ascii_split_whitespace(pa.array(lower, pa.large_binary()).view(pa.large_string()))
        words = split.flatten().dictionary_encode()
        coded = pa.array(self._ids_of(words.dictionary), pa.large_binary()).take(words.indices)
        joined = pa.compute.binary_join(pa.ListArray.from_arrays(split.offsets, coded), pa.scalar(b"", coded.type))
        for i, ids in enumerate(joined.to_pylist()):
            if i in whole:
                ids = np.array(self.plain.encode(texts[i], add_special_tokens=False).ids, dtype=self.kind).tobytes()
            yield ids

    def _ids_of(self, different: pa.Array) -> list[bytes]:
        """Ids of words that differ; those not known yet are encoded first."""
        words = different.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.forget()
        found = list(map(self.known.get, words))
        fresh = [w for w, ids in zip(words, found, strict=True) if ids is None]
        self._merge_stems({w for w in fresh if w.isalpha()})
        parts = [(w, *(m.groups() if (m := self.STEM.fullmatch(w)) else (b"", w))) for w in fresh if not w.isalpha()]
        self._merge_stems({stem for _, stem, _ in parts}.difference(self.known))
        self._encode_others(list({other for _, _, other in parts if other}.difference(self.others)))
        self.known.update((w, self.known[stem] + self.others[other]) for w, stem, other in parts if other)
        return [self.known[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def _has_added(self, text: str) -> bool:
        if not self.added or all(t[0] not in text and t[0].upper() not in text for t in self.added):
            return False
        low = text.lower()
        return any(t in low for t in self.added)

    def forget(self) -> None:
        self.known, self.others = {}, {}

    def _merge_stems(self, fresh: set[bytes]) -> None:
        known, merge, code = self.known, self.merge, self.code
        for stem in fresh:
            text = stem.decode("latin-1")
            if not text.isascii():
                for raw, char in self.shown:
                    text = text.replace(raw, char)
            known[stem] = array(code, [t.id for t in merge(text)]).tobytes()

    def _encode_others(self, fresh: list[bytes], at_once: int = 10_000) -> None:
        for a in range(0, len(fresh), at_once):
            part = fresh[a : a + at_once]
            coded = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in part], add_special_tokens=False)
            self.others.update(zip(part, (array(self.code, e.ids).tobytes() for e in coded), strict=True))


_encoders: dict[int, WordIds] = {}


def encoder_of(tokenizer_json: str) -> WordIds:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _encoders:
        _encoders[key] = WordIds(tokenizer_json)
    return _encoders[key]


def tokenized(df: DataFrame, tokenizer_file: str, end_id: int, key: str, source: str, text: str) -> DataFrame:
    """(key, source, block, start, n, ids): a document's ids, the end id last, and its place
    in its source's queue: after the blocks before its own, `start` ids into it."""
    with open(tokenizer_file, encoding="utf-8") as file:
        given = df.sparkSession.sparkContext.broadcast(file.read())

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, queued = encoder_of(given.value), TaskContext.get().partitionId(), {}
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        for batch in slices(batches, "text", AT_ONCE):
            ids = [x + end for x in encoder.encode(texts_of(batch))]
            sizes = [len(x) // encoder.kind().itemsize for x in ids]
            starts = []
            for s, n in zip(batch.column("source").to_pylist(), sizes, strict=True):
                starts.append(queued.get(s, 0))
                queued[s] = starts[-1] + n
            columns = [pa.array([block] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("source"), *columns, pa.array(ids, pa.binary())],
                names=["key", "source", "block", "start", "n", "ids"],
            )
        encoder.forget()
        give_back()

    kind = df.schema[key].dataType.simpleString()
    queue = F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")
    chosen = df.select(F.col(key).alias("key"), queue, F.col(text).alias("text"))
    return chosen.mapInArrow(blocks, f"key {kind}, source string, block int, start long, n long, ids binary")


class Allotment:
    """How many tokens each queue has given when a window begins."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, length: int) -> None:
        self.totals, self.weights, self.length = totals.astype(np.int64), weights.astype(np.float64), length
        self.total = int(self.totals.sum())
        self.windows = -(-self.total // length)

    def served(self, time: np.ndarray) -> np.ndarray:
        """Tokens of each queue at or before a virtual time."""
        due = np.floor(np.minimum(time[:, None] * self.weights + 0.5, self.totals)).astype(np.int64)
        return np.minimum(due, self.totals)

    def before(self, windows: np.ndarray) -> np.ndarray:
        """A row for each window: tokens that each queue gave to the windows before it."""
        target = np.minimum(windows * self.length, self.total)
        low = np.zeros(len(windows))
        high = np.full(len(windows), ((self.totals + 1) / self.weights).max(initial=0.0))
        for _ in range(100):
            middle = (low + high) / 2
            if ((middle == low) | (middle == high)).all():
                break
            reached = self.served(middle).sum(axis=1) >= target
            low, high = np.where(reached, low, middle), np.where(reached, middle, high)
        given, extra = self.served(low), self.served(high)
        extra -= given
        missing = target - given.sum(axis=1)
        # tokens due at the very same time are served in the order of the queues
        return given + np.clip(missing[:, None] - (np.cumsum(extra, axis=1) - extra), 0, extra)


def _last_cuts(n: int) -> list[int]:
    """Ends of the sequences that a last, short window is cut into: powers of two."""
    out, at = [], 0
    for bit in reversed(range(n.bit_length())):
        if n >> bit & 1:
            at += 1 << bit
            out.append(at)
    return out


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs within pass so many rows at a time to Python; what the session says holds again afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        if rows:
            spark.conf.set(name, before)


def pack(
    df: DataFrame,
    tokenizer_file: str,
    length: int = 2048,
    end_id: int = 1,
    weights: Mapping[str, float] | None = None,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    rows_at_once: int | None = None,
) -> DataFrame:
    """One row for each piece: the key, `start` in its document, `length`, `doc_tokens`,
    `sequence_id`, `offset` there, and `ids`, the piece's ids as little-endian 32-bit.

    `weights` are the sources' target proportions; sources not named, and all of them by
    default, weigh as much as they have tokens. Every id of every row lies in one piece.
    Windows are full; the last tokens, fewer than a window, fill sequences whose lengths
    are powers of two, so there is no padding. Null and empty texts are the end id alone.
    A null source is the source ''. Repeated rows and null keys are packed like others;
    other columns are not read. No rows: no pieces. A window has room for `length` ids, so
    sources that matter number fewer than that; their table of totals is read on the driver.

    `rows_at_once`: texts that an executor and its workers exchange at a time while they are encoded,
    by default as many as the session says. Fewer take less memory, and a little more time.
    """
    with _batches_of(df.sparkSession, rows_at_once):
        queued = hold(tokenized(df, tokenizer_file, end_id, key, source, text))
    sums = queued.groupBy("source", "block").agg(F.sum("n").alias("tokens"))
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("source", "block", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("ahead"))
    by_source = sums.groupBy("source").agg(F.sum("tokens").alias("n"), F.sum(F.octet_length("source") + 32).alias("size"))
    counted = by_source.orderBy("source").collect()
    totals = {r["source"]: r["n"] for r in counted}
    if sum(r["size"] for r in counted) <= SENT:  # or else both sides are dealt by their key
        ahead = F.broadcast(ahead)
    names = list(totals)
    shares = np.array([(weights or {}).get(s, totals[s]) for s in names], dtype=np.float64)
    if len(shares) and not (shares > 0).all():
        raise ValueError("weights must be above 0")
    given = df.sparkSession.sparkContext.broadcast((names, np.array([totals[s] for s in names], dtype=np.int64), shares))
    placed = queued.join(ahead, ["source", "block"]).select("key", "source", (F.col("ahead") + F.col("start")).alias("at"), "n", "ids")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, totals, shares = given.value
        allotment, number = Allotment(totals, shares, length), {s: i for i, s in enumerate(names)}
        for batch in batches:
            for part in slices([batch], "ids", 2_000_000):
                queue = np.array([number[s] for s in part.column("source").to_pylist()], dtype=np.int64)
                yield from _pieces(part, queue, allotment, key)

    kind = df.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(cut, shape)


def _pieces(rows: pa.RecordBatch, queue: np.ndarray, allotment: Allotment, key: str) -> Iterator[pa.RecordBatch]:
    if not len(queue):
        return
    at, n = rows.column("at").to_numpy(), rows.column("n").to_numpy()
    slack = len(allotment.totals) + 1

    def near(tokens: np.ndarray, by: int) -> np.ndarray:
        """A window at or before (after) the one that holds a queue's token."""
        rank = allotment.served((tokens + 0.5) / allotment.weights[queue]).sum(axis=1) + by * slack
        return np.clip(rank // allotment.length + by, 0, allotment.windows - 1)

    low, high = near(at, -1), near(at + n - 1, 1)
    windows = np.unique(_ranges(low, high - low + 1))
    begins, ends = allotment.before(windows), allotment.before(windows + 1)
    row = np.repeat(np.arange(len(queue)), high - low + 1)
    place = np.searchsorted(windows, _ranges(low, high - low + 1))
    mine = queue[row]
    first = np.maximum(begins[place, mine], at[row])
    last = np.minimum(ends[place, mine], (at + n)[row])
    real = last > first
    row, place, mine, first, last = (x[real] for x in (row, place, mine, first, last))
    inside = np.cumsum(ends - begins, axis=1) - (ends - begins)
    offset = inside[place, mine] + first - begins[place, mine]
    sequence = windows[place]
    row, first, last, offset, sequence = _end_cut(row, first, last, offset, sequence, allotment)
    start, size = first - at[row], last - first
    per_id = np.dtype(np.uint16).itemsize if len(rows.column("ids")[0].as_py()) == 2 * n[0] else 4
    kind = np.uint16 if per_id == 2 else np.uint32
    wide = [np.frombuffer(x, dtype=kind).astype("<u4").tobytes() for x in rows.column("ids").to_pylist()]
    spans = zip(row.tolist(), (4 * start).tolist(), (4 * (start + size)).tolist(), strict=True)
    ids = pa.array([wide[r][a:b] for r, a, b in spans], type=pa.binary())
    columns = [start, size, n[row], sequence, offset]
    yield pa.RecordBatch.from_arrays(
        [rows.column("key").take(pa.array(row)), *[pa.array(c.astype(np.int64)) for c in columns], ids],
        names=[key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def _end_cut(row, first, last, offset, sequence, allotment: Allotment):
    """Pieces of the last window cut where its sequences end, and numbered by them."""
    rest = allotment.total % allotment.length
    final = sequence == allotment.windows - 1
    if not rest or not final.any():
        return row, first, last, offset, sequence
    out = [(row[~final], first[~final], last[~final], offset[~final], sequence[~final])]
    begin = 0
    for i, end in enumerate(_last_cuts(rest)):
        r, f, o = row[final], first[final], offset[final]
        a, b = np.maximum(o, begin), np.minimum(o + last[final] - f, end)
        real = b > a
        out.append((r[real], (f + a - o)[real], (f + b - o)[real], (a - begin)[real], (sequence[final] + i)[real]))
        begin = end
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
