"""Byte-level BPE by merge replay over the distinct words of a block of documents.

A block's distinct words lie in one array of symbols. An inverted index leads from the
rank of a mergeable pair to the positions where that pair stands; ranks are taken in
order, every position of a rank is merged at once, and only the touched neighbours get
new index entries. Words do not touch each other, so one replay encodes all of them.
Blocks are independent: there is no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import slices, texts_of

NO_RANK = np.iinfo(np.int32).max
#: The characters of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Blank run and what follows it. Every match of the word pattern lies in one such part.
PARTS = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
#: Parts whose words a task remembers from block to block.
REMEMBERED = 250_000


class Ranks:
    """A rank file's vocabulary: tokens by rank and the pairs that make each of them."""

    def __init__(self, raw: bytes) -> None:
        pairs = (line.split() for line in raw.splitlines() if line.strip())
        self.by_token = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.single = np.array([self.by_token[bytes([b])] for b in range(256)], dtype=np.int32)
        found: dict[int, int] = {}
        for token, rank in self.by_token.items():
            for cut in range(1, len(token)):
                left, right = self.by_token.get(token[:cut]), self.by_token.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.keys = np.array(sorted(found), dtype=np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], dtype=np.int32)
        lowest = np.full(max(self.by_token.values()) + 1, NO_RANK, dtype=np.int32)
        np.minimum.at(lowest, self.keys >> 32, self.ranks)
        np.minimum.at(lowest, self.keys & 0xFFFFFFFF, self.ranks)
        #: A token is settled if no pair it takes part in comes at its own rank or before.
        self.settled = lowest > np.arange(len(lowest))

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of token pairs, NO_RANK where the vocabulary has no such pair."""
        wanted = (left.astype(np.int64) << 32) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    @cached_property
    def bytes_of(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, and where each rank's bytes begin (and end)."""
        tokens = [b""] * (max(self.by_token.values()) + 1)
        for token, rank in self.by_token.items():
            tokens[rank] = token
        ends = np.cumsum([len(t) for t in tokens])
        return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.concatenate([[0], ends])


_loaded: dict[str, Ranks] = {}


def ranks_from(raw: bytes) -> Ranks:
    """The vocabulary of a rank file's bytes, built once in each Python worker."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _loaded:
        _loaded[key] = Ranks(raw)
    return _loaded[key]


class PairIndex:
    """Positions by the rank of the pair that stands there; ranks come out in order."""

    def __init__(self) -> None:
        self.positions: dict[int, list[np.ndarray]] = {}
        self.order: list[int] = []

    def add(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        real = ranks != NO_RANK
        positions, ranks = positions[real], ranks[real]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            if rank not in self.positions:
                self.positions[rank] = []
                heapq.heappush(self.order, rank)
            self.positions[rank].append(positions[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.order)
        return rank, np.unique(np.concatenate(self.positions.pop(rank)))


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in a row, and how many each word has.

    Merging one position at a time, lowest rank first and leftmost first within a word,
    is what a tokenizer does. All positions of a rank can go together if the token they
    make is settled; else one position of each word goes, and the others queue again.
    """
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    n = int(lengths.sum())
    if n == 0:
        return np.empty(0, dtype=np.int32), lengths
    token = np.full(n + 1, -1, dtype=np.int32)
    token[:n] = ranks.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
    ends = np.cumsum(lengths)
    following, previous = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    full = lengths > 0
    following[ends[full] - 1], previous[(ends - lengths)[full]] = n, n
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    rank_at = np.full(n + 1, NO_RANK, dtype=np.int32)
    rank_at[:n] = ranks.of_pairs(token[:n], token[following[:n]])
    index = PairIndex()
    index.add(np.arange(n, dtype=np.int32), rank_at[:n])
    while index.order:
        rank, at = index.pop()
        at = at[rank_at[at] == rank]
        if not len(at):
            continue
        if ranks.settled[rank]:
            at = _apart(at, following)
        else:
            first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            index.add(at[~first], rank_at[at[~first]])
            at = at[first]
        gone = following[at]
        after = following[gone]
        token[at], token[gone], rank_at[gone] = rank, -1, NO_RANK
        following[at], previous[after] = after, at
        before = previous[at]
        touched = np.concatenate([at, before[before < n]])
        fresh = ranks.of_pairs(token[touched], token[following[touched]])
        rank_at[touched] = fresh
        index.add(touched, fresh)
    alive = token[:n] >= 0
    return token[:n][alive], np.bincount(word[alive], minlength=len(words))


def _apart(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row, every other one from the left."""
    overlaps = np.concatenate([[False], following[at[:-1]] == at[1:]])
    if not overlaps.any():
        return at
    places = np.arange(len(at))
    begins = np.maximum.accumulate(np.where(overlaps, 0, places))
    return at[(places - begins) % 2 == 0]


class _Numbers(dict):
    """Gives every new key the next number."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _spread(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs flat[starts[i] : starts[i] + counts[i]] of the chosen i, in a row."""
    lengths = counts[chosen]
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts[chosen] - ends + lengths, lengths) + np.arange(ends[-1])]


class Encoder:
    """Encodes blocks of texts; remembers the parts of earlier blocks up to a bound."""

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        white = {r"\s": r"\p{White_Space}", r"\S": r"\P{White_Space}"}
        self.ranks, self.pattern = ranks, regex.compile(re.sub(r"\\[sS]", lambda m: white[m[0]], pattern))
        self.forget()

    def forget(self) -> None:
        self.parts = _Numbers()
        self.ids, self.counts = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.parts) > REMEMBERED:
            self.forget()
        known, number = len(self.parts), self.parts.__getitem__
        numbered = [np.fromiter(map(number, PARTS.findall(t)), dtype=np.int32) for t in texts]
        self._learn(list(self.parts)[known:])
        starts = np.cumsum(self.counts) - self.counts
        for parts in numbered:
            yield _spread(self.ids, starts, self.counts, parts)

    def _learn(self, parts: list[str]) -> None:
        words = _Numbers()
        split = [[words[w.encode("utf-8", "surrogatepass")] for w in self.pattern.findall(p)] for p in parts]
        ids, counts = replay(list(words), self.ranks)
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        chosen = np.fromiter((w for ws in split for w in ws), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(parts)), sizes)
        self.ids = np.concatenate([self.ids, _spread(ids, np.cumsum(counts) - counts, counts, chosen)])
        per_part = np.bincount(owner, weights=counts[chosen], minlength=len(parts)).astype(np.int64)
        self.counts = np.concatenate([self.counts, per_part])


def encode(df: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns: the key, and `ids`, the token ids of the whole text (null or empty: none).

    Special tokens' strings are ordinary text. Rows that repeat give repeated rows; a null
    key stays null; other columns are not read. The rank file is read on the driver and
    broadcast (its size is the vocabulary's, not the data's).
    """
    with open(rank_file, "rb") as file:
        raw = df.sparkSession.sparkContext.broadcast(file.read())

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_from(raw.value), pattern)
        for batch in slices(batches, "text", 4_000_000):
            ids = pa.array(list(encoder.encode(texts_of(batch))), type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids], names=[key, "ids"])

    chosen = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    return chosen.mapInArrow(blocks, f"`{key}` {kind}, ids array<int>")


def decoder(df: DataFrame, rank_file: str):
    """A column function from ids to the bytes they stand for (null: null)."""
    with open(rank_file, "rb") as file:
        raw = df.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        flat, starts = ranks_from(raw.value).bytes_of
        counts = np.diff(starts)
        return ids.map(lambda x: x if x is None else _spread(flat, starts, counts, np.asarray(x)).tobytes())

    return decode


def digests(encoded: DataFrame, decode, key: str = "doc_id") -> DataFrame:
    """Token count, and digests of the ids and of the decoded bytes."""
    joined: Column = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"),
    )
