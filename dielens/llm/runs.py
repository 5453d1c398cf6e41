"""Periodic runs of words, found on a Re-Pair grammar.

The words of a block of texts become ids, and frequent pairs of neighbours are replaced by
new symbols until no pair is left twice (Re-Pair, several pairs a round that cannot overlap).
What remains is folded in halves, so every stretch of text hangs under one symbol. A run lies
across the middle of the lowest symbol that holds it: runs are looked for once at the middle
of each symbol and carried over to all places the symbol is derived at; pieces of the same
period that overlap by a period are one run.

Only words that stand in a window of six repeated in their text take part: every word of a
run of twelve or more does, so the text is cut at all others without losing a run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import slices, texts_of, words

#: A run has this many words at least, and two periods.
SHORTEST = 12
#: Words that are replaced and searched together; a longer text is a block of its own.
BLOCK_WORDS = 200_000
#: Middles and periods that are tried in one array operation.
TRIED_AT_ONCE = 1 << 21


@dataclass(frozen=True)
class Grammar:
    """Symbols of two parts: length and length of the left part, and where each is derived."""

    length: np.ndarray
    middle: np.ndarray
    derived: np.ndarray  # symbol number of each derivation
    start: np.ndarray  # its first word


def repeated_words(ids: np.ndarray, text: np.ndarray, width: int = SHORTEST // 2) -> np.ndarray:
    """Which words stand in a window of `width` that its text has twice."""
    n = len(ids) - width + 1
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    if n > 0:
        key = text[:n].astype(np.uint64)
        for k in range(width):
            key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64)
            key ^= key >> np.uint64(29)
        whole = np.flatnonzero(text[:n] == text[width - 1 :])  # equal keys by chance only keep more words
        order = whole[np.argsort(key[whole], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        np.add.at(covered, order[twice], 1)
        np.add.at(covered, order[twice] + width, -1)
    return covered[:-1].cumsum() > 0


def _same_pairs(seq: np.ndarray) -> np.ndarray:
    """Of the pairs of equal neighbours every other one, from each stretch's first."""
    new = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
    since = np.arange(len(seq)) - np.repeat(new, np.diff([*new, len(seq)]))
    return (since[:-1] % 2 == 0) & (seq[1:] == seq[:-1])


def _chosen(left: np.ndarray, right: np.ndarray, symbols: int) -> np.ndarray:
    """Pairs, most frequent first, that cannot overlap: no symbol ends one and begins another."""
    role = bytearray(symbols)  # 1: begins pairs, 2: ends pairs, 3: is paired with itself
    taken = np.zeros(len(left), dtype=bool)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        if a == b:
            if not role[a]:
                role[a] = 3
                taken[i] = True
        elif role[a] < 2 and role[b] in (0, 2):
            role[a], role[b] = 1, 2
            taken[i] = True
    return taken


def re_pair(ids: np.ndarray, piece: np.ndarray) -> Grammar:
    """The grammar of ids cut into pieces (their numbers, rising); no symbol spans two."""
    seq, at, piece = ids.astype(np.int64), np.arange(len(ids)), piece.astype(np.int64)
    size = np.ones(len(ids), dtype=np.int64)
    symbols = words_known = int(ids.max()) + 1 if len(ids) else 0
    lengths, middles, derived, starts = [], [], [], []

    def replace(first: np.ndarray, symbol: np.ndarray) -> None:
        nonlocal seq, at, size, piece
        derived.append(symbol - words_known)
        starts.append(at[first])
        left, both = size[first], size[first] + size[first + 1]
        fresh, example = np.unique(symbol, return_index=True)
        lengths.append(both[example])
        middles.append(left[example])
        assert len(fresh) == fresh[-1] - fresh[0] + 1  # symbols are numbered as they come
        seq[first], size[first] = symbol, both
        keep = np.ones(len(seq), dtype=bool)
        keep[first + 1] = False
        seq, at, size, piece = seq[keep], at[keep], size[keep], piece[keep]

    while len(seq) > 1:
        inside = piece[1:] == piece[:-1]
        equal = seq[1:] == seq[:-1]
        usable = np.flatnonzero(inside & (~equal | _same_pairs(seq)))
        key = seq[usable] * symbols + seq[usable + 1]
        pairs, where, count = np.unique(key, return_inverse=True, return_counts=True)
        often = np.flatnonzero(count > 1)
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")]
        chosen = often[_chosen(pairs[often] // symbols, pairs[often] % symbols, symbols)]
        number = np.full(len(pairs), -1, dtype=np.int64)
        number[chosen] = symbols + np.arange(len(chosen))
        symbol = number[where]
        replace(usable[symbol >= 0], symbol[symbol >= 0])
        symbols += len(chosen)

    while True:  # what is left has no pair twice: halves, each a symbol of one place
        new = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(piece) else np.empty(0, dtype=int)
        since = np.arange(len(seq)) - np.repeat(new, np.diff([*new, len(seq)])) if len(seq) else np.empty(0, dtype=int)
        first = np.flatnonzero((since[:-1] % 2 == 0) & (piece[1:] == piece[:-1]))
        if not len(first):
            break
        replace(first, symbols + np.arange(len(first)))
        symbols += len(first)
    flat = lambda x: np.concatenate(x) if x else np.empty(0, dtype=np.int64)
    return Grammar(flat(lengths), flat(middles), flat(derived), flat(starts))


class Stretches:
    """Exact comparison of stretches of a sequence, by names of all those of 2^k ids."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.names = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
        while 2 << (len(self.names) - 1) <= longest:
            last, half = self.names[-1], 1 << (len(self.names) - 1)
            if len(last) <= half:
                break
            self.names.append(np.unique(last[:-half] * (int(last.max()) + 1) + last[half:], return_inverse=True)[1])

    def equal(self, a: np.ndarray, b: np.ndarray, level: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=bool)
        for k in np.unique(level):
            these = level == k
            out[these] = self.names[k][a[these]] == self.names[k][b[these]]
        return out

    def after(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal ids from a and b on, up to `most`."""
        n = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            for _ in range(2 if k == len(self.names) - 1 else 1):
                can = np.flatnonzero(n + (1 << k) <= most)
                can = can[self.names[k][a[can] + n[can]] == self.names[k][b[can] + n[can]]]
                n[can] += 1 << k
        return n

    def before(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal ids that end before a and b, up to `most`."""
        n = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            for _ in range(2 if k == len(self.names) - 1 else 1):
                can = np.flatnonzero(n + (1 << k) <= most)
                back = n[can] + (1 << k)
                can = can[self.names[k][a[can] - back] == self.names[k][b[can] - back]]
                n[can] += 1 << k
        return n


def middle_runs(ids: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, offset in it, length, period) of the runs across each symbol's middle.

    With period q, ids equal their neighbour q on over a stretch of the run's length less q.
    It holds the middle m or m - q, and so the half of that many ids before or after.
    """
    symbol = np.flatnonzero(grammar.length >= SHORTEST)
    _, example = np.unique(grammar.derived, return_index=True)
    first = grammar.start[example]
    tried = grammar.length[symbol] // 2
    found = [np.empty((4, 0), dtype=np.int64)]
    if not len(symbol):
        return tuple(found[0])
    same = Stretches(ids, int(grammar.length[symbol].max()))
    bounds = np.searchsorted(np.cumsum(tried), np.arange(TRIED_AT_ONCE, tried.sum(), TRIED_AT_ONCE)) + 1
    for part in np.split(np.arange(len(symbol)), np.unique(bounds)):
        x = np.repeat(symbol[part], tried[part])
        ends = np.cumsum(tried[part])
        q = np.arange(len(x)) - np.repeat(ends - tried[part], tried[part]) + 1
        low, high = first[x], first[x] + grammar.length[x]
        for shift in (0, 1):
            m = low + grammar.middle[x] - shift * q
            need = np.maximum(q, SHORTEST - q)
            level = np.floor(np.log2(np.maximum(need // 2, 1))).astype(np.int64)
            level = np.minimum(level, len(same.names) - 1)
            w = 1 << level
            hit = np.zeros(len(x), dtype=bool)
            on = np.flatnonzero((m >= low) & (m + q + w <= high))
            hit[on] = same.equal(m[on], m[on] + q[on], level[on])
            back = np.flatnonzero(~hit & (m - w >= low) & (m + q <= high))
            hit[back] = same.equal(m[back] - w[back], m[back] - w[back] + q[back], level[back])
            i = np.flatnonzero(hit)
            a, b = m[i], m[i] + q[i]
            forth = same.after(a, b, high[i] - b)
            back = same.before(a, b, a - low[i])
            length = forth + back + q[i]
            ok = (length >= SHORTEST) & (length >= 2 * q[i])
            i, back, length = i[ok], back[ok], length[ok]
            found.append(np.stack([x[i], m[i] - back - low[i], length, q[i]]))
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1][[0, 1, 2, 3]])]  # by symbol, offset, length, period
    new = np.ones(rows.shape[1], dtype=bool)  # of one stretch the smallest period
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return tuple(rows[:, new])


def find_runs(ids: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs inside the pieces, by start, then period."""
    grammar = re_pair(ids, piece)
    symbol, offset, length, period = middle_runs(ids, grammar)
    order = np.argsort(grammar.derived, kind="stable")
    low = np.searchsorted(grammar.derived[order], symbol, "left")
    times = np.searchsorted(grammar.derived[order], symbol, "right") - low
    each = np.repeat(np.arange(len(symbol)), times)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
    start = grammar.start[order][low[each] + nth] + offset[each]
    end, q = start + length[each], period[each]
    order = np.lexsort((-end, start, q))
    start, end, q = start[order], end[order], q[order]
    if not len(start):
        return start, end, q
    # within a period, pieces by start: one that begins a period or more before the end so far
    # belongs to the same run; lifting each period over all ends before lets one pass do
    lift = np.cumsum(np.concatenate([[0], (q[1:] != q[:-1]).astype(np.int64)])) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (start[1:] + lift[1:] > reach[:-1] - q[1:]) | (q[1:] != q[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    start, end, q = start[first], (reach - lift)[last], q[first]
    order = np.lexsort((q, end, start))  # of one stretch the smallest period
    start, end, q = start[order], end[order], q[order]
    keep = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def runs_of(texts: list[list[int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each list of word ids its runs (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.fromiter((i for t in texts for i in t), dtype=np.int64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    empty = (np.empty(0, dtype=np.int64),) * 3
    if not len(ids):
        return [empty] * len(texts)
    covered = repeated_words(ids, text)
    cut = np.ones(len(ids), dtype=bool)
    cut[1:] = (covered[1:] != covered[:-1]) | (text[1:] != text[:-1])
    edges = np.flatnonzero(cut)
    long = np.diff([*edges, len(ids)])
    good = covered[edges] & (long >= SHORTEST)
    keep = np.repeat(good, long)
    if not keep.any():
        return [empty] * len(texts)
    place, piece = np.flatnonzero(keep), np.repeat(np.arange(len(edges)), long)[keep]
    number = np.unique(piece, return_inverse=True)[1]
    # a name of its own between two pieces, so that no stretch spans them
    at = np.arange(len(place)) + number
    spread = np.arange(int(at[-1]) + 1, dtype=np.int64) + int(ids.max()) + 1
    spread[at] = ids[place]
    pieces = np.full(len(spread), -1, dtype=np.int64)
    pieces[at] = number
    gaps = np.flatnonzero(pieces < 0)
    pieces[gaps] = number.max() + 1 + np.arange(len(gaps))
    start, length, period = find_runs(np.unique(spread, return_inverse=True)[1], pieces)
    back = np.zeros(len(spread), dtype=np.int64)
    back[at] = place
    start = back[start]
    whose = text[start]
    out, low = [], np.searchsorted(whose, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        these = slice(low[i], low[i + 1])
        out.append((start[these] - begin[i], length[these], period[these]))
    return out


def stretched(found: list, h: int) -> list:
    """The words of a text, repeated from some place on for one id hash in ten."""
    n, g = len(found), h // 10
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + (found[a : a + p] * ((n - a) // p + 1))[: n - a]


def collapsed(found: list, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list:
    """The words without those that a run holds after its first period."""
    if not len(start):
        return found
    marks = np.zeros(len(found) + 1, dtype=np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + length, -1)
    return [found[i] for i in np.flatnonzero(marks[:-1].cumsum() == 0)]


def periodic_runs(df: DataFrame, stretch: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: the key, `n_words`, `runs`, an array of (start, length,
    period) by start and then period, and `collapsed`, the words without those that a run
    holds after its first period, joined by one space.

    A run is a stretch of at least twelve words and two periods whose words equal those a
    period on, as long as it can be; its period is its smallest. Null, empty and blank texts
    have no words and no runs. A null key stays null; repeated rows each give a row; other
    columns are not read. With `stretch`, texts whose key has a crc32 divisible by ten are
    repeated from some word on first (`stretched`); a null key counts as the empty text.
    Every text is a task's own work: no shuffle, and memory follows the longest text.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes = batch.column("h").to_pylist()
            texts = [stretched(words(t), h) if stretch else words(t) for t, h in zip(texts_of(batch), hashes, strict=True)]
            known: dict[bytes, int] = {}
            i = 0
            while i < len(texts):
                j, held = i, 0
                while j < len(texts) and (j == i or held + len(texts[j]) <= BLOCK_WORDS):
                    held += len(texts[j])
                    j += 1
                part = texts[i:j]
                found = runs_of([[known.setdefault(w, len(known)) for w in t] for t in part])
                yield _rows(batch.column("key").slice(i, j - i), part, found, key)
                i = j

    kind = df.schema[key].dataType.simpleString()
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    chosen = df.select(F.col(key).alias("key"), h.alias("h"), F.col(text).alias("text"))
    schema = f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return chosen.mapInArrow(blocks, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def _rows(keys: pa.Array, texts: list[list[bytes]], found: list, key: str) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
    columns = [pa.array(np.concatenate([f[i] for f in found]).astype(np.int64)) for i in range(3)]
    runs = pa.StructArray.from_arrays(columns, names=["start", "length", "period"])
    kept = pa.array([b" ".join(collapsed(t, *f)) for t, f in zip(texts, found, strict=True)], type=pa.binary())
    sizes = pa.array([len(t) for t in texts], type=pa.int64())
    return pa.RecordBatch.from_arrays(
        [keys, sizes, pa.ListArray.from_arrays(pa.array(ends), runs), kept], names=[key, "n_words", "runs", "collapsed"]
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest (ties: smallest start, then period), and hashes of all of
    them and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("_best", longest).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.l").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("_best.l") / (-F.col("_best.p"))).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
