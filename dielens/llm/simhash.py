"""SimHash fingerprints and exact links between them by tiles.

Distinct fingerprints are tiled by the population counts of their four 16-bit parts. Two
fingerprints that differ in r bits have part counts that differ by r at most in sum, so a
tile meets only the tiles within that distance; all others are skipped. Tiles that meet
are compared exactly, by exclusive-or and bit counts on whole arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import lower_words, slices, texts_of
from dielens.llm.components import connected_components
from dielens.plans.hold import hold

PARTS = 4
#: Most fingerprints of a tile in one comparison; a larger tile is cut by a hash.
CHUNK = 4096
#: Rounds in which texts are checked against their nearest ones before all pairs are.
ROUNDS = 3


def shingle_hashes(words: list[bytes], width: int, seed: int = 42) -> np.ndarray:
    """The hashes of the word shingles, repeats included; fewer words are one shingle."""
    spans = range(max(len(words) - width + 1, 1) if words else 0)
    return np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), seed) for i in spans), dtype="<u8", count=len(spans)
    )


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 4096):
        part = hashes[a : a + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(words: list[bytes], width: int = 3, seed: int = 42) -> int:
    """The bits set in over half the hashes of the word shingles, repeats included."""
    return majority(shingle_hashes(words, width, seed))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Columns: the key and `fp`, the fingerprint's bits as a long. Null texts are empty."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bits = np.array([fingerprint(lower_words(t), width) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(bits.view(np.int64))], names=[key, "fp"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(blocks, f"`{key}` {kind}, fp long")


def _part_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four parts, packed one byte each into a long."""
    parts = fps.astype("<u8").view("<u2").reshape(len(fps), PARTS)
    return (np.bitwise_count(parts).astype(np.int64) << (8 * np.arange(PARTS))).sum(axis=1)


def _steps(radius: int) -> list[int]:
    """Tile distances in one direction of all tiles within the radius."""
    around = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius]
    packed = [sum(x << (8 * i) for i, x in enumerate(d)) for d in around]
    return sorted(x for x in packed if x > 0)


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join the same values as the links (a, b): each to its smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        fresh = label.copy()
        np.minimum.at(fresh, left, low)
        np.minimum.at(fresh, right, low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that join all those within the
    radius: what is linked directly or by way of others is linked in the result.

    Each tile goes once to its own place and once to each tile before it within the
    radius (64 of them at radius 3), whatever the number of rows. The table of tiles, at
    most 17 ** 4 rows, is broadcast; it says which places exist and into how many chunks
    a large tile is cut.
    """
    tile = F.lit(0).cast("long")
    for i in range(PARTS):
        part = F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF)
        tile = tile + F.shiftleft(F.bit_count(part).cast("long"), 8 * i)
    tiled = fps.withColumn("tile", tile)
    chunks = tiled.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    steps = F.array(F.lit(0).cast("long"), *[F.lit(s).cast("long") for s in _steps(radius)])
    sent = (
        tiled.join(F.broadcast(chunks.withColumnRenamed("chunks", "own")), "tile")
        .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("own")).cast("int"))
        .withColumn("step", F.explode(steps))
        .withColumn("home", F.col("tile") - F.col("step"))
        .join(F.broadcast(chunks.withColumnRenamed("tile", "home")), "home")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .where("step > 0 or chunk >= mine")
        .select("home", "chunk", ((F.col("step") > 0) | (F.col("chunk") > F.col("mine"))).cast("int").alias("role"), "fp")
    )
    placed = sent.repartition("home", "chunk").sortWithinPartitions("home", "chunk", "role")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            home, chunk, role, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.astype(np.int64).view(np.uint64)
            ends = np.flatnonzero((home[1:] != home[:-1]) | (chunk[1:] != chunk[:-1]) | (role[1:] != role[:-1])) + 1
            out = []
            for i, j in zip([0, *ends.tolist()], [*ends.tolist(), len(fp)], strict=True):
                if (home[i], chunk[i]) != place:
                    place, own = (home[i], chunk[i]), np.empty(0, dtype=np.uint64)
                if role[i] == 0:
                    out += _compared(own, fp[i:j], radius) + _compared(fp[i:j], fp[i:j], radius)
                    own = np.concatenate([own, fp[i:j]])
                else:
                    out += _compared(own, fp[i:j], radius)
            if out:
                ends = [np.concatenate(x).view(np.int64) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    return placed.mapInArrow(compare, "a long, b long")


def _compared(own: np.ndarray, others: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between two tiles, none of a fingerprint with itself."""
    out = []
    for i in range(0, len(own), 512):
        for j in range(0, len(others), 4096):
            left, right = own[i : i + 512], others[j : j + 4096]
            x, y = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
            a, b = left[x], right[y]
            unequal = a != b
            if unequal.any():
                out.append(star_edges(a[unequal], b[unequal]))
    return out


def prefix_size(n: int, at_least: float) -> int:
    """How many of n sorted values must be looked at: two sets with the Jaccard similarity
    share one of these, in whatever order all sets are sorted."""
    return n - math.ceil(at_least * n - 1e-9) + 1 if n else 0


#: Cells of a set's bitmap.
CELLS = 1024


def bitmap(hashes: np.ndarray) -> bytes:
    """For each cell whether an odd number of the hashes fall in it. A hash that only one of two
    sets has changes one bit, so bitmaps differ in no more bits than the sets in hashes."""
    odd = np.bincount((hashes % CELLS).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _near_bitmaps(left: np.ndarray, x: np.ndarray, right: np.ndarray, y: np.ndarray, at_least: float) -> np.ndarray:
    """Whether columns x of left and y of right, (id, fp, n, label, words of the bitmap), may
    have the similarity by their bitmaps. Two sets that have it differ in few hashes."""
    most = (1 - at_least) / (1 + at_least) * (left[2][x] + right[2][y]) + 1e-9
    differ = np.zeros(len(x), dtype=np.int64)
    for a, b in zip(left[4:].view(np.uint64), right[4:].view(np.uint64), strict=True):
        differ += np.bitwise_count(a[x] ^ b[y])
    return differ <= most


def marked_rows(df: DataFrame, width: int, at_least: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row `key`, `row` (a hash of its text), `fp` as in `fingerprints`, `id`, a hash of
    its different word shingles, `n`, their number, `first`, the smallest of them, and `bitmap`."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            found = [shingle_hashes(lower_words(t), width) for t in texts_of(batch)]
            sets = [np.unique(h) for h in found]
            bits = np.array([majority(h) for h in found], dtype=np.uint64).view(np.int64)
            ids = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            first = [s[: prefix_size(len(s), at_least)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("row"), pa.array(bits), pa.array(ids),
                    pa.array([len(s) for s in sets], pa.int64()), _lists(first), pa.array(map(bitmap, sets), pa.binary()),
                ],
                names=["key", "row", "fp", "id", "n", "first", "bitmap"],
            )

    kind = df.schema[key].dataType.simpleString()
    chosen = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    return chosen.mapInArrow(blocks, f"`key` {kind}, row long, fp long, id long, n long, first array<long>, bitmap binary")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, dtype="<u8")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.uint64).view(np.int64)))


def shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """`id` and `shingles`, the different ones of a text, for rows `id`, `text`."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            sets = [np.unique(shingle_hashes(lower_words(t), width)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(sets)], names=["id", "shingles"])

    return rows.mapInArrow(blocks, "id long, shingles array<long>")


#: Rows compared with all others in one step.
AT_ONCE = 64


def _close(left: np.ndarray, right: np.ndarray, radius: int, at_least: float) -> np.ndarray:
    """Bits between rows (id, fp, n, label) that may be linked, 65 where they may not: further
    than the radius, sizes too different, the same label, or bitmaps, if any, too different."""
    if left.shape[1] > AT_ONCE:  # what is made on the way has a bounded size
        parts = [np.ascontiguousarray(left[:, i : i + AT_ONCE]) for i in range(0, left.shape[1], AT_ONCE)]
        return np.concatenate([_close(part, right, radius, at_least) for part in parts])
    bits = np.bitwise_count(left[1].view(np.uint64)[:, None] ^ right[1].view(np.uint64)[None, :])
    x, y = np.nonzero(bits <= radius)
    sizes, others = left[2][x].astype(float), right[2][y].astype(float)
    fits = np.minimum(sizes, others) >= at_least * np.maximum(sizes, others) - 1e-9
    fits &= left[3][x] != right[3][y]
    x, y = x[fits], y[fits]
    if len(left) > 4:
        fits = _near_bitmaps(left, x, right, y, at_least)
        x, y = x[fits], y[fits]
    out = np.full(bits.shape, 65, dtype=np.uint8)
    out[x, y] = bits[x, y]
    return out


#: Groups of so many rows, or fewer, are compared all at once, row by distance in the order.
SMALL = 64


def _small_pairs(rows: np.ndarray, group: np.ndarray, radius: int, at_least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, bits) of the pairs of rows (id, fp, n, label) within each group, i < j, that are
    close as in `_close`. Groups are small and numbered in order."""
    out = [(np.empty(0, dtype=np.int64),) * 3]
    prints, sizes = rows[1].view(np.uint64), rows[2].astype(float)
    for step in range(1, SMALL):
        i = np.flatnonzero(group[step:] == group[:-step])
        if not len(i):
            break
        j = i + step
        bits = np.bitwise_count(prints[i] ^ prints[j])
        fits = (bits <= radius) & (rows[3, i] != rows[3, j])
        fits &= np.minimum(sizes[i], sizes[j]) >= at_least * np.maximum(sizes[i], sizes[j]) - 1e-9
        i, j, bits = i[fits], j[fits], bits[fits]
        if len(rows) > 4:
            fits = _near_bitmaps(rows, i, rows, j, at_least)
            i, j, bits = i[fits], j[fits], bits[fits]
        out.append((i, j, bits.astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def with_partners(postings: DataFrame, radius: int, at_least: float) -> DataFrame:
    """Of the postings (`k`, `id`, `fp`, `n`) those that are close to another of their key.

    A key's rows come as a stream. Beyond CHUNK of them they are all passed on: they are few
    keys, and what is passed on too much is compared later.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the last key seen, as its end is not known

        def kept(rows: np.ndarray) -> np.ndarray:
            own = np.vstack([rows[1:], rows[1:2]])  # each its own label
            near = _close(np.ascontiguousarray(own[:, :SMALL]), own, radius, at_least) < 65
            met = near.any(axis=0)  # of near copies most meet one of the first rows
            met[:SMALL] |= near.any(axis=1)
            left = np.flatnonzero(~met)
            for a in range(0, len(left), 1024):
                part = left[a : a + 1024]
                met[part] = (_close(np.ascontiguousarray(own[:, part]), own, radius, at_least) < 65).any(axis=1)
            return rows[:, met]

        def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            edges = np.concatenate([[0], np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1, [rows.shape[1]]])
            sizes = np.diff(edges)
            each = np.repeat(sizes, sizes)
            small = np.ascontiguousarray(rows[:, (each > 1) & (each <= SMALL)])
            i, j, _ = _small_pairs(np.vstack([small[1:], small[1:2]]), small[0], radius, at_least)
            out = [small[:, np.unique(np.concatenate([i, j]))]]
            out += [kept(rows[:, a : a + n]) for a, n in zip(edges[:-1][sizes > SMALL], sizes[sizes > SMALL], strict=True)]
            found = np.concatenate(out, axis=1)
            if found.shape[1]:
                yield _columns(found, "k", "id", "fp", "n")

        passed: int | None = None  # a key of more rows than are held
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([*held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            if passed is not None:
                same = rows[0] == passed
                if same.any():
                    yield _columns(rows[:, same], "k", "id", "fp", "n")
                    rows = rows[:, ~same]
                if not rows.shape[1]:
                    held = []
                    continue
                passed = None
            last = int(np.searchsorted(rows[0], rows[0, -1], "left"))
            if last:
                yield from done(rows[:, :last])
            held = [rows[:, last:]]
            if held[0].shape[1] > CHUNK:
                passed = int(rows[0, -1])
                yield _columns(held[0], "k", "id", "fp", "n")
                held = []
        if held and held[0].shape[1]:
            yield from done(held[0])

    dealt = postings.select("k", "id", "fp", "n").repartition("k").sortWithinPartitions("k")
    return dealt.mapInArrow(task, "k long, id long, fp long, n long")


def _columns(rows: np.ndarray, *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(r)) for r in rows], names=list(names))


def star_pairs(postings: DataFrame, radius: int, at_least: float) -> DataFrame:
    """Pairs (a, b), a < b, of each row of postings (`k`, `id`, `fp`, `n`) and the smallest id of
    its key, where the two are close: as much work as there are rows."""
    hubs = postings.groupBy("k").agg(F.min(F.struct("id", "fp", "n")).alias("hub"))
    met = postings.join(hubs, "k").where("id <> hub.id")
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub.fp")))
    sizes = F.least("n", "hub.n") >= F.lit(at_least) * F.greatest("n", "hub.n") - 1e-9
    return met.where((bits <= radius) & sizes).select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()


def candidate_pairs(postings: DataFrame, radius: int, at_least: float, nearest: bool) -> DataFrame:
    """Pairs (a, b), a < b, of ids that share a key, have different labels and are close, from
    postings (`k`, `id`, `fp`, `n`, `label`, `bitmap`).

    With `nearest`, of each row's pairs in one comparison only the one of fewest bits, so
    there are no more pairs than rows compared. The rows of a large key are dealt to
    chunks; each chunk meets itself and those before it. A key whose rows all have one label is
    left out before it is dealt.
    """
    chunks = (
        postings.groupBy("k")
        .agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("k", "chunks")
    )
    sent = (
        postings.join(chunks, "k")
        .withColumn("mine", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("mine"))))
        .select("k", "chunk", (F.col("chunk") < F.col("mine")).cast("int").alias("role"), "id", "fp", "n", "label", "bitmap")
    )
    placed = sent.repartition("k", "chunk").sortWithinPartitions("k", "chunk", "role")

    def pairs(own: np.ndarray, others: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(0, own.shape[1], 512):
            for j in range(0, others.shape[1], 4096):
                left, right = own[:, i : i + 512], others[:, j : j + 4096]
                bits = _close(left, right, radius, at_least)
                if nearest:
                    x, y = np.arange(bits.shape[0]), bits.argmin(axis=1)
                    u, v = bits.argmin(axis=0), np.arange(bits.shape[1])
                    x, y = np.concatenate([x, u]), np.concatenate([y, v])
                    good = bits[x, y] < 65
                    x, y = x[good], y[good]
                else:
                    x, y = np.nonzero(bits < 65)
                if len(x):
                    a, b = left[0, x], right[0, y]
                    yield np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.empty((4 + CELLS // 64, 0), dtype=np.int64)
        place, own = None, nothing
        for batch in batches:
            if not batch.num_rows:
                continue
            k, chunk, role = (batch.column(i).to_numpy() for i in range(3))
            bitmaps = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype=np.int64).reshape(batch.num_rows, -1)
            rows = np.vstack([*(batch.column(i).to_numpy() for i in range(3, 7)), bitmaps.T])
            # whole small groups of one chunk at once; the others, and the last, which may go on, in turn
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (chunk[1:] != chunk[:-1])])
            sizes = np.diff([*np.flatnonzero(new), len(k)])
            number = np.repeat(np.arange(len(sizes)), sizes)
            whole = (sizes <= SMALL) & (np.bincount(number, role) == 0)
            whole[-1] = False
            whole[0] &= place != (k[0], chunk[0])
            at_once = whole[number]
            if at_once.any():
                these = np.ascontiguousarray(rows[:, at_once])
                a, b, bits = _small_pairs(these, number[at_once], radius, at_least)
                if nearest and len(a):
                    row, other, bits = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([bits, bits])
                    order = np.lexsort((bits, row))
                    row, other = row[order], other[order]
                    first = np.concatenate([[True], row[1:] != row[:-1]])
                    a, b = row[first], other[first]
                if len(a):
                    ids = these[0, a], these[0, b]
                    yield _columns(np.unique(np.stack([np.minimum(*ids), np.maximum(*ids)]), axis=1), "a", "b")
                k, chunk, role, rows = k[~at_once], chunk[~at_once], role[~at_once], rows[:, ~at_once]
            ends = np.flatnonzero((k[1:] != k[:-1]) | (chunk[1:] != chunk[:-1]) | (role[1:] != role[:-1])) + 1
            for i, j in zip([0, *ends.tolist()], [*ends.tolist(), len(k)], strict=True):
                if (k[i], chunk[i]) != place:
                    place, own = (k[i], chunk[i]), nothing
                these = np.ascontiguousarray(rows[:, i:j])
                if role[i] == 0:
                    own = np.concatenate([own, these], axis=1)
                for found in pairs(own, these) if own.shape[1] else ():
                    yield _columns(found, "a", "b")

    return placed.mapInArrow(compare, "a long, b long").distinct()


def alike(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    """Of the pairs (a, b) of ids those whose sets of shingles have the Jaccard similarity."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"{x}_shingles"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    either = F.size("a_shingles") + F.size("b_shingles") - shared
    return both.where(shared >= F.lit(at_least) * either - 1e-9).select("a", "b")


def similar(df: DataFrame, radius: int, at_least: float, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As `near_duplicates`, linked by Jaccard similarity of the word shingles.

    Two sets that are alike share one of their smallest hashes (`prefix_size`), so only texts
    that do are compared: by fingerprint, where these are within the radius by bitmap, and
    exactly where that leaves them possible.
    First each text is checked against the first one of each key, then against its nearest
    one, a few rounds with what is not joined yet; then every pair that is left between groups.
    So a large group of near copies costs few checks and no link is lost. Sets of shingles are made again for texts
    with a close one only, never stored for all.
    """
    marked = hold(marked_rows(df, width, at_least, key, text))
    classes = hold(
        marked.groupBy("id").agg(
            F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("first").alias("first"),
            F.first("bitmap").alias("bitmap"), F.min(F.struct("key", "row")).alias("one"),
        )
    )
    postings = classes.select(F.explode("first").alias("k"), "id", "fp", "n")
    live = hold(with_partners(postings, radius, at_least).join(classes.select("id", "bitmap"), "id"))
    wanted = classes.join(live.select("id").distinct(), "id", "left_semi").select("id", "one.key", "one.row")
    texts = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    met = texts.join(wanted, texts["key"].eqNullSafe(wanted["key"]) & (texts["row"] == wanted["row"]))
    sets = hold(shingle_sets(met.select("id", "text"), width).dropDuplicates(["id"]))

    labelled, checked, links = live.withColumn("label", F.col("id")), None, None
    for turn in range(1 + ROUNDS):
        pairs = candidate_pairs(labelled, radius, at_least, True) if turn else star_pairs(live, radius, at_least)
        pairs = hold(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"))
        good = hold(alike(pairs, sets, at_least))
        checked = pairs if checked is None else checked.union(pairs)
        if good.isEmpty():
            if turn:
                break
            continue
        links = good if links is None else links.union(good)
        groups = connected_components(links).withColumnsRenamed({"node": "id", "component": "label"})
        labelled = hold(live.join(groups, "id", "left").withColumn("label", F.coalesce("label", "id")))
    rest = candidate_pairs(labelled, radius, at_least, False).join(checked, ["a", "b"], "left_anti")
    rest = alike(rest, sets, at_least)
    groups = connected_components(rest if links is None else links.union(rest)).withColumnRenamed("node", "id")
    ids = marked.select("key", "fp", "id").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = ids.groupBy("component").agg(F.min("key").alias("component_id"))
    named = ids.join(least, "component")
    return named.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(
    df: DataFrame,
    radius: int = 3,
    key: str = "doc_id",
    text: str = "text",
    width: int = 3,
    at_least: float | None = None,
) -> DataFrame:
    """One row for each row of df: the key, `fingerprint` in hex, and `component_id`, the
    smallest key that links reach.

    Equal fingerprints are one class, compared once. Null, empty and wordless texts have
    fingerprint zero. Rows with a null key are linked too, but never give the component's
    name; a component of such rows alone has a null one. Repeated rows each give a row.

    `width` is the words of a shingle. With `at_least`, fingerprints within the radius are
    linked only if the Jaccard similarity of their sets of shingles is so high (`similar`).
    """
    if at_least is not None:
        return similar(df, radius, at_least, width, key, text)
    prints = hold(fingerprints(df, key, text, width))
    classes = hold(prints.groupBy("fp").agg(F.min(key).alias("first")))
    groups = connected_components(near_links(classes.select("fp"), radius))
    named = classes.join(groups, classes["fp"] == groups["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "component").select("fp", "component_id")
    return prints.join(ids, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
