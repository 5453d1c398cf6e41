"""Removal of byte strings that repeat anywhere in the corpus, by sorted suffixes.

Strings of `length` bytes are called windows. Each window has an anchor: the byte gram in
it whose hash is smallest. Equal windows have equal anchors, so windows are dealt out by
anchor; the windows of one place that share an anchor travel as one segment. Segments
that are equal are one class, and a class with several places repeats as a whole. Only
classes that share an anchor with a different class may share some windows: their bytes
are sorted as suffixes, and adjacent common prefixes of `length` bytes or more are the
repeated windows. The segments of an anchor with very many classes are cut into runs that
must share more bytes, until no group is large, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import slices
from dielens.plans.hold import hold

#: Bytes of a gram.
GRAM = 24
#: Rows of one group that are sorted together; a larger group is cut further.
CROWD = 1024
#: Bytes of segments that are sorted at once.
SORTED = 2_000_000
PLACE_BITS = 28


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in a row, and where each begins (and the last ends)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, dtype=np.uint8)
    return flat, (offsets - offsets[0]).astype(np.int64)


def _eights(flat: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position on as a number; zeros follow the end."""
    padded = np.concatenate([flat, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(flat), dtype=f"{order}u8", buffer=padded, strides=(1,))


def _gram_hashes(flat: np.ndarray) -> np.ndarray:
    """A 64-bit mix of the GRAM bytes from each position on."""
    eights = _eights(flat, "<").astype(np.uint64)
    mixed = np.zeros(len(flat), dtype=np.uint64)
    for at in range(0, GRAM, 8):
        mixed[: len(flat) - at] ^= eights[at:]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _lowest_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the `width` keys from each position on."""
    n = len(keys)
    full = np.full(-(-n // width) * width + width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:n] = keys
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: text number, first window's start in the text,
    number of windows, anchor hash, hash of the run's bytes."""
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    hashes = _gram_hashes(flat)
    places = np.arange(len(flat), dtype=np.uint64)
    keys = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
    anchor_at = (_lowest_in_windows(keys, length - GRAM + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(windows)), windows)
    starts = np.repeat(offsets[:-1] - np.cumsum(windows) + windows, windows) + np.arange(total)
    anchor_at = anchor_at[starts]
    first = np.concatenate([[0], np.flatnonzero((anchor_at[1:] != anchor_at[:-1]) | (owner[1:] != owner[:-1])) + 1])
    counts = np.diff(np.append(first, total))
    begins, text = starts[first], memoryview(flat.tobytes())
    bodies = (
        xxhash.xxh3_64_intdigest(text[a:b])
        for a, b in zip(begins.tolist(), (begins + counts + length - 1).tolist(), strict=True)
    )
    body = np.fromiter(bodies, dtype=np.uint64, count=len(first)).view(np.int64)
    return owner[first], begins - offsets[owner[first]], counts, hashes[anchor_at[first]].view(np.int64), body


# --- two-stage suffix sorting ------------------------------------------------------------


def smaller_than_next(flat: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that begins a byte later."""
    n = len(flat)
    differs = np.append(flat[:-1] != flat[1:], True)
    until = np.where(differs, np.arange(n), n)
    until = np.minimum.accumulate(until[::-1])[::-1]
    rises = np.append(flat[:-1] < flat[1:], False)
    return rises[until]


def sort_directly(flat: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at `at` in the order of their first `depth` bytes; only tied ones are
    compared further."""
    eights = np.concatenate([_eights(flat, ">").astype(np.uint64), np.zeros(depth + 8, dtype=np.uint64)])
    order = at[np.argsort(eights[at], kind="stable")]
    key = eights[order]
    equal = key[1:] == key[:-1]
    for done in range(8, depth, 8):
        tied = np.concatenate([equal, [False]]) | np.concatenate([[False], equal])
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        group = np.cumsum(~np.concatenate([[False], equal]))[slots]
        members = order[slots]
        key = eights[members + done]
        again = np.lexsort((key, group))
        members, key = members[again], key[again]
        order[slots] = members
        same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        equal = np.zeros(len(order) - 1, dtype=bool)
        equal[slots[:-1][same]] = True
    return order


def suffix_order(flat: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first `depth` bytes or more.

    Suffixes smaller than their successors are sorted directly. The others follow by
    scanning the buckets of first bytes upwards: the suffix before a placed one, if it is
    larger than it, is the next of its bucket.
    """
    n = len(flat)
    if not n:
        return np.empty(0, dtype=np.int64)
    small = smaller_than_next(flat)
    direct = sort_directly(flat, np.flatnonzero(small), depth)
    cuts = np.searchsorted(flat[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[flat[-1]].append(np.array([n - 1], dtype=np.int64))
    out = []
    for byte in range(256):
        fresh = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, dtype=np.int64)
        while len(fresh):  # runs of one byte are followed byte by byte
            out.append(fresh)
            fresh = _before(fresh, flat, small, byte, waiting)
        placed = direct[cuts[byte] : cuts[byte + 1]]
        if len(placed):
            out.append(placed)
            _before(placed, flat, small, byte, waiting)
    return np.concatenate(out)


def _before(placed: np.ndarray, flat: np.ndarray, small: np.ndarray, byte: int, waiting: list) -> np.ndarray:
    """Files the larger suffixes just before the placed ones; returns those of this bucket."""
    before = placed[placed > 0] - 1
    before = before[~small[before]]
    first = flat[before]
    later = first > byte
    order = np.argsort(first[later], kind="stable")
    moved, bytes_ = before[later][order], first[later][order]
    ends = np.flatnonzero(np.diff(bytes_)) + 1
    for part in np.split(moved, ends):
        if len(part):
            waiting[flat[part[0]]].append(part)
    return before[first == byte]


def common_prefixes(flat: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Equal bytes at the head of the suffixes at a and b, in steps of eight up to `most`."""
    eights = np.concatenate([_eights(flat, "<").astype(np.uint64), np.zeros(most + 8, dtype=np.uint64)])
    equal = np.zeros(len(a), dtype=np.int64)
    left = np.arange(len(a))
    for done in range(0, most, 8):
        left = left[eights[a[left] + done] == eights[b[left] + done]]
        equal[left] = done + 8
    return equal


def repeated_windows(flat: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at `starts` (each inside one segment) equal another of them."""
    chosen = np.full(len(flat), -1, dtype=np.int64)
    chosen[starts] = np.arange(len(starts))
    number = chosen[suffix_order(flat, length)]
    number = number[number >= 0]
    at = starts[number]
    same = common_prefixes(flat, at[:-1], at[1:], length) >= length
    out = np.zeros(len(starts), dtype=bool)
    out[number[1:][same]] = True
    out[number[:-1][same]] = True
    return out


# --- the operator --------------------------------------------------------------------------


def _packed(body: Column) -> Column:
    """Texts compressed, for a shuffle."""

    @F.pandas_udf("binary")
    def compress(bodies: pd.Series) -> pd.Series:
        return bodies.map(zstandard.ZstdCompressor(level=1).compress)

    return compress(body)


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


#: Parts of the places of one anchor where they are joined; a bit of a long for each.
SALTS = 64


def _salts_seen() -> Column:
    return F.expr("bit_or(shiftleft(1L, salt)) as salts")


def _by_salt(counted: DataFrame) -> DataFrame:
    """A row for each salt that its places have, for a join by the salt too."""
    seen = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("salts", i) == 1)
    return counted.withColumn("salt", F.explode(seen)).drop("salts")


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc, row, spans): for each text of docs (doc, row, body) that repeats something, its
    runs of windows that also stand elsewhere, each first window << 32 | number."""
    kind = docs.schema["doc"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 3_000_000):
            flat, offsets = _bytes_of(batch.column("body"))
            owner, start, count, anchor, body = segments(flat, offsets, length)
            who = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(who),
                    batch.column("row").take(who),
                    pa.array(start.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(anchor),
                    pa.array(body),
                ],
                names=["doc", "row", "start", "count", "anchor", "body"],
            )

    places = docs.mapInArrow(cut, f"doc {kind}, row long, start int, count int, anchor long, body long")
    # what a passage of very many texts brings together is dealt by salt where it meets its counts
    places = places.withColumn("salt", F.pmod(F.xxhash64("doc", "row", "start"), F.lit(SALTS)).cast("int"))
    busy = hold(
        places.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("body").alias("low"), F.max("body").alias("high"), _salts_seen())
        .where("n > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("mixed"), "salts")
    )
    shared = hold(places.join(_by_salt(busy), ["anchor", "salt"]))
    mixed = shared.where("mixed")
    classes = hold(
        mixed.groupBy("anchor", "body").agg(
            F.count("*").alias("n"), _salts_seen(), *[F.first(c).alias(c) for c in ("doc", "row", "start", "count")]
        )
    )
    crowds = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where(F.col("classes") > CROWD)
    crowds = hold(crowds.select("anchor", F.lit(True).alias("crowd")))
    told = classes.join(crowds, "anchor", "left").withColumn("crowd", F.coalesce("crowd", F.lit(False)))
    wanted = told.groupBy("doc", "row").agg(
        F.collect_list(F.struct("anchor", "start", "count", (F.col("n") == 1).alias("alone"), "crowd")).alias("wanted")
    )
    found = hold(_bodies(docs, wanted, length))
    spans = [
        shared.where("not mixed").select("doc", "row", "start", "count"),
        mixed.join(
            _by_salt(classes.where("n > 1").select("anchor", "body", "salts")), ["anchor", "body", "salt"], "left_semi"
        ).select("doc", "row", "start", "count"),
        _by_suffixes(found.where("not crowd"), length, "anchor"),
        *_by_parts(found.where("crowd"), length),
    ]
    every = reduce(DataFrame.union, spans)
    packed = F.shiftleft(F.col("start").cast("long"), 32) + F.col("count")
    return every.groupBy("doc", "row").agg(F.collect_list(packed).alias("spans"))


def _bodies(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments."""
    kind = docs.schema["doc"].dataType.simpleString()
    same = docs["doc"].eqNullSafe(wanted["doc"]) & (docs["row"] == wanted["row"])
    joined = docs.withColumn("body", _packed(F.col("body"))).join(wanted, same).select(docs["doc"], docs["row"], "body", "wanted")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in slices([batch], "body", 1_000_000):
                lists = one.column("wanted")
                rows = lists.flatten()
                texts = map(_unpacked, one.column("body").to_pylist())
                sizes = pa.compute.list_value_length(lists).to_pylist()
                at = zip(rows.field("start").to_pylist(), rows.field("count").to_pylist(), strict=True)
                bodies = [
                    text[s : s + c + length - 1]
                    for text, n in zip(texts, sizes, strict=True)
                    for s, c in (next(at) for _ in range(n))
                ]
                who = pa.compute.list_parent_indices(lists)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[one.column(c).take(who) for c in ("doc", "row")],
                        *[rows.field(c) for c in ("anchor", "start", "count", "alone", "crowd")],
                        pa.array(bodies, type=pa.binary()),
                    ],
                    names=["doc", "row", "anchor", "start", "count", "alone", "crowd", "body"],
                )

    shape = f"doc {kind}, row long, anchor long, start int, count int, alone boolean, crowd boolean, body binary"
    return joined.mapInArrow(cut, shape)


def _by_suffixes(found: DataFrame, length: int, group: str) -> DataFrame:
    """Runs of repeated windows of segments that are alone in their class. Rows of a group
    are sorted together, as many groups at once as SORTED allows."""
    kind = found.schema["doc"].dataType.simpleString()
    dealt = found.repartition(group).sortWithinPartitions(group)

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            anchor = batch.column(group).to_numpy()
            cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            if len(anchor) and held and held[-1].column(group)[-1].as_py() != anchor[0]:
                cuts = np.append(0, cuts)
            size = sum(b.nbytes for b in held)
            sizes = np.cumsum(np.append(0, pa.compute.binary_length(batch.column("body")).to_numpy()))
            begin = 0
            for c in cuts.tolist():
                if size + sizes[c] - sizes[begin] > SORTED:
                    yield from repeats(pa.Table.from_batches([*held, batch.slice(begin, c - begin)]))
                    held, size, begin = [], 0, c
            held.append(batch.slice(begin))
        if held:
            yield from repeats(pa.Table.from_batches(held))

    def repeats(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        if not rows.num_rows:
            return
        body, offsets = _bytes_of(rows.column("body").chunk(0))
        counts = rows.column("count").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        again = repeated_windows(body, offsets[owner] + inner, length)
        again &= rows.column("alone").to_numpy()[owner]
        owner, inner = owner[again], inner[again]
        if not len(owner):
            return
        first = np.concatenate([[0], np.flatnonzero((np.diff(owner) != 0) | (np.diff(inner) != 1)) + 1])
        runs = np.diff(np.append(first, len(owner)))
        who = pa.array(owner[first])
        begins = rows.column("start").to_numpy()[owner[first]] + inner[first]
        yield pa.RecordBatch.from_arrays(
            [
                *[rows.column(c).chunk(0).take(who) for c in ("doc", "row")],
                pa.array(begins.astype(np.int32)),
                pa.array(runs.astype(np.int32)),
            ],
            names=["doc", "row", "start", "count"],
        )

    return dealt.mapInArrow(sort, f"doc {kind}, row long, start int, count int")


def _by_parts(crowd: DataFrame, length: int) -> list[DataFrame]:
    """The same for anchors of a crowd, in parts that share more than the anchor.

    A segment's windows are cut into runs by their distance from the anchor. The windows of
    a run all hold the bytes between the last one's start and the first one's end; runs at
    the same distance with the same such bytes are dealt out together and sorted. Crowds
    that are left are cut into shorter runs, at last into single windows, which are equal
    if their digests are: Spark counts those. Runs that a batch holds several times are
    known to repeat and leave at once; one of them stays for the others to meet.
    """
    spans, place = [], ["doc", "row", "start", "count"]
    for width in (32, 4):
        made = hold(_cut(crowd, width, length))
        spans.append(made.where("part is null").select(*place))
        parts = made.where("part is not null")
        more = hold(parts.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("part"))
        spans.append(_by_suffixes(parts.join(more, "part", "left_anti"), length, "part"))
        crowd = parts.join(more, "part", "left_semi")
    made = hold(_cut(crowd, 1, length).select(*place, "alone", "part", F.xxhash64("body").alias("body")))
    windows = made.where("part is not null")
    again = windows.groupBy("part", "body").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    last = windows.where("alone").join(again, ["part", "body"], "left_semi")
    return [*spans, made.where("part is null").select(*place), last.select(*place)]


def _cut(segments_: DataFrame, width: int, length: int) -> DataFrame:
    """Segments cut at multiples of `width` bytes from their anchor; `part` is what runs
    have to share. Rows without a part are runs of windows found to repeat."""
    kind = segments_.schema["doc"].dataType.simpleString()
    columns = ["doc", "row", "anchor", "lead", "start", "count", "alone", "body"]

    def runs(count: int, lead: int) -> Iterator[tuple[int, int, int]]:
        """First window, one past the last, and the number of the run."""
        for j in range(max(lead - count + 1, 0) // width, lead // width + 1):
            yield max(lead - j * width - width + 1, 0), min(lead - j * width + 1, count), j

    def combined(cuts: list[tuple[int, tuple]]) -> tuple[list[int], list[tuple]]:
        """Equal runs once, and where all of them are, in as few rows as touch."""
        times = Counter(run[-2:] for _, run in cuts)
        who, out, found, met = [], [], [], set()
        for i, run in cuts:
            anchor, lead, start, count, alone, body, part = run
            if times[body, part] > 1:
                if alone and found and found[-1][0] == i and start + count == found[-1][1]:
                    found[-1] = (i, start, count + found[-1][2])  # runs come from a segment's end
                elif alone:
                    found.append((i, start, count))
                if (body, part) in met:
                    continue
                met.add((body, part))
                run = (anchor, lead, start, count, False, body, part)
            who.append(i)
            out.append(run)
        who += [i for i, _, _ in found]
        out += [(None, None, start, count, True, None, None) for _, start, count in found]
        return who, out

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts: list[tuple[int, tuple]] = []
            rows = zip(*(batch.column(c).to_pylist() for c in columns[2:]), strict=True)
            for i, (anchor, lead, start, count, alone, body) in enumerate(rows):
                if lead is None:
                    hashes = _gram_hashes(np.frombuffer(body, dtype=np.uint8))
                    lead = int(np.flatnonzero(hashes.view(np.int64) == anchor)[0])
                for a, b, j in runs(count, lead):
                    middle = body[lead - j * width : lead - j * width - width + 1 + length]
                    part = xxhash.xxh3_64_intdigest(b"%d %d " % (anchor, j) + middle) - (1 << 63)
                    cuts.append((i, (anchor, lead - a, start + a, b - a, alone, body[a : b + length - 1], part)))
            who, out = combined(cuts)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int64()]
            made = [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, types, strict=True)]
            chosen = pa.array(who, type=pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(chosen) for c in columns[:2]], *made], names=[*columns, "part"])

    shape = f"doc {kind}, row long, anchor long, lead int, start int, count int, alone boolean, body binary, part long"
    known = F.col("lead") if "lead" in segments_.columns else F.lit(None).cast("int").alias("lead")
    return segments_.select(*[known if c == "lead" else c for c in columns]).mapInArrow(cut, shape)


def merged(first: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the byte ranges that runs of windows cover, joined where they touch."""
    order = np.argsort(first, kind="stable")
    begins, ends = first[order], np.maximum.accumulate((first + count + length - 1)[order])
    fresh = np.concatenate([[True], begins[1:] > ends[:-1]])
    last = np.concatenate([fresh[1:], [True]])
    return begins[fresh], ends[last]


def remove_repeats(df: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of df but the text, and `n_bytes`, `n_removed`, `n_spans` and `kept`, the
    remaining bytes (which may cut a character; see `whole_characters`).

    A byte goes if a window of `length` bytes that covers it also begins anywhere else, in
    the same text too. All copies go, whole repeated rows included. Texts shorter than a
    window, null (as empty) and empty texts keep all. A null key is a key like others. The
    added columns replace columns of those names; columns whose names begin with two
    underscores are not carried. `length` is at least GRAM and a multiple of eight.
    """
    if length % 8 or length < GRAM:
        raise ValueError("length must be a multiple of 8, and not below the gram")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = df.select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("row"), body.alias("body"))
    spans = repeated_spans(docs.where(F.octet_length("body") >= length), length)

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long")
    def cut(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for z, found in zip(packed, spans, strict=True):
            text, edges = _unpacked(z), []
            if found is not None:
                found = np.asarray(found, dtype=np.int64)
                edges = np.stack(merged(found >> 32, found & 0xFFFFFFFF, length), axis=1).ravel().tolist()
            bounds = [0, *edges, len(text)]
            kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
            rows.append((kept, len(text), len(text) - len(kept), len(edges) // 2))
        return pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans"])

    added = ("kept", "n_bytes", "n_removed", "n_spans")
    names = [c for c in df.columns if not c.startswith("__") and c != text and c not in added]
    mine = df.select(*names, F.xxhash64(F.col(text)).alias("__row"), _packed(body).alias("__body"))
    joined = mine.join(spans, mine[key].eqNullSafe(spans["doc"]) & (mine["__row"] == spans["row"]), "left")
    done = joined.select(*[mine[c] for c in names], cut(mine["__body"], spans["spans"]).alias("__cut"))
    return done.select(*names, "__cut.*")


def whole_characters(kept: str) -> Column:
    """Remaining bytes as text, without the bytes of characters that a removal cut."""

    @F.pandas_udf("string")
    def text(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: b.decode("utf-8", "ignore"))

    return text(F.col(kept))


def digest(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    return removed.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
