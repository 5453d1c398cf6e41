"""Many models fitted in the same scans.

A sweep over k, or one mixture per cluster and k, would read the data once per model
and iteration. Here every iteration is one Spark job of one stage for all models together:
each task folds its rows (packed once to blocks of bytes, which Python workers read as
they are) into sums per model, Spark adds the sums up, and the driver turns them into
the next parameters. Only model-sized sums move; every row takes part in every
iteration, however the rows spread over groups.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The task functions travel to the executors with the job; nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Seeding draws this many times the largest k from all rows, in each of its rounds.
DRAWN_PER_CENTRE = 2
SEED_ROUNDS = 5
# Starts tried on the candidates for each model.
STARTS = 8
RIDGE = 1e-6
# Rows folded at a time: their distances or densities under all models stay in a core's cache.
BLOCK = 1024
# Tasks whose sums the driver adds up itself; those of more are added up by tasks first.
FEW_TASKS = 128

GROUP, POINT = "_group", "_point"


def grouped_points(df: DataFrame, group: Column, features: Column) -> DataFrame:
    """The two columns a sweep reads: an int group and the feature array."""
    return df.select(group.cast("int").alias(GROUP), features.alias(POINT))


def group_sizes(points: DataFrame | RDD) -> dict[int, int]:
    if isinstance(points, RDD):
        counted = _add_up(points, lambda group, rows: iter([(group, np.array([float(len(rows))]))]))
        return {group: int(n[0]) for group, n in counted.items()}
    return {r[GROUP]: r["count"] for r in points.groupBy(GROUP).count().collect()}


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row, and the squared distance to it."""
    part = (centres**2).sum(1) - 2 * rows @ centres.T
    label = part.argmin(1)
    return label, np.maximum(part[np.arange(len(rows)), label] + (rows**2).sum(1), 0.0)


def _chance(rows: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each row, by its values: the same in any partition."""
    mixed = np.full(len(rows), (salt * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64)
    for column in np.ascontiguousarray((rows + 0.0).T).view(np.uint64):
        mixed = (mixed ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * np.uint64(0x94D049BB133111EB)) ^ (mixed >> np.uint64(32))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


@dataclass(frozen=True)
class Seeds:
    """Distinct rows of a group and how many of all its rows are nearest to each."""

    rows: np.ndarray
    weights: np.ndarray


def seed_candidates(points: DataFrame | RDD, most: int, seed: int) -> dict[int, Seeds]:
    """Candidates for starting centres, drawn from all rows of every group (k-means||).

    A round is one job: distinct values are drawn with a chance that grows with the squared
    distance to the candidates so far, by ranking log(u) / distance, so a small far cluster
    is met however many rows the others have. Each task passes on its best ``most``, and
    Spark keeps the best of all. A last job counts the rows nearest to each candidate.
    """
    found: dict[int, np.ndarray] = {}

    def best_of(a: dict, b: dict) -> dict:
        best = dict(a)
        for group, (keys, rows) in b.items():
            if group in best:
                keys, rows = np.concatenate([best[group][0], keys]), np.concatenate([best[group][1], rows])
                rows, kept = np.unique(rows, axis=0, return_index=True)
                keys = keys[kept]
            top = np.argsort(-keys, kind="stable")[:most]
            best[group] = keys[top], rows[top]
        return best

    for turn in range(SEED_ROUNDS):
        so_far = dict(found)

        def draw(group: int, rows: np.ndarray) -> dict:
            rows, keys = _drawn(rows, so_far.get(group), most, seed + turn)
            return {group: (keys, rows)} if len(rows) else {}

        for group, (_, fresh) in _folded(points, draw, best_of).items():
            found[group] = np.concatenate([found[group], fresh]) if group in found else fresh

    def count(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if group in found:
            yield group, np.bincount(_nearest(rows, found[group])[0], minlength=len(found[group])).astype(float)

    return {group: Seeds(found[group], weights) for group, weights in _add_up(points, count).items()}


def _drawn(rows: np.ndarray, so_far: np.ndarray | None, most: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and their keys, among them the ``most`` of the largest keys."""
    gap = _nearest(rows, so_far)[1] if so_far is not None else np.ones(len(rows))
    away = gap > 1e-12 * (rows**2).sum(1)
    rows, gap = rows[away], gap[away]
    keys = np.log(_chance(rows, salt)) / gap
    values = np.unique(keys)  # equal rows have equal keys: only rows of the largest are put in order
    for least in (values[-2 * most], -math.inf) if len(values) > 2 * most else (-math.inf,):
        top = keys >= least
        distinct, first = np.unique(rows[top], axis=0, return_index=True)
        if len(distinct) >= most:
            break
    return distinct, keys[top][first]


def _spread_centres(seeds: Seeds, k: int, rng: np.random.Generator) -> np.ndarray:
    """The best of some starts among the candidates; all their rows are few."""
    starts = [_one_start(seeds, k, rng) for _ in range(STARTS)]
    return min(starts, key=lambda s: s[0])[1]


def _one_start(seeds: Seeds, k: int, rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """(cost, centres): weighted greedy k-means++, each step the best of several draws, then
    Lloyd steps on the candidates."""
    rows, weights = seeds.rows, seeds.weights
    apart = np.maximum((rows**2).sum(1)[:, None] + (rows**2).sum(1)[None, :] - 2 * rows @ rows.T, 0.0)
    picks = [rng.choice(len(rows), p=weights / weights.sum())]
    nearest = apart[picks[0]]
    draws = 2 + int(math.log(k))
    while len(picks) < k:
        mass = nearest * weights
        total = mass.sum()
        tried = rng.choice(len(rows), draws, p=mass / total) if total > 0 else rng.integers(len(rows), size=draws)
        best = tried[(np.minimum(nearest[None, :], apart[tried]) @ weights).argmin()]
        picks.append(best)
        nearest = np.minimum(nearest, apart[best])
    found = rows[picks].copy()
    for _ in range(5):
        label = _nearest(rows, found)[0]
        for j in np.unique(label):
            mine = label == j
            if weights[mine].sum() > 0:
                found[j] = np.average(rows[mine], axis=0, weights=weights[mine])
    return float(_nearest(rows, found)[1] @ weights), found


def _batches(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(group, rows as a matrix) for every group in every Arrow batch of points."""
    for batch in stream:
        if not batch.num_rows:
            continue
        groups = batch.column(0).to_numpy(zero_copy_only=False)
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for group in np.unique(groups):
            yield int(group), values[groups == group]


@contextmanager
def _packed(points: DataFrame) -> Iterator[DataFrame]:
    """The points as blocks of one group's rows, dealt evenly over the session's shuffle
    partitions, whatever files they come from: no iteration waits for one large partition or
    leaves cores idle. Blocks are dealt, not rows: fewer bytes, and nothing to sort."""

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _batches(stream):
            yield pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), pa.array([rows.shape[1]], pa.int32()), pa.array([rows.tobytes()], pa.binary())],
                [GROUP, "_width", "_rows"],
            )

    blocks = points.mapInArrow(pack, f"{GROUP} int, _width int, _rows binary")
    yield blocks.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bytes_of(blocks: DataFrame) -> RDD:
    return blocks.rdd.map(lambda row: (row[0], row[1], bytes(row[2])))


@contextmanager
def held_blocks(points: DataFrame | RDD) -> Iterator[RDD]:
    """The points packed, as (group, width, bytes) kept for the block: each of the many jobs of a
    sweep reads bytes, with a task for each core (two where each has much to read). Blocks that
    are held already stay as they are."""
    if isinstance(points, RDD):
        yield points
        return
    with _packed(points) as blocks:
        held = _bytes_of(blocks).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # not compressed in memory
        try:
            cores = held.context.defaultParallelism
            tasks = cores if held.getNumPartitions() < 8 * cores else 2 * cores
            yield held.coalesce(tasks) if held.getNumPartitions() > tasks else held
        finally:
            held.unpersist()


def _matrix(block: tuple[int, int, bytes]) -> np.ndarray:
    return np.frombuffer(block[2], dtype=np.float64).reshape(-1, block[1])


def _folded(points: DataFrame | RDD, fold: Callable[[int, np.ndarray], dict], merge: Callable[[dict, dict], dict]) -> dict:
    """One job: what ``fold`` makes of each block, merged in the tasks and then across tasks."""
    if not isinstance(points, RDD):
        if "_rows" not in points.columns:
            with _packed(points) as blocks:
                return _folded(blocks, fold, merge)
        points = _bytes_of(points)

    def task(stream: Iterator[tuple[int, int, bytes]]) -> Iterator[dict]:
        found: dict = {}
        for block in stream:
            found = merge(found, fold(block[0], _matrix(block)))
        yield found

    tasks = points.getNumPartitions()
    return points.mapPartitions(task).treeReduce(merge, 1 if tasks <= FEW_TASKS else 2) if tasks else {}


def _sum_up(a: dict, b: dict) -> dict:
    for model, part in b.items():
        a[model] = a[model] + part if model in a else part
    return a


def _add_up(points: DataFrame | RDD, fold: Callable[[int, np.ndarray], Iterator[tuple[int, np.ndarray]]]) -> dict:
    """One job: per-model sums of ``fold`` over all rows."""
    return _folded(points, lambda group, rows: dict(fold(group, rows)), _sum_up)


@dataclass(frozen=True)
class KMeansFit:
    group: int
    k: int
    centres: np.ndarray
    cost: float
    distortion: float


def kmeans_sweep(
    points: DataFrame | RDD, wanted: Sequence[tuple[int, int]], sizes: Mapping[int, int], seed: int = 1,
    max_iter: int = 20, tol: float = 1e-4,
) -> list[KMeansFit]:
    """Lloyd's k-means for every (group, k) wanted, one job per iteration."""
    with held_blocks(points) as blocks:
        return _kmeans_fits(blocks, wanted, sizes, seed, max_iter, tol)


def _kmeans_fits(
    points: RDD, wanted: Sequence[tuple[int, int]], sizes: Mapping[int, int], seed: int, max_iter: int, tol: float
) -> list[KMeansFit]:
    seeds = seed_candidates(points, DRAWN_PER_CENTRE * max(k for _, k in wanted), seed)
    centres = {i: _spread_centres(seeds[g], k, np.random.default_rng([seed, g, k])) for i, (g, k) in enumerate(wanted)}
    width = len(next(iter(centres.values()))[0])

    def sums_for(active: list[int]) -> dict:
        by_group: dict[int, list[int]] = {}
        for i in active:
            by_group.setdefault(wanted[i][0], []).append(i)
        current = {i: centres[i] for i in active}

        def fold(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            mine = by_group.get(group, ())
            if mine:
                yield from zip(mine, _cluster_sums(rows, [current[i] for i in mine]))

        return _add_up(points, fold)

    active = list(range(len(wanted)))
    for _ in range(max_iter):
        moved = []
        for i, sums in sums_for(active).items():
            k = wanted[i][1]
            count, total = sums[2 : 2 + k], sums[2 + k :].reshape(k, width)
            updated = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres[i])
            if ((updated - centres[i]) ** 2).sum(1).max() > tol**2:
                moved.append(i)
            centres[i] = updated
        active = moved
        if not active:
            break
    final = sums_for(list(range(len(wanted))))
    return [
        KMeansFit(g, k, centres[i], float(final[i][0]), float(final[i][1]) / sizes[g])
        for i, (g, k) in enumerate(wanted)
    ]


def _cluster_sums(rows: np.ndarray, models: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For each set of centres its cost, its sum of distances, and the rows and sums of rows of
    its clusters. A row is in the first of the clusters whose centres are nearest."""
    if not np.isfinite(rows).all():
        return [_labelled_sums(rows, centres) for centres in models]
    weights = _centre_weights(np.concatenate(models))
    ends = np.cumsum([len(m) for m in models])
    spans = list(zip(ends - [len(m) for m in models], ends))
    costs, sums = np.zeros((len(models), 2)), np.zeros((len(weights), 1 + rows.shape[1]))
    for at in range(0, len(rows), BLOCK):
        part = _with_ones(rows[at : at + BLOCK])
        # Distances to the centres of all models in one product; |x|^2 comes back at the end.
        apart = weights @ part
        member, best = np.empty(apart.shape), np.empty((len(models), part.shape[1]))
        for nearest, (a, b) in zip(best, spans):
            apart[a:b].min(0, out=nearest)
            np.equal(apart[a:b], nearest, out=member[a:b])
        found = member @ part.T
        if found[:, 0].sum() > best.size:  # equally near centres
            for a, b in spans:
                member[a:b] *= member[a:b].cumsum(0) == 1
            found = member @ part.T
        best += (part[1:] ** 2).sum(0)
        np.maximum(best, 0.0, out=best)
        costs += np.stack([best.sum(1), np.sqrt(best).sum(1)], 1)
        sums += found
    return [np.concatenate([cost, sums[a:b, 0], sums[a:b, 1:].ravel()]) for cost, (a, b) in zip(costs, spans)]


def _centre_weights(centres: np.ndarray) -> np.ndarray:
    """What rows ``_with_ones`` are multiplied by for |x - c|^2 - |x|^2."""
    return np.column_stack([(centres**2).sum(1), -2 * centres])


def _with_ones(rows: np.ndarray) -> np.ndarray:
    """1 and the values of every row, a column for each row."""
    out = np.empty((1 + rows.shape[1], len(rows)))
    out[0], out[1:] = 1.0, rows.T
    return out


def _labelled_sums(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """As `_cluster_sums` for one set, row by row: a row with a value that is no number stays out of the sums of
    other clusters than its own."""
    k = len(centres)
    label, best = _nearest(rows, centres)
    totals = [np.bincount(label, weights=column, minlength=k) for column in rows.T]
    return np.concatenate(
        [[best.sum(), np.sqrt(best).sum()], np.bincount(label, minlength=k), np.stack(totals, 1).ravel()]
    )


def centre_labels(models: Sequence[np.ndarray]) -> Callable[[np.ndarray], list[np.ndarray]]:
    """For each set of centres the 0-based number of the one nearest to each row."""
    weights = _centre_weights(np.concatenate(models))
    ends = np.cumsum([len(m) for m in models])
    spans = list(zip(ends - [len(m) for m in models], ends))

    def labels(rows: np.ndarray) -> list[np.ndarray]:
        apart = weights @ _with_ones(rows)
        return [apart[a:b].argmin(0) for a, b in spans]

    return labels


def silhouettes(
    points: DataFrame | RDD, ks: Sequence[int], labels: Callable[[np.ndarray], list[np.ndarray]]
) -> list[float | None]:
    """Mean silhouette of every labelling of all rows, as Spark ML scores it: by squared distances, which
    sums of each cluster give exactly. Two jobs for all; None where all rows have one label."""

    def parts(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        for at in range(0, len(rows), BLOCK):
            part = rows[at : at + BLOCK]
            yield _with_ones(part), np.einsum("ij,ij->i", part, part), labels(part)

    def add(_: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        sums = [0.0] * len(ks)
        for values, norms, found in parts(rows):
            added = np.concatenate([values, norms[None]]).T
            for i, label in enumerate(found):
                sums[i] = sums[i] + (label == np.arange(ks[i])[:, None]).astype(float) @ added
        yield from enumerate(sums)

    sizes, weights = [], []
    for _, sums in sorted(_add_up(points, add).items()):
        n = sums[:, :1]
        with np.errstate(divide="ignore", invalid="ignore"):  # clusters of no rows are no neighbours
            weights.append(np.where(n > 0, np.concatenate([sums[:, -1:], -2 * sums[:, 1:-1]], 1) / n, [math.inf] + [0.0] * (sums.shape[1] - 2)))
        sizes.append(n[:, 0])

    def score(_: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        total, place = np.zeros(len(ks)), np.arange(BLOCK)
        for values, norms, found in parts(rows):
            for i, label in enumerate(found):
                apart = weights[i] @ values + norms
                at = label, place[: len(label)]
                own, mine = apart[at], sizes[i][label]
                apart[at] = math.inf
                other = apart.min(0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    own = own * (mine / (mine - 1))
                    score = np.where(own < other, 1 - own / other, np.where(own > other, other / own - 1, 0.0))
                total[i] += np.where(mine > 1, score, 0.0).sum()
        yield 0, total

    totals = _add_up(points, score).get(0) if sizes else None
    return [
        float(totals[i] / sizes[i].sum()) if sizes and (sizes[i] > 0).sum() > 1 else None for i in range(len(ks))
    ]


def _apart(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gaps = rows - centre
    return np.einsum("ij,ij->i", gaps, gaps)


def _parts(group: int, rows: np.ndarray, centres: Mapping[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, its rows, their squared distances to its centre): each row is in the part of the nearer
    centre, the first on a tie; parts of no rows are left out."""
    gaps = [_apart(rows, c) for c in centres.values()]
    later = gaps[0] > gaps[-1]
    for part, mine, apart in zip(centres, (~later, later), gaps):
        if mine.any():
            yield part, rows[mine], apart[mine]


def part_costs(points: RDD, divisions: Mapping[int, Mapping[int, np.ndarray]]) -> dict[int, tuple[int, float]]:
    """Rows and cost of the parts of every divided cluster, given by their centres."""

    def fold(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for part, mine, apart in _parts(group, rows, divisions[group]) if group in divisions else ():
            yield part, np.array([len(mine), apart.sum()])

    return {part: (int(n), float(cost)) for part, (n, cost) in _add_up(points, fold).items()}


def divided(points: RDD, divisions: Mapping[int, Mapping[int, np.ndarray]]) -> RDD:
    """The blocks of the parts of divided clusters. They are made anew in each scan, next to what reads
    them, so that a tree of divisions keeps one copy of the rows however deep it is."""

    def divide(stream: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        for block in stream:
            for part, mine, _ in _parts(block[0], _matrix(block), divisions[block[0]]) if block[0] in divisions else ():
                yield part, block[1], mine.tobytes()

    return points.mapPartitions(divide)


def bisecting_rounds(
    points: DataFrame | RDD, k: int, first: Sequence[np.ndarray], noise: Callable[[int], np.ndarray], max_iter: int
) -> dict[int, np.ndarray]:
    """Centres of the tree of Spark ML's bisecting k-means: of the whole, 0, and of the parts of every
    divided cluster n, 2n + 1 and 2n + 2 (one, where the other has no rows).

    Points are of one group; ``first`` are the centres of the parts of the whole after one step. A level
    divides the largest clusters, as many as are still needed, each from its centre less and plus a
    ten-thousandth of ``noise`` times its norm. A step is one job for all divisions of a level; a level
    ends after ``max_iter`` steps, or when no centre moves any more.
    """
    centres: dict[int, np.ndarray] = {}
    with held_blocks(points) as level:
        whole = _add_up(level, lambda _, rows: iter([(0, np.append(rows.sum(0), len(rows)))]))
        if not whole:
            return centres
        centres[0] = whole[0][:-1] / whole[0][-1]
        bottom = {0: (int(whole[0][-1]), math.inf)}
        needed = k - 1
        while needed > 0:
            able = [n for n, (size, cost) in sorted(bottom.items()) if cost > np.finfo(float).eps * size]
            chosen = able if len(able) <= needed else sorted(able, key=lambda n: -bottom[n][0])[:needed]
            if not chosen:
                break
            parts = {}
            for n in chosen:
                shift = 1e-4 * np.linalg.norm(centres[n]) * noise(len(centres[n]))
                parts[n] = {2 * n + 1: centres[n] - shift, 2 * n + 2: centres[n] + shift}
            if chosen == [0]:
                parts[0] = dict(enumerate(first, 1))
                sizes = {1: bottom[0][0]}
            for _ in range(max_iter - (chosen == [0])):
                before, now = {n: list(p.values()) for n, p in parts.items()}, dict(parts)

                def fold(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
                    if group in now:
                        yield group, _cluster_sums(rows, [np.stack(list(now[group].values()))])[0]

                sizes = {}
                for n, sums in _add_up(level, fold).items():
                    count = sums[2 : 2 + len(parts[n])]
                    means = sums[2 + len(count) :].reshape(len(count), -1) / np.maximum(count, 1)[:, None]
                    found = [(p, c, m) for p, c, m in zip(parts[n], count, means) if c > 0]
                    parts[n] = {p: m for p, _, m in found}
                    sizes |= {p: int(c) for p, c, _ in found}
                if all(np.array_equal(before[n], list(p.values())) for n, p in parts.items()):
                    break
            costs = part_costs(level, parts)
            level = divided(level, parts)
            bottom = {p: (size, costs[p][1] if p in costs else 0.0) for p, size in sizes.items()}
            centres |= {p: c for found in parts.values() for p, c in found.items()}
            needed -= len(chosen)
    return centres


@dataclass(frozen=True)
class MixtureFit:
    """A Gaussian mixture with full covariances."""

    group: int
    k: int
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -math.inf
    converged: bool = False

    def coefficients(self, origin: np.ndarray) -> np.ndarray:
        """log(weight) + log density of every component as weights of ``_powers``, a row for each."""
        found = []
        above = np.triu_indices(len(origin))
        twice = np.where(above[0] == above[1], 1.0, 2.0)
        for weight, mean, covariance in zip(self.weights, self.means - origin, self.covariances):
            precision = np.linalg.inv(covariance)
            precision = (precision + precision.T) / 2
            log_det = np.linalg.slogdet(covariance)[1]
            at_origin = mean @ precision @ mean + len(mean) * math.log(2 * math.pi) + log_det
            constant = math.log(max(weight, 1e-300)) - 0.5 * at_origin
            found.append(np.concatenate([[constant], precision @ mean, -0.5 * twice * precision[above]]))
        return np.stack(found)

    def labels(self, rows: np.ndarray) -> np.ndarray:
        """0-based most likely component of each row."""
        origin = self.means.mean(0)
        weights = self.coefficients(origin)
        found = [(weights @ _powers(rows[at : at + BLOCK] - origin)).argmax(0) for at in range(0, len(rows), BLOCK)]
        return np.concatenate(found) if found else np.empty(0, dtype=int)


def _powers(rows: np.ndarray) -> np.ndarray:
    """1, the values and their products (each pair once) of every row, a column for each row: all
    a mixture step needs, as one matrix."""
    n, d = rows.shape
    out = np.empty((1 + d + d * (d + 1) // 2, n))
    out[0], values = 1.0, out[1 : d + 1]
    values[:] = rows.T
    start = 1 + d
    for i in range(d):
        np.multiply(values[i], values[i:], out=out[start : start + d - i])
        start += d - i
    return out


def _second_moments(products: np.ndarray, d: int) -> np.ndarray:
    """Matrices of the sums of products of each pair, from those that ``_powers`` has."""
    above = np.triu_indices(d)
    found = np.empty((len(products), d, d))
    found[:, above[0], above[1]] = products
    found[:, above[1], above[0]] = products
    return found


def _first_mixture(group: int, k: int, seeds: Seeds, rng: np.random.Generator) -> MixtureFit:
    rows, mass = seeds.rows, seeds.weights
    centres = _spread_centres(seeds, k, rng)
    label = _nearest(rows, centres)[0]
    d = rows.shape[1]
    overall = np.cov(rows.T, bias=True, aweights=mass).reshape(d, d)
    weights, covariances = np.empty(k), np.empty((k, d, d))
    for j in range(k):
        mine = (label == j) & (mass > 0)
        weights[j] = (mass[mine].sum() + 1) / (mass.sum() + k)
        own = np.cov(rows[mine].T, bias=True, aweights=mass[mine]).reshape(d, d) if mine.sum() > d else overall
        covariances[j] = own + RIDGE * np.eye(d)
    return MixtureFit(group, k, weights, centres, covariances)


def mixture_sweep(
    points: DataFrame | RDD, wanted: Sequence[tuple[int, int]], sizes: Mapping[int, int], seed: int = 1,
    max_iter: int = 100, tol: float = 1e-3,
) -> list[MixtureFit]:
    """EM for every (group, k) wanted, one job per iteration.

    A model stops when its mean log likelihood gains less than ``tol``; the loop ends
    when all have. k = 1 is exact after its first step.
    """
    with held_blocks(points) as blocks:
        return _mixture_fits(blocks, wanted, sizes, seed, max_iter, tol)


def _mixture_fits(
    points: RDD, wanted: Sequence[tuple[int, int]], sizes: Mapping[int, int], seed: int, max_iter: int, tol: float
) -> list[MixtureFit]:
    seeds = seed_candidates(points, DRAWN_PER_CENTRE * max(k for _, k in wanted), seed)
    fits = [_first_mixture(g, k, seeds[g], np.random.default_rng([seed, g, k])) for g, k in wanted]
    origin = {g: np.average(s.rows, axis=0, weights=s.weights) for g, s in seeds.items()}

    for _ in range(max_iter + 1):
        active = [i for i, f in enumerate(fits) if not f.converged]
        if not active:
            break
        by_group: dict[int, list[tuple[int, MixtureFit]]] = {}
        for i in active:
            by_group.setdefault(fits[i].group, []).append((i, fits[i]))

        weights = {
            group: np.concatenate([f.coefficients(origin[group]) for _, f in models])
            for group, models in by_group.items()
        }
        widths = {group: [(i, f.k) for i, f in models] for group, models in by_group.items()}

        def fold(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            if group not in widths:
                return
            models, gained, sums = widths[group], np.zeros(len(widths[group])), 0.0
            for at in range(0, len(rows), BLOCK):
                powers = _powers(rows[at : at + BLOCK] - origin[group])
                share = weights[group] @ powers
                start = 0
                for j, (_, k) in enumerate(models):
                    part = share[start : start + k]
                    start += k
                    top = part.max(0)
                    part -= top
                    np.exp(part, out=part)
                    mass = part.sum(0)
                    part /= mass
                    gained[j] += (top + np.log(mass)).sum()
                sums = sums + share @ powers.T
            start = 0
            for gain, (i, k) in zip(gained, models):
                yield i, np.concatenate([[gain], sums[start : start + k].ravel()])
                start += k

        for i, sums in _add_up(points, fold).items():
            fit, (_, d) = fits[i], fits[i].means.shape
            n_rows, start = sizes[fit.group], origin[fit.group]
            gain = (sums[0] - fit.log_likelihood) / n_rows
            if abs(gain) < tol:
                fits[i] = replace(fit, log_likelihood=float(sums[0]), converged=True)
                continue
            by_component = sums[1:].reshape(fit.k, -1)
            mass = np.maximum(by_component[:, 0], 1e-10)
            means = by_component[:, 1 : d + 1] / mass[:, None]
            second = _second_moments(by_component[:, d + 1 :] / mass[:, None], d)
            covariances = second - means[:, :, None] * means[:, None, :] + RIDGE * np.eye(d)
            fits[i] = replace(
                fit, weights=mass / n_rows, means=means + start, covariances=covariances,
                log_likelihood=float(sums[0]),
            )
    return fits


@dataclass(frozen=True)
class Densities:
    """The components of a mixture as Spark ML weighs them: a covariance's pseudo-inverse, its
    square root (after its mean's part), and a floor under every density, so that a row far from all is in
    none more than in others."""

    weights: np.ndarray
    roots: np.ndarray
    constants: np.ndarray

    @staticmethod
    def of(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> Densities:
        values, vectors = np.linalg.eigh(covariances)
        d = means.shape[1]
        real = values > np.finfo(float).eps * values.max(1, keepdims=True) * d
        sure = np.where(real, values, 1.0)
        roots = np.where(real, 1 / np.sqrt(sure), 0.0)[:, :, None] * vectors.transpose(0, 2, 1)
        constants = -0.5 * (d * math.log(2 * math.pi) + np.log(sure).sum(1))
        shifts = (roots @ means[:, :, None]).reshape(-1, 1)
        return Densities(weights, np.concatenate([-shifts, roots.reshape(-1, d)], 1), constants)

    def masses(self, columns: np.ndarray) -> np.ndarray:
        """Components x rows: weighted densities of rows that are given as columns, 1 first."""
        apart = self.roots @ columns
        apart *= apart
        density = apart.reshape(len(self.weights), -1, columns.shape[1]).sum(1)
        density *= -0.5
        density += self.constants[:, None]
        np.exp(density, out=density)
        density *= self.weights[:, None]
        density += np.finfo(float).eps
        return density


def mixture_rounds(
    points: DataFrame | RDD, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray, max_iter: int, tol: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, means, covariances) after the EM steps of Spark ML's mixture from a given start,
    one job each: at most ``max_iter``, or until the log likelihood moves by no more than ``tol``.

    Points are of one group. Tasks fold blocks of rows; Spark ML weighs one row at a time.
    """
    k, d = means.shape
    before, likelihood = 0.0, -sys.float_info.max
    with held_blocks(points) as blocks:
        for _ in range(max_iter):
            if abs(likelihood - before) <= tol:
                break
            densities = Densities.of(weights, means, covariances)

            def fold(group: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
                total, sums = 0.0, 0.0
                for at in range(0, len(rows), BLOCK):
                    powers = _powers(rows[at : at + BLOCK])
                    share = densities.masses(powers[: d + 1])
                    mass = share.sum(0)
                    share /= mass
                    total += np.log(mass).sum()
                    sums = sums + share @ powers.T
                yield 0, np.concatenate([[total], sums.ravel()])

            found = _add_up(blocks, fold)[0]
            before, likelihood = likelihood, float(found[0])
            by_component = found[1:].reshape(k, -1)
            mass = by_component[:, 0]
            weights, means = mass / mass.sum(), by_component[:, 1 : d + 1] / mass[:, None]
            covariances = _second_moments(by_component[:, d + 1 :] / mass[:, None], d)
            covariances -= means[:, :, None] * means[:, None, :]
    return weights, means, covariances


def densest(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray, features: Sequence[Column]) -> Column:
    """1-based component of the largest weighted density; the first on a tie."""
    densities = Densities.of(weights, means, covariances)

    @F.pandas_udf("int")
    def component(*columns: pd.Series) -> pd.Series:
        rows = np.stack([np.ones(len(columns[0])), *[c.to_numpy(dtype=float) for c in columns]])
        found = [densities.masses(rows[:, at : at + BLOCK]).argmax(0) for at in range(0, rows.shape[1], BLOCK)]
        return pd.Series(np.concatenate(found).astype(np.int32) + 1 if found else [], dtype=np.int32)

    return component(*features)


def mixture_label(fits: Mapping[int, MixtureFit], group: Column, features: Column) -> Column:
    """1-based component of each row under its group's mixture; 1 for other groups."""
    held = dict(fits)

    @F.pandas_udf("int")
    def component(groups: pd.Series, points: pd.Series) -> pd.Series:
        label = np.ones(len(groups), dtype=np.int32)
        for g in groups.unique():
            if g in held:
                at = (groups == g).to_numpy()
                label[at] = held[g].labels(np.stack(points[at].to_numpy())) + 1
        return pd.Series(label)

    return component(group, features)
