"""Near-duplicate vectors by collision-counting projections.

Unit vectors are projected on many random lines. On one line, two vectors at distance d
differ by a normal variable of deviation d, so near vectors fall into each other's window
far more often than others do. For each query vector the collisions in its windows on the
sorted lines are counted per pair; pairs that reach a count calibrated for recall are
verified by their cosine in double precision.

A first line deals the vectors of a label out to tiles. A tile meets itself and the tiles
after it within three deviations; large tiles are cut into chunks. Equal vectors are one
class, compared once, and clusters of near vectors give sums and tree links, never all
their pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb, erf, floor, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.llm.components import connected_components
from dielens.llm.simhash import star_edges
from dielens.plans.hold import hold

#: Vectors of a tile that are queries at once.
CHUNK = 1024


@dataclass(frozen=True)
class Plan:
    """Lines, windows and the count to reach, from the threshold and the recall wanted."""

    cosine: float = 0.93
    lines: int = 32
    recall: float = 0.99
    cell: float = 0.25
    seed: int = 11

    @cached_property
    def distance(self) -> float:
        """Of unit vectors at the threshold; also half a window."""
        return sqrt(2 - 2 * self.cosine)

    @cached_property
    def reach(self) -> int:
        """How many tiles further a near vector may lie, but for three deviations."""
        return floor(3 * self.distance / self.cell) + 1

    @cached_property
    def enough(self) -> int:
        """The largest count that pairs at the threshold reach with the recall."""
        p = erf(1 / sqrt(2))  # a normal variable within one deviation
        at_least = lambda k: sum(comb(self.lines, i) * p**i * (1 - p) ** (self.lines - i) for i in range(k, self.lines + 1))
        return max(k for k in range(self.lines + 1) if at_least(k) >= self.recall)

    def directions(self, width: int) -> np.ndarray:
        """The first line, then the counted ones."""
        return np.random.default_rng([self.seed, width]).normal(size=(width, 1 + self.lines))


def collisions(queries: np.ndarray, others: np.ndarray, half: float) -> np.ndarray:
    """On how many lines (columns) each of the others lies in a query's window."""
    counts = np.zeros((len(queries), len(others)), dtype=np.uint8)
    for line in range(queries.shape[1]):
        order = np.argsort(others[:, line], kind="stable")
        row = others[order, line]
        low = np.searchsorted(row, queries[:, line] - half, side="left").tolist()
        high = np.searchsorted(row, queries[:, line] + half, side="right").tolist()
        for q, (a, b) in enumerate(zip(low, high, strict=True)):
            counts[q, order[a:b]] += 1
    return counts


def linked_pairs(queries: np.ndarray, others: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of unit vectors at the threshold or nearer, as far as counts show them."""
    if not len(queries) or not len(others):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    lines = plan.directions(queries.shape[1])[:, 1:]
    found = [np.empty((2, 0), dtype=np.int64)]
    for j in range(0, len(others), 4096):
        part = others[j : j + 4096]
        x, y = np.nonzero(collisions(queries @ lines, part @ lines, plan.distance) >= plan.enough)
        for a in range(0, len(x), 100_000):
            p, q = x[a : a + 100_000], y[a : a + 100_000]
            near = np.einsum("ij,ij->i", queries[p], part[q]) >= plan.cosine
            found.append(np.stack([p[near], q[near] + j]))
    return tuple(np.concatenate(found, axis=1))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def comparable(vector: str, label: str):
    """Whether a row takes part: a label, and a vector of finite values, not all zero."""
    big = F.lit(1.7976931348623157e308)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= big))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & (F.size(vector) > 0) & finite & some, F.lit(False))


def near_vectors(df: DataFrame, plan: Plan = Plan(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each row of df: the key, `n_links`, `component_id`, `kept`.

    Only rows with equal labels and vectors of equal length are compared. Rows that take
    no part (`comparable`) link with nothing and keep their own key as component, null for
    a null key. Repeated rows are different vectors that link with each other. A key that
    stands on several different vectors is one node with the links of all. Other columns
    are not read.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    valid = comparable("vector", "label")
    classes = hold(rows.where(valid).groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    compared = hold(_compared(classes, plan))
    degree = compared.groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(compared.where("b is not null").select("a", "b"))
    by_class = (
        classes.join(degree, classes["first"] == degree["a"], "left")
        .join(groups, classes["first"] == groups["node"], "left")
        .select("label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    )
    linked = rows.where(valid).join(by_class, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~valid).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.union(alone)
    return every.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _compared(classes: DataFrame, plan: Plan) -> DataFrame:
    """(a, b, links): rows with b are links that join clusters; rows without b say how many
    vectors class a links with, to be summed."""
    kind = classes.schema["first"].dataType.simpleString()

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy()
            cells = np.zeros(len(sizes), dtype=np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                unit = _unit(_matrix(batch.column("vector").take(pa.array(at))))
                cells[at] = np.floor(unit @ plan.directions(int(size))[:, 0] / plan.cell)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    placed = classes.mapInArrow(place, f"{shape}, cell int").withColumn("width", F.size("vector"))
    tile = ["label", "width", "cell"]
    chunks = placed.groupBy(*tile).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(plan.reach))).alias("step")
    homes = chunks.select("label", "width", F.col("cell").alias("home"), "chunks", steps)
    homes = homes.withColumn("cell", F.col("home") + F.col("step")).groupBy(*tile)
    homes = homes.agg(F.collect_list(F.struct("home", "chunks", "step")).alias("homes"))
    sent = (
        placed.join(homes, tile)
        .select("label", "width", "first", "n", "vector", F.explode("homes").alias("h"), F.filter("homes", lambda h: h["step"] == 0)[0]["chunks"].alias("own"))
        .select("*", "h.home", "h.step", F.explode(F.sequence(F.lit(0), F.col("h.chunks") - 1)).alias("chunk"))
        .withColumn("mine", F.pmod(F.xxhash64("vector"), F.col("own")).cast("int"))
        .where("step > 0 or chunk >= mine")
        .select("label", "width", "home", "chunk", ((F.col("step") > 0) | (F.col("chunk") > F.col("mine"))).cast("int").alias("role"), "first", "n", "vector")
    )
    place_key = ["label", "width", "home", "chunk"]
    dealt = sent.repartition(*place_key).sortWithinPartitions(*place_key, "role")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in [*place_key, "role"]), strict=True))
            cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            for i, j in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if i == j:
                    continue
                part = batch.slice(i, j - i)
                first, n = part.column("first").to_numpy(zero_copy_only=False), part.column("n").to_numpy()
                unit = _unit(_matrix(part.column("vector")))
                if keys[i][:-1] != at:
                    at, own = keys[i][:-1], (first[:0], n[:0], unit[:0])
                x, y = linked_pairs(own[2], unit, plan)
                yield from found(own[0][x], own[1][x], first[y], n[y])
                if keys[i][-1] == 0:
                    x, y = linked_pairs(unit, unit, plan)
                    x, y = x[x < y], y[x < y]
                    yield from found(first[x], n[x], first[y], n[y])
                    own = tuple(np.concatenate(z) for z in zip(own, (first, n, unit), strict=True))

    def found(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(a):
            return
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = np.bincount(at, weights=np.concatenate([n_b, n_a])).astype(np.int64)
        left, right = star_edges(a, b)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes, left])),
                pa.array([None] * len(nodes) + right.tolist(), type=pa.int64()),
                pa.array(np.concatenate([links, np.zeros(len(left), dtype=np.int64)])),
            ],
            names=["a", "b", "links"],
        )

    return dealt.mapInArrow(compare, f"a {kind}, b {kind}, links long")
