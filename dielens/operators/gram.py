"""Sums of products of all column pairs, per group, in one scan.

Tasks fold their rows into sums over blocks of columns (NumPy on Arrow batches); Spark adds
the blocks up. A pair counts the rows where both columns have a value. Values are taken
from a shift near their middle, so that large means do not eat the digits of the spread.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named

# The task functions travel to the executors with the job; nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of a block.
BLOCK = 32
#: A task passes its sums on and begins new ones beyond this many bytes.
MOST_BYTES = 64_000_000
#: Rows that the shift is taken from.
LOOKED_AT = 1000
PARTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _fold(rows: np.ndarray, block: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """For each pair of blocks i <= j the six sums of all column pairs, and the ranges."""
    there = ~np.isnan(rows)
    values, mask = np.where(there, rows, 0.0), there.astype(float)
    squares = values * values
    high, low = np.where(there, rows, -np.inf).max(0), np.where(there, -rows, -np.inf).max(0)
    out = {}
    cuts = [slice(a, a + block) for a in range(0, rows.shape[1], block)]
    for i, a in enumerate(cuts):
        for j, b in enumerate(cuts[i:], i):
            sums = (
                mask[:, a].T @ mask[:, b], values[:, a].T @ mask[:, b], mask[:, a].T @ values[:, b],
                squares[:, a].T @ mask[:, b], mask[:, a].T @ squares[:, b], values[:, a].T @ values[:, b],
            )
            out[i, j] = np.concatenate([s.ravel() for s in sums]), np.concatenate([high[a], low[a], high[b], low[b]])
    return out


def pair_sums(df: DataFrame, group: str | None, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(group, i, j, n, sx, sy, sxx, syy, sxy, x_varies, y_varies) for all columns i <= j by
    number; sums are of values less a shift, the same for all groups. Missing values are
    NULL or NaN.

    Action: a look at some rows for the shift.
    """
    d, block = len(columns), min(block, max(len(columns), 1))
    few = df.select(*[named(c).cast("double") for c in columns]).limit(LOOKED_AT).toPandas().to_numpy(dtype=float)
    # a value that occurs, so that a constant column is exactly zero everywhere
    shift = np.array([(np.sort(v)[len(v) // 2] if len(v := c[np.isfinite(c)]) else 0.0) for c in few.T])
    width = -(-d // block) * block

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for name, blocks in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(blocks), kind),
                        pa.array([i for i, _ in blocks], pa.int32()),
                        pa.array([j for _, j in blocks], pa.int32()),
                        pa.array([s.tolist() for s, _ in blocks.values()], pa.list_(pa.float64())),
                        pa.array([r.tolist() for _, r in blocks.values()], pa.list_(pa.float64())),
                    ],
                    ["_group", "bi", "bj", "sums", "ranges"],
                )
            held.clear()

        for batch in stream:
            if not batch.num_rows:
                continue
            kind = batch.column(0).type
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
            names = [*coded.dictionary.to_pylist(), None]
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = np.full((batch.num_rows, width), np.nan)
            rows[:, :d] = flat.reshape(batch.num_rows, d) - shift
            for code in np.unique(codes):
                mine = held.setdefault(names[code], {})
                for at, (sums, ranges) in _fold(rows[codes == code], block).items():
                    if at in mine:
                        sums, ranges = mine[at][0] + sums, np.maximum(mine[at][1], ranges)
                    mine[at] = sums, ranges
            if sum(len(b) for b in held.values()) * 6 * block * block * 8 > MOST_BYTES:
                yield from passed_on()
        yield from passed_on()

    key = F.lit(0) if group is None else named(group)
    points = df.select(key.alias("_group"), F.array(*[named(c).cast("double") for c in columns]).alias("_row"))
    kind_of = points.schema["_group"].dataType.simpleString()
    parts = points.mapInArrow(task, f"_group {kind_of}, bi int, bj int, sums array<double>, ranges array<double>")
    added = parts.groupBy("_group", "bi", "bj").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"),
        vector_to_array(Summarizer.max(array_to_vector("ranges"))).alias("ranges"),
    )
    place = added.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(block * block - 1))))
    row, column = F.expr(f"p div {block}").cast("int"), (F.col("p") % block).cast("int")
    at = lambda c, i: F.get(c, i.cast("int"))
    varies = lambda first, n: at("ranges", first + n) > -at("ranges", first + block + n)
    return place.select(
        *([] if group is None else [F.col("_group").alias(group)]),
        (F.col("bi") * block + row).alias("i"),
        (F.col("bj") * block + column).alias("j"),
        *[at("sums", F.col("p") + k * block * block).alias(n) for k, n in enumerate(PARTS)],
        varies(F.lit(0), row).alias("x_varies"),
        varies(F.lit(2 * block), column).alias("y_varies"),
    ).where((F.col("i") <= F.col("j")) & (F.col("j") < d))
