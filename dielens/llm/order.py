"""Positions and running totals of rows in an order, however large one group is.

Rows are dealt by ranges of the order, so a group that holds a third of them lies in many
parts. A running total is the total of the group's earlier parts, of which there are as many
as partitions at most, plus the running total within the part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dielens.plans.hold import hold

PART = "part"


def ranged(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows with `part`: those of a lower part come first. Held, as it must not change."""
    return hold(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def totals_before(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    values: dict[str, Column],
    also: DataFrame | None = None,
    xor: bool = False,
) -> DataFrame:
    """df (with `part`, and groups that are not null) and for each name the total of the
    value over the rows of the group that come before; with `xor` its exclusive or.

    `also` has columns to add to all rows of a group. It meets the parts of each group, and
    those their rows, so no join has all rows of a group on one key.
    """
    total = F.bit_xor if xor else F.sum
    plus = (lambda a, b: a.bitwiseXOR(b)) if xor else (lambda a, b: a + b)
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c, window: F.coalesce(total(c).over(window), F.lit(0).cast("long"))
    parts = df.groupBy(PART, *group).agg(*[total(c).alias(f"_{n}") for n, c in values.items()])
    parts = parts.select(PART, *group, *[so_far(F.col(f"_{n}"), earlier).alias(f"_{n}") for n in values])
    if also is not None:
        parts = parts.join(also, list(group))
    inside = df.withColumns({n: so_far(c, within) for n, c in values.items()})
    both = inside.join(parts, [PART, *group])
    return both.withColumns({n: plus(F.col(n), F.col(f"_{n}")) for n in values}).drop(*[f"_{n}" for n in values])
