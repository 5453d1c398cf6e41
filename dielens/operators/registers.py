"""Choosing registers: which ones vary, dependent differences, Pareto selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dielens.functions.scalars import floor_at_zero_difference, named
from dielens.spec import ProbeSpec, RegisterSpec


class NoRegistersLeftError(ValueError):
    """Every register was dropped; nothing is left to cluster."""


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Long form with NULLs kept, whatever characters the names hold."""
    return df.unpivot([named(c) for c in ids], [named(c) for c in values], name, value)


def register_cardinality(df: DataFrame, registers: Sequence[str]) -> DataFrame:
    """Distinct values per register, as (register, n_distinct); NULL does not count.

    The long form makes this one distinct per (register, value), combined map-side,
    instead of one expansion of every row per register.
    """
    long = unpivot(df, [], registers, "register", "value")
    return long.groupBy("register").agg(F.countDistinct("value").alias("n_distinct"))


def low_cardinality(df: DataFrame, registers: Sequence[str]) -> DataFrame:
    """One row per register with ``n_distinct`` counted to 3 ("3 or more").

    Two scans with plain min/max aggregates, no shuffle of values: a register has at
    most two values exactly when each value is its minimum or its maximum.
    """
    bounds = df.agg(
        *[F.min(named(c)).alias(f"lo{i}") for i, c in enumerate(registers)],
        *[F.max(named(c)).alias(f"hi{i}") for i, c in enumerate(registers)],
    )
    between = df.select(*[named(c) for c in registers]).crossJoin(F.broadcast(bounds)).agg(
        *[
            F.coalesce(
                F.bool_or((named(c) != F.col(f"lo{i}")) & (named(c) != F.col(f"hi{i}"))), F.lit(False)
            ).alias(f"more{i}")
            for i, c in enumerate(registers)
        ]
    )
    row = bounds.crossJoin(F.broadcast(between))
    entries = [
        F.struct(
            F.lit(c).alias("register"),
            F.when(F.col(f"lo{i}").isNull(), 0)
            .when(F.col(f"more{i}"), 3)
            .when(F.col(f"lo{i}") == F.col(f"hi{i}"), 1)
            .otherwise(2)
            .alias("n_distinct"),
        )
        for i, c in enumerate(registers)
    ]
    return row.select(F.inline(F.array(*entries)))


def dull_registers(
    df: DataFrame,
    registers: Sequence[str],
    max_dropped_cardinality: int = 2,
    drop_all_null: bool = False,
    protected: Sequence[str] = (),
) -> DataFrame:
    """(register, n_distinct, dropped): the registers that do not vary enough.

    ``protected`` names (model features, probe items) are never dropped. An all-NULL
    register has 0 distinct values and stays unless ``drop_all_null``.
    """
    if max_dropped_cardinality <= 2:
        counts = low_cardinality(df, registers)
    else:
        counts = register_cardinality(df, registers)
    least = 0 if drop_all_null else 1
    dull = F.col("n_distinct").between(least, max_dropped_cardinality)
    return counts.withColumn("dropped", dull & ~F.col("register").isin(*protected) if protected else dull)


@dataclass(frozen=True)
class Selection:
    """What register selection decided: the plan without the dull registers."""

    spec: ProbeSpec
    dropped: tuple[str, ...]


def without(spec: ProbeSpec, dropped: Sequence[str]) -> ProbeSpec:
    """The column plan without the dropped registers."""
    gone = set(dropped)

    def kept(group: Sequence[RegisterSpec]) -> tuple[RegisterSpec, ...]:
        return tuple(r for r in group if r.name not in gone)

    return ProbeSpec(
        **{**spec.__dict__, "main": kept(spec.main), "dependent": kept(spec.dependent), "extra": kept(spec.extra)}
    )


def select_informative(
    df: DataFrame, spec: ProbeSpec, max_dropped_cardinality: int = 2, drop_all_null: bool = False
) -> Selection:
    """Action: reads one small row per register and narrows the column plan."""
    verdict = dull_registers(
        df,
        spec.measured,
        max_dropped_cardinality,
        drop_all_null,
        protected=[*spec.probe_columns, *spec.features],
    )
    dropped = {r["register"] for r in verdict.where("dropped").collect()}
    if all(r in dropped for r in spec.registers):
        raise NoRegistersLeftError("no register varies, nothing is left to cluster")
    return Selection(without(spec, sorted(dropped)), tuple(sorted(dropped)))


def difference_name(main: RegisterSpec, dependent: RegisterSpec) -> str:
    return main.name.replace(f"_{main.bin}_", f"_{main.bin}-{dependent.bin}_")


def dependent_difference(df: DataFrame, spec: ProbeSpec) -> tuple[DataFrame, list[str]]:
    """Main register minus its dependent, floored at 0, for bases that have both.

    Returns the frame with the pair replaced by the difference, and the registers
    left to cluster: the differences and the extras when there is a dependent item,
    the main registers and the extras when there is none.
    """
    extras = [r.name for r in spec.extra]
    if spec.dependent_column is None:
        return df, [*(r.name for r in spec.main), *extras]
    by_base = {r.base: r for r in spec.dependent}
    pairs = [(m, by_base[m.base]) for m in spec.main if m.base in by_base]
    used = {r.name for pair in pairs for r in pair}
    differences = {
        difference_name(m, d): floor_at_zero_difference(named(m.name), named(d.name)) for m, d in pairs
    }
    out = df.select(
        *[named(c) for c in df.columns if c not in used],
        *[column.alias(name) for name, column in differences.items()],
    )
    return out, [*differences, *extras]


@dataclass(frozen=True)
class ParetoRule:
    """How many of the largest registers to keep."""

    threshold: float = 0.99
    include_crossing: bool = True
    min_keep: int = 6
    fallback: int = 8
    append_probe_bin: bool = False  # a probe item of one character is clustered on too


STRICT_PARETO = ParetoRule(threshold=0.97, include_crossing=False, append_probe_bin=True)


def register_pareto(df: DataFrame, registers: Sequence[str], rule: ParetoRule = ParetoRule()) -> DataFrame:
    """(position, register, total, share, kept): registers by total, largest first.

    One aggregate over the dies; everything after it is one row per register. Equal
    totals go by name. All-zero totals have a NULL share and use the fallback.
    """
    totals = df.agg(*[F.coalesce(F.sum(named(c)), F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(registers)])
    entries = [
        F.struct(F.lit(c).alias("register"), F.col(f"s{i}").alias("total")) for i, c in enumerate(registers)
    ]
    everything = Window.partitionBy(F.lit(1))
    order = everything.orderBy(F.desc("total"), F.asc("register"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = totals.select(F.inline(F.array(*entries))).select(
        F.row_number().over(order).alias("position"),
        "register",
        "total",
        F.try_divide(F.sum("total").over(running), F.sum("total").over(everything)).alias("share"),
        F.count(F.lit(1)).over(everything).alias("_n"),
    )
    below = F.coalesce(F.sum((F.col("share") < rule.threshold).cast("int")).over(everything), F.lit(0))
    wanted = F.least(below + (1 if rule.include_crossing else 0), F.col("_n"))
    quota = F.when(wanted < rule.min_keep, F.least(F.lit(rule.fallback), F.col("_n"))).otherwise(wanted)
    return (
        ranked.withColumn("kept", F.col("position") <= quota)
        .select("position", "register", "total", "share", "kept")
    )


def select_pareto(
    df: DataFrame, registers: Sequence[str], rule: ParetoRule = ParetoRule(), spec: ProbeSpec | None = None
) -> list[str]:
    """Action: the kept register names, largest total first. With ``append_probe_bin`` the
    probe column of ``spec`` comes last, when the probe item is a bin of one character."""
    rows = register_pareto(df, registers, rule).where("kept").orderBy("position").collect()
    kept = [r["register"] for r in rows]
    if rule.append_probe_bin and spec is not None and len(spec.probe_item) == 1 and spec.probe_column not in kept:
        kept.append(spec.probe_column)
    return kept
