"""Row filters and parsing: from raw text dies to clean numeric ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import NOT_MEASURED, finite, named, parse_fid, zone_code
from dielens.spec import BIN_COLUMN, ZONE_COLUMN, ProbeSpec


class EmptyInputError(ValueError):
    """The scan returned no dies."""


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyInputError("the queried die table is empty")
    return df


def drop_unbinned(df: DataFrame) -> DataFrame:
    """Dies with a bin; NULL bins go too."""
    return df.where(~F.col(BIN_COLUMN).startswith(".:"))


def drop_void_steps(df: DataFrame, bin_step: str) -> DataFrame:
    """Dies whose bin-step value is real: neither ``NA!`` nor anything with a dot."""
    step = named(bin_step)
    return df.where(~step.contains("NA!") & ~step.contains("."))


def first_pass(df: DataFrame) -> DataFrame:
    return df.where(F.col("REPROBE") == "0")


def with_position(df: DataFrame, max_x_digits: int | None = 4) -> DataFrame:
    """Adds lot, wafer and die position parsed from FID, in the same projection."""
    return df.withColumns(parse_fid(F.col("FID"), max_x_digits))


def keep_target_bin(df: DataFrame, item: str) -> DataFrame:
    """Dies failing the requested bin."""
    return df.where(F.col(BIN_COLUMN).endswith(":" + item))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def drop_failed(df: DataFrame, measured: Sequence[str]) -> DataFrame:
    """Dies with every register measured. A NULL register removes the die as well."""
    return df.where(_all([named(c) != NOT_MEASURED for c in measured]))


def count_failed(df: DataFrame, measured: Sequence[str]) -> DataFrame:
    """One row: dies in, and dies with at least one register not measured."""
    failed = F.coalesce(_any([named(c) == NOT_MEASURED for c in measured]), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("dies"),
        F.coalesce(F.sum(failed.cast("bigint")), F.lit(0).cast("bigint")).alias("failed_dies"),
    )


def to_numbers(df: DataFrame, measured: Sequence[str]) -> DataFrame:
    """Register text to doubles in one projection; text that is no finite number becomes NULL."""
    wanted = set(measured)
    # Parsed in a projection of its own: each text is read once, not for the test and for the value.
    parsed = df.select(*[named(c).try_cast("double").alias(c) if c in wanted else named(c) for c in df.columns])
    return parsed.select(*[finite(named(c)).alias(c) if c in wanted else named(c) for c in df.columns])


def prepare_rows(
    df: DataFrame, spec: ProbeSpec, first_pass_only: bool = True, max_x_digits: int | None = 4
) -> DataFrame:
    """The row filters of one request, then position and zone code. Registers stay text."""
    if spec.probe_column == BIN_COLUMN:
        df = drop_unbinned(df)
    elif spec.probe_column == spec.bin_step:
        df = drop_void_steps(df, spec.probe_column)
    if first_pass_only:
        df = first_pass(df)
    df = with_position(df, max_x_digits)
    if ZONE_COLUMN in df.columns:
        df = df.withColumn(ZONE_COLUMN, zone_code(F.col(ZONE_COLUMN)))
    return df


def numeric_dies(df: DataFrame, measured: Sequence[str]) -> DataFrame:
    """Failed dies out, registers to numbers."""
    return to_numbers(drop_failed(df, measured), measured)
