"""Scans: filters and column lists that reach the file reader."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.functions.scalars import named, normalise_date_text
from dielens.spec import CONTEXT_COLUMNS, unique_names

LOT_LENGTH = 7
LOTS_AS_PREDICATE = 200


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Context columns first, then the requested ones; the reader prunes the rest."""
    return df.select(*[named(c) for c in unique_names([*CONTEXT_COLUMNS, *columns])])


def _at(df: DataFrame, site: str | None, design_id: str | None, process: tuple[str, str] | None) -> DataFrame:
    if site is not None:
        df = df.where(F.col("FAB") == site.lower().replace(" ", "").removeprefix("fab"))
    if design_id is not None:
        df = df.where(F.col("DESIGN_ID") == design_id)
    if process is not None:
        df = df.where(named(process[0]) == process[1])
    return df


def scan_by_lot(
    df: DataFrame, lots: Sequence[str], columns: Sequence[str], site: str | None = None,
    process: tuple[str, str] | None = None,
) -> DataFrame:
    """Dies of the given lots, compared on their first seven characters.

    Lots are written as equality and prefix tests, which parquet and JDBC readers can
    skip data by. Longer lists become a semi join; Spark broadcasts them by their size.
    """
    wanted = sorted({lot[:LOT_LENGTH] for lot in lots})
    df = _at(df, site, None, process)
    if len(wanted) <= LOTS_AS_PREDICATE:
        short = [lot for lot in wanted if len(lot) < LOT_LENGTH]
        tests = [F.col("LOT_ID").isin(short)] if short else []
        tests += [F.col("LOT_ID").startswith(lot) for lot in wanted if len(lot) == LOT_LENGTH]
        hit = reduce(lambda a, b: a | b, tests, F.lit(False))
        return project(df.where(hit), columns)
    keys = df.sparkSession.createDataFrame([(lot,) for lot in wanted], "_lot string")
    cut = F.substring(F.col("LOT_ID"), 1, LOT_LENGTH)
    return project(df.join(keys, cut == F.col("_lot"), "left_semi"), columns)


def scan_by_time(
    df: DataFrame, start: str, end: str, columns: Sequence[str], site: str | None = None,
    design_id: str | None = None, process: tuple[str, str] | None = None,
) -> DataFrame:
    """Dies tested on the days from ``start`` to ``end``, both included."""
    first = datetime.strptime(normalise_date_text(start), "%y%m%d")
    after = datetime.strptime(normalise_date_text(end), "%y%m%d") + timedelta(days=1)
    kind = dict(df.dtypes)["START_DATETIME"]

    def bound(at: datetime):
        return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast(kind)

    df = _at(df, site, design_id, process)
    return project(
        df.where((F.col("START_DATETIME") >= bound(first)) & (F.col("START_DATETIME") < bound(after))), columns
    )


def tall_to_wide(
    df: DataFrame, keys: Sequence[str], registers: Sequence[str], register: str = "register", value: str = "value"
) -> DataFrame:
    """One row per die and register -> one row per die, one column per register.

    The names are given, so no extra job looks for them. A repeated (die, register)
    takes the largest value, the same one in every run.
    """
    return (
        df.where(named(register).isin(*registers))
        .groupBy(*[named(k) for k in keys])
        .agg(*[F.max(F.when(named(register) == r, named(value))).alias(r) for r in registers])
    )


def catalog_lookup(
    catalog: DataFrame, site: str, design_id: str, probe_item: str, model_dir: str = "",
    feature_column: str = "Register",
) -> DataFrame:
    """(Failure_Mode, features, model_path) of the stored models for one request."""
    fab = site.lower().replace(" ", "").removeprefix("fab")
    root = f"{model_dir}{site}/{design_id}/{probe_item}/"
    return (
        catalog.where((F.col("FAB") == fab) & (F.col("DESIGN_ID") == design_id) & (F.col("BIN") == probe_item))
        .select("Failure_Mode", named(feature_column).alias("feature"))
        .distinct()
        .groupBy("Failure_Mode")
        .agg(F.array_sort(F.collect_list("feature")).alias("features"))
        .withColumn("model_path", F.concat(F.lit(root), F.col("Failure_Mode")))
    )
