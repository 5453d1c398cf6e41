"""Row-level rules as column expressions; all of them stay in generated JVM code."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dielens.spec import BIN_COLUMN, FAIL_BIN_STEP, FAMILY_LETTERS, OTHER_FAMILY

NOT_MEASURED = "X"

# Wafer zone letter -> code.
ZONE_CODES = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5}


def named(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def finite(number: Column) -> Column:
    """The number, or NULL for NaN and the infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def lookup(value: Column, table: Mapping, default: Column) -> Column:
    chain = reduce(lambda acc, kv: acc.when(value == kv[0], F.lit(kv[1])), table.items(), F)
    return chain.otherwise(default)


def design_family(design_id: Column) -> Column:
    """Product family by the first letter of the design id."""
    letter = F.substring(design_id, 1, 1)
    chain = F
    for family, letters in FAMILY_LETTERS.items():
        chain = chain.when(letter.isin(*letters), F.lit(family))
    return chain.otherwise(F.lit(OTHER_FAMILY))


def zone_code(zone: Column, unknown: int | None = 0) -> Column:
    """Zone letter as a number; ``unknown=None`` leaves other letters NULL."""
    return lookup(zone, ZONE_CODES, F.lit(unknown).cast("int"))


def normalise_date(text: Column) -> Column:
    """``YYYY-MM-DD...`` or ``YYMMDD...`` as ``YYMMDD``; NULL when it is neither."""
    day = F.coalesce(
        F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(F.substring(text, 1, 6), F.lit("yyMMdd")),
    )
    return F.date_format(day, "yyMMdd")


def normalise_date_text(text: str) -> str:
    """The same rule for a query bound given on the driver; an error when malformed."""
    if re.match(r"\d{4}-\d{2}-\d{2}", text):
        return text[2:10].replace("-", "")
    if re.match(r"\d{6}", text):
        return text[:6]
    raise ValueError(f"not a date: {text!r}")


def parse_fid(fid: Column, max_x_digits: int | None = 4) -> dict[str, Column]:
    """Lot, wafer and die position out of ``lot:wafer:dieX:dieY``.

    ``dieX`` is a letter and digits, negative for ``N``. ``max_x_digits`` bounds
    the digits read (None reads all).
    """
    part = F.split(fid, ":")
    x = F.get(part, F.lit(2))
    digits = F.substring(x, 2, max_x_digits or 2147483647)
    return {
        "LotId": F.get(part, F.lit(0)),
        "WaferId": F.get(part, F.lit(1)),
        "DieX": F.when(x.startswith("N"), F.concat(F.lit("-"), digits)).otherwise(digits).try_cast("int"),
        "DieY": F.get(part, F.lit(3)).try_cast("int"),
        "lot_wafer": F.concat(F.get(part, F.lit(0)), F.lit("_"), F.get(part, F.lit(1))),
    }


def bin_indicator(probe_item: str, bin_step: str) -> Column:
    """1 where the die fails the requested bin, else 0."""
    if bin_step == FAIL_BIN_STEP:
        hit = F.col(BIN_COLUMN).startswith(probe_item + ":")
    else:
        hit = named(bin_step) == probe_item
    return F.coalesce(hit, F.lit(False)).cast("int")


def floor_at_zero_difference(main: Column, dependent: Column) -> Column:
    """``max(main - dependent, 0)``, NULL when either side is missing."""
    both = main.isNotNull() & dependent.isNotNull()
    return F.when(both, F.greatest(main - dependent, F.lit(0.0)))


def penalised_slope(slope: Column, r2: Column) -> Column:
    """Slope weighted by its fit; 0 where no line can be drawn."""
    return F.coalesce(slope * r2, F.lit(0.0))


def round_score(score: Column) -> Column:
    """A regression score as a whole number, halves to the even one."""
    return F.rint(score).cast("int")


def squared_distance(point: Sequence[Column], centre: Sequence[float]) -> Column:
    return reduce(
        lambda acc, pair: acc + (pair[0] - F.lit(float(pair[1]))) * (pair[0] - F.lit(float(pair[1]))),
        zip(point, centre),
        F.lit(0.0),
    )


def nearest_centre(point: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """1-based number of the closest centre (the first one on a tie)."""
    distances = F.array(*[squared_distance(point, c) for c in centres])
    return F.array_position(distances, F.array_min(distances)).cast("int")


def cluster_name(label: Column) -> Column:
    return F.concat(F.lit("cluster_"), label.cast("int").cast("string"))
