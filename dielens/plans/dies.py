"""A raw die table derived from ``lineitem``.

The expressions are plain SQL, the same text in Spark and in DuckDB, so that the
registered queries and their check queries start from equal rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dielens.plans.methods import compiled_methods
from dielens.spec import ProbeSpec, resolve_spec


def _text(expression: str) -> str:
    return f"cast(cast({expression} as decimal(18,2)) as varchar(30))"


_LOT = "concat('L', cast(l_suppkey % 25 as varchar(10)))"
_WAFER = "concat('W', cast(l_linenumber as varchar(10)))"
_DIE_X = (
    "case when l_partkey % 21 < 10 "
    "then concat('N', right(concat('00', cast(10 - l_partkey % 21 as varchar(10))), 2)) "
    "else concat('P', right(concat('00', cast(l_partkey % 21 - 10 as varchar(10))), 2)) end"
)
_DIE_Y = "cast(cast(floor(l_partkey / 21.0) as bigint) % 21 - 10 as varchar(10))"

DIE_EXPRESSIONS = {
    "src_order": "l_orderkey",
    "src_line": "l_linenumber",
    "FID": f"concat({_LOT}, ':', {_WAFER}, ':', {_DIE_X}, ':', {_DIE_Y})",
    "DESIGN_ID": "case l_returnflag when 'A' then 'Z32M' when 'N' then 'B47R' else 'S15A' end",
    "PART_TYPE": "concat('T', cast(l_partkey % 4 as varchar(10)))",
    "FAB": "case l_linestatus when 'O' then '15' else '10' end",
    "RUN_ID": "concat('R', cast(l_orderkey % 7 as varchar(10)))",
    "LOT_ID": _LOT,
    "WAFER_ID": _WAFER,
    "FBD_REGION": "chr(cast(65 + l_partkey % 6 as int))",
    "REPROBE": "case when l_discount > 0.095 then '1' else '0' end",
    "START_DATETIME": "l_shipdate",
    "TOTAL_DIE": "441",
    "BIN_BIT": "case when l_partkey % 89 = 0 then '.:NA' else concat(l_returnflag, ':', l_linestatus) end",
    "STEP_BIN": "case when l_partkey % 83 = 0 then 'NA!' when l_partkey % 79 = 0 then '0.5' else l_returnflag end",
    "BITQ_V_ALL": f"case when l_partkey % 97 = 0 then 'X' else {_text('l_quantity')} end",
    "BITQ_t_ALL": _text("floor(l_quantity * l_discount * 12)"),
    "BITP_V_ALL": f"case when l_partkey % 101 = 0 then 'X' else {_text('floor(l_extendedprice / 1000)')} end",
    "BITP_t_ALL": _text("(l_suppkey % 40) * 1.5"),
    "BITD_V_ALL": _text("l_discount * 100"),
    "BITX_V_ALL": _text("l_tax * 100"),
    "BITM_V_ALL": _text("l_partkey % 13"),
    "BITO_V_ALL": _text("l_orderkey % 11"),
    "BITS_V_ALL": _text("l_suppkey % 9"),
    "BITK_V_ALL": "'7.00'",
    "BITB_V_ALL": _text("l_orderkey % 2"),
    "__rdV": _text("l_orderkey % 5"),
    "__rdt": _text("l_orderkey % 3"),
}

_WHOLE = 10**15


def _whole_text(expression: str) -> str:
    """``_text`` of a whole number, without decimals where it has at most 15 digits."""
    plain = f"concat(cast({expression} as string), '.00')"
    return f"case when {expression} between {1 - _WHOLE} and {_WHOLE - 1} then {plain} else {_text(expression)} end"


def _double_text(expression: str) -> str:
    """``_text`` of a double, from its whole hundredths unless they are huge or near a half, where the
    decimal's rounding decides."""
    cents = f"rint(({expression}) * 100)"
    size = f"abs(cast({cents} as bigint))"
    digits = f"cast({size} div 100 as string), '.', substr(cast({size} % 100 + 100 as string), 2, 2)"
    parts = f"concat(case when {cents} < 0 then '-' else '' end, {digits})"
    whole = f"concat(cast(cast({cents} / 100 as bigint) as string), '.00')"
    clear = f"abs({expression}) < 1e10 and abs(({expression}) * 100 - {cents}) < 0.49"
    return f"case when not coalesce({clear}, false) then {_text(expression)} when {cents} % 100 = 0 then {whole} else {parts} end"


_WHOLE_NUMBERS = (
    "floor(l_quantity * l_discount * 12)",
    "floor(l_extendedprice / 1000)",
    "l_partkey % 13",
    "l_orderkey % 11",
    "l_suppkey % 9",
    "l_orderkey % 2",
    "l_orderkey % 5",
    "l_orderkey % 3",
)
_DOUBLES = ("l_quantity", "l_discount * 100", "l_tax * 100")
_QUICKER = {_text(e): _whole_text(e) for e in _WHOLE_NUMBERS} | {_text(e): _double_text(e) for e in _DOUBLES}
_QUICKER[_text("(l_suppkey % 40) * 1.5")] = _double_text("(l_suppkey % 40) * 1.5D")


def spark_expression(name: str) -> str:
    """The column for Spark alone, of the same values: decimals made of doubles, and their texts,
    took much of a die's time."""
    return reduce(lambda text, pair: text.replace(*pair), _QUICKER.items(), DIE_EXPRESSIONS[name])


# Cluster labels by rule, for aggregate queries that need no model.
RULE_CLUSTER = (
    "case when BIN_BIT like 'A:%' then 'cluster_1' when BIN_BIT like 'N:%' then 'cluster_2' else 'cluster_3' end"
)

EXTRA_REGISTERS = (
    "BITD_V_ALL",
    "BITX_V_ALL",
    "BITM_V_ALL",
    "BITO_V_ALL",
    "BITS_V_ALL",
    "BITK_V_ALL",
    "BITB_V_ALL",
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; one from fewer splits than cores is spread over all of them."""
    compiled_methods(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def die_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dies: context, bins, registers and probe items as text."""
    columns = [F.expr(spark_expression(name)).alias(name) for name in DIE_EXPRESSIONS]
    return load(spark, sf_dir, "lineitem").select(*columns)


def die_spec() -> ProbeSpec:
    """The request the registered queries make on the die table."""
    return resolve_spec("Z32M", "rdV", ["BITQ", "BITP"], dependent_item="rdt", extra=list(EXTRA_REGISTERS))
