"""Plans: what reaches the reader, and what must not appear."""

import pytest
from pyspark.sql import functions as F

from dielens.functions import quantiles
from dielens.operators import clean, outputs, stacked
from dielens.plans import dies, queries
from dielens.plans.dies import die_spec, die_table, load
from dielens.plans.hold import hold, shared_folder, written
from dielens.sources import tables
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dies") / "t")
    die_table(spark, SF_SMALL).write.partitionBy("FAB", "DESIGN_ID").parquet(path)
    return spark.read.option("basePath", path).schema(die_table(spark, SF_SMALL).schema).parquet(path)


def test_lot_scan_prunes_and_pushes(stored):
    text = plan(tables.scan_by_lot(stored, ["L3", "ABCDEFGH"], ["BITQ_V_ALL"], site="fab15"))
    assert "PushedFilters: [Or(EqualTo(LOT_ID,L3),StringStartsWith(LOT_ID,ABCDEFG))]" in text
    assert "PartitionFilters" in text and "BITQ_V_ALL" in text and "BITP_V_ALL" not in text


def test_time_scan_pushes(stored):
    text = plan(tables.scan_by_time(stored, "1996-02-01", "970131", die_spec().scan_columns, "fab10", "Z32M"))
    assert "GreaterThanOrEqual(START_DATETIME" in text and "LessThan(START_DATETIME" in text
    assert "PartitionFilters: [isnotnull(FAB" in text


@pytest.mark.parametrize(
    "name", ["cluster_item_stats", "stacked_map_labelled", "pairwise_regression", "wafer_grid", "sample_per_cluster", "parse_fid"]
)
def test_no_python_and_no_cartesian(spark, name):
    text = plan(queries.registered()[name](spark, SF_SMALL))
    assert "EvalPython" not in text and "InPandas" not in text and "CartesianProduct" not in text


def test_statistics_aggregate_before_they_shuffle(spark):
    text = plan(queries.registered()["cluster_item_stats"](spark, SF_SMALL))
    assert "partial_count" in text or "partial_sum" in text
    assert "percentile" not in text  # no map of all values of a group


def test_hold(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, `BITQ_V-t_ALL` double")
    table = written(df.where("id > 3"), str(tmp_path))
    assert table.count() == 6 and table.columns == df.columns
    text = plan(table.select("id"))
    assert "Scan parquet" in text and "BITQ" not in text
    kept = hold(df)
    if shared_folder(df) is None:
        assert kept.storageLevel.useDisk
        kept.unpersist()
    else:
        assert "Scan parquet" in plan(kept)


def test_group_mean_fill_keeps_rows(spark):
    rows = [("a", 1.0), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    filled = outputs.group_mean_fill(df, ["g"], ["v"])
    assert sorted(filled.collect(), key=str) == sorted([("a", 1.0), ("a", 1.0), ("b", None)], key=str)


def test_known_modes_repeat_for_every_model(spark):
    labelled, rest = queries.split(spark, SF_SMALL)
    maps = stacked.stacked_maps(rest, queries.MODELS, queries.STACK, labelled, list(queries.MODES))
    counts = {(r["model"], r["cluster"]): r["count"] for r in maps.groupBy("model", "cluster").count().collect()}
    assert counts[("kmeans", "HighQ")] == counts[("gmm", "HighQ")] > 0
    assert {m for m, _ in counts} == set(queries.MODELS)


def test_held_counts_do_not_reach_the_driver(spark, tmp_path):
    rows = spark.range(40000).selectExpr("id % 4000 g", "cast(id % 7 as double) v")
    counts = written(quantiles.value_counts(rows, ["g"], "v"), str(tmp_path))  # files far below the broadcast limit
    text = plan(quantiles.quantiles_of_counts(counts, {"mid": 0.5}))
    assert "ShuffledHashJoin" in text and "Broadcast" not in text
    one = quantiles.value_counts(rows, [], "v")
    assert "BroadcastHashJoin" in plan(quantiles.quantiles_of_counts(one, {"mid": 0.5}))
    found = quantiles.exact_quantiles(rows, ["g"], "v", {"mid": 0.5}, with_stats=True)
    assert found.count() == 4000 and found.where("n_values != 10").isEmpty()


def test_a_held_map_does_not_reach_the_driver(spark, tmp_path):
    names = "FAB string, DESIGN_ID string, DieX int, DieY int, model string, cluster string, stacked_item string, median_value double"
    rows = [("10", "Z", 1, 1, "m", "c1", "i", 1.0), ("10", "Z", None, 2, "m", "c2", "i", 2.0)]
    full = stacked.full_die_map(written(spark.createDataFrame(rows, names), str(tmp_path)))
    assert "SortMergeJoin" in plan(full) and "BroadcastHashJoin" not in plan(full)
    found = {(r["DieX"], r["DieY"], r["cluster"]): r["median_value"] for r in full.collect()}
    assert found == {(1, 1, "c1"): 1.0, (1, 1, "c2"): None, (None, 2, "c1"): None, (None, 2, "c2"): 2.0}


def test_die_stages_have_methods_the_jvm_compiles(spark):
    limit, given = "spark.sql.codegen.hugeMethodLimit", "7000"
    spark.conf.unset(limit)
    load(spark, SF_SMALL, "lineitem")
    assert spark.conf.get(limit) == "8000"
    spark.conf.set(limit, given)  # a user's own limit stays
    load(spark, SF_SMALL, "lineitem")
    assert spark.conf.get(limit) == given
    spark.conf.unset(limit)


def test_die_texts_need_no_decimals(spark):
    odd = [None, 0.0, -0.0, 0.005, -0.005, 1.005, 2.675, -0.004, -0.4, 7.000000000000001, -3.0, 1e9 + 0.25, 1e10, 9999999999.99, 123.455]
    rows = spark.createDataFrame([(v,) for v in odd], "x double").withColumn("n", F.expr("cast(x as bigint)"))
    same = rows.selectExpr(
        f"{dies._double_text('x')} <=> {dies._text('x')} as doubles", f"{dies._whole_text('n')} <=> {dies._text('n')} as wholes"
    )
    assert same.where("not doubles or not wholes").isEmpty()
    clear = rows.where("x = -3").selectExpr(f"{dies._double_text('x')} as t")
    assert clear.first()["t"] == "-3.00"
    quick = [dies.spark_expression(n) for n in dies.DIE_EXPRESSIONS if n.startswith(("BIT", "__")) and n not in ("BIN_BIT", "BITK_V_ALL")]
    assert len(quick) == 12 and all(q not in dies.DIE_EXPRESSIONS.values() for q in quick)


def test_registers_are_parsed_once_and_only_what_is_asked_is_held(spark):
    held = queries.held_dies(spark, SF_SMALL, ["BITD_V_ALL"])
    assert held.columns == [*queries.ROW, "BITD_V_ALL"]
    numbers = clean.to_numbers(spark.createDataFrame([("1.5",), ("NaN",), ("x",)], "r string"), ["r"])
    assert plan(numbers).count("try_cast(r#") == 1
    assert [r["r"] for r in numbers.collect()] == [1.5, None, None]


@pytest.mark.parametrize("name", ["cluster_item_stats", "stacked_die_median", "cluster_impact", "stacked_map_labelled", "cluster_pareto"])
def test_raw_dies_are_read_once(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr("dielens.plans.hold.shared_folder", lambda df: str(tmp_path))
    found = queries.registered()[name](spark, SF_SMALL)
    assert "lineitem" not in plan(found)  # only held tables
    assert not found.isEmpty()
