"""Naming rules and row rules on small hand-made tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dielens import spec
from dielens.functions import quantiles, scalars
from dielens.functions.quantiles import exact_quantiles
from dielens.operators import clean, knee, labelling, outputs, registers, stacked, transform, wafers
from dielens.plans.hold import written
from dielens.sources import sinks, tables


def test_resolve_probe_marked_item():
    s = spec.resolve_spec("Z32M", "rdV", ["BITQ", "bitq", "BITP_V_ALL"], dependent_item="rdt", extra=" DB_V2_ALL, BITQ_V_ALL ")
    assert s.family == "DRAM" and s.probe_columns == ["__rdV", "__rdt"]
    assert [r.name for r in s.main] == ["BITQ_V_ALL", "BITP_V_ALL"]
    assert [r.name for r in s.dependent] == ["BITQ_t_ALL", "BITP_t_ALL"]
    assert [r.name for r in s.extra] == ["DB_V2_ALL"]
    assert s.scan_columns[:2] == ["FID", "DESIGN_ID"]


def test_resolve_bins():
    assert spec.resolve_spec("B1", "V:V", ["BITQ_V"], bin_step="Fail_bin").probe_column == "BIN_BIT"
    assert spec.resolve_spec("S1", "5", ["BITQ_V"], bin_step="STEP").probe_column == "STEP"
    with pytest.raises(ValueError):
        spec.resolve_spec("S1", "V", ["BITQ_V"])
    with pytest.raises(ValueError):
        spec.resolve_spec("S1", "rdV", ["BITQ"], dependent_item="t")


def test_missing_features():
    s = spec.resolve_spec("Z32M", "rdV", ["BITQ"])
    assert spec.missing_features(["bitq_v_all", "FBD_REGION", "BITZ_V_ALL"], s) == ["BITZ_V_ALL"]


def test_parse_fid(spark):
    rows = [("L1:W1:N03:-7",), ("L1:W1:P10:8",), ("L1:W1:P12345:0",), ("L1:W1:P0",), (None,)]
    df = spark.createDataFrame(rows, "FID string").select(*[c.alias(n) for n, c in scalars.parse_fid(F.col("FID")).items()])
    got = [(r["DieX"], r["DieY"], r["lot_wafer"]) for r in df.collect()]
    assert got == [(-3, -7, "L1_W1"), (10, 8, "L1_W1"), (1234, 0, "L1_W1"), (0, None, "L1_W1"), (None, None, None)]
    every = spark.createDataFrame(rows[2:3], "FID string").select(scalars.parse_fid(F.col("FID"), None)["DieX"]).first()
    assert every[0] == 12345


def test_dates(spark):
    rows = [("2019-06-04",), ("2019-06-04 10:00:00",), ("190604",), ("4 June",)]
    df = spark.createDataFrame(rows, "d string").select(scalars.normalise_date(F.col("d")))
    assert [r[0] for r in df.collect()] == ["190604", "190604", "190604", None]
    assert scalars.normalise_date_text("2019-06-04 10:00") == "190604"
    with pytest.raises(ValueError):
        scalars.normalise_date_text("4 June")


def test_failed_and_null_registers(spark):
    df = spark.createDataFrame([("1", "2"), ("X", "3"), (None, "4"), ("X", None)], "a string, b string")
    assert clean.numeric_dies(df, ["a", "b"]).collect() == [(1.0, 2.0)]
    assert tuple(clean.count_failed(df, ["a", "b"]).first()) == (4, 2)


def test_empty_input(spark):
    with pytest.raises(clean.EmptyInputError):
        clean.require_rows(spark.createDataFrame([], "a string"))


def test_cardinality_rules(spark):
    rows = [("7", None, "a", "1"), ("7", None, "b", "2"), ("7", None, "b", "X"), ("7", None, None, "1")]
    df = spark.createDataFrame(rows, "one string, none string, two string, three string")
    names = df.columns

    def dropped(**rule):
        return {r["register"] for r in registers.dull_registers(df, names, **rule).where("dropped").collect()}

    assert dropped() == {"one", "two"}
    assert dropped(protected=["two"]) == {"one"}
    assert dropped(max_dropped_cardinality=1, drop_all_null=True) == {"one", "none"}
    assert dropped(max_dropped_cardinality=3) == {"one", "two", "three"}


def test_nothing_left(spark):
    df = spark.createDataFrame([("1", "1"), ("1", "2")], "BITQ_V_ALL string, `__rdV` string")
    with pytest.raises(registers.NoRegistersLeftError):
        registers.select_informative(df, spec.resolve_spec("Z", "rdV", ["BITQ"]))


def test_dependent_pairs_need_the_same_base(spark):
    s = spec.resolve_spec("Z", "rdV", ["BITCR1", "BITCR10"], dependent_item="rdt")
    s = spec.ProbeSpec(**{**s.__dict__, "dependent": s.dependent[1:]})  # only BITCR10 has a partner
    df = spark.createDataFrame(
        [(1.0, 5.0, 7.0), (1.0, 9.0, 7.0), (1.0, None, 7.0)], "BITCR1_V_ALL double, BITCR10_V_ALL double, BITCR10_t_ALL double"
    )
    out, names = registers.dependent_difference(df, s)
    assert names == ["BITCR10_V-t_ALL"]
    assert [r["BITCR10_V-t_ALL"] for r in out.collect()] == [0.0, 2.0, None]
    assert "BITCR1_V_ALL" in out.columns


def test_pareto_edges(spark):
    df = spark.createDataFrame([(5.0, 5.0, 0.0)], "b double, a double, c double")
    assert registers.select_pareto(df, ["b", "a", "c"]) == ["a", "b", "c"]
    zeros = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    assert registers.select_pareto(zeros, ["a", "b"]) == ["a", "b"]
    many = spark.createDataFrame([tuple([1000.0] + [1e-9] * 11)], ", ".join(f"c{i} double" for i in range(12)))
    assert len(registers.select_pareto(many, many.columns)) == 8


@pytest.mark.parametrize(
    "values, p, expected",
    [([1, 2, 3, 4], 0.5, 2.5), ([5], 0.9, 5.0), ([0, -1000.5, 1e9, 3], 0.25, -250.125), ([1.0, 1.0001, 1.0002], 0.5, 1.0001)],
)
def test_exact_quantiles(spark, values, p, expected):
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("g", None), (None, 2.0)], "k string, v double")
    got = {r["k"]: r["q"] for r in exact_quantiles(df, ["k"], "v", {"q": p}).collect()}
    assert got == {"g": pytest.approx(expected), None: 2.0}


def test_exact_quantiles_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1e-3, 3000), rng.lognormal(5, 3, 3000), np.full(3000, 7.0)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    row = exact_quantiles(df, [], "v", {"a": 0.1, "b": 0.5, "c": 0.999}, with_stats=True).first()
    assert list(row)[:3] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.999]).tolist(), rel=1e-12)
    assert (row["n_values"], row["min_value"]) == (9000, values.min())


def test_knees(spark):
    curves = {
        "bend": [100, 40, 12, 10, 9, 8, 7, 6],
        "line": [80, 70, 60, 50, 40, 30, 20, 10],
        "flat": [5] * 8,
    }
    rows = [(g, i + 2, float(y)) for g, ys in curves.items() for i, y in enumerate(ys)]
    got = {r["g"]: r["knee"] for r in knee.knee_point(spark.createDataFrame(rows, "g string, x int, y double"), ["g"]).collect()}
    assert got == {"bend": 4, "line": 1, "flat": 1}


def test_knee_shapes_mirror(spark):
    falling = [100, 40, 12, 10, 9, 8, 7, 6]
    shapes = {
        ("convex", "decreasing"): falling,
        ("concave", "increasing"): [106 - y for y in falling],
        ("convex", "increasing"): falling[::-1],
        ("concave", "decreasing"): [106 - y for y in falling[::-1]],
    }
    for (curve, direction), ys in shapes.items():
        df = spark.createDataFrame([(i, float(y)) for i, y in enumerate(ys)], "x int, y double")
        knee_x = knee.knee_point(df, [], curve=curve, direction=direction).first()["knee"]
        assert knee_x == (2 if ys[:2] in ([100, 40], [6, 66]) else 5), (curve, direction)


def test_bic_rules(spark):
    curves = {"dip": [90, 50, 20, 25, 30, 35], "fall": [90, 40, 12, 10, 9, 8], "end": [10, 20, 30, 40, 50, 60]}
    rows = [(g, i + 1, float(y)) for g, ys in curves.items() for i, y in enumerate(ys)]
    got = {r["g"]: r for r in knee.bic_choice(spark.createDataFrame(rows, "g string, k int, bic double"), ["g"]).collect()}
    assert got["dip"]["first_minimum"] == 3
    assert got["fall"]["first_minimum"] is None and got["fall"]["chosen_k"] == got["fall"]["knee"] == 3
    assert got["end"]["first_minimum"] is None


def test_last_mode_wins_and_rows_stay(spark):
    columns = "FAB string, DESIGN_ID string, LOT_ID string, WAFER_ID string, lot_wafer string, DieX int, DieY int"
    at = ("15", "Z", "L", "W", "L_W")
    dies = spark.createDataFrame(
        [(*at, 1, 1, 0, 0, "c1"), (*at, 2, 1, 1, 0, "c1"), (*at, 3, 1, 1, 1, "c1")], columns + ", m1 int, m2 int, kmeans string"
    )
    labelled, rest = labelling.split_labelled(dies, ["m1", "m2"])
    merged = outputs.merge_labelled(rest, ["kmeans"], labelled, ["m1", "m2"])
    assert {(r["DieX"], r["kmeans"]) for r in merged.collect()} == {(1, "c1"), (2, "m1"), (3, "m2")}
    assert labelling.split_labelled(dies, [])[0] is None


def test_long_lot_lists_and_short_lots(spark):
    columns = [f"{c} string" for c in spec.CONTEXT_COLUMNS]
    rows = [tuple([lot if c == "LOT_ID" else c for c in spec.CONTEXT_COLUMNS]) for lot in ("ABCDEFGH", "ABCDEFG", "ABC", "ABCD")]
    df = spark.createDataFrame(rows, ", ".join(columns))
    short = tables.scan_by_lot(df, ["ABCDEFGHI", "ABC"], [])
    assert sorted(r["LOT_ID"] for r in short.collect()) == ["ABC", "ABCDEFG", "ABCDEFGH"]
    many = tables.scan_by_lot(df, ["ABCDEFGHI", "ABC", *[f"Z{i}" for i in range(300)]], [])
    assert sorted(r["LOT_ID"] for r in many.collect()) == ["ABC", "ABCDEFG", "ABCDEFGH"]


def test_outputs_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "DieX int, Cluster string")
    sinks.write_json(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().asDict() == {"cluster": "a", "diex": 1}
    with pytest.raises(ValueError):
        sinks.output_modes("xml")
    with pytest.raises(ValueError):
        sinks.output_modes(["csv"])
    assert sinks.output_modes(["csv", "dataframe"], "/x") == {"csv", "dataframe"}


def test_text_of_no_finite_number_is_null(spark):
    df = spark.createDataFrame([("NaN",), ("1",), ("2",), ("Infinity",), ("x",)], "v string")
    found = exact_quantiles(clean.to_numbers(df, ["v"]), [], "v", {"median": 0.5}, with_stats=True).first()
    assert (found["n_values"], found["median"], found["max_value"]) == (2, 1.5, 2.0)


def test_full_map_keeps_unreadable_positions(spark):
    rows = [("F", "D", None, 1, "m", "c", "i", 5.0), ("F", "D", 2, 1, "m", "c", "i", 6.0)]
    names = "FAB string, DESIGN_ID string, DieX int, DieY int, model string, cluster string, stacked_item string, v double"
    found = stacked.full_die_map(spark.createDataFrame(rows, names)).collect()
    assert sorted((r["DieX"] is None, r["v"]) for r in found) == [(False, 6.0), (True, 5.0)]


def test_outlier_rule_scans_the_dies_once(spark):
    items = ["a", "b", "c", "d"]
    rows = [(f"w{i % 5}", *(float(i * j % 7) for j in range(1, 5))) for i in range(50)]
    plan = transform.label_wafer_outliers(spark.createDataFrame(rows, ["lot_wafer", *items]), items)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2


def test_narrow_ranges_are_cut_until_few_values_are_left(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.uniform(0, 1e-4, 40_000), rng.uniform(1.2, 1.2005, 40_001), -rng.uniform(3, 3.0001, 9000)])
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "v": values})).repartition(4)
    found = exact_quantiles(df, ["g"], "v", {"a": 0.02, "b": 0.3, "c": 0.5, "d": 0.9}).first()
    assert list(found)[1:] == pytest.approx(list(np.quantile(values, [0.02, 0.3, 0.5, 0.9])), rel=1e-12)
    counts = quantiles.value_counts(df, ["g"], "v").withColumn("_cell", quantiles._cell(F.col("_v")))
    few = quantiles.cells_with_ranks(counts, [F.floor(F.lit(p) * F.col("_total")) for p in (0.02, 0.3, 0.5, 0.9)])
    met = counts.join(few, ["_k", "_cell"]).where("_v between _lo and _hi").groupBy("_cell", "_lo").count()
    sizes = [r["count"] for r in met.collect()]
    assert len(sizes) == 4 and max(sizes) <= quantiles.FEW  # of up to 40,001 values within 0.04 %


def test_groups_of_nulls_keep_their_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("b", float("nan"))], "g string, v double")
    found = quantiles.quantiles_of_counts(quantiles.value_counts(df, ["g"], "v"), {"m": 0.5}, with_stats=True)
    rows = {r["_k"]["g"]: tuple(r)[1:] for r in found.collect()}
    assert rows == {"a": (1.0, 1, 1.0, 1.0, 1.0), "b": (None, 0, None, None, None)}


def test_stacked_map_keeps_items_without_values(spark, tmp_path, monkeypatch):
    rows = [("F", "D", 0, 0, "c1", "w1", 1.0, None), ("F", "D", 0, 0, "c1", "w2", 3.0, None), ("F", "D", 1, 0, "c1", "w1", None, None), ("F", "D", 0, 0, "c2", "w1", 5.0, 2.0)]
    schema = "FAB string, DESIGN_ID string, DieX int, DieY int, cluster string, lot_wafer string, p double, r double, TOTAL_DIE int"
    df = spark.createDataFrame([(*r, 10) for r in rows], schema)
    stack = stacked.Stack.of(["r"], "p", "probe")
    monkeypatch.setattr(stacked, "hold", lambda counts: written(counts, str(tmp_path)))
    got = stacked.stacked_map(df, "cluster", stack, stacked.die_totals(df))
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()  # unpivoted and counted once, before
    assert len(list(tmp_path.iterdir())) == 1
    found = {(r["DieX"], r["cluster"], r["stacked_item"]): (r["num_dies_in_cluster"], r["median_value"], r["die_max_value"]) for r in got.collect()}
    assert found == {
        (0, "c1", "probe"): (2, 2.0, 3.0), (1, "c1", "probe"): (2, None, 3.0), (0, "c2", "probe"): (1, 5.0, 5.0),
        (0, "c1", "r"): (0, None, None), (1, "c1", "r"): (0, None, None), (0, "c2", "r"): (1, 2.0, 2.0),
    }


def test_strict_rule_takes_a_probe_bin_along(spark):
    df = spark.createDataFrame([(5.0, 3.0, "A:O")], "p double, r double, BIN_BIT string")
    bins = spec.resolve_spec("B1", "V", ["p"], bin_step="Fail_bin")
    assert registers.select_pareto(df, ["r", "p"], registers.STRICT_PARETO, bins) == ["p", "r", "BIN_BIT"]
    assert registers.select_pareto(df, ["r", "p"], registers.ParetoRule(), bins) == ["p", "r"]
    marked = spec.resolve_spec("B1", "V:V", ["p"], bin_step="Fail_bin")
    assert registers.select_pareto(df, ["r", "p"], registers.STRICT_PARETO, marked) == ["p", "r"]


def test_rows_are_appended_to_a_catalog_table(spark, tmp_path):
    spark.sql(f"create table appended (a int, b string) using parquet location '{tmp_path / 'appended'}'")
    try:
        df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
        sinks.append_rows(df, "appended")
        sinks.append_rows(df.where("a = 2"), "appended")
        assert sorted(r["a"] for r in spark.table("appended").collect()) == [1, 2, 2]
    finally:
        spark.sql("drop table appended")


def test_a_stray_die_grows_the_grids_of_its_design_only(spark):
    rows = [("F", "D1", "L", "W", 0, 0, 1.0), ("F", "D1", "L", "W", 1, 1, 2.0), ("F", "D2", "L", "W", 0, 0, 3.0), ("F", "D2", "L", "W", 50, 9, 4.0), (None, None, "L", "V", 3, 3, 5.0)]
    df = spark.createDataFrame(rows, "FAB string, DESIGN_ID string, LOT_ID string, WAFER_ID string, DieX int, DieY int, v double")
    grids = wafers.wafer_grid(df, "v", ["v"], ["FAB", "DESIGN_ID"])
    sizes = {r["DESIGN_ID"]: (r["count"], r["s"]) for r in grids.groupBy("DESIGN_ID").agg(F.count("*").alias("count"), F.sum("value").alias("s")).collect()}
    assert sizes == {"D1": (4, 3.0), "D2": (510, 7.0), None: (1, 5.0)}
