"""Properties of the model-backed operators on planted data."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dielens.operators import choose_k, clusters, labelling, level2, samples, sweeps, transform, wafers
from dielens.plans import end_to_end
from dielens.plans.dies import die_spec, die_table
from dielens.plans.hold import exists
from dielens.plans.stages import Stages
from tests.conftest import SF_SMALL

CENTRES = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [10.0, 12.0]])


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, *[float(v) for v in CENTRES[i] + rng.normal(0, 0.5, 2)]) for i in range(4) for _ in range(300)
    ]
    return spark.createDataFrame(rows, "truth int, a double, b double").repartition(5).persist()


def agrees(df, label):
    """Each planted blob has one label and each label one blob."""
    pairs = df.select("truth", label).distinct().collect()
    return len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


@pytest.mark.parametrize("method, first", [("kmeans", 1), ("gmm", 1), ("bisecting_kmeans", 0)])
def test_labels(blobs, method, first):
    out = clusters.cluster(blobs, method, 4, ["a", "b"], "label")
    assert agrees(out, "label")
    assert {r[0] for r in out.select("label").distinct().collect()} == set(range(first, first + 4))
    assert out.count() == blobs.count()


def test_single_cluster_and_unknown_method(blobs):
    assert clusters.cluster(blobs, "kmeans", 1, ["a"], "l").select("l").distinct().collect() == [(1,)]
    with pytest.raises(ValueError):
        clusters.cluster(blobs, "dbscan", 2, ["a"], "l")


def test_elbow_and_costs(blobs):
    curve = choose_k.elbow_curves(blobs, ["a", "b"], range(1, 9)).orderBy("k").collect()
    one = choose_k.one_cluster_costs(blobs, ["a", "b"]).first()
    assert curve[0]["inertia"] == pytest.approx(one["inertia"]) and curve[0]["distortion"] == pytest.approx(one["distortion"])
    points = np.array([[r["a"], r["b"]] for r in blobs.collect()])
    truth = sum(((points[[r["truth"] == t for r in blobs.collect()]] - points[[r["truth"] == t for r in blobs.collect()]].mean(0)) ** 2).sum() for t in range(4))
    assert curve[3]["inertia"] == pytest.approx(truth, rel=1e-6)
    sweep = choose_k.kmeans_cost_sweep(blobs, ["a", "b"], range(2, 9))
    assert choose_k.elbow_k(sweep) == 4


def test_mixture_choice(blobs):
    curve = choose_k.gmm_bic_sweep(blobs, ["a", "b"], range(1, 8))
    rows = {r["k"]: r["bic"] for r in curve.collect()}
    assert min(rows, key=rows.get) == 4 and choose_k.bic_k(curve) == 4
    x = np.array([[r["a"], r["b"]] for r in blobs.collect()])
    cov = np.cov(x.T, bias=True) + 1e-6 * np.eye(2)
    likelihood = -len(x) / 2 * (2 * math.log(2 * math.pi) + math.log(np.linalg.det(cov)) + 2)
    assert rows[1] == pytest.approx(choose_k.mixture_bic(likelihood, 1, 2, len(x)), rel=1e-6)
    few = choose_k.gmm_bic_sweep(blobs.limit(9), ["a", "b"])
    assert few.count() == 0 and choose_k.bic_k(few) == 1


@pytest.mark.parametrize("method", ["kmeans", "gmm"])
def test_silhouettes(blobs, method):
    curve = choose_k.silhouette_sweep(blobs, ["a", "b"], range(2, 7), method)
    best = max(curve.collect(), key=lambda r: r["silhouette"])
    assert best["k"] == 4 and best["silhouette"] > 0.9
    assert choose_k.silhouette_k(curve) == 4


def test_sweep_is_repeatable_and_many_groups_share_it(blobs):
    points = sweeps.grouped_points(blobs, (F.col("truth") > 1).cast("int"), F.array("a", "b"))
    sizes = sweeps.group_sizes(points)
    assert sizes == {0: 600, 1: 600}
    fits = sweeps.mixture_sweep(points, [(0, 2), (1, 2), (1, 1)], sizes)
    assert all(f.converged for f in fits)
    found = sorted(tuple(np.round(m).astype(int)) for f in fits[:2] for m in f.means)
    assert found == sorted(tuple(c.astype(int)) for c in CENTRES)
    label = sweeps.mixture_label({0: fits[0], 1: fits[1]}, (F.col("truth") > 1).cast("int"), F.array("a", "b"))
    out = blobs.withColumn("label", F.concat((F.col("truth") > 1).cast("string"), label.cast("string")))
    assert agrees(out, "label")


def test_components(blobs):
    out, found = transform.pca_scores(blobs, ["a", "b"])
    assert sum(found.shares) == pytest.approx(1.0)
    row = out.agg(F.corr("PC1", "PC2"), F.avg("PC1"), F.var_samp("PC1"), F.var_samp("PC2")).first()
    assert abs(row[0]) < 1e-9 and abs(row[1]) < 1e-9 and row[2] > row[3]
    white, kept = transform.pca_by_share(blobs, ["a", "b"], 0.999)
    assert len(kept.columns) == 2
    assert list(white.agg(F.var_samp("PC1"), F.var_samp("PC2")).first()) == pytest.approx([1.0, 1.0])


def test_representatives(blobs):
    _, model = clusters.fit_and_label(blobs, ["a", "b"], "gmm", 4, "label")
    means, covariances = clusters.mixture_parts(model)
    rows = clusters.component_representatives(blobs, ["a", "b"], means, [*covariances[:3], np.zeros((2, 2))]).collect()
    for r, mean in zip(rows[:3], means):
        assert np.hypot(r["a"] - mean[0], r["b"] - mean[1]) < 0.3
    assert (rows[3]["a"], rows[3]["b"]) == (0.0, 0.0)


def test_constant_columns_leave_no_noise(spark):
    df = spark.range(4900).select(F.lit(7.1).alias("c"), (F.col("id") % 10).cast("double").alias("v"), F.lit("g").alias("g")).repartition(7)
    scaled = transform.standard_scale(df, ["c"]).agg(F.min("c_norm"), F.max("c_norm")).first()
    assert tuple(scaled) == (0.0, 0.0)
    lines = {(r["x"], r["y"]): (r["slope"], r["r2"]) for r in level2.pairwise_regression(df, "g", ["c", "v"]).collect()}
    assert lines == {("c", "v"): (None, None)}
    slopes = level2.slope_signature(df, "g", ["c", "v"]).collect()
    assert [r["penalised_slope"] for r in slopes] == [0.0]


def test_split_nests_and_merge_keeps_rows(spark):
    rng = np.random.default_rng(0)
    rows = []
    for cluster, centres in ((1, (1.0, 60.0)), (2, (200.0,))):
        for c in centres:
            for i in range(1500):
                a = abs(rng.normal(c, c / 20))
                rows.append((cluster, f"L{i % 5}", f"W{i % 3}", i % 40, i % 30, float(a), float(abs(rng.normal(3 * a if c == 60.0 else 5, 0.5)))))
    df = spark.createDataFrame(rows, "level1 int, LOT_ID string, WAFER_ID string, DieX int, DieY int, a double, b double")
    split = level2.level2_split(df, "level1", ["a", "b"]).persist()
    assert split.count() == len(rows)
    names = {(r["level1"], r["Subgroup"]) for r in split.select("level1", "Subgroup").distinct().collect()}
    assert all(s.startswith(f"{c}-") for c, s in names)
    assert len([s for c, s in names if c == 1]) >= 2
    merged = level2.level2_merge(split, "level1", ["a", "b"], "merged")
    assert merged.count() == len(rows)
    per_group = merged.groupBy("Subgroup").agg(F.count_distinct("merged").alias("n"))
    assert {r["n"] for r in per_group.collect()} == {1}


def test_stored_models(spark, blobs, tmp_path):
    trained = labelling.train_mode(blobs, "right", ["a", "b"], F.col("a") > 5)
    trained.model.write().overwrite().save(str(tmp_path / "right"))
    catalog = [
        {"Failure_Mode": "right", "features": ["a", "b"], "model_path": str(tmp_path / "right")},
        {"Failure_Mode": "gone", "features": ["a"], "model_path": str(tmp_path / "gone")},
    ]
    models, unreadable = labelling.load_models(catalog)
    assert [m.mode for m in models] == ["right"] and list(unreadable) == ["gone"]
    lacking = labelling.StoredModel("lacking", ("zz",), models[0].model)
    scored = labelling.score_models(blobs, [*models, lacking])
    assert scored.modes == ("right",) and "zz" in scored.skipped["lacking"]
    wrong = scored.dies.where((F.col("a") > 5) != (F.col("right") == 1)).count()
    assert wrong == 0 and scored.dies.count() == blobs.count()


def test_sample_is_exact_repeatable_and_copy_safe(spark):
    rows = [("hot", 1.0)] * 4000 + [("hot", float(i)) for i in range(2, 2002)] + [("cold", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "c string, v double").repartition(6)
    first = samples.sample_per_cluster(df, "c", ["v"], 600)
    again = samples.sample_per_cluster(df.repartition(3), "c", ["v"], 600)
    assert sorted(first.collect()) == sorted(again.collect())
    sizes = {r["c"]: r["count"] for r in first.groupBy("c").count().collect()}
    assert sizes == {"hot": 600, "cold": 50}
    copies = first.where("c = 'hot' and v = 1.0").count()
    assert 320 < copies < 480  # two thirds of the cluster are copies
    over = first.groupBy("c", "v").count().join(df.groupBy("c", "v").agg(F.count("*").alias("have")), ["c", "v"])
    assert over.where("count > have").count() == 0


def test_whole_analysis(spark, tmp_path):
    spec = die_spec()
    raw = die_table(spark, SF_SMALL)
    settings = end_to_end.Settings(sweep_ks=range(2, 7), split_ks=range(1, 4), merge_ks=range(1, 6), mixture_iterations=15)
    dies = end_to_end.prepare(raw, spec, settings).dies
    mode = labelling.train_mode(dies, "HighQ", ["BITQ_V-t_ALL", "FBD_REGION"], F.col("`BITQ_V-t_ALL`") > 20)
    folder = str(tmp_path / "stages")
    broken = Stages(spark, folder, "job", settings)
    with pytest.raises(ZeroDivisionError):  # as if the driver had gone after the clustering
        broken.table("maps", lambda: 1 / 0)
    result = end_to_end.analyse(raw, spec, [mode], settings, first := Stages(spark, folder, "job", settings))
    assert first.computed == ["registers", "dies", "clustered", "maps"] and not first.reread
    assert result.failure_modes == ("HighQ",)
    labels = {r[0] for r in result.dies.select("gmm").distinct().collect()}
    assert "HighQ" in labels and all(v.startswith("cluster_") for v in labels - {"HighQ"})
    files = result.save("job", ["csv", "dataframe", "df_4_debug"], str(tmp_path))
    for key in ("cluster_signature_json", "wafer_association_json", "cluster_pareto_json", "scatter_sample_gmm_json"):
        assert spark.read.json(f"{tmp_path}/{files[key]}").count() > 0
    assert set(files) >= {"dataframe", "raw_data"}
    result.release()
    again = end_to_end.analyse(raw, spec, [mode], settings, second := Stages(spark, folder, "job", settings))
    assert second.reread == ["registers", "dies", "clustered", "maps"] and not second.computed
    assert again.stacked_map.count() > 0
    assert Stages(spark, folder, "job", end_to_end.Settings()).place != second.place
    second.release()
    assert not exists(spark, f"{second.place}/maps")
    spark.catalog.clearCache()


def test_requests():
    with pytest.raises(ValueError):
        end_to_end.requested(None, die_spec(), start="2020-01-01", end="2020-02-01")


def test_clusters_without_components(blobs):
    features = end_to_end._features(transform.standard_scale(blobs, ["a", "b"]), ["a", "b"], end_to_end.Settings(with_pca=False))
    assert features[1] == ["a_norm", "b_norm"]
    assert agrees(clusters.cluster(features[0], "kmeans", 4, features[1], "label"), "label")


def test_leading_components_are_those_of_pca(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(60, 4)) * [9, 5, 3, 1.5] @ rng.normal(size=(4, 40)) + rng.normal(0, 0.05, (60, 40)) + 50
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "grid array<double>").repartition(3)
    mean, axes = wafers.leading_components(df, 3)
    assert np.allclose(mean, rows.mean(0))
    values, vectors = np.linalg.eigh(np.cov(rows.T))
    for i in range(3):
        assert abs(axes[:, i] @ vectors[:, -1 - i]) == pytest.approx(1, abs=1e-9)


def test_leading_components_of_many_positions(spark):
    """40,000 positions: a dense matrix would take 12.8 GB."""
    axis = F.transform(F.sequence(F.lit(0), F.lit(39_999)), lambda i: F.sin(i / 900.0) * F.col("s") + F.cos(i * 7.0) * 0.01 * F.col("id"))
    df = spark.range(24).repartition(4).withColumn("s", F.sin("id") * 10).select(axis.alias("grid"))
    mean, axes = wafers.leading_components(df, 2)
    assert axes.shape == (40_000, 2)
    wave = np.sin(np.arange(40_000) / 900.0)
    assert abs(axes[:, 0] @ wave) / np.linalg.norm(wave) > 0.999


def test_seeds_meet_a_tiny_far_cluster(spark):
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(0, 1, (20_000, 2)), rng.normal(500, 0.1, (2, 2))])
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["a", "b"]))
    fits = []
    for parts in (2, 8):
        points = sweeps.grouped_points(frame.repartition(parts), F.lit(0), F.array("a", "b")).persist()
        fits.append(sweeps.kmeans_sweep(points, [(0, 2)], sweeps.group_sizes(points))[0])
        for seed in range(2, 21) if parts == 2 else ():
            fits.append(sweeps.kmeans_sweep(points, [(0, 2)], sweeps.group_sizes(points), seed)[0])
        points.unpersist()
    for fit in fits:
        assert max(fit.centres.sum(1)) > 990
    assert np.allclose(np.sort(fits[0].centres, axis=0), np.sort(fits[-1].centres, axis=0))


def test_bisecting_costs_of_planted_squares(spark):
    from dielens.operators.choose_k import bisecting_cost_sweep

    # two far pairs of near crosses: a pair costs 10 rows * 5^2, a cross 4 * 0.1^2
    cross = [(0.0, 0.0), (0.1, 0.0), (-0.1, 0.0), (0.0, 0.1), (0.0, -0.1)]
    rows = [(x + a, y + b) for x in (0.0, 10.0) for y in (0.0, 100.0) for a, b in cross]
    found = {r["k"]: r["cost"] for r in bisecting_cost_sweep(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], (2, 3, 4)).collect()}
    assert found == pytest.approx({2: 500.16, 3: 250.16, 4: 0.16}, rel=1e-6)
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    costs = bisecting_cost_sweep(same, ["a", "b"], (2, 3)).collect()
    assert [r["cost"] for r in costs] == pytest.approx([0.0, 0.0], abs=1e-9)


def test_sweep_costs_are_near_those_of_spark_ml(spark):
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.normal(rng.uniform(-30, 30, 3), rng.uniform(0.5, 3), (n, 3)) for n in (3000, 900, 300, 90, 30, 9)])
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["a", "b", "c"])).repartition(4).persist()
    ks = (2, 3, 5, 6, 8)
    ours = {r["k"]: r["cost"] for r in choose_k.kmeans_cost_sweep(frame, ["a", "b", "c"], ks).collect()}
    vectors = clusters.feature_frame(frame, ["a", "b", "c"])
    for k in ks:
        theirs = clusters.estimator("kmeans", k).fit(vectors).summary.trainingCost
        assert ours[k] <= 1.1 * theirs
    frame.unpersist()


def test_gram_of_many_columns_in_one_scan(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1.0, (400, 70))
    x[:, 3] = 7.0
    x[rng.random((400, 70)) < 0.05] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(70)]).assign(g=["a", "b"] * 200)
    df = spark.createDataFrame(frame).replace(float("nan"), None).repartition(5)
    lines = level2.pairwise_regression(df, "g", [f"c{i}" for i in range(70)])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Scan") == 1
    rows = lines.collect()
    assert len(rows) == 2 * 70 * 69 // 2
    assert [(r["x"], r["y"]) for r in sorted(rows, key=lambda r: r["pair"]) if r["g"] == "a"] == [(f"c{i}", f"c{j}") for i in range(70) for j in range(i + 1, 70)]
    for r in rows[::37]:
        u, v = (frame.loc[frame["g"] == r["g"], r[c]].to_numpy() for c in "xy")
        both = ~np.isnan(u) & ~np.isnan(v)
        u, v = u[both], v[both]
        if r["x"] == "c3":
            assert r["slope"] is None and r["r2"] is None
        elif r["y"] == "c3":
            assert r["slope"] == 0 and r["r2"] == 1
        else:
            cov = np.cov(u, v)
            assert r["slope"] == pytest.approx(cov[0, 1] / cov[0, 0], abs=1e-9)
            assert r["r2"] == pytest.approx(cov[0, 1] ** 2 / cov[0, 0] / cov[1, 1], abs=1e-9)
    found = {(r["column_a"], r["column_b"]): r["covariance"] for r in transform.covariance_matrix(df, ["c0", "c1", "c3"]).collect()}
    want = frame[["c0", "c1", "c3"]].cov()
    assert found == {k: pytest.approx(want.loc[k], abs=1e-9) for k in found} and len(found) == 6


def test_sweeps_read_blocks_of_all_rows(spark):
    rows = [(i % 3, [float(i), float(i * i % 7)]) for i in range(500)] + [(1, [3.0, 4.0])] * 5
    points = spark.createDataFrame(rows, "g int, x array<double>").repartition(4)
    points = sweeps.grouped_points(points, F.col("g"), F.col("x"))
    with sweeps._packed(points) as blocks:
        assert blocks.columns == [sweeps.GROUP, "_width", "_rows"] and blocks.count() < 100
        fold = lambda group, values: iter([(group, np.append(values.sum(0), len(values)))])
        plain, packed = sweeps._add_up(points, fold), sweeps._add_up(blocks, fold)
    assert {g: v.tolist() for g, v in plain.items()} == {g: v.tolist() for g, v in packed.items()}
    assert sum(v[-1] for v in packed.values()) == 505
    empty = sweeps.grouped_points(spark.createDataFrame([], "g int, x array<double>"), F.col("g"), F.col("x"))
    with sweeps._packed(empty) as blocks:
        assert blocks.isEmpty()


def test_mixture_takes_the_steps_of_spark_ml(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 4, (3, 2))
    rows = [tuple(map(float, rng.normal(centres[i % 3], 1 + i % 3))) for i in range(3000)]
    df = spark.createDataFrame([*rows, (90.0, 80.0), (-70.0, 99.0)], "a double, b double").repartition(5).cache()
    vectors = clusters.feature_frame(df, ["a", "b"])
    for k, most in ((3, 40), (4, 1)):
        model = clusters.estimator("gmm", k, 1, most).fit(vectors.select(clusters.VECTOR))
        labelled, mine = clusters.fit_and_label(df, ["a", "b"], "gmm", k, "label", 1, most)
        for wanted, found in zip((*clusters.mixture_parts(model), model.weights), (mine.means, mine.covariances, mine.weights)):
            assert np.allclose(wanted, found, rtol=1e-6)
        theirs = model.transform(vectors).select("a", "b", (F.col("_prediction") + 1).alias("label"))
        assert sorted(map(tuple, labelled.collect())) == sorted(map(tuple, theirs.collect()))


def test_blocks_of_rows_add_up_to_single_rows():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(size=(2500, 3)), np.zeros((10, 3))])
    models = [np.array([[1.0, 0, 0], [-1.0, 0, 0], [-1.0, 0, 0]]), rng.normal(size=(5, 3)), np.zeros((1, 3))]
    for found, centres in zip(sweeps._cluster_sums(rows, models), models):
        assert np.allclose(found, sweeps._labelled_sums(rows, centres))
    rows[7, 1] = np.nan
    for found, centres in zip(sweeps._cluster_sums(rows, models), models):
        assert np.array_equal(found, sweeps._labelled_sums(rows, centres), equal_nan=True)


def test_only_the_best_rows_of_a_draw_are_put_in_order():
    rng = np.random.default_rng(2)
    for rows in (rng.normal(size=(4000, 2)), rng.integers(0, 6, (4000, 2)) + 0.5, np.ones((50, 2))):
        found, keys = sweeps._drawn(rows, rows[:3], 10, 4)
        every, all_keys = sweeps._drawn(np.unique(rows, axis=0), rows[:3], len(rows), 4)
        best = lambda r, k: r[np.argsort(-k, kind="stable")[:10]].tolist()
        assert best(found, keys) == best(every, all_keys)


def test_a_step_of_a_sweep_is_one_job_of_a_task_for_each_core(spark):
    rng = np.random.default_rng(4)
    frame = spark.createDataFrame(pd.DataFrame(rng.normal(size=(4000, 2)), columns=["a", "b"])).repartition(3)
    points = sweeps.grouped_points(frame, F.lit(0), F.array("a", "b"))
    spark.conf.set("spark.sql.shuffle.partitions", 3 * spark.sparkContext.defaultParallelism)
    try:
        with sweeps.held_blocks(points) as blocks:
            sizes = sweeps.group_sizes(blocks)
            assert sizes == {0: 4000} and blocks.getNumPartitions() == spark.sparkContext.defaultParallelism
            spark.sparkContext.setJobGroup("sweep", "one job for each step")
            fit = sweeps.kmeans_sweep(blocks, [(0, 1)], sizes)[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # five draws, their counts, two steps at most and the costs
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("sweep")) <= 9
    values = np.array([tuple(r) for r in frame.collect()])
    assert np.allclose(fit.centres[0], values.mean(0)) and fit.cost == pytest.approx(((values - values.mean(0)) ** 2).sum())


def test_powers_and_labels_of_a_mixture():
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(2500, 3))
    powers = sweeps._powers(rows)
    above = np.triu_indices(3)
    assert np.array_equal(powers, np.concatenate([np.ones((1, 2500)), rows.T, (rows[:, above[0]] * rows[:, above[1]]).T]))
    assert np.allclose(sweeps._second_moments(powers[4:].sum(1)[None], 3)[0], rows.T @ rows)
    parts = [np.cov(rng.normal(size=(50, 3)).T) for _ in range(4)]
    fit = sweeps.MixtureFit(0, 4, np.array([0.1, 0.2, 0.3, 0.4]), rng.normal(size=(4, 3)), np.stack(parts))
    gaps = rows[:, None] - fit.means[None]
    squared = np.einsum("nki,kij,nkj->nk", gaps, np.linalg.inv(fit.covariances), gaps)
    wanted = np.log(fit.weights) - 0.5 * (squared + np.linalg.slogdet(fit.covariances)[1])
    assert np.array_equal(fit.labels(rows), wanted.argmax(1)) and len(fit.labels(rows[:0])) == 0


def test_silhouettes_of_all_k_share_two_scans(spark, monkeypatch):
    from pyspark.ml.evaluation import ClusteringEvaluator

    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(0, 1, (3000, 2)), rng.normal(6, 2, (1500, 2)), [[400.0, 400.0]]])
    frame = spark.createDataFrame(pd.DataFrame(values, columns=["a", "b"])).repartition(3).persist()
    scans = []
    real = sweeps._add_up
    monkeypatch.setattr(sweeps, "_add_up", lambda points, fold: scans.append(fold.__qualname__) or real(points, fold))
    curve = {r["k"]: r["silhouette"] for r in choose_k.silhouette_sweep(frame, ["a", "b"], (2, 3, 5)).collect()}
    assert sum("silhouettes" in name for name in scans) == 2
    points = sweeps.grouped_points(frame, F.lit(0), F.array("a", "b"))
    vectors = clusters.feature_frame(frame, ["a", "b"]).collect()
    for fit in sweeps.kmeans_sweep(points, [(0, k) for k in (2, 3, 5)], {0: len(values)}, clusters.SEED):
        label = sweeps.centre_labels([fit.centres])(np.array([r[clusters.VECTOR].toArray() for r in vectors]))[0]
        rows = [(r[clusters.VECTOR], float(found)) for r, found in zip(vectors, label)]
        labelled = spark.createDataFrame(rows, [clusters.VECTOR, "_prediction"])
        wanted = ClusteringEvaluator(featuresCol=clusters.VECTOR, predictionCol="_prediction").evaluate(labelled)
        assert curve[fit.k] == pytest.approx(wanted, abs=1e-9)
    frame.unpersist()
    single = sweeps.silhouettes(points, [2], lambda rows: [np.zeros(len(rows), dtype=int)])
    assert single == [None]


def test_bisecting_sweep_keeps_one_copy_of_the_points(spark, monkeypatch):
    from pyspark import RDD

    rng = np.random.default_rng(9)
    frame = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (3000, 2)), columns=["a", "b"])).repartition(3)
    kept, of_rdd, of_frame = [], RDD.persist, type(frame).persist
    monkeypatch.setattr(RDD, "persist", lambda self, *a: kept.append(self) or of_rdd(self, *a))
    monkeypatch.setattr(type(frame), "persist", lambda self, *a: kept.append(self) or of_frame(self, *a))
    costs = [r["cost"] for r in choose_k.bisecting_cost_sweep(frame, ["a", "b"], range(2, 9)).collect()]
    assert len(kept) == 1 and costs == sorted(costs, reverse=True) and len(set(costs)) == 7


def test_bisecting_takes_the_steps_of_spark_ml(spark, monkeypatch):
    rng = np.random.default_rng(10)
    centres = rng.normal(10, 6, (7, 3))
    values = np.concatenate([rng.normal(c, 1.0, (200 + 60 * i, 3)) for i, c in enumerate(centres)])
    frame = spark.createDataFrame(pd.DataFrame(values, columns=["a", "b", "c"])).repartition(5).cache()
    vectors = clusters.feature_frame(frame, ["a", "b", "c"]).cache()
    wanted = {}
    for k in (2, 3, 6):
        model = clusters.estimator("bisecting_kmeans", k).fit(vectors.select(clusters.VECTOR))
        rows = model.transform(vectors).select("a", "b", "c", F.col("_prediction").alias("label"))
        wanted[k] = sorted(map(tuple, rows.collect()))
    steps, fit = [], clusters.BisectingKMeans.fit
    monkeypatch.setattr(clusters.BisectingKMeans, "fit", lambda self, df: steps.append(self.getMaxIter()) or fit(self, df))
    for k, theirs in wanted.items():
        labelled, _ = clusters.fit_and_label(frame, ["a", "b", "c"], "bisecting_kmeans", k, "label")
        assert sorted(map(tuple, labelled.collect())) == theirs
    assert steps == [1, 1, 1]  # Spark ML, with an object for each row, takes the first step only
    even = spark.createDataFrame([(x, y) for x in (-1.0, 1.0) for y in (-5.0, 5.0)], "a double, b double")
    evened = clusters.feature_frame(even, ["a", "b"])  # a mean of 0 is moved nowhere: Spark ML divides nothing
    assert len(clusters.estimator("bisecting_kmeans", 3).fit(evened).clusterCenters()) == 1
    assert {r["l"] for r in clusters.cluster(even, "bisecting_kmeans", 3, ["a", "b"], "l").collect()} == {0}
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    assert {r["l"] for r in clusters.cluster(same, "bisecting_kmeans", 3, ["a", "b"], "l").collect()} == {0}
    frame.unpersist(), vectors.unpersist()
