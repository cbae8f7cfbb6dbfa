import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadwright.models import classify, ols

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_ols_matches_numpy_and_residuals_are_orthogonal(spark, lineitem):
    fit = ols.ols_fit(lineitem, "l_extendedprice", ["l_quantity", "l_discount"])
    pdf = lineitem.select("l_extendedprice", "l_quantity", "l_discount").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.l_quantity, pdf.l_discount])
    beta, *_ = np.linalg.lstsq(X, pdf.l_extendedprice.to_numpy(), rcond=None)
    got = np.array([fit.intercept] + fit.coefficients)
    assert np.allclose(got, beta, rtol=1e-9, atol=1e-6)
    pred = ols.ols_predict(fit, lineitem)
    resid = pred.select((F.col("l_extendedprice") - F.col("prediction")).alias("r"), "l_quantity", "l_discount")
    sums = resid.agg(F.sum("r"), F.sum(F.col("r") * F.col("l_quantity")), F.sum(F.col("r") * F.col("l_discount"))).first()
    scale = pdf.l_extendedprice.abs().sum() * 50
    assert all(abs(v) / scale < 1e-9 for v in sums)


def test_ols_summary_and_stats(spark, lineitem):
    fit = ols.ols_fit(lineitem, "l_extendedprice", ["l_quantity", "l_discount"])
    rows = ols.ols_summary_rows(fit)
    assert [r["term"] for r in rows] == ["const", "l_quantity", "l_discount"]
    pdf = lineitem.select("l_extendedprice", "l_quantity", "l_discount").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.l_quantity, pdf.l_discount])
    y = pdf.l_extendedprice.to_numpy()
    beta = np.linalg.solve(X.T @ X, X.T @ y)
    resid = y - X @ beta
    s2 = resid @ resid / (len(y) - 3)
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * s2)
    for r, b, e in zip(rows, beta, se):
        assert math.isclose(r["std_err"], e, rel_tol=1e-7)
        assert math.isclose(r["t_value"], b / e, rel_tol=1e-7)
        # large residual degrees of freedom: the t law is close to the normal law
        assert abs(r["p_value"] - math.erfc(abs(r["t_value"]) / math.sqrt(2))) < 2e-3
    st = ols.ols_fit_stats(fit)
    assert st["n"] == len(y) and st["df_resid"] == len(y) - 3
    assert math.isclose(st["r2"], 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean())), rel_tol=1e-9)


def test_regression_line_grid(spark, lineitem):
    line = ols.regression_line(lineitem, "l_extendedprice", "l_quantity", steps=10).orderBy("step").collect()
    assert len(line) == 11 and line[0].x == 1.0 or line[0].x >= 0
    assert all(r.se_fit > 0 for r in line)
    mid = min(line, key=lambda r: r.se_fit)         # narrowest near the mean of x
    assert line[0].se_fit > mid.se_fit and line[-1].se_fit > mid.se_fit


def _iris_like(spark):
    rng = np.random.default_rng(0)
    rows = []
    for cls, centre in enumerate([(1.0, 1.0, 0.2, 0.1), (5.0, 3.0, 4.0, 1.3), (6.5, 3.0, 5.5, 2.0)]):
        for i in range(50):
            v = rng.normal(centre, 0.15)
            rows.append((cls * 50 + i, *map(float, v), ["setosa", "versicolor", "virginica"][cls]))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, species string")


def test_logit_separates_classes_with_weak_penalty(spark):
    from pyspark.ml.feature import StringIndexer

    df = StringIndexer(inputCol="species", outputCol="y").fit(_iris_like(spark)).transform(_iris_like(spark))
    model = classify.logit_fit(df, "y", ["a", "b", "c", "d"])
    assert math.isclose(model.getRegParam(), 1 / (1e5 * 150))
    pred = classify.logit_predict(model, df, ["a", "b", "c", "d"], keep=["id", "y"])
    assert pred.where(F.col("y") != F.col("prediction")).count() == 0


def test_forest_tree_nodes_invariants(spark, tmp_path):
    from pyspark.ml.feature import StringIndexer

    df = StringIndexer(inputCol="species", outputCol="y").fit(_iris_like(spark)).transform(_iris_like(spark))
    model = classify.forest_fit(df, "y", ["a", "b", "c", "d"], seed=3)
    assert model.getNumTrees == 10
    nodes = classify.tree_nodes(spark, model, 5, ["a", "b", "c", "d"], ["setosa", "versicolor", "virginica"],
                                path=str(tmp_path / "m")).collect()
    by_id = {n.node_id: n for n in nodes}
    for n in nodes:
        counts = np.array(n.value)
        assert math.isclose(n.gini, 1 - ((counts / counts.sum()) ** 2).sum(), abs_tol=1e-9)
        assert n.samples > 0
        if n.left >= 0:
            l, r = by_id[n.left], by_id[n.right]
            assert np.allclose(np.array(l.value) + np.array(r.value), counts)
            assert n.feature in {"a", "b", "c", "d"} and n.threshold is not None
        else:
            assert n.feature is None and n.right == -1
    again = classify.tree_nodes(spark, classify.forest_fit(df, "y", ["a", "b", "c", "d"], seed=3), 5,
                                path=str(tmp_path / "m2")).collect()
    assert [(n.node_id, n.threshold, n.samples) for n in sorted(nodes)] == \
        [(n.node_id, n.threshold, n.samples) for n in sorted(again)]


def test_regression_points_sample(spark, lineitem):
    pts = ols.regression_points(lineitem, "l_extendedprice", "l_quantity", fraction=0.5, seed=1)
    n, total = pts.count(), lineitem.count()
    assert 0.35 * total < n < 0.65 * total and pts.columns == ["x", "y"]


def test_student_t_against_known_values(spark):
    """Closed forms for 1, 2 and 4 degrees of freedom; the quantile is the inverse."""
    from loadwright.functions import student

    closed = {1: lambda t: 1 - 2 * math.atan(t) / math.pi, 2: lambda t: 1 - t / math.sqrt(2 + t * t),
              4: lambda t: 1 - t / math.sqrt(4 + t * t) * (1 + 2 / (4 + t * t))}
    rows = [(float(t), d) for t in (0.0, 0.1, 1.0, -1.7, 2.5, 12.0, 1e4) for d in closed] + [(None, 3)]
    got = spark.createDataFrame(rows, "t double, df int").select("t", "df", student.two_sided_p(F.col("t"), F.col("df")).alias("p")).collect()
    for r in got:
        assert r.p is None if r.t is None else abs(r.p - closed[r.df](abs(r.t))) < 1e-12
    for p, known in ((0.975, {1: 12.706204736, 5: 2.570581836, 30: 2.042272456, 1000: 1.962339081}), (0.95, {3: 2.353363435, 60_000: 1.644879})):
        found = spark.createDataFrame([(d,) for d in known], "df int").select("df", student.quantile(p, F.col("df")).alias("q")).collect()
        assert all(math.isclose(r.q, known[r.df], rel_tol=1e-6) for r in found)
    with pytest.raises(ValueError):
        student.quantile(0.3, F.lit(3))


def test_forest_scored_from_its_nodes_equals_spark_tree_by_tree(spark):
    df = _iris_like(spark)
    xs = ["a", "b", "c", "d"]
    model = classify.forest_fit(df, "species", xs, seed=5)
    rows = classify.assemble(df, xs)
    nodes = classify.forest_nodes(spark, model)
    from pyspark.ml.functions import vector_to_array

    values = rows.withColumn("f", vector_to_array(classify.FEATURES))
    got = {r.id: r for r in classify.forest_score(nodes, values, "f", model.classes).collect()}
    own = {r.id: r.prediction for r in classify.logit_predict(model, df, xs, keep=["id"]).collect()}
    assert len(got) == 150 and all(got[i].prediction == own[i] for i in own)
    for k in (0, 7):
        tree = {r.id: int(r.prediction) for r in model.trees[k].transform(rows).select("id", "prediction").collect()}
        assert all(got[i].tree_classes[k] == tree[i] for i in tree)
    assert {r.check_name: r.n_bad for r in classify.node_checks(nodes).collect()} == {"children": 0, "gini": 0, "links": 0, "parents": 0}
    broken = nodes.withColumn("left", F.when(F.col("node_id") == 0, F.lit(-1)).otherwise(F.col("left")))
    assert sum(r.n_bad for r in classify.node_checks(broken).collect()) > 0


def test_forest_keeps_node_ids_and_is_the_forest_without_them(spark):
    """No pass sends the trees grown so far with it; every node is as Spark's plain fit grows it."""
    from pyspark.ml.classification import RandomForestClassifier

    rng = np.random.default_rng(7)
    rows = [([float(v) for v in rng.normal(size=6)], int(rng.integers(4)) if i % 50 else None) for i in range(1200)]
    df = spark.createDataFrame(rows, "x array<float>, y int").repartition(3, "x").localCheckpoint()
    model = classify.forest_fit(df, "y", "x")
    assert model.getCacheNodeIds()
    data = classify.assemble(df.where("y IS NOT NULL"), "x").withColumn("_label", F.col("y").cast("double"))
    plain = RandomForestClassifier(featuresCol=classify.FEATURES, labelCol="_label", numTrees=10, maxDepth=30, seed=42, impurity="gini").fit(data)
    assert not plain.getCacheNodeIds() and model.classes == [0, 1, 2, 3]
    nodes = lambda m: classify.forest_nodes(spark, m).orderBy("tree", "node_id").collect()
    assert max(t.depth for t in plain.trees) > 10 and model.toDebugString.count("\n") == plain.toDebugString.count("\n")
    key = lambda n: (n.tree, n.node_id, n.feature_index, n.threshold, n.gini, tuple(n.value), n.left, n.right)
    assert [key(n) for n in nodes(model)] == [key(n) for n in nodes(plain)]


def test_forest_is_grown_without_sparks_dense_passes(spark, monkeypatch):
    """Node for node Spark's own forest, in groups of few nodes, with rows summed in a shuffle as well as dealt by node."""
    from pyspark.ml.classification import RandomForestClassifier

    from loadwright.models import forest
    from loadwright.session import scratch_path

    rng = np.random.default_rng(3)
    rows = [([*map(float, rng.integers(0, 9, 4)), 1.0, float(rng.normal())], int(rng.integers(5))) for _ in range(700)]
    df = spark.createDataFrame(rows, "x array<double>, y int").repartition(5).localCheckpoint()
    data = classify.assemble(df, "x").withColumn("_label", F.col("y").cast("double"))
    rf = RandomForestClassifier(featuresCol=classify.FEATURES, labelCol="_label", numTrees=6, maxDepth=12, seed=42, impurity="gini", maxMemoryInMB=1)
    own = {(r.treeID, str(r.nodeData)) for r in spark.read.parquet(f"{classify._saved(spark, rf.fit(data), None)}/data").collect()}
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *a: pytest.fail("Spark's own passes"))
    for dealt_rows in (0, forest.DEALT_ROWS):
        monkeypatch.setattr(forest, "DEALT_ROWS", dealt_rows)
        grown = forest.grow(rf, data)
        path = scratch_path(spark, "forest")
        forest.save(spark, rf, grown, path)
        assert {(r.treeID, str(r.nodeData)) for r in spark.read.parquet(f"{path}/data").collect()} == own
    model = classify.forest_fit(df, "y", "x", trees=3, max_depth=4)
    assert model.getNumTrees == 3 and model.numClasses == 5 and model.classes == [0, 1, 2, 3, 4]


def test_bootstrap_counts_and_feature_subsets_are_sparks(spark):
    from loadwright.models import forest

    jvm = spark._jvm
    for seed in (43, -5, 2**40 + 17):
        draws = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
        draws.reseedRandomGenerator(seed)
        assert forest.poisson_counts(seed, 400).tolist() == [draws.sample() for _ in range(400)]
    java = jvm.java.util.Random(42)
    seeds, _ = forest.JavaRandom(42).longs(50)
    assert seeds.astype(np.int64).tolist() == [java.nextLong() for _ in range(50)]
    sets = forest.feature_subsets(seeds, 20, 4)
    assert all(len(set(s)) == 4 and 0 <= min(s) and max(s) < 20 for s in sets.tolist())
