"""Classifiers: multinomial logistic regression and a random forest.

Fixed values that must equal the reference:
  - logistic regression penalty strength ``C = 1e5`` (an L2 penalty summed
    over rows); Spark averages the loss over rows, so ``regParam = 1 / (C * n)``
    with ``standardization = False`` gives the same objective
  - the forest has 10 trees; the tree shown is the one at index 5

Both fit with Spark ML (distributed aggregation of gradients / split
statistics); prediction is ``model.transform``.  Array features (such as
embeddings) become vectors with ``array_to_vector`` on the JVM side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

LOGIT_C = 1e5
FOREST_TREES = 10
SHOWN_TREE = 5
MAX_DEPTH = 30  # the deepest tree that Spark ML grows
FEATURES = "_features"


def assemble(df: DataFrame, xs: list[str] | str, out: str = FEATURES) -> DataFrame:
    """One vector column from numeric columns, or from a single array column."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    if isinstance(xs, str):
        xs = [xs]
    if len(xs) == 1 and isinstance(df.schema[xs[0]].dataType, ArrayType):
        return df.withColumn(out, array_to_vector(F.col(xs[0]).cast("array<double>")))
    return VectorAssembler(inputCols=list(xs), outputCol=out, handleInvalid="skip").transform(df)


def feature_names(df: DataFrame, xs: list[str] | str, model=None) -> list[str]:
    """Names for vector slots: the column names, or ``col[i]`` for an array column.

    A fitted model already knows the width of an array column; without one it
    takes a pass over the table.
    """
    if isinstance(xs, str):
        xs = [xs]
    if len(xs) == 1 and isinstance(df.schema[xs[0]].dataType, ArrayType):
        width = model.numFeatures if model is not None else df.select(F.max(F.size(xs[0]))).first()[0] or 0
        return [f"{xs[0]}[{i}]" for i in range(width)]
    return list(xs)


@dataclass
class Classifier:
    """A fitted Spark ML model and the class values behind its label indices."""

    model: object
    classes: list

    def __getattr__(self, name):
        return getattr(self.model, name)

    def class_of(self, prediction: str | Column) -> Column:
        """The class value of a predicted index."""
        return F.get(F.array(*[F.lit(c) for c in self.classes]), F.col(prediction).cast("int") if isinstance(prediction, str) else prediction)


def _labelled(df: DataFrame, label: str, xs: list[str] | str) -> tuple[DataFrame, list, int]:
    """Vectors and label indices 0 .. k-1, the class values in order, and the row count.

    Labels may have any type; one aggregate finds the classes (a row per class)
    and counts the rows.
    """
    data = df.where(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in data.groupBy(label).count().collect()}
    classes = sorted(counts)
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1 if classes else F.lit(0)
    return assemble(data, xs).withColumn("_label", index.cast("double")), classes, sum(counts.values())


def _without_summary(spark, model):
    """The model without its training summary.

    The summary holds the training DataFrame and with it the session, which
    Spark would try to send along with the model when it predicts.
    """
    model._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return model


def logit_fit(df: DataFrame, label: str, xs: list[str] | str, C: float = LOGIT_C, max_iter: int = 100, tol: float = 1e-8) -> Classifier:
    """Multinomial logistic regression with the reference's penalty."""
    from pyspark.ml.classification import LogisticRegression

    data, classes, n = _labelled(df, label, xs)
    lr = LogisticRegression(featuresCol=FEATURES, labelCol="_label", family="multinomial",
                            regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol)
    return Classifier(_without_summary(df.sparkSession, lr.fit(data)), classes)


def logit_predict(model: Classifier, rows: DataFrame, xs: list[str] | str, keep: list[str] | None = None) -> DataFrame:
    """Predicted class value for each row of ``rows`` (a table of feature vectors)."""
    out = model.transform(assemble(rows, xs))
    keep = keep if keep is not None else [c for c in rows.columns]
    return out.select(*keep, model.class_of("prediction").alias("prediction"))


def two_class_terms(model: Classifier, xs: list[str]) -> list[tuple[str, float]]:
    """Intercept and coefficients of a two-class fit as the log odds of the second class (the difference of the classes' rows)."""
    if len(model.classes) != 2:
        raise ValueError(f"two classes are needed, got {model.classes}")
    low, high = model.coefficientMatrix.toArray()
    first, second = model.interceptVector.toArray()
    return [("const", float(second - first))] + [(x, float(b - a)) for x, a, b in zip(xs, low, high)]


def forest_fit(df: DataFrame, label: str, xs: list[str] | str, trees: int = FOREST_TREES,
               seed: int = 42, max_depth: int = MAX_DEPTH) -> Classifier:
    """Random-forest classifier (bootstrap samples, sqrt(features) per split).

    Trees grow until their leaves are pure, as the original's do, up to
    ``max_depth``, whose default is the deepest that Spark ML allows.

    ``forest.grow`` grows the forest that Spark ML's own fit gives, node for
    node, with passes that cost what their rows cost; Spark's fit keeps a
    histogram of every open node in every partition.  The forest is saved in
    Spark ML's format below the shared checkpoint folder.  Categorical
    features (columns with nominal ML attributes) are left to Spark's fit,
    where every row keeps the node it has reached in each tree.
    """
    from pyspark.ml.classification import RandomForestClassifier

    from loadwright.models import forest
    from loadwright.session import checkpoint_root, scratch_path

    spark = df.sparkSession
    checkpoint_root(spark)
    data, classes, _ = _labelled(df, label, xs)
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol="_label", numTrees=trees,
                                maxDepth=max_depth, seed=seed, impurity="gini", cacheNodeIds=True)
    grown = forest.grow(rf, data)
    if grown is None:
        return Classifier(_without_summary(spark, rf.fit(data)), classes)
    path = scratch_path(spark, "forest")
    forest.save(spark, rf, grown, path)
    return Classifier(forest.SavedForest(path, len(grown[1])), classes)


def _saved(spark, model, path: str | None) -> str:
    """The folder of a saved forest: where its growth has left it, or ``path``, to which it is saved here."""
    from loadwright.session import scratch_path

    if path is None and (own := getattr(model, "path", None)):
        return own
    path = path or scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    return path


def tree_nodes(spark, model, tree: int = SHOWN_TREE, features: list[str] | None = None,
               classes: list[str] | None = None, path: str | None = None) -> DataFrame:
    """One tree of a fitted forest as node records.

    Columns: ``node_id, feature, threshold, gini, samples, value, class, left, right``.
    ``samples`` is the bootstrap-weighted count Spark keeps (``rawCount``), and
    ``value`` the per-class weighted counts.  Leaves have NULL feature and
    threshold and ``left = right = -1``.  The model is saved below the shared
    checkpoint folder and its node table read back with Spark.
    """
    path = _saved(spark, model, path)
    classes = classes or [str(c) for c in getattr(model, "classes", [])]
    nodes = spark.read.parquet(f"{path}/data").where(F.col("treeID") == tree).select("nodeData.*")
    feat = F.col("split.featureIndex")
    if features:
        names = F.array(*[F.lit(f) for f in features])
        feat_name = F.when(F.col("leftChild") >= 0, F.get(names, feat))
    else:
        feat_name = F.when(F.col("leftChild") >= 0, F.concat(F.lit("f"), feat.cast("string")))
    pred = F.col("prediction").cast("int")
    cls = F.get(F.array(*[F.lit(c) for c in classes]), pred) if classes else pred.cast("string")
    return nodes.select(
        F.col("id").alias("node_id"),
        feat_name.alias("feature"),
        F.when(F.col("leftChild") >= 0, F.get(F.col("split.leftCategoriesOrThreshold"), 0)).alias("threshold"),
        F.col("impurity").alias("gini"),
        F.col("rawCount").alias("samples"),
        F.col("impurityStats").alias("value"),
        cls.alias("class"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
    )


def forest_nodes(spark, model, path: str | None = None) -> DataFrame:
    """All trees of a fitted forest: ``tree, node_id, feature_index, threshold, gini, value, left, right``."""
    path = _saved(spark, model, path)
    n = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    return n.select("tree", F.col("id").alias("node_id"), F.when(inner, F.col("split.featureIndex")).alias("feature_index"),
                    F.when(inner, F.get(F.col("split.leftCategoriesOrThreshold"), 0)).alias("threshold"), F.col("impurity").alias("gini"),
                    F.col("impurityStats").alias("value"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"))


def node_checks(nodes: DataFrame) -> DataFrame:
    """(check_name, n_bad): what must hold of every node table, with the number of nodes that break it.

    * ``children``  class counts of the two children add up to the parent's
    * ``gini``      the impurity follows from the class counts
    * ``links``     an inner node has a feature and two children after it, a leaf has none
    * ``parents``   every node but the root is the child of exactly one node
    """
    at = lambda side: nodes.select(F.col("tree").alias(f"{side}_tree"), F.col("node_id").alias(f"{side}_id"), F.col("value").alias(f"{side}_value"))
    left, right = at("l"), at("r")
    both = (nodes.where("left >= 0").join(left, (F.col("tree") == F.col("l_tree")) & (F.col("left") == F.col("l_id")), "left")
            .join(right, (F.col("tree") == F.col("r_tree")) & (F.col("right") == F.col("r_id")), "left"))
    off = F.exists(F.arrays_zip("value", "l_value", "r_value"), lambda v: F.abs(v["value"] - v["l_value"] - v["r_value"]) > 1e-6)
    total = F.aggregate("value", F.lit(0.0), lambda a, v: a + v)
    gini = 1 - F.aggregate("value", F.lit(0.0), lambda a, v: a + v * v) / (total * total)
    inner = (F.col("left") > F.col("node_id")) & (F.col("right") > F.col("node_id")) & F.col("feature_index").isNotNull() & F.col("threshold").isNotNull()
    leaf = (F.col("left") < 0) & (F.col("right") < 0) & F.col("feature_index").isNull()
    asked = nodes.where("left >= 0").select("tree", F.explode(F.array("left", "right")).alias("node_id")).groupBy("tree", "node_id").agg(F.count(F.lit(1)).alias("n"))
    found = nodes.where("node_id > 0").join(asked, ["tree", "node_id"], "full").where("n IS NULL OR n <> 1 OR value IS NULL")
    count = lambda df, name, bad: df.agg(F.count_if(F.coalesce(bad, F.lit(True))).alias("n_bad")).select(F.lit(name).alias("check_name"), "n_bad")
    return (count(both, "children", off).unionByName(count(nodes, "gini", F.abs(gini - F.col("gini")) > 1e-9))
            .unionByName(count(nodes, "links", ~(inner | leaf))).unionByName(count(found, "parents", F.lit(True))))


def forest_score(nodes: DataFrame, rows: DataFrame, features: str, classes: list) -> DataFrame:
    """``rows`` with ``tree_classes`` (the class index that each tree gives) and ``prediction`` from the node table alone.

    The forest is one value of the plan (its nodes by tree, a model's size) and
    every row walks it: from the root to the left where the feature is at most
    the threshold, until a leaf.  A tree votes with its leaf's class shares.
    """
    node = F.struct("node_id", "feature_index", "threshold", "value", "left", "right")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"), F.max("node_id").alias("last"))
    forest = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("f")).scalar()

    def leaf(tree):
        here = lambda at: F.get(tree["nodes"], at)
        step = lambda at, _: F.when(here(at)["left"] < 0, at).when(
            F.get(F.col(features), here(at)["feature_index"]) <= here(at)["threshold"], here(at)["left"]).otherwise(here(at)["right"])
        return here(F.aggregate(F.sequence(F.lit(1), F.lit(MAX_DEPTH)), F.lit(0), step))["value"]

    best = lambda v: F.array_position(v, F.array_max(v)) - 1
    share = lambda v: F.transform(v, lambda c: c / F.aggregate(v, F.lit(0.0), lambda a, x: a + x))
    walked = rows.withColumn("_forest", forest).withColumn("_leaves", F.transform("_forest", lambda t: leaf(t))).drop("_forest")
    votes = F.aggregate("_leaves", F.array_repeat(F.lit(0.0), len(classes)), lambda a, v: F.zip_with(a, share(v), lambda x, y: x + y))
    index = best(votes)
    return walked.select(*rows.columns, F.transform("_leaves", lambda v: best(v).cast("int")).alias("tree_classes"),
                         F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int")).alias("prediction"))
