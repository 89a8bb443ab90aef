"""Fitted models as plain tables: exported, scored by column expressions, checked (M2, M3, M7).

* A logistic regression is a row for each input: median, mean, deviation,
  coefficient.  Its score is one expression over a row; ``logreg_gradient``
  computes the gradient of the penalised loss at the exported point over all
  training rows, which is zero only at the best point, as the loss is convex.
* Boosted trees are a row for each node (tree, node, feature, threshold, left,
  right, value), children after their parents.  ``score_trees`` lets all trees
  of a row descend one level at a time through the node arrays, which are one
  broadcast row: as large as the model, whatever the data.

Neither needs MLlib to score, so any engine that reads the tables can.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOGREG_SCHEMA = "feature string, median double, mean double, deviation double, coefficient double"
TREES_SCHEMA = "tree int, node int, feature string, threshold double, `left` int, `right` int, value double, weight double"
INTERCEPT = "intercept"


def export_logreg(spark: SparkSession, model: PipelineModel, cols: list[str], medians: dict[str, float]) -> DataFrame:
    """The fitted pipeline as a table; ``medians`` are those it was fitted with.  The intercept has no median."""
    scaler, logreg = model.stages[-2], model.stages[-1]
    rows = [(c, float(medians.get(c) or 0.0), float(m), float(d), float(b)) for c, m, d, b in zip(cols, scaler.mean, scaler.std, logreg.coefficients)]
    return spark.createDataFrame([*rows, (INTERCEPT, None, 0.0, 1.0, float(logreg.intercept))], LOGREG_SCHEMA)


def _standardised(r) -> Column:
    """An input as the model sees it; one without spread is 0."""
    if r.deviation == 0.0:
        return F.lit(0.0)
    return (F.coalesce(F.col(f"`{r.feature}`").cast("double"), F.lit(r.median)) - F.lit(r.mean)) / F.lit(r.deviation)


def logreg_probability(table: DataFrame) -> Column:
    """Probability of class 1 for rows with the table's inputs.  The table has a row for each input."""
    z = F.lit(0.0)
    for r in table.collect():
        z = z + F.lit(r.coefficient) * (F.lit(1.0) if r.feature == INTERCEPT else _standardised(r))
    return 1.0 / (1.0 + F.exp(-z))


def logreg_gradient(train: DataFrame, table: DataFrame, reg_param: float, label: str = "label", weight: str = "weight") -> DataFrame:
    """(feature, n_rows, gradient) of mean weighted log loss + ``reg_param`` / 2 * sum of squared coefficients, in one pass."""
    rows = table.collect()
    off = train.select("*", (F.col(weight) * (logreg_probability(table) - F.col(label))).alias("_off"))
    parts = {r.feature: F.col("_off") if r.feature == INTERCEPT else F.col("_off") * _standardised(r) for r in rows}
    sums = off.agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"), *[F.sum(c).alias(f"g{i}") for i, c in enumerate(parts.values())])
    found = F.explode(F.array(*[
        F.struct(F.lit(r.feature).alias("feature"), F.col("_n").alias("n_rows"),
                 (F.col(f"g{i}") / F.col("_w") + F.lit(0.0 if r.feature == INTERCEPT else reg_param * r.coefficient)).alias("gradient"))
        for i, r in enumerate(rows)])).alias("r")
    return sums.select(found).select("r.*")


def export_trees(spark: SparkSession, model: PipelineModel, cols: list[str], folder: str) -> DataFrame:
    """The nodes of boosted trees, read from the model's saved form below ``folder``.  A leaf has no feature."""
    model.stages[-1].write().overwrite().save(folder)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.stages[-1].treeWeights)], "tree int, weight double")
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    names = F.array(*[F.lit(c) for c in cols])
    inner = F.col("leftChild") >= 0
    return (nodes.join(F.broadcast(weights), "tree")
            .select(F.col("tree").cast("int"), F.col("id").cast("int").alias("node"), F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
                    F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"), F.when(inner, F.col("leftChild")).cast("int").alias("left"),
                    F.when(inner, F.col("rightChild")).cast("int").alias("right"), F.col("prediction").alias("value"), "weight"))


@dataclass
class Forest:
    """The node arrays of all trees, one after another, as one row; ``depth`` levels below the roots."""

    row: DataFrame
    depth: int


def forest(nodes: DataFrame, cols: list[str]) -> Forest:
    """``cols``: the inputs, in the order in which rows will hold them."""
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n"))
    # trees are parameters: their number and sizes are bounded by the model's settings
    start, before, total = {}, 0, sizes.orderBy("tree").collect()
    for r in total:
        start[r.tree], before = before, before + r.n
    starts = F.create_map(*[F.lit(x) for kv in start.items() for x in kv])
    at = nodes.withColumn("start", F.element_at(starts, F.col("tree")))
    place = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("feature")) - 1
    flat = at.select((F.col("start") + F.col("node")).alias("at"), F.coalesce(place, F.lit(-1)).cast("int").alias("f"), F.coalesce("threshold", F.lit(0.0)).alias("t"),
                     F.coalesce(F.col("start") + F.col("left"), F.lit(-1)).alias("l"), F.coalesce(F.col("start") + F.col("right"), F.lit(-1)).alias("r"),
                     (F.col("value") * F.col("weight")).alias("v"))
    arrays = flat.agg(F.sort_array(F.collect_list(F.struct("at", "f", "t", "l", "r", "v"))).alias("nodes"))
    row = arrays.select(*[F.col(f"nodes.{c}").alias(f"_{c}") for c in ("f", "t", "l", "r", "v")],
                        F.array(*[F.lit(start[r.tree]) for r in total]).alias("_roots"))
    levels, depth = nodes.where("node = 0").select("tree", "node"), -1
    while not levels.isEmpty():
        depth += 1
        kids = nodes.join(levels, ["tree", "node"]).where("`left` is not null").select("tree", F.explode(F.array("left", "right")).alias("node"))
        levels = kids.sparkSession.createDataFrame(kids.collect(), "tree int, node int")
    return Forest(row, depth)


def score_trees(df: DataFrame, nodes: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` with ``margin`` and ``probability``.  Inputs must not be missing (impute first)."""
    trees = forest(nodes, cols)
    state = df.withColumn("_x", F.array(*[F.col(f"`{c}`").cast("double") for c in cols])).crossJoin(F.broadcast(trees.row)).withColumn("_at", F.col("_roots"))
    for _ in range(trees.depth):
        down = F.transform("_at", lambda n: F.when(F.get("_f", n) < 0, n).when(F.get("_x", F.get("_f", n)) <= F.get("_t", n), F.get("_l", n)).otherwise(F.get("_r", n)))
        state = state.withColumn("_at", down)
    margin = F.aggregate("_at", F.lit(0.0), lambda a, n: a + F.get("_v", n))
    return state.select(*df.columns, margin.alias("margin")).withColumn("probability", 1.0 / (1.0 + F.exp(-2.0 * F.col("margin"))))
