"""Tree ensembles as tables: one row per node, and scores computed from the rows in DataFrame steps.

The table is what the model itself stores, so a score can be looked into, kept next to its model, and computed again by
any engine that joins. It has at most 2 ** (depth + 1) - 1 rows per tree, however many rows were trained on.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.session import require_checkpoint_dir


class Nodes(NamedTuple):
    """Columns of ``rows``: tree, weight, node (0 is the root), feature, threshold, left and right (-1 at a leaf), prediction,
    and the training weight by class that reached the node."""

    rows: DataFrame
    trees: int
    depth: int


def node_table(spark: SparkSession, model) -> Nodes:
    """The nodes of a fitted forest or boosted model; its splits must be thresholds, as those of assembled numbers are."""
    path = os.path.join(require_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), split["featureIndex"].alias("feature"),
        split["leftCategoriesOrThreshold"][0].alias("threshold"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"),
        (split["numCategories"] > 0).alias("by_category"),
    )
    if not nodes.filter("by_category").isEmpty():
        raise ValueError("splits by category are not supported")
    return Nodes(nodes.drop("by_category").join(weights, "tree"), len(model.trees), max(t.depth for t in model.trees))


def leaves(features: DataFrame, keys: Sequence[str], nodes: Nodes) -> DataFrame:
    """(keys, x, tree, node): the leaf of every tree that each distinct row of keys and features reaches.

    Every step is one equi join with the node table, which Catalyst ships to the rows as long as it is small.
    """
    rows = features.select(*keys, vector_to_array("features").alias("x")).distinct()
    at = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(nodes.trees - 1)))).withColumn("node", F.lit(0))
    splits = nodes.rows.filter("left >= 0").select("tree", "node", "feature", "threshold", "left", "right")
    # Arrays are counted from 1. A missing value goes right, like any that is not at most the threshold.
    value = F.element_at("x", F.col("feature") + 1)
    down = F.when(F.isnan(value) | (value > F.col("threshold")), F.col("right")).otherwise(F.col("left"))
    for _ in range(nodes.depth):
        step = at.join(splits, ["tree", "node"], "left")
        at = step.select(*keys, "x", "tree", F.when(F.col("left").isNull(), F.col("node")).otherwise(down).alias("node"))
    return at


def _of_leaves(features: DataFrame, keys: Sequence[str], nodes: Nodes, **values: Column) -> DataFrame:
    reached = leaves(features, keys, nodes).join(nodes.rows.select("tree", "node", "weight", "prediction", "stats"), ["tree", "node"])
    return reached.groupBy(*keys, "x").agg(*[v.alias(n) for n, v in values.items()]).drop("x")


def forest_scores(features: DataFrame, keys: Sequence[str], nodes: Nodes) -> DataFrame:
    """(keys, prediction, probability of class 1): every tree votes with the shares of its leaf."""
    total = F.aggregate("stats", F.lit(0.0), lambda s, v: s + v)
    voted = _of_leaves(features, keys, nodes, probability=F.avg(F.col("stats")[1] / total))
    return voted.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


def boosted_values(features: DataFrame, keys: Sequence[str], nodes: Nodes) -> DataFrame:
    """(keys, prediction) of a boosted regressor: the weighted sum of the leaves."""
    return _of_leaves(features, keys, nodes, prediction=F.sum(F.col("weight") * F.col("prediction")))


def boosted_scores(features: DataFrame, keys: Sequence[str], nodes: Nodes) -> DataFrame:
    """(keys, prediction, probability of class 1) of a boosted classifier: the sum is half of the log odds."""
    margin = F.col("margin")
    summed = _of_leaves(features, keys, nodes, margin=F.sum(F.col("weight") * F.col("prediction")))
    shaped = summed.withColumns({"probability": 1 / (1 + F.exp(-2 * margin)), "prediction": (margin > 0).cast("double")})
    return shaped.drop("margin")
