"""Scores computed again from the nodes of the models, and clusters from their centres."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from queries.common import REGISTRY, TRAINED
from tallymark.operators import learning as ml
from tallymark.operators import trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Noisy labels, so that trees grow to their full depth."""
    df = spark.range(600).select(
        "id", (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("c"),
    )
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) == 0
    label = ((F.col("a") > 9) & (F.col("b") < 5)) != noise
    return ml.assemble(df.withColumns({"label": label.cast("double"), "y": F.col("a") * 3 + F.col("c")}), FEATURES)


def same(walked, predicted, *columns):
    left, right = ({r["id"]: r for r in df.collect()} for df in (walked, predicted))
    assert left.keys() == right.keys() and len(left) == 600
    for key, row in left.items():
        for column in columns:
            assert row[column] == pytest.approx(right[key][column], rel=1e-9, abs=1e-12)


def test_forest(spark, rows):
    model = ml.fit_rf(rows, "label", trees=9, depth=5)
    nodes = trees.node_table(spark, model)
    assert nodes.trees == 9 and nodes.depth == 5
    assert nodes.rows.count() == model.totalNumNodes
    same(trees.forest_scores(rows, ["id"], nodes), ml.predictions(model, rows, ["id"]), "prediction", "probability")
    # The decision and the risk of a batch score are those of the nodes too.
    walked = trees.forest_scores(rows, ["id"], nodes).select("id", F.col("probability").alias("risk_prob"))
    same(walked, ml.score(model, rows, ["id"]), "risk_prob")


def test_boosted(spark, rows):
    model = ml.fit_gbt_classifier(rows, "label", iterations=6, depth=4)
    walked = trees.boosted_scores(rows, ["id"], trees.node_table(spark, model))
    same(walked, ml.predictions(model, rows, ["id"]), "prediction", "probability")
    right = walked.join(rows.select("id", "label"), "id")
    found = ml.accuracy(right, "label").first()["accuracy"]
    assert found == ml.accuracy(model.transform(rows), "label").first()["accuracy"] > 0.85
    regressor = ml.fit_gbt_regressor(rows, "y", iterations=5)
    same(trees.boosted_values(rows, ["id"], trees.node_table(spark, regressor)), ml.predictions(regressor, rows, ["id"]), "prediction")


def test_missing_values_go_as_the_model_sends_them(spark, rows):
    model = ml.fit_rf(rows, "label", trees=5, depth=4)
    gaps = ml.assemble(rows.drop("features").withColumn("a", F.when(F.col("id") % 3 > 0, F.col("a"))), FEATURES, "keep")
    same(trees.forest_scores(gaps, ["id"], trees.node_table(spark, model)), ml.predictions(model, gaps, ["id"]), "probability")


def test_centres_are_the_means_of_their_rows(rows):
    """At the fixed point: another round would move no centre, and the cost is the one the trainer reports."""
    model = ml.fit_kmeans(rows, 4, tol=0.0, maxIter=200)
    centres = [c.tolist() for c in model.clusterCenters()]
    clustered = model.transform(rows)
    found = ml.cluster_means(clustered, centres).collect()
    assert sum(r["row_count"] for r in found) == 600 and len(found) == 4
    for r in found:
        assert r["mean"] == pytest.approx(centres[r["cluster"]], rel=1e-9)
    assert sum(r["cost"] for r in found) == pytest.approx(model.summary.trainingCost, rel=1e-9)
    assert ml.nearest_centre(clustered, centres).filter("NOT nearest").isEmpty()
    # Centres off their rows are seen.
    moved = [[v + 1 for v in centres[0]], *centres[1:]]
    assert sum(r["cost"] for r in ml.cluster_means(clustered, moved).collect()) > model.summary.trainingCost


def test_trained_queries_return_rows_and_have_checks(spark):
    """Small: the forest's queries. Each trained result has a registered check next to it."""
    sf_dir = "/root/testdata/sf0.001"
    assert not TRAINED.keys() & REGISTRY.keys() and TRAINED.keys() <= contract.queries().keys()
    assert not TRAINED.keys() & contract.oracle_sql().keys()
    scored = TRAINED["loan_scored_rows"].run(spark, sf_dir)
    assert scored.count() == 1500 and scored.filter("risk_prob BETWEEN 0 AND 1 AND approved = (risk_prob <= 0.5)").count() == 1500
    assert scored.agg(F.countDistinct("risk_prob")).first()[0] > 10
    clusters = TRAINED["sensor_cluster_rows"].run(spark, sf_dir)
    assert clusters.select("prediction").distinct().count() == 5 and clusters.filter("distance < 0 OR distance IS NULL").isEmpty()
