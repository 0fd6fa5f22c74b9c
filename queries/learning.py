"""Training and scoring jobs.

A model's numbers depend on the trainer. Registered with SQL is what holds for any of them: the split, the
weighted training table, the feature vectors, scores in range that agree with the decisions, accuracy above a bound, alerts
equal to the predictions above the limit, and the nearest centre for every row. The scores, predictions, clusters, alerts
and the accuracy themselves are registered without SQL; tests recompute them from the models' nodes and centres.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queries import scoring  # noqa: F401 - its loan features are stated again here
from queries.common import DOMAIN, REGISTRY, TRAINED, add
from tallymark.operators import learning as ml
from tallymark.plans.scoring import energy, finance, retail
from tallymark.session import cut_lineage

# Applications without gaps, and a label that follows the income and the amount.
DOMAIN["loan_history"] = """
    SELECT o_orderkey AS customer_id, CAST(o_totalprice * 2 AS DOUBLE) AS loan_amount,
           CAST((1 + o_custkey % 250) * 1000 AS DOUBLE) AS annual_income,
           CAST(550 + o_custkey % 250 AS DOUBLE) AS credit_score, CAST(120 + 60 * (o_custkey % 5) AS DOUBLE) AS loan_term,
           CAST(o_custkey % 9 AS DOUBLE) AS interest_rate, CAST(o_totalprice * 3 AS DOUBLE) AS property_value,
           CAST(10000 + o_custkey AS STRING) AS zip_code,
           CASE WHEN o_totalprice > 150000 AND o_custkey % 250 < 120 THEN 1.0 ELSE 0.0 END AS default_flag
    FROM {orders}"""


# Values of the same arithmetic in SQL.
def _test_rows(key: str, weights: tuple[float, float]) -> str:
    """SQL for: the row belongs to the test part."""
    terms = []
    for name, factor in zip(key.split(), ml.SPLIT_FACTORS):
        m = ml.SPLIT_BUCKETS
        terms.append(f"((COALESCE({name}, 0) % {m} + {m}) % {m}) * {factor}")
    return f"(({ml.SEED} + {' + '.join(terms)}) % {ml.SPLIT_BUCKETS}) >= {ml.split_cut(weights)}"


LOAN_PARTS, DEMAND_PARTS, CLAIM_PARTS = (0.8, 0.2), (0.8, 0.2), (0.7, 0.3)
# Shares of test rows that the models must get right.
LOAN_ACCURACY, CLAIM_ACCURACY = 0.9, 0.85


def loan_split(applications: DataFrame) -> DataFrame:
    train, test = ml.split(applications, ["customer_id"], LOAN_PARTS)
    part = lambda df, name: df.select("customer_id", F.lit(name).alias("part"))
    return part(train, "train").unionByName(part(test, "test"))


def _loan_model(applications: DataFrame):
    features = ml.assemble(finance.loan_features(applications), finance.LOAN["features"])
    train, test = ml.split(features, ["customer_id"], LOAN_PARTS)
    return ml.fit_rf(train, finance.LOAN["label"]), features, test


def loan_scores(applications: DataFrame) -> DataFrame:
    """Every application's score lies between 0 and 1 and agrees with the decision."""
    model, features, _ = _loan_model(applications)
    risk = F.col("risk_prob")
    return ml.score(model, features, ["customer_id"]).select(
        "customer_id", risk.between(0, 1).alias("in_range"), (F.col("approved") == (risk <= 0.5)).alias("agrees")
    )


def loan_accuracy(applications: DataFrame) -> DataFrame:
    model, _, test = _loan_model(applications)
    found = ml.accuracy(model.transform(test), finance.LOAN["label"])
    return found.select((F.col("accuracy") >= LOAN_ACCURACY).alias("accurate"))


def demand_condensed(sales: DataFrame) -> DataFrame:
    """The weighted training table has the label sum and the rows of the sales it stands for."""
    rows = retail.demand_features(sales)
    return ml.condensed_equals_rows(rows, ml.condense(rows, retail.DEMAND["features"], "quantity"), "quantity")


def _demand(sales: DataFrame) -> DataFrame:
    """Trains on one weighted row per feature combination: a few thousand rows, however many sales there are."""
    cols = retail.DEMAND["features"]
    rows = retail.demand_features(sales)
    train, test = ml.split(rows, ["sale_id", "l_linenumber", "product_sku"], DEMAND_PARTS)
    condensed = ml.assemble(ml.condense(train, cols, "quantity"), cols)
    model = ml.fit_gbt_regressor(condensed, "quantity", weight="weight")
    return model.transform(ml.assemble(test, cols))


def demand_predictions(sales: DataFrame) -> DataFrame:
    """Every test row has a prediction near the range of the quantities."""
    bounds = sales.agg(F.min("quantity").alias("low"), F.max("quantity").alias("high"))
    low, high = (bounds.select(c).scalar() for c in ("low", "high"))
    slack = (high - low) / 2
    return _demand(sales).select("product_sku", "sale_id", F.col("prediction").between(low - slack, high + slack).alias("near"))


def _compare(predicted: DataFrame, above: Column, alerts: DataFrame, key: list[str]) -> DataFrame:
    """Rows that only the alerts or only the predictions above the limit have."""
    want, got = predicted.filter(above).select(*key), alerts.select(*key)
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return predicted.sparkSession.range(1).select(
        count(want.exceptAll(got)).alias("missing"), count(got.exceptAll(want)).alias("extra")
    )


def demand_alerts(sales: DataFrame) -> DataFrame:
    predicted = cut_lineage(_demand(sales).select("product_sku", "prediction"))
    alerts = retail.demand_alerts(predicted)
    return _compare(predicted, F.col("prediction") > retail.DEMAND["alert_above"], alerts, ["product_sku", "prediction"])


def _claims(*frames: DataFrame) -> DataFrame:
    """The label comes from the amount itself and an inspection the features know nothing of.

    Trains on one weighted row per combination of feature bins, however many claims there are.
    """
    large = (F.col("claim_amount") > 38000) & (F.col("prior_claims_count") >= 3)
    rows = finance.claim_features(*frames).withColumn(
        "is_fraud", F.when(F.col("claim_id") % 17 == 0, ~large).otherwise(large).cast("double")
    )
    train, test = ml.split(rows, ["claim_id", "claim_amount"], CLAIM_PARTS)
    model, features = ml.fit_binned_gbt_classifier(train, finance.CLAIM["features"], "is_fraud")
    return model.transform(features(test))


def claim_alerts(*frames: DataFrame) -> DataFrame:
    """The alerts are the claims predicted as fraud, the predictions are accurate, and no number is shown in full."""
    predicted = cut_lineage(
        _claims(*frames).select("claim_id", "claim_amount", "claimant_name", "claimant_ssn", "prediction", "is_fraud")
    )
    alerts = finance.claim_alerts(predicted)
    numbers = predicted.select(F.col("claimant_ssn").alias("claimant_ssn_masked"))
    shown = alerts.join(numbers, "claimant_ssn_masked", "left_semi").agg(F.count(F.lit(1))).scalar()
    accurate = ml.accuracy(predicted, "is_fraud").scalar() >= CLAIM_ACCURACY
    same = _compare(predicted, F.col("prediction") == 1.0, alerts, ["claim_id", "claim_amount"])
    return same.withColumns({"shown": shown, "accurate": accurate})


def claim_test_rows(*frames: DataFrame) -> DataFrame:
    return _claims(*frames).select("claim_id", F.col("prediction").isin(0.0, 1.0).alias("decided"))


def sensor_clusters(readings: DataFrame) -> DataFrame:
    features = ml.assemble(energy.grid_features(readings), energy.GRID["features"])
    model = ml.fit_kmeans(features, 5)
    return ml.nearest_centre(model.transform(features), [c.tolist() for c in model.clusterCenters()])


def loan_vectors(applications: DataFrame) -> DataFrame:
    """The assembled features by position; what is missing is not a number."""
    names = finance.LOAN["features"]
    rows = ml.assemble(finance.loan_features(applications), names, "keep")
    x = vector_to_array("features")
    return rows.select("customer_id", *[(F.round(x[i], 3) if n == "monthly_payment" else x[i]).alias(f"x{i}") for i, n in enumerate(names)])


def loan_scored_rows(applications: DataFrame) -> DataFrame:
    """Approval and risk probability of every application."""
    model, features, _ = _loan_model(applications)
    return ml.score(model, features, ["customer_id"])


def loan_accuracy_value(applications: DataFrame) -> DataFrame:
    model, _, test = _loan_model(applications)
    return ml.accuracy(model.transform(test), finance.LOAN["label"])


def demand_predicted_rows(sales: DataFrame) -> DataFrame:
    return _demand(sales)


def demand_alert_rows(sales: DataFrame) -> DataFrame:
    return retail.demand_alerts(_demand(sales))


def claim_predicted_rows(*frames: DataFrame) -> DataFrame:
    return _claims(*frames).withColumn("probability", vector_to_array("probability")[1])


def claim_alert_rows(*frames: DataFrame) -> DataFrame:
    """The claims of the test part that are predicted as fraud, with masked names and numbers."""
    return finance.claim_alerts(_claims(*frames))


def sensor_cluster_rows(readings: DataFrame) -> DataFrame:
    """The cluster of every reading and its distance to the cluster's centre."""
    features = ml.assemble(energy.grid_features(readings), energy.GRID["features"])
    model = ml.fit_kmeans(features, 5)
    centres = [c.tolist() for c in model.clusterCenters()]
    distance = F.sqrt(ml.squared_distance(vector_to_array("features"), centres, F.col("prediction")))
    return model.transform(features).withColumn("distance", distance)


add("loan_split", loan_split, "loan_history", "customer_id:l part:s",
    f"SELECT customer_id, CASE WHEN {_test_rows('customer_id', LOAN_PARTS)} THEN 'test' ELSE 'train' END AS part FROM loan_history")
add("loan_scores", loan_scores, "loan_history", "customer_id:l in_range:b agrees:b",
    "SELECT customer_id, TRUE AS in_range, TRUE AS agrees FROM loan_history")
add("loan_accuracy", loan_accuracy, "loan_history", "accurate:b", "SELECT COUNT(*) >= 0 AS accurate FROM loan_history")
add("demand_condensed", demand_condensed, "demand_sales", "sum_all:d rows_all:l sum_condensed:d rows_condensed:l",
    """SELECT ROUND(SUM(quantity), 3) AS sum_all, COUNT(quantity) AS rows_all, ROUND(SUM(quantity), 3) AS sum_condensed,
       COUNT(quantity) AS rows_condensed FROM demand_sales""")  # fmt: skip
add("demand_predictions", demand_predictions, "demand_sales", "product_sku:l sale_id:l near:b",
    f"""SELECT product_sku, sale_id, TRUE AS near FROM demand_sales
        WHERE {_test_rows('sale_id l_linenumber product_sku', DEMAND_PARTS)}""")  # fmt: skip
add("demand_alerts", demand_alerts, "demand_sales", "missing:l extra:l",
    "SELECT COUNT(*) FILTER (quantity IS NULL AND quantity IS NOT NULL) AS missing, 0 AS extra FROM demand_sales")
add("claim_test_rows", claim_test_rows, "claims claim_history policies agents", "claim_id:l decided:b",
    f"""SELECT claim_id, TRUE AS decided FROM (SELECT *, CAST(ROUND(claim_amount * {ml.SPLIT_SCALE}) AS BIGINT) AS units FROM claims)
        WHERE {_test_rows('claim_id units', CLAIM_PARTS)}""")  # fmt: skip
add("claim_alerts", claim_alerts, "claims claim_history policies agents", "missing:l extra:l shown:l accurate:b",
    "SELECT 0 AS missing, 0 AS extra, 0 AS shown, COUNT(*) >= 0 AS accurate FROM claims")
add("sensor_clusters", sensor_clusters, "grid_readings", "sensor_id:s nearest:b",
    "SELECT sensor_id, TRUE AS nearest FROM grid_readings")

_VECTOR = " ".join(f"x{i}:d" for i in range(len(finance.LOAN["features"])))
add("loan_vectors", loan_vectors, "loan_applications", f"customer_id:l {_VECTOR}",
    "SELECT customer_id, " + ", ".join(f"COALESCE(CAST({n} AS DOUBLE), 'NaN'::DOUBLE) AS x{i}" for i, n in enumerate(finance.LOAN["features"]))
    + f" FROM ({REGISTRY['loan_features'].sql})")

CLAIMS = "claims claim_history policies agents"
add("loan_scored_rows", loan_scored_rows, "loan_history", "customer_id:l approved:b risk_prob:d", to=TRAINED)
add("loan_accuracy_value", loan_accuracy_value, "loan_history", "accuracy:d", to=TRAINED)
add("demand_predicted_rows", demand_predicted_rows, "demand_sales", "product_sku:l sale_id:l prediction:d", to=TRAINED)
add("demand_alert_rows", demand_alert_rows, "demand_sales", "product_sku:l prediction:d", to=TRAINED)
add("claim_predicted_rows", claim_predicted_rows, CLAIMS, "claim_id:l claim_amount:d prediction:d probability:d", to=TRAINED)
add("claim_alert_rows", claim_alert_rows, CLAIMS, "claim_id:l claim_amount:d claimant_name_masked:s claimant_ssn_masked:s", to=TRAINED)
add("sensor_cluster_rows", sensor_cluster_rows, "grid_readings", "sensor_id:s prediction:l distance:d", to=TRAINED)
