import pytest
from pyspark.sql import functions as F

from tallymark.operators import learning as ml
from tallymark.operators.quality import counted
from tallymark.plans.scoring import finance, health, retail, telecom
from tallymark.plans.scoring.common import publish, row_alerts


def test_churn_rules_keep_their_order(spark):
    schema = "customer_id int, monthly_charge double, data_usage_gb double, call_minutes int, contract_end_date string, last_complaint_date string"
    df = spark.createDataFrame(
        [
            # Contract long over, few calls, fresh complaint: first rule.
            (1, 50.0, 30.0, 100, "2024-01-01", "2024-06-20"),
            # Fits the second rule and the third; the second wins.
            (2, 50.0, 1.0, 300, "2024-01-01", "2024-05-15"),
            (3, 50.0, 1.0, 600, "2024-01-01", None),
            (4, 50.0, 50.0, 600, "2024-06-15", None),
            (5, 50.0, 50.0, 600, "2024-12-31", None),
            # Thresholds: 30 days old is not fresh any more.
            (6, 0.0, 0.0, None, None, "2024-05-31"),
        ],
        schema,
    ).withColumns({c: F.col(c).cast("date") for c in ("contract_end_date", "last_complaint_date")})
    scored = telecom.churn_features(df, "2024-06-30").orderBy("customer_id").collect()
    assert [r["churn_risk"] for r in scored] == ["HIGH", "MEDIUM", "HIGH", "MEDIUM", "LOW", "MEDIUM"]
    assert [r["complaint_age_days"] for r in scored] == [10, 46, 999, 999, 999, 30]
    assert [r["contract_band"] for r in scored] == [4, 4, 4, 2, 0, 4]


def trial(spark):
    rows = [(i, "A", "B", float(i), 18 + i, 45.5, 180.0, 3, "completed" if i % 2 else "active", i % 8, i % 3, 0.5) for i in range(60)]
    schema = """patient_id int, first_name string, last_name string, dosage double, age int, weight double,
        height double, visit_count int, status string, adverse_events int, site_id int, efficacy_score double"""
    return spark.createDataFrame(rows, schema)


def test_trial_phases(spark):
    df = trial(spark)

    def ages(**plan):
        return sorted(r["age"] for r in health.trial_results(df, health.TrialPlan(**plan)).collect())

    assert len(ages(phase=1)) == 60
    assert ages(phase=1, include_adverse=True, blinding="double") == list(range(19, 66))
    # The upper age only counts together with a lower one.
    assert max(ages(phase=1, include_adverse=True, blinding="double", interim=True, max_age=30)) == 65
    assert ages(phase=1, include_adverse=True, blinding="double", interim=True, min_age=20, max_age=22) == [20, 21, 22]
    assert ages(phase=2) == []
    assert health.trial_results(df.limit(0), health.TrialPlan(phase=2)).count() == 0
    assert len(ages(phase=3)) == 30
    row = health.trial_results(df, health.TrialPlan(phase=3)).filter("patient_id = 43").first()
    assert (row["full_name"], row["risk_score"], row["adjusted_dosage"]) == ("A B", 1.5, pytest.approx(49.05))
    assert row["bmi"] == pytest.approx(45.5 / 3.24)
    assert sorted(r["cnt"] for r in health.small_sites(df).collect()) == [10, 10, 10]


def test_phase_two_needs_enough_rows(spark):
    df = trial(spark)
    for _ in range(2):
        df = df.unionByName(df)
    assert health.trial_results(df, health.TrialPlan(phase=2)).count() == 4 * 46


def test_loan_features_survive_bad_input(spark):
    schema = "loan_amount double, annual_income double, credit_score int, property_value double, interest_rate double, zip_code string"
    df = spark.createDataFrame([(100.0, 0.0, None, 0.0, 0.0, "AB1"), (190.0, 200000.0, 700, 200.0, 6.0, "12345")], schema)
    first, second = finance.loan_features(df).collect()
    assert (first["dti_ratio"], first["risk_bucket"], first["ltv_ratio"], first["monthly_payment"], first["zip_risk"]) == (None, 4, None, None, None)
    assert (second["risk_bucket"], second["income_bracket"], second["ltv_ratio"], second["zip_risk"]) == (1, "medium", 1.0, 3)


def test_unmatched_side_rows_get_the_default_band(spark):
    customers = spark.createDataFrame([(1, 50.0, 12.0, 3, "2024-06-30"), (2, None, None, None, None)], "customer_id int, lifetime_spend double, avg_order_value double, order_count int, last_purchase_date string")
    customers = customers.withColumn("last_purchase_date", F.col("last_purchase_date").cast("date"))
    empty = spark.createDataFrame([], "customer_id int, preferred_channel string")
    scored = retail.customer_value(customers, empty, empty.withColumnRenamed("preferred_channel", "note"), "2024-07-07")
    first, second = scored.orderBy("customer_id").collect()
    assert (first["r_score"], first["f_score"], first["m_score"], first["segment"]) == (5, 1, 0, "New_Active")
    assert (second["r_score"], second["churn_prob"], second["segment"], second["preferred_channel"]) == (0, 0.85, "Lost", None)


def test_alert_rows_never_show_contacts(spark):
    df = spark.createDataFrame([(1, 0.9, "Ann Lee", "Ann@Example.com", "5550001234"), (2, 0.1, "B", "b@x.y", "1")], "id int, p double, customer_name string, email string, phone string")
    alerts = row_alerts(df, F.col("p") > 0.5, ["id", "p"], {"customer_name": "name", "email": "email", "phone": "phone", "ssn": "ssn"})
    assert alerts.columns == ["id", "p", "customer_name_masked", "email_masked", "phone_masked"]
    (row,) = alerts.collect()
    assert row["email_masked"] == "a***@example.com" and row["phone_masked"] == "******1234" and "Ann" not in row["customer_name_masked"]


def test_published_rows_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id int, score double")
    stored = publish(df, str(tmp_path / "scored"))
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()


def separable(spark, n=600):
    rows = [(i, float(i % 20), float(i % 7), 1.0 if i % 20 >= 10 else 0.0) for i in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double, label double")


def test_split_is_stable_and_complete(spark, rows):
    df = separable(spark)
    train, test = ml.split(df, ["id"], (0.8, 0.2))
    again, _ = ml.split(df.repartition(5), ["id"], (0.8, 0.2))
    assert rows(train, "id") == rows(again, "id")
    assert train.count() + test.count() == 600 and 400 < train.count() < 560


def test_models_learn_a_separable_rule(spark):
    df = ml.assemble(separable(spark), ["a", "b"])
    train, test = ml.split(df, ["id"], (0.8, 0.2))
    forest = ml.fit_rf(train, "label", trees=5, depth=3)
    assert ml.accuracy(forest.transform(test), "label").first()["accuracy"] == 1.0
    scores = ml.score(forest, test, ["id"]).collect()
    assert all(r["approved"] == (r["risk_prob"] < 0.5) for r in scores)
    boosted = ml.fit_gbt_classifier(train, "label", iterations=3, depth=2)
    assert ml.accuracy(boosted.transform(test), "label").first()["accuracy"] == 1.0
    clusters = ml.fit_kmeans(df.filter("a in (0, 19)"), 2).transform(df.filter("a in (0, 19)"))
    assert clusters.groupBy("a").agg(F.countDistinct("prediction").alias("n")).filter("n > 1").isEmpty()


def test_a_forest_scores_in_a_session_that_has_observed_rows(spark):
    """An observation stays in the session; a model that holds the session could not be sent to the tasks any more."""
    seen, n = counted(spark.range(7))
    assert seen.count() == 7 and n() == 7
    df = ml.assemble(separable(spark), ["a", "b"])
    forest = ml.fit_rf(df, "label", trees=2, depth=2)
    assert not forest.hasSummary and len(forest.trees) == 2
    assert len(ml.score(forest, df, ["id"]).collect()) == 600


def test_scores_do_not_depend_on_the_session(spark, monkeypatch):
    """The same model from other layouts and shuffle widths, with more partitions than the shuffle has."""
    monkeypatch.setattr(ml, "_ROWS_PER_PARTITION", 60)
    df = separable(spark).withColumn("label", F.when(F.col("id") % 11 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    found = []
    for width, parts in (("4", 3), ("64", 17)):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        train = ml.assemble(df.repartition(parts), ["a", "b"])
        model = ml.fit_rf(train, "label", trees=7, depth=4)
        found.append([r["risk_prob"] for r in ml.score(model, ml.assemble(df, ["a", "b"]), ["id"]).orderBy("id").collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_a_forests_partitions_grow_slower_than_its_rows(spark, monkeypatch):
    """Its shuffles grow with the square of the partitions. All rows are there, few rows are dealt as ever, and other trainers too."""
    monkeypatch.setattr(ml, "_ROWS_PER_PARTITION", 2)
    monkeypatch.setattr(ml, "_FOREST_PARTITIONS", 4, raising=False)
    widths = []

    class Trainer:
        def __init__(self, **params):
            pass

        def fit(self, rows):
            widths.append((rows.count(), rows.rdd.getNumPartitions()))
            return self

        def copy(self):
            return self

    monkeypatch.setattr(ml, "RandomForestClassifier", Trainer)
    monkeypatch.setattr(ml, "KMeans", Trainer)
    for n in (1, 8, 32, 128):
        ml.fit_rf(ml.assemble(separable(spark, n), ["a", "b"]), "label")
    assert widths == [(1, 1), (8, 4), (32, 8), (128, 16)]
    ml.fit_kmeans(ml.assemble(separable(spark, 32), ["a", "b"]), 2)
    assert widths[-1] == (32, 16)


def test_a_forest_of_many_partitions_does_not_depend_on_the_layout(spark, monkeypatch):
    """Beyond the number from which partitions grow slower as well."""
    monkeypatch.setattr(ml, "_ROWS_PER_PARTITION", 20)
    monkeypatch.setattr(ml, "_FOREST_PARTITIONS", 4, raising=False)
    df = separable(spark).withColumn("label", F.when(F.col("id") % 11 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    found = []
    for parts in (3, 17):
        model = ml.fit_rf(ml.assemble(df.repartition(parts), ["a", "b"]), "label", trees=7, depth=4)
        found.append([r["risk_prob"] for r in ml.score(model, ml.assemble(df, ["a", "b"]), ["id"]).orderBy("id").collect()])
    assert found[0] == found[1] and len(found[0]) == 600


def test_training_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    def missing(_):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")

    monkeypatch.setattr(ml, "require_checkpoint_dir", missing)
    with pytest.raises(RuntimeError, match="checkpoint"):
        ml.fit_rf(ml.assemble(separable(spark), ["a", "b"]), "label", trees=1, depth=1)


def test_nearest_centre(spark):
    df = ml.assemble(spark.createDataFrame([(0.0, 0), (9.0, 1), (9.0, 0)], "a double, prediction int"), ["a"])
    assert [r["nearest"] for r in ml.nearest_centre(df, [[1.0], [8.0]]).collect()] == [True, True, False]


def test_condensed_training_equals_full_training(spark):
    # Irregular labels, so that no two splits are equally good.
    df = separable(spark).withColumn("y", F.col("a") * 3 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100)
    full = ml.fit_gbt_regressor(ml.assemble(df, ["a", "b"]), "y", iterations=4)
    small = ml.condense(df, ["a", "b"], "y")
    assert small.count() == 140
    condensed = ml.fit_gbt_regressor(ml.assemble(small, ["a", "b"]), "y", iterations=4, weight="weight")
    features = ml.assemble(df, ["a", "b"])
    left = [r["prediction"] for r in full.transform(features).orderBy("id").collect()]
    right = [r["prediction"] for r in condensed.transform(features).orderBy("id").collect()]
    assert left == pytest.approx(right, rel=1e-6)


def claims_like(spark, n):
    """Few combinations of bins, a feature with many values and irregular labels, so that no two splits are equally good."""
    df = spark.range(n).select(
        "id", (F.col("id") % 5).cast("double").alias("a"), F.lit(3).alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7).alias("c"),
    )
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) == 0
    return df.withColumn("label", (((F.col("a") > 2) & (F.col("c") < 9000)) != noise).cast("double"))


def test_training_on_bins_equals_training_on_rows(spark):
    df = claims_like(spark, 3000)
    full = ml.fit_gbt_classifier(ml.assemble(df, ["a", "b", "c"]), "label", iterations=2, depth=3)
    model, features = ml.fit_binned_gbt_classifier(df, ["a", "b", "c"], "label", iterations=2, depth=3)
    left = ml.predictions(full, ml.assemble(df, ["a", "b", "c"]), ["id"]).orderBy("id").collect()
    right = ml.predictions(model, features(df), ["id"]).orderBy("id").collect()
    assert len(right) == 3000 and [r["prediction"] for r in left] == [r["prediction"] for r in right]
    assert [r["probability"] for r in left] == pytest.approx([r["probability"] for r in right], rel=1e-9)


@pytest.mark.parametrize("counted_values", [10_000, 10])
def test_trees_grow_over_bins_however_many_rows_there_are(spark, monkeypatch, counted_values):
    """Five values, one value and 32 bins, in two classes; with the values counted and from a sketch."""
    monkeypatch.setattr(ml, "_COUNTED_VALUES", counted_values)
    grown = []
    monkeypatch.setattr(ml, "fit_gbt_classifier", lambda train, label, **params: grown.append(train))
    df = claims_like(spark, 20_000).withColumn("c", F.when(F.col("id") < 19_990, F.col("c")).otherwise(1e9))
    _, features = ml.fit_binned_gbt_classifier(df, ["a", "b", "c"], "label")
    assert grown[0].count() <= 5 * ml.BINS * 2 and grown[0].agg(F.sum("weight")).first()[0] == 20_000
    sizes = [r["count"] for r in features(df).groupBy("_bin_c").count().collect()]
    assert len(sizes) == ml.BINS and max(sizes) < 1.1 * 20_000 / ml.BINS
    assert features(df).select("_bin_a").distinct().count() == 5


def test_cuts_lie_between_neighbours():
    assert ml.cuts_of_counts({}) == ml.cuts_of_counts({2.0: 9}) == []
    assert ml.cuts_of_counts({3.0: 1, 1.0: 50, 2.0: 1}) == [1.5, 2.5]
    assert ml.cuts_of_counts({float(v): 1 for v in range(8)}, 4) == [1.5, 3.5, 5.5]


def test_rows_without_a_feature_are_refused(spark):
    df = claims_like(spark, 50).withColumn("c", F.when(F.col("id") > 0, F.col("c")))
    with pytest.raises(Exception, match="null"):
        ml.fit_binned_gbt_classifier(df, ["a", "c"], "label", iterations=1, depth=1)
