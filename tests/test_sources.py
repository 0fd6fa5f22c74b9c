import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators.registry import REGISTRY_SCHEMA
from tallymark.plans.scoring.energy import SENSOR_SCHEMA, grid_features
from tallymark.sources import readers, writers
from tallymark.streaming.incremental import score_new_files


def test_tables_round_trip(spark, rows):
    writers.ensure_database(spark, "layer")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, kind string")
    writers.write_table(df, "layer.things", ["kind"])
    writers.write_table(df.withColumn("extra", F.lit(1)), "layer.things", ["kind"])
    assert rows(readers.read_table(spark, "layer.things"), "id", "kind", "extra") == [(1, "a", 1), (2, "b", 1)]
    with pytest.raises(ValueError):
        readers.read_table(spark, " ")
    with pytest.raises(ValueError):
        writers.write_table(df, "")


def test_validated_write_refuses_empty_rows(spark):
    df = spark.range(5)
    with pytest.raises(ValueError):
        writers.write_validated(df.filter("id > 9"), "checked")
    writers.write_validated(df, "checked")
    assert spark.table("checked").count() == 5


def test_rejected_rows_are_appended_only_if_any(spark):
    df = spark.range(3)
    assert not writers.append_rejected(df.filter("id > 9"), "rejected")
    assert not spark.catalog.tableExists("rejected")
    assert writers.append_rejected(df, "rejected") and writers.append_rejected(df, "rejected")
    assert spark.table("rejected").count() == 6


def test_path_is_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_path(spark.range(3), path)
    writers.write_path(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_registry_rows(spark):
    row = dict.fromkeys(REGISTRY_SCHEMA.names)
    row.update(project_name="p", file_names=["f"], selected_rules=[1, 2], is_active=True, created_at=datetime(2024, 1, 1))
    for _ in range(2):
        writers.append_rows(spark, [tuple(row.values())], REGISTRY_SCHEMA, "job_registry")
    stored = spark.table("job_registry")
    assert stored.count() == 2 and stored.select(F.explode("selected_rules")).count() == 4


class RecordingReader:
    """Stands in for a session's reader, since no database runs here: keeps the options, returns fixed rows."""

    def __init__(self, df):
        self.df, self.fmt, self.seen = df, None, {}
        self.read = self

    def format(self, fmt):
        self.fmt = fmt
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.df


def test_jdbc_read_is_partitioned_and_filtered(spark, rows):
    df = spark.createDataFrame([(i, "auto" if i % 2 else "home", float(i)) for i in range(6)], "id int, kind string, amount double")
    reader = RecordingReader(df)
    part = readers.JdbcPartition("id", "0", "10", 3)
    got = readers.read_jdbc(reader, "jdbc:x:y", "claims", ["id", "amount"], F.col("kind") == "auto", part, fetchsize="100")
    assert rows(got, "id", "amount") == [(1, 1.0), (3, 3.0), (5, 5.0)] and got.columns == ["id", "amount"]
    assert reader.fmt == "jdbc" and reader.seen == {
        "url": "jdbc:x:y", "dbtable": "claims", "fetchsize": "100", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "10", "numPartitions": "3",
    }
    assert readers.read_jdbc(reader, "u", "claims", ["id"], F.col("kind") == "x' OR '1'='1").isEmpty()


def sensor_lines(path, *ids):
    path.mkdir(exist_ok=True)
    lines = [json.dumps({"sensor_id": i, "voltage": 252.0, "current": 500.0, "frequency": 50.0}) for i in ids]
    (path / f"{'-'.join(ids)}.json").write_text("\n".join(lines))


def test_json_with_schema(spark, tmp_path):
    sensor_lines(tmp_path / "in", "s1")
    df = readers.read_json(spark, str(tmp_path / "in"), SENSOR_SCHEMA)
    assert df.schema == SENSOR_SCHEMA
    scored = grid_features(df).first()
    assert (scored["voltage_deviation"], scored["overload_flag"], scored["temp_flag"]) == (0.05, 1, 0)
    assert scored["risk_index"] == pytest.approx(5.15)


def test_new_files_are_scored_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")

    def run():
        query = score_new_files(spark, str(source), SENSOR_SCHEMA, grid_features, target, str(tmp_path / "state"))
        assert query.awaitTermination(120)

    sensor_lines(source, "s1", "s2")
    run()
    sensor_lines(source, "s3")
    run()
    run()
    assert sorted(r["sensor_id"] for r in spark.read.parquet(target).collect()) == ["s1", "s2", "s3"]


def test_sql_over_leaves_no_views(spark):
    df = spark.range(4)
    assert readers.sql_over(spark, {"v": df}, "SELECT sum(id) AS s FROM {v}").first()["s"] == 6
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]
