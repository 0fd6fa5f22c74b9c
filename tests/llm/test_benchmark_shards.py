"""The benchmark in shards: bounded, written to the shared folder, and neither in the plan nor in the driver."""

import random

import pyarrow as pa

from tallymark.llm import decontaminate as d
from tests.llm.test_decontaminate import brute


def items_of(spark, n, seed=5):
    rng = random.Random(seed)
    items = [(i, " ".join(f"w{rng.randrange(3_000)}" for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    return items, spark.createDataFrame(items, "item_id long, text string")


def written(spark, made):
    return spark.read.schema("name string, words binary, shard string").parquet(made.path).collect()


def test_shards_are_bounded_and_hold_all(spark):
    items, bench = items_of(spark, 300)
    made = d.shards(bench, 13, 100)
    rows = written(spark, made)
    sizes = {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + len(r["words"].split())
    assert sorted(sizes) == made.names and len(sizes) > 50
    assert max(sizes.values()) <= 100
    assert sorted((r["name"], r["words"].decode()) for r in rows) == sorted((str(i), t) for i, t in items if t)


def test_one_item_on_many_rows_is_kept_once(spark):
    bench = spark.createDataFrame([(1, "a b c d")] * 400 + [(2, "a b c d")], "item_id long, text string")
    assert len(written(spark, d.shards(bench, 3, 6))) == 2


def test_many_shards_equal_brute_force(spark, documents):
    items, bench = items_of(spark, 120)
    rng = random.Random(9)
    docs = []
    for i in range(90):
        words = [f"w{rng.randrange(3_000)}" for _ in range(rng.randrange(0, 50))]
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join([*words[:at], *rng.choice(items)[1].split()[: rng.randrange(60)], *words[at:]])))
    docs += [(200, None), (201, ""), (202, " ".join(t for _, t in items))]
    assert len(d.shards(bench, 5, 60).names) > 30
    got = d.report(documents(*docs), bench, 5, 60).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, items, 5))


def test_no_item_text_in_the_plan(spark, documents):
    """The function that goes to the tasks is as small for a large benchmark as for a small one."""
    from pyspark import cloudpickle

    def closure(n):
        made = d.shards(items_of(spark, n)[1], 13, 100_000)
        return len(cloudpickle.dumps(d._matcher(made, 13, d.Names())))

    assert abs(closure(2_000) - closure(20)) < 200


def test_documents_are_held_in_bounded_parts():
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * 1_000]}) for _ in range(10)]
    parts = list(d.held_together(iter(batches), 2_500))
    assert [len(p) for p in parts] == [3, 3, 3, 1]
