import random

from pyspark.sql import functions as F

from tallymark.llm import token_counts
from tallymark.llm.common import scratch_path
from tallymark.llm.queries import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


def strange_texts(n=300):
    rng = random.Random(3)
    pool = list("abcXYZ  \t\n\r\x0b\x0c.,'0129éÉßñ́  ​\x1c\x85中文👍🏽ΣςİıⅨ½ﬁ") + [
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "don't ", "the ", " and",
    ]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 60))) for _ in range(n)] + ["", " \n ", "word " * 30_000, "x" * 9_000]


def library(texts):
    return [len(e.ids) for e in token_counts.tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]


def test_equals_library(spark, documents):
    texts = strange_texts()
    rows = token_counts.report(documents(*enumerate(texts)), PATH).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == library(texts)
    assert [r["n_bytes"] for r in rows] == [len(t.encode()) for t in texts]
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)


def test_cache_encodes_only_misses(spark, documents):
    cache = token_counts.new_cache(spark, scratch_path(spark, "cache"))
    first = documents((1, "one two"), (2, "one  two "), (3, "three"), (4, None), (None, "three"))
    assert {(r["doc_id"], r["n_tokens"]) for r in token_counts.token_counts(first, PATH, cache).collect()} == {
        (1, 2), (2, 2), (3, 1), (4, 0), (None, 1),
    }
    stored = spark.read.parquet(cache)
    assert stored.count() == 3
    # A count planted for a known text is used, so the text is not encoded again; a new one is appended.
    planted = stored.withColumn("n_tokens", F.lit(7).cast("long")).withColumn("tokenizer", F.lit("other version"))
    planted.write.mode("append").parquet(cache)
    again = token_counts.token_counts(documents((9, "four"), (8, "one two"), (8, "one two")), PATH, cache).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in again) == [(8, 2), (8, 2), (9, 1)]
    assert spark.read.parquet(cache).filter(F.col("tokenizer") != "other version").count() == 4


def test_empty_table(spark, documents):
    assert token_counts.report(documents(), PATH).count() == 0
