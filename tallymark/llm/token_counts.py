"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count). A text is known by the SHA-256 of its
normalised content (runs of white space as one blank, none at the ends, which this tokenizer family drops anyway),
the tokenizer by the SHA-256 of its file, so another version never reads old counts. Digests are joined to the
cache, only distinct misses are encoded, and their counts are appended. Copies are merged map-side before the
shuffle, so a hot text is one row per task.

Inside a task the library encodes each distinct run of non-space characters once: the tokenizer never joins
characters across white space, so the counts of the runs add up to the count of the text.

Edge cases: a null text is the empty text with 0 tokens and 0 bytes; texts of any length are counted whole; repeated
rows give one row each; an empty table gives an empty result and leaves the cache as it is; columns other than
doc_id and text are not read. A repeated append of the same counts does no harm: the cache is read by distinct key.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, SPACE_CLASS, in_batches, scratch_path, texts

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
# Runs that a worker remembers with their counts, and the longest that it does, in bytes.
REMEMBERED, LONGEST = 500_000, 64


@functools.cache
def tokenizer(path: str):
    # A task has one core; the library's own threads would also keep memory of their own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class RunCounts:
    """Counts of the runs seen lately: a new and an old generation, each of at most about ``REMEMBERED`` runs."""

    def __init__(self, path: str):
        self.path = path
        self.new: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def know(self, runs: set[bytes]) -> None:
        """Have a count for each of the runs in ``new``."""
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        missing = [w for w in runs if w not in self.new]
        unseen = [w for w in missing if w not in self.old]
        self.new.update((w, self.old[w]) for w in missing if w in self.old)
        for i in range(0, len(unseen), 50_000):
            part = unseen[i : i + 50_000]
            encoded = tokenizer(self.path).encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self.new.update(zip(part, map(len, encoded)))

    def totals(self, contents: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [t.encode().split() for t in contents]
        runs = set().union(*split)
        self.know(runs)
        out = [sum(map(self.new.__getitem__, words)) for words in split]
        for run in [w for w in runs if len(w) > LONGEST]:
            del self.new[run]
        return out


@functools.cache
def run_counts(path: str) -> RunCounts:
    """Kept by the worker process for all its tasks."""
    return RunCounts(path)


def encoder(path: str):
    def run(batches: Iterable[pa.RecordBatch]):
        known = run_counts(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = known.totals(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def new_cache(spark: SparkSession, path: str) -> str:
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return path


def cached_counts(spark: SparkSession, cache: str, tokenizer_digest: str) -> DataFrame:
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == tokenizer_digest)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def content_digest(text):
    blank = F.regexp_replace(text, SPACE_CLASS + "+", " ")
    return F.unhex(F.sha2(F.trim(blank, F.lit(SPACE)), 256))


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row. ``cache`` is a table in the shared folder and gains the misses."""
    spark, digest = docs.sparkSession, version(tokenizer_path)
    known = texts(docs).withColumn("content", content_digest(F.col("text")))
    distinct = known.groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(cached_counts(spark, cache, digest).select("content"), "content", "left_anti")
    encoded = in_batches(misses.select("content", "text")).mapInArrow(encoder(tokenizer_path), "content binary, n_tokens long")
    encoded.select("content", F.lit(digest).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    rows = known.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return rows.join(cached_counts(spark, cache, digest), "content").select("doc_id", "n_bytes", "n_tokens")


def report(docs: DataFrame, tokenizer_path: str, limit: int = 2048, cache: str | None = None) -> DataFrame:
    """Counts, and whether a text is over the limit. Without a cache of its own the call starts an empty one."""
    cache = cache or new_cache(docs.sparkSession, scratch_path(docs.sparkSession, "token-cache"))
    counted = token_counts(docs, tokenizer_path, cache)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
