"""Draws the documents that look most like a target, with weights from hashed word runs and exact lots.

1. The features of both corpora are counted in ``BUCKETS`` buckets, in arrays inside the tasks; what a bucket gains is
   the logarithm of its share in the target over its share in the documents. The array of gains has a fixed size.
2. A document's weight is the sum of the gains of its features; its score adds a lot (Gumbel noise from a hash of its id),
   so that the highest scores are a weighted sample without replacement. Scores are written once, without texts.
3. The score to be drawn last is found by selection, not by sorting all. The rows that remain are cut into groups of at
   most ``GROUP`` rows where they lie; the medians of the groups, weighted by their sizes, have a median; the rows on
   one side of it are counted and go. That is at least a quarter in every round. What has gone is filtered out and, once
   enough has, not stored. The driver sees one row per group. When at most ``FEW`` different rows are left, they are
   sorted at once. The cutoff is exact: score, then id.
4. Equal winners are counted and the winners sorted by ranges; the ranges' sums give the ranks.

Edge cases: a null text has no words, weight 0 and no feature, and is not drawn (fewer than ``min_words``); texts of
any length are read whole. A null id has the lot of the empty id and comes after all ids at equal scores. Rows with equal
id and text are documents of their own and take one rank each; with equal ids and scores, fewer features come first.
An empty table gives an empty result, an empty target gains as the formula says. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, stage
from tallymark.llm.word_features import features_of, words_of

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 5, 20, 42
GROUP, FEW = 1 << 18, 1 << 16
# Copies of one winner that a row is unfolded to at once.
COPIES = 100_000

ROWS = ["doc_id", "n_words", "n_features", "weight", "score"]


def _texts(docs: DataFrame, *others: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return in_batches(docs.select(*[F.col(c).cast("long") for c in others], text))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all whole texts by bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for f in features_of(words_of(batch.column("text"))):
                for hashes in (f.one, f.two[f.has_two], f.three[f.has_three]):
                    held += np.bincount(hashes % buckets, minlength=buckets)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(held[seen], pa.int64())], ["bucket", "n"])

    counted = _texts(docs).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the documents."""
    many, wanted = float(documents.sum() + len(documents)), float(target.sum() + len(target))
    ratio = lambda s, t: float(t + 1) * many / (float(s + 1) * wanted)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(documents.tolist(), target.tolist())], dtype=np.int64)


def lot(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate that follows from the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    schema = pa.schema([(n, pa.int64()) for n in ROWS[:-1]])

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column("text"))
            gained = np.zeros(len(words.starts) + 1, dtype=np.int64)
            for f in features_of(words):
                of = lambda hashes: gain[hashes % len(gain)]
                gained[1:][f.at] = of(f.one) + of(f.two) * f.has_two + of(f.three) * f.has_three
            upto, n = np.cumsum(gained), np.diff(words.first)
            features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
            columns = [batch.column("doc_id"), n, features, upto[words.first[1:]] - upto[words.first[:-1]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return _texts(docs, "doc_id").mapInArrow(weigh, ", ".join(f"{n} long" for n in ROWS[:-1]))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Weight and score of every document, written once."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    return stage(weights(docs, gain).withColumn("score", F.col("weight") + lot(F.col("doc_id"), seed)), "resampling")


class Key(NamedTuple):
    """Place of a row in the order of drawing: smaller is earlier."""

    minus_score: int
    no_id: int
    doc_id: int
    n_features: int


KEY = list(Key._fields)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "minus_score": -F.col("score"),
            "no_id": F.col("doc_id").isNull().cast("long"),
            "doc_id": F.coalesce("doc_id", F.lit(0).cast("long")),
        }
    )


def _before(key: Key) -> Column:
    """The row comes before ``key``."""
    here, there = F.struct(*KEY), F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(KEY, key)])
    # The first column alone lets the scan skip what is far off.
    return (F.col("minus_score") <= key.minus_score) & (here < there)


def _after(key: Key) -> Column:
    here, there = F.struct(*KEY), F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(KEY, key)])
    return (F.col("minus_score") >= key.minus_score) & (here > there)


def group_medians(rows: DataFrame, group: int = GROUP) -> list[tuple[Key, int]]:
    """Median and size of each group of at most ``group`` rows, cut where the rows lie."""
    schema = pa.schema([(n, pa.int64()) for n in [*KEY, "size"]])

    def medians(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def settle() -> pa.RecordBatch:
            keys = np.concatenate(held, axis=1)
            middle = keys[:, np.lexsort(keys[::-1])[keys.shape[1] // 2]]
            return pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in [*middle, keys.shape[1]]], schema=schema)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in KEY])
            while keys.shape[1]:
                take = keys[:, : group - n]
                held.append(take)
                n, keys = n + take.shape[1], keys[:, take.shape[1] :]
                if n == group:
                    yield settle()
                    held, n = [], 0
        if n:
            yield settle()

    found = rows.select(*KEY).mapInArrow(medians, ", ".join(f"{f.name} long" for f in schema))
    return [(Key(*row[:4]), row["size"]) for row in found.collect()]


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first median with at least half of the weight up to it."""
    half, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += 2 * n
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(rows: DataFrame, k: int, group: int = GROUP, few: int = FEW) -> Key:
    """The key of the row drawn as number ``k``; there are at least ``k`` rows, with columns ``KEY``."""
    stored = None
    while True:
        medians = group_medians(rows, group)
        left = sum(n for _, n in medians)
        stored = left if stored is None else stored
        if 4 * left <= stored:
            rows, stored = stage(rows.select(*KEY), "resampling"), left
        if left <= few:
            for row in rows.groupBy(*KEY).count().orderBy(*KEY).collect():
                k -= row["count"]
                if k <= 0:
                    return Key(*row[:4])
        pivot = weighted_median(medians)
        counted = rows.agg(F.count_if(_before(pivot)).alias("before"), F.count_if(_after(pivot)).alias("after")).first()
        if k <= counted["before"]:
            rows = rows.filter(_before(pivot))
        elif k <= left - counted["after"]:
            return pivot
        else:
            k -= left - counted["after"]
            rows = rows.filter(_after(pivot))


def ranked(winners: DataFrame, k: int, copies: int = COPIES) -> DataFrame:
    """Ranks 1 to ``k`` by key; equal rows, counted first, take one rank each, and those beyond ``k`` none."""
    columns = [*ROWS, "minus_score", "no_id"]
    counted = winners.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    ranges = counted.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("place", F.monotonically_increasing_id())
    sorted_rows = stage(ranges, "resampling")
    task = F.shiftrightunsigned("place", 33)
    sizes = sorted_rows.groupBy(task.alias("task")).agg(F.sum("copies").alias("n"), F.max("copies").alias("most"))
    upto, offsets, most = 0, [], 0
    for row in sizes.orderBy("task").collect():  # one row per range
        offsets.append((row["task"], upto))
        upto, most = upto + row["n"], max(most, row["most"])
    spark = winners.sparkSession
    starts = F.broadcast(spark.createDataFrame(offsets, "task long, start long"))
    earlier = Window.partitionBy("task").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = sorted_rows.withColumn("task", task).withColumn("inside", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    rows = placed.join(starts, "task").withColumn("start", F.col("start") + F.col("inside"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(copies).cast("long"))))
    if most > copies:
        rows = rows.repartition("place", "part")
    last = F.least(F.col("part") + copies, F.col("copies")) - 1
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("part"), last)))
    rank = F.col("start") + F.col("copy") + 1
    return rows.withColumn("rank", F.when(rank <= k, rank))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
    seed: int = SEED, group: int = GROUP, few: int = FEW, copies: int = COPIES,
) -> DataFrame:
    """Every document with weight and score; ``percent`` of those with at least ``min_words`` words have a rank."""
    rows = _keyed(scored(docs, target, buckets, seed))
    can = F.col("n_words") >= min_words
    k = percent * rows.filter(can).count() // 100
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    real_id = lambda df: df.withColumn("doc_id", F.when(F.col("no_id") == 0, F.col("doc_id")))
    no_rank = F.lit(None).cast("long")
    if k == 0:
        return real_id(rows).withColumn("rank", no_rank).select(*out)
    beyond = _after(cutoff(rows.filter(can), k, group, few))
    drawn = ranked(rows.filter(can & ~beyond), k, copies)
    return real_id(drawn).select(*out).unionByName(real_id(rows.filter(~can | beyond)).withColumn("rank", no_rank).select(*out))
