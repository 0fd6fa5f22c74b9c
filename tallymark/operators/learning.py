"""Training and batch scoring with Spark's machine-learning library."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.session import require_checkpoint_dir

# Fixed values of the trainers.
SEED = 42
FOREST_TREES = 100
FOREST_DEPTH = 10
REGRESSOR_ITERATIONS = 100
CLASSIFIER_ITERATIONS = 50
CLASSIFIER_DEPTH = 8

# Fixed values of the split: a prime number of buckets, a multiplier per key column, and the scale of non-integers.
SPLIT_BUCKETS = 1_000_003
SPLIT_FACTORS = (69_621, 48_271, 39_373, 16_807)
SPLIT_SCALE = 100
# Boosting adds a step to the lineage in every round; it is cut this often where a checkpoint folder is set.
_CHECKPOINT_EVERY = 10
# Bins of a feature, as the tree trainers cut them by default; up to so many distinct values of a feature are counted one by one,
# of others a sketch of all rows gives the quantiles, by this accuracy.
BINS = 32
_COUNTED_VALUES = 10_000
_SKETCH_ACCURACY = 10_000
# Below this, more partitions cost a trainer more in task starts than they save.
_ROWS_PER_PARTITION = 20_000
# At every depth of a forest each partition sends the sums of all its nodes to as many partitions again, so partitions in step with
# the rows would let the shuffles grow with the square of the rows. From this number on they grow with the square root of the rows.
_FOREST_PARTITIONS = 64


def assemble(df: DataFrame, cols: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """Feature vector; ``handle_invalid`` says whether NULLs raise, are skipped or are kept as NaN."""
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid=handle_invalid).transform(df)


def split_bucket(df: DataFrame, key: Sequence[str], seed: int = SEED) -> Column:
    """A bucket by whole-number arithmetic on the key columns, which any engine can repeat; NULL counts as 0."""
    total = F.lit(seed)
    for name, factor in zip(key, SPLIT_FACTORS, strict=False):
        whole = isinstance(df.schema[name].dataType, T.IntegralType)
        number = F.col(name).cast("long") if whole else F.round(F.col(name).cast("double") * SPLIT_SCALE).cast("long")
        total = total + F.pmod(F.coalesce(number, F.lit(0)), F.lit(SPLIT_BUCKETS)) * factor
    return F.pmod(total, F.lit(SPLIT_BUCKETS))


def split_cut(weights: tuple[float, float]) -> int:
    return int(SPLIT_BUCKETS * weights[0] / sum(weights))


def split(df: DataFrame, key: Sequence[str], weights: tuple[float, float], seed: int = SEED):
    """Train and test rows by the bucket of the key: the same row goes the same way in every run and layout."""
    bucket, cut = split_bucket(df, key, seed), split_cut(weights)
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def condense(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One row per distinct feature combination with its mean label and number of rows.

    A squared-error tree only uses sums of labels and weights, so training on this weighted table finds equally
    good splits, while its size depends on the number of combinations and not on the number of rows.
    """
    return df.groupBy(*cols).agg(F.avg(label).alias(label), F.count(label).cast("double").alias("weight"))


def condense_classes(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One row per distinct feature combination and class with its number of rows, for the same reason as ``condense``."""
    return df.groupBy(*cols, label).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def cuts_of_counts(counts: Mapping[float, int], bins: int = BINS) -> list[float]:
    """Where a tree trainer cuts the values of a feature: between all neighbours if they are few, else at steps of equal weight."""
    values = sorted(counts)
    between = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if len(between) < bins:
        return between
    stride = sum(counts.values()) / bins
    cuts, target, seen = [], stride, counts[values[0]]
    for at, value in enumerate(values[1:]):
        before, seen = seen, seen + counts[value]
        if abs(before - target) < abs(seen - target):
            cuts.append(between[at])
            target += stride
    return cuts


def bin_cuts(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Cut points of each feature, at most ``bins`` - 1, from all rows; missing values do not count.

    The values of a feature with few of them are counted; of the others, one sketch per feature gives the quantiles. What comes
    to the driver is bounded by ``_COUNTED_VALUES`` and does not grow with the rows.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    kinds = numbers.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    few = [c for c in cols if kinds[c] <= _COUNTED_VALUES]
    many = [c for c in cols if kinds[c] > _COUNTED_VALUES]
    counts: dict[str, dict[float, int]] = {c: {} for c in few}
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in few])).alias("pair")
        for name, value, n in numbers.select(pairs).groupBy("pair.name", "pair.value").count().collect():
            if value is not None:
                counts[name][value] = n
    cuts = {c: cuts_of_counts(counts[c], bins) for c in few}
    if many:
        shares = [i / bins for i in range(1, bins)]
        found = numbers.agg(*[F.percentile_approx(c, shares, _SKETCH_ACCURACY).alias(c) for c in many]).first()
        cuts |= {c: sorted(set(found[c])) for c in many}
    return cuts


def binned(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> tuple[DataFrame, list[str]]:
    """Adds the number of the bin of each feature, and names these columns; a value at a cut goes up.

    The numbers lose their mark as categories, so that trees split them in order, as they would split the values.
    """
    names = [f"_bin_{c}" for c in cuts]
    splits = [[-math.inf, *points, math.inf] for points in cuts.values()]
    # One bin only: the trainer has no use for the feature, but its place stays.
    splits = [s if len(s) > 2 else [-math.inf, 0.0, math.inf] for s in splits]
    rows = Bucketizer(splitsArray=splits, inputCols=list(cuts), outputCols=names).transform(df)
    return reduce(lambda out, name: out.withMetadata(name, {}), names, rows), names


def _width(rows: int, straight: float = math.inf) -> int:
    """Partitions for so many rows: in step with the rows up to ``straight``, with their square root from there."""
    width = max(1, math.ceil(rows / _ROWS_PER_PARTITION))
    return width if width <= straight else math.ceil(math.sqrt(width * straight))


def _fit(estimator, train: DataFrame, *columns: str, straight: float = math.inf):
    """Fit on the needed columns only, computed once, in partitions that follow from the rows alone.

    The number of partitions follows from the number of rows, without a limit (``_width``), and rows are placed and
    ordered by their hashes, so the model does not depend on session settings or on the layout of the input. The
    trainers pass over their input many times, and several of these passes would go back to the source. The kept
    rows spill to disk, and lost ones are computed again.
    """
    require_checkpoint_dir(train.sparkSession)
    place = F.xxhash64(*[vector_to_array(c) if c == "features" else F.col(c) for c in columns])
    rows = train.select(*columns, place.alias("_place")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        width = _width(rows.count(), straight)
        return estimator.fit(rows.repartition(width, "_place").sortWithinPartitions("_place").drop("_place"))
    finally:
        rows.unpersist()


def fit_rf(train: DataFrame, label: str, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, **params):
    """The copy leaves the training summary behind: it holds the session, which cannot be sent to the tasks once a row
    count has been observed in it."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=SEED, **params
    )
    return _fit(forest, train, "features", label, straight=_FOREST_PARTITIONS).copy()


def fit_gbt_regressor(
    train: DataFrame, label: str, iterations: int = REGRESSOR_ITERATIONS, weight: str | None = None, **params
):
    boosted = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxIter=iterations,
        seed=SEED,
        checkpointInterval=_CHECKPOINT_EVERY,
        **({"weightCol": weight} if weight else {}),
        **params,
    )
    return _fit(boosted, train, "features", label, *([weight] if weight else []))


def fit_gbt_classifier(
    train: DataFrame, label: str, iterations: int = CLASSIFIER_ITERATIONS, depth: int = CLASSIFIER_DEPTH,
    weight: str | None = None, **params,
):
    boosted = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        maxIter=iterations,
        maxDepth=depth,
        seed=SEED,
        checkpointInterval=_CHECKPOINT_EVERY,
        **({"weightCol": weight} if weight else {}),
        **params,
    )
    return _fit(boosted, train, "features", label, *([weight] if weight else []))


def fit_binned_gbt_classifier(train: DataFrame, cols: Sequence[str], label: str, **params):
    """A boosted classifier of all rows by their bins, and a function that assembles the features of other rows for it.

    A tree only sees in which of its bins a value lies, so the rows of a combination of bins and a class are one weighted row.
    Trees grow over these, whose number depends on the bins and the features and not on the rows.
    """
    kept = train.select(*cols, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cuts = bin_cuts(kept, cols)
        rows, names = binned(kept, cuts)
        condensed = condense_classes(rows, names, label)
        model = fit_gbt_classifier(assemble(condensed, names), label, weight="weight", **params)
    finally:
        kept.unpersist()
    return model, lambda df: assemble(binned(df, cuts)[0], names)


def fit_kmeans(train: DataFrame, k: int, seed: int = SEED, **params):
    return _fit(KMeans(k=k, seed=seed, featuresCol="features", **params), train, "features")


def score(model, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Approval flag and risk probability per key, computed where the rows are."""
    return model.transform(df).select(
        *keys,
        (F.col("prediction") == 0).alias("approved"),
        vector_to_array("probability")[1].alias("risk_prob"),
    )


def predictions(model, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, prediction and, of a classifier, the probability of class 1, computed where the rows are."""
    found = model.transform(df)
    more = [vector_to_array("probability")[1].alias("probability")] if "probability" in found.columns else []
    return found.select(*keys, "prediction", *more)


def accuracy(predicted: DataFrame, label: str) -> DataFrame:
    """Share of rows whose prediction equals the label, in one pass."""
    return predicted.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))


def nearest_centre(clustered: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Adds ``nearest``: no other centre is closer to the row than that of its cluster."""
    x = vector_to_array("features")
    distance = lambda c: F.aggregate(
        F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )
    distances = F.array(*[distance(c) for c in centres])
    best = F.array_min(distances)
    return clustered.withColumn("nearest", F.element_at(distances, F.col("prediction") + 1) <= best * (1 + 1e-9) + 1e-9)


def squared_distance(x: Column, centres: Sequence[Sequence[float]], cluster: Column) -> Column:
    """Squared distance of a row to the centre of its cluster."""
    own = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres]), cluster + 1)
    return F.aggregate(F.zip_with(x, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def cluster_means(clustered: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """(cluster, row_count, mean, cost): what the centres must be if the clustering has come to rest, and its cost."""
    x = vector_to_array("features")
    rows = clustered.select(
        F.col("prediction").alias("cluster"), squared_distance(x, centres, F.col("prediction")).alias("cost"), x.alias("x")
    )
    n = len(centres[0])
    means = F.array(*[F.avg(F.col("x")[i]) for i in range(n)])
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("row_count"), means.alias("mean"), F.sum("cost").alias("cost"))


def condensed_equals_rows(rows: DataFrame, condensed: DataFrame, label: str) -> DataFrame:
    """One row: label sum and number of rows of a table and of its condensed form."""
    of = lambda df, total, n, tag: df.agg(F.round(F.sum(total), 3).alias(f"sum_{tag}"), F.sum(n).cast("long").alias(f"rows_{tag}"))
    whole = of(rows, F.col(label), F.when(F.col(label).isNotNull(), 1), "all")
    short = of(condensed, F.col(label) * F.col("weight"), F.col("weight"), "condensed")
    return whole.select("*", *[short.select(c).scalar().alias(c) for c in ("sum_condensed", "rows_condensed")])
