"""Quality classifier with hierarchical empirical Bayes over sites.

For each target (``quality``, ``toxic``) a document classifier weighs the words and word shapes of the text: naive
Bayes on hashed features, calibrated on other labelled documents. It is fitted on at most ``MAX_LABELLED`` labelled
documents, those with the smallest hashes of their ids; everything else covers all documents.

The rates of sites come from all documents, a label counting as it is and an unlabelled document by the classifier's
probability: sums by path (host and section) and from them by host, by grouped aggregation. Both levels get Beta
priors whose strength is estimated by moments from the spread between sites. A host's posterior shrinks toward the
global rate, a path's posterior toward its host, the more so the fewer documents it has. A document's posterior odds
are those of its path, without the document itself, times the classifier's evidence. Sites are joined back by
shuffle, so their number is not limited, and a source with a third of all rows is summed map-side.

Edge cases: a null text is empty and gives features of emptiness only; null hosts and sections are one site of their
own; labels are averaged by id, null labels are left out and unlabelled targets keep all rows at probability 0.5; rows
that repeat an id are judged one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import in_batches, let, stage, texts, words_of

TARGETS = ("quality", "toxic")
MAX_LABELLED = 20_000
# Features with a smaller root of the likelihood-ratio statistic have no weight, however many labels there are.
LEAST_ROOT = 5.0
# Labelled texts with the same least shingle of so many words count as one.
SHINGLE = 5
# So many of the strongest features on either side make up the evidence, so that a long text does not drown it.
STRONGEST = 5
SMOOTHING = 0.5
# Bounds of the prior strength in documents.
STRENGTH = (2.0, 1e6)

# Lengths of the word beginnings that are features of their own.
STEMS = (5, 6)
LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"[0-9]+")


def feature(kind: str, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{value}") >> 1


def shape(word: str) -> str:
    """The word with runs of letters as x, of capitals as X and of digits as 9."""
    runs = LETTERS.sub(lambda m: "X" if len(m.group()) > 1 and m.group().isupper() else "x", word)
    return DIGITS.sub("9", runs)[:16]


def word_features(word: str) -> tuple[int, ...]:
    found = [feature("s", shape(word))]
    for part in LETTERS.findall(word.lower()):
        found.append(feature("w", part))
        found += (feature("p", part[:n]) for n in STEMS if len(part) > n)
    return tuple(found)


def text_features(text: str, words: list[str]) -> Iterable[int]:
    """Features of the text as a whole: its length, and how much of it repeats, in steps."""
    lines = [x for x in text.split("\n") if x.strip()]
    step = lambda part, of: 10 * part // max(of, 1)
    yield feature("n", str(len(words).bit_length()))
    yield feature("l", str(step(len(lines) - len(set(lines)), len(lines))))
    yield feature("d", str(step(len(set(words)), len(words))))


class Remembered(dict):
    """Features by word, limited to those that ``wanted`` holds if it is given."""

    def __init__(self, wanted: frozenset[int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 300_000:
            self.clear()
        found = word_features(word)
        if self.wanted is not None:
            found = tuple(f for f in found if f in self.wanted)
        if len(word) <= 64:
            self[word] = found
        return found

    def of(self, text: str) -> set[int]:
        words = text.split()
        found = set(text_features(text, words))
        for word in set(words):
            found.update(self[word])
        return found


class Head(NamedTuple):
    """Weights of one target's features, and the calibration of their sum to log evidence."""

    weights: dict[int, float]
    slope: float
    shift: float
    prior: float


def labelled_sample(labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids; half fits the weights, half the calibration."""
    mean = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.avg(F.col(t).cast("double")).alias(t) for t in TARGETS])
    ranked = mean.filter("doc_id is not null").withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(limit)
    return ranked.select("doc_id", *TARGETS, (F.xxhash64("doc_id", F.lit(1)) % 2 == 0).alias("fits"))


def with_copies_once(sample: DataFrame) -> DataFrame:
    """The rows with ``share``, one over the number of rows whose text has the same least shingle of ``SHINGLE`` words.

    Copies and near copies together so count as one text: else they would make its words look telling in proportion
    to their number. Each group as a whole fits the weights or the calibration.
    """
    hashed = F.transform(words_of(F.lower("text")), lambda w: F.xxhash64(w))
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))
    shingle = lambda w: lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
    least = let(hashed, lambda w: F.array_min(F.transform(starts(w), shingle(w))))
    marked = stage(sample.withColumn("family", least), "families")
    # Whole parts of a power of two: their sums do not depend on the order of rows.
    sizes = marked.groupBy("family").agg((F.floor(F.lit(1 << 20) / F.count(F.lit(1))) / F.lit(1 << 20)).alias("share"))
    # As bounded as the sample.
    shared = marked.join(F.broadcast(sizes), "family")
    return shared.select("text", *TARGETS, "share", (F.xxhash64("family", F.lit(1)) % 2 == 0).alias("fits"))


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, and for each target the labelled documents for and against it that have the feature).

    Feature -1 is in every document. Counts are added up in the tasks before the shuffle.
    """
    sides = [f"{t}_{side}" for t in TARGETS for side in ("yes", "no")]

    def run(batches: Iterable[pa.RecordBatch]):
        memory = Remembered()
        for batch in batches:
            sums: dict[int, np.ndarray] = {}
            marks = zip(*(batch.column(t).to_pylist() for t in TARGETS))
            rows = zip(batch.column("text").to_pylist(), batch.column("share").to_pylist(), marks)
            for text, share, known in rows:
                adds = share * np.array([x for y in known for x in ((0, 0) if y is None else (y, 1 - y))], float)
                for f in (*memory.of(text), -1):
                    sums[f] = sums[f] + adds if f in sums else adds
            table = np.array(list(sums.values())).reshape(-1, len(sides))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums.keys(), pa.int64()), *(pa.array(table[:, i]) for i in range(len(sides)))], ["feature", *sides]
            )

    schema = "feature long, " + ", ".join(f"{s} double" for s in sides)
    partial = in_batches(sample.filter("fits").select("text", *TARGETS, "share")).mapInArrow(run, schema)
    return partial.groupBy("feature").agg(*[F.sum(s).alias(s) for s in sides])


def weights(counts: DataFrame, target: str) -> dict[int, float]:
    """Log odds of the features that tell the two sides apart; as many as the bounded sample supports."""
    total = counts.filter("feature = -1").first()
    if total is None or min(total[f"{target}_yes"], total[f"{target}_no"]) < 1:
        return {}
    all_yes, all_no = total[f"{target}_yes"], total[f"{target}_no"]
    yes, no = F.col(f"{target}_yes"), F.col(f"{target}_no")
    share = all_yes / (all_yes + all_no)
    surprise = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = 2 * (surprise(yes, (yes + no) * share) + surprise(no, (yes + no) * (1 - share)))
    odds = F.log((yes + SMOOTHING) / (all_yes + 2 * SMOOTHING)) - F.log((no + SMOOTHING) / (all_no + 2 * SMOOTHING))
    clear = counts.filter((F.col("feature") >= 0) & (yes + no > 0)).filter(ratio >= LEAST_ROOT**2)
    return {r["feature"]: r["odds"] for r in clear.select("feature", odds.alias("odds")).collect()}


def scorer(of: dict[str, dict[int, float]]):
    """Sum of the strongest feature weights for and against each target, on a compressed scale."""

    def run(batches: Iterable[pa.RecordBatch]):
        memory = Remembered(frozenset().union(*of.values()))
        for batch in batches:
            sums: dict[str, list[float]] = {t: [] for t in TARGETS}
            for text in batch.column("text"):
                found = memory.of(text.as_py())
                for t in TARGETS:
                    known = sorted(of[t][f] for f in found if f in of[t])
                    against, speaks_for = known[:STRONGEST], known[-STRONGEST:]
                    total = sum(w for w in against if w < 0) + sum(w for w in speaks_for if w > 0)
                    sums[t].append(float(np.arcsinh(total)))
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns |= {f"{t}_sum": pa.array(sums[t], pa.float64()) for t in TARGETS}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def calibrate(sums: np.ndarray, marks: np.ndarray) -> tuple[float, float, float]:
    """Slope and shift of a logistic curve, and the share of positives.

    Newton steps on the penalised loss, halved until they lower it, so separable marks are no trouble.
    """
    prior = float(np.clip(marks.mean(), 1e-3, 1 - 1e-3)) if len(marks) else 0.5
    flat = (0.0, float(np.log(prior / (1 - prior))), prior)
    if not len(marks) or np.ptp(sums) == 0:
        return flat
    middle, scale = sums.mean(), sums.std()
    x = np.stack([(sums - middle) / scale, np.ones(len(sums))], axis=1)
    ridge = np.array([1e-2, 0.0])
    loss = lambda b: float(np.logaddexp(0, x @ b).sum() - marks @ (x @ b) + (ridge * b * b).sum() / 2)
    b = np.array([0.0, flat[1]])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
        step = np.linalg.solve(curve, x.T @ (marks - p) - ridge * b)
        while loss(b + step) > loss(b) and np.abs(step).max() > 1e-9:
            step = step / 2
        b = b + step
        if np.abs(step).max() < 1e-7:
            break
    if b[0] <= 0:
        return flat
    slope = b[0] / scale
    return float(slope), float(b[1] - slope * middle), prior


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> dict[str, Head]:
    """The document classifier of each target. ``limit`` bounds the labelled documents it reads."""
    chosen = labelled_sample(labels, limit)
    narrow = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    # The sample has at most ``limit`` rows of four numbers, so it may be broadcast.
    sample = stage(with_copies_once(narrow.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])), "labelled")
    counts = stage(feature_counts(sample), "feature-counts")
    found = {t: weights(counts, t) for t in TARGETS}
    others = sample.filter("not fits").select("text", *TARGETS)
    fields = "quality double, toxic double, quality_sum double, toxic_sum double"
    rows = in_batches(others).mapInArrow(scorer(found), fields).collect()
    heads = {}
    for t in TARGETS:
        known = [(r[f"{t}_sum"], r[t]) for r in rows if r[t] is not None]
        slope, shift, prior = calibrate(np.array([s for s, _ in known]), np.array([y for _, y in known]))
        heads[t] = Head(found[t], slope, shift, prior)
    return heads


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(sites: DataFrame, yes: str, n: str, center: Column) -> float:
    """Prior strength by moments: the spread of the sites' rates around ``center`` beyond chance."""
    rate = F.col(yes) / F.col(n)
    row = sites.agg(
        F.sum(F.col(n) * (rate - center) * (rate - center)).alias("q"),
        F.sum(center * (1 - center)).alias("chance"),
        F.sum(n).alias("n"),
        F.sum(F.col(n) * F.col(n)).alias("n2"),
        F.avg(center * (1 - center)).alias("each"),
    ).first()
    if not row["n"] or row["n"] * row["n"] <= row["n2"]:
        return STRENGTH[1]
    between = (row["q"] - row["chance"]) / (row["n"] - row["n2"] / row["n"])
    if between <= 0:
        return STRENGTH[1]
    return float(np.clip(row["each"] / between - 1, *STRENGTH))


def judge(docs: DataFrame, labels: DataFrame, host: Column, section: Column, limit: int = MAX_LABELLED) -> DataFrame:
    """Per row: host, documents of its path, the probabilities of both targets, and whether it is kept."""
    heads = fit(docs, labels, limit)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(section.cast("string"), F.lit("")).alias("section"), F.coalesce("text", F.lit("")).alias("text"),
    )
    sums = ", ".join(f"{t}_sum double" for t in TARGETS)
    weigh = scorer({t: h.weights for t, h in heads.items()})
    scored = in_batches(narrow).mapInArrow(weigh, f"doc_id long, host string, section string, {sums}")
    means = [F.avg(F.col(t).cast("double")).alias(f"{t}_label") for t in TARGETS]
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(*means)
    scored = stage(scored, "evidence")
    rows = scored.join(known, scored["doc_id"] == known["label_id"], "left").drop("label_id")
    for t, head in heads.items():
        odds = head.slope * F.col(f"{t}_sum") + F.lit(head.shift)
        rows = rows.withColumn(f"{t}_evidence", odds - float(np.log(head.prior / (1 - head.prior))))
        rows = rows.withColumn(f"{t}_yes", F.coalesce(f"{t}_label", 1 / (1 + F.exp(-odds))))
    rows = stage(rows.select("doc_id", "host", "section", *[f"{t}_{c}" for t in TARGETS for c in ("evidence", "yes")]), "site-evidence")
    return with_sites(rows)


def with_sites(rows: DataFrame) -> DataFrame:
    """Adds the posteriors of paths and hosts to the evidence of each row."""
    count = F.count(F.lit(1)).cast("double").alias("n")
    # Sums of decimals do not depend on the order of rows.
    total = lambda c: F.sum(F.col(c).cast("decimal(28,12)")).cast("double").alias(c)
    paths = stage(rows.groupBy("host", "section").agg(count, *[total(f"{t}_yes") for t in TARGETS]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"{t}_yes").alias(f"{t}_host_yes") for t in TARGETS])
    everything = hosts.agg(F.sum("host_n"), *[F.sum(f"{t}_host_yes") for t in TARGETS]).first()
    sites = paths.join(hosts, "host")
    clip = lambda p: F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    path_sums = [F.col(f"{t}_yes").alias(f"{t}_path_yes") for t in TARGETS]
    known = sites.select("host", "section", "n", "host_n", *path_sums, *[f"{t}_host_yes" for t in TARGETS])
    joined = rows.join(known, ["host", "section"])
    out = []
    for i, t in enumerate(TARGETS):
        rate = float(np.clip((everything[i + 1] or 0.0) / (everything[0] or 1.0), 1e-4, 1 - 1e-4))
        host_s = strength(hosts, f"{t}_host_yes", "host_n", F.lit(rate))
        path_s = strength(sites, f"{t}_yes", "n", clip(F.col(f"{t}_host_yes") / F.col("host_n")))
        own = F.col(f"{t}_yes")
        host_rate = (F.col(f"{t}_host_yes") - own + host_s * rate) / (F.col("host_n") - 1 + host_s)
        path_rate = (F.col(f"{t}_path_yes") - own + path_s * host_rate) / (F.col("n") - 1 + path_s)
        out.append((1 / (1 + F.exp(-(logit(clip(path_rate)) + F.col(f"{t}_evidence"))))).alias(t))
    judged = joined.select("doc_id", "host", F.col("n").cast("long").alias("n_site"), *out)
    return judged.withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") <= 0.5))


def report(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """Documents by source and language: the source's part before a slash is the host."""
    return judge(docs, labels, F.split_part("source", F.lit("/"), F.lit(1)), F.concat_ws("/", "source", "lang"), limit)
