"""Quality rules as a short-circuit cascade.

Each rule is a predicate that rejects a text. On a bounded sample every rule is run alone, which gives its cost
(seconds) and its selectivity (share rejected). A first run, which pays for code generation, gives the selectivity and is
not timed; then the sample is read several times over in one job, and what a rule that looks at nothing takes is
subtracted, so that the start of a job does not pass for the cost of a rule. The rules are then put in the order of rejection per cost and
joined into one CASE, so a text stops at the first rule that rejects it. The order only changes the cost: a text
is kept if no rule rejects it. Rules of nearly the same rejection per cost may change places from run to run.

Built-in expressions only, all row-local: no shuffle, no window, no Python.

Edge cases: a null or empty text has no words and is rejected by ``few_words``; every repeated row is judged for
itself; an empty table gives an empty result; other columns are carried through untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, free_names, let, quoted, words_of

WINDOW = 5
# The characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
# The sample that the costs are measured on.
SAMPLE_ROWS, SAMPLE_CHARS = 512, 20_000
# Characters that a timed run reads, and the number of timed runs, of which the shortest counts.
TIMED_CHARS, TIMED_RUNS = 1 << 20, 2
# Costs below this are told apart from nothing by chance only.
LEAST_SECONDS = 0.02

# Limits of the rules. A caller can replace any of them.
LIMITS = {
    "min_words": 10,
    "max_repeat_percent": 20,
    "max_symbol_percent": 10,
    "max_dup_line_percent": 50,
    "min_mean_chars": 2,
    "max_mean_chars": 20,
    "min_alpha_percent": 40,
    "max_upper_percent": 60,
}


def lines_of(text: Column) -> Column:
    """Lines with at least one word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line, F.lit(SPACE)) != "")


def n_dup_lines(text: Column) -> Column:
    return let(lines_of(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def _covered(hashes: Column, width: int) -> Column:
    """Words below the windows that occur twice or more; linear but for one sort of the windows."""

    def positions(ranked: Column) -> Column:
        last = F.size(ranked) - 1
        same = lambda i, j: ranked[i]["h"] == ranked[j]["h"]
        twice = F.filter(ranked, lambda x, i: ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("at"))
    add = lambda acc, at: F.struct(
        (acc["n"] + F.least(F.lit(width), at - acc["at"])).alias("n"), at.alias("at")
    )
    return let(ranked, lambda r: F.aggregate(positions(r), start, add, lambda acc: acc["n"]))


def n_repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that the text has twice or more, the first one included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. A text without a repeated window is
    settled by one distinct count.
    """

    def count(hashed: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashed) - width)
        windows = F.transform(starts, lambda i: F.xxhash64(*[hashed[i + k] for k in range(width)]))
        repeats = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w, width))
        return F.when(F.size(hashed) < width + 1, 0).otherwise(let(windows, repeats))

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def rules(text: Column, limits: Mapping[str, int] = LIMITS) -> dict[str, Column]:
    """Name of each rule and the predicate that rejects; every predicate stands alone and is never null."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    few = F.size(words) < limits["min_words"]
    repeated = let(words, lambda w: 100 * n_repeat_words(w) > limits["max_repeat_percent"] * F.size(w))
    symbols = 100 * n_symbols(text) > limits["max_symbol_percent"] * F.size(words)
    dup_lines = let(
        lines_of(text),
        lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) > limits["max_dup_line_percent"] * F.size(x),
    )
    length = let(
        words,
        lambda w: (word_chars(w) < limits["min_mean_chars"] * F.size(w))
        | (word_chars(w) > limits["max_mean_chars"] * F.size(w)),
    )
    alpha = let(
        words,
        lambda w: 100 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) < limits["min_alpha_percent"] * F.size(w),
    )
    upper = 100 * F.regexp_count(text, F.lit(r"\p{Lu}")) > limits["max_upper_percent"] * F.regexp_count(
        text, F.lit(r"\p{L}")
    )
    return {
        "few_words": few,
        "repeated_words": repeated,
        "symbols": symbols,
        "repeated_lines": dup_lines,
        "word_length": length,
        "few_letters": alpha,
        "upper_case": upper,
    }


BASE_RULES = ("few_words", "repeated_words")


def measure(docs: DataFrame, predicates: Mapping[str, Column], rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Cost in seconds and share rejected of each rule on at most ``rows`` texts of at most ``SAMPLE_CHARS`` characters.

    The sample is taken from as few input splits as hold enough rows and is bounded in rows and characters.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= SAMPLE_CHARS).take(rows)
    if not texts:
        return {name: (0.0, 0.0) for name in predicates}
    sample = docs.sparkSession.createDataFrame(texts, "text string").coalesce(1).persist()
    copies = max(1, TIMED_CHARS // max(1, sum(len(row["text"]) for row in texts)))
    # A sample of empty texts is not read more than a thousand times.
    many = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(min(copies, 1_000))))).select("text")

    def seconds(rejects: Column) -> float:
        runs = []
        for _ in range(TIMED_RUNS):
            began = time.perf_counter()
            many.agg(F.count_if(rejects)).first()
            runs.append(time.perf_counter() - began)
        return min(runs)

    try:
        share = {name: sample.agg(F.count_if(rejects)).first()[0] / len(texts) for name, rejects in predicates.items()}
        nothing = seconds(F.col("text").isNull())
        return {name: (max(seconds(rejects) - nothing, LEAST_SECONDS), share[name]) for name, rejects in predicates.items()}
    finally:
        sample.unpersist()


def cascade_order(measured: Mapping[str, tuple[float, float]]) -> list[str]:
    """Most rejection per second first; ties by name."""
    return sorted(measured, key=lambda name: (-measured[name][1] / max(measured[name][0], 1e-6), name))


def cascade(predicates: Mapping[str, Column], order: Sequence[str]) -> Column:
    """The first rule in the order that rejects the text, null if none does; later rules are not evaluated."""
    return reduce(lambda rest, name: F.when(predicates[name], F.lit(name)).otherwise(rest), reversed(order), F.lit(None).cast("string"))


def judge(
    docs: DataFrame, verdict: str = "rejected_by", limits: Mapping[str, int] = LIMITS,
    names: Sequence[str] | None = None, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All rows and columns, and the first rule that rejects (null: kept)."""
    predicates = {k: v for k, v in rules(F.col("text"), limits).items() if names is None or k in names}
    return docs.withColumn(verdict, cascade(predicates, cascade_order(measure(docs, predicates, sample_rows))))


def keep_good(docs: DataFrame, limits: Mapping[str, int] = LIMITS) -> DataFrame:
    """The rows that no rule rejects, with their columns as they were."""
    (verdict,) = free_names(docs, "_rejected_by")
    kept = judge(docs, verdict, limits).filter(F.col(verdict).isNull())
    return kept.select(*quoted(docs.columns))


def report(docs: DataFrame, limits: Mapping[str, int] = LIMITS) -> DataFrame:
    """One row per input row: the base counts and both verdicts.

    The base rules follow from the counts; the cascade holds the other rules and runs only for texts that pass.
    """
    narrow = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    predicates = {k: v for k, v in rules(F.col("text"), limits).items() if k not in BASE_RULES}
    order = cascade_order(measure(narrow, predicates))
    counted = (
        narrow.withColumn("words", words_of(F.col("text")))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("n_repeat_words", n_repeat_words(F.col("words")).cast("long"))
    )
    failed = (F.col("n_words") < limits["min_words"]) | (
        100 * F.col("n_repeat_words") > limits["max_repeat_percent"] * F.col("n_words")
    )
    return counted.select(
        "doc_id",
        "n_words",
        word_chars(F.col("words")).cast("long").alias("word_chars"),
        n_symbols(F.col("text")).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(cascade(predicates, order).isNull()).alias("kept"),
    )
