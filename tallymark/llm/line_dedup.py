"""Line dedup by winnowing over line hashes.

A text is the sequence of its lines with a word, compared without the white space around them. Every window of
``min_run`` lines selects its smallest line hash as fingerprint, so two texts that share a run of ``min_run`` lines
or more are guaranteed to select the same fingerprint inside it. Windows whose fingerprint occurs once in the corpus end
there. The others, which are all windows that hold a shared fingerprint to the left and right of it, are grouped by their
hash; one that occurs earlier (smaller doc_id, or the same document and an earlier line) belongs to a repeated run, and
adjoining windows form the whole run. All lines of later runs are deleted; windows are judged on the input, not on what is
left. Positions are so matched through the earliest occurrence of each window instead of pair by pair, since the pairs of
a common line would be the square of its occurrences.

Built-in expressions only. Only hashes and positions are shuffled before the last join; occurrences of one
fingerprint or window are counted map-side and never collected into one group. The rows of those that are hot are spread
over several tasks before they are joined to what was counted.

Edge cases: a null or empty text has no lines and stays as it is; lines without a word are in no run and are kept; a
null doc_id sorts before all others; rows that repeat an id with another text are ordered by the text's hash; fully
equal rows count as one document and are treated alike; an empty table gives an empty result; other columns are
carried through whatever their names. Equal lines are told by 64-bit hashes, windows by 64-bit hashes of these.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, free_names, let, quoted, stage, text_key
from tallymark.operators.joins import Hot, copy_to_pieces, hot_values, spread

MIN_RUN = 3


def windows(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """One row per window of ``min_run`` lines: its place, its fingerprint, its hash and its line numbers."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: let(F.trim(line, F.lit(SPACE)), lambda s: F.when(s != "", F.struct(F.xxhash64(s).alias("h"), i.alias("i")))),
    )

    def cut(seq):
        def window(i):
            hashes = [seq[i + k]["h"] for k in range(min_run)]
            return F.struct(
                i.alias("start"),
                F.least(*hashes).alias("fingerprint"),
                F.xxhash64(*hashes).alias("window"),
                F.array(*[seq[i + k]["i"] for k in range(min_run)]).alias("lines"),
            )

        return F.when(F.size(seq) >= min_run, F.transform(F.sequence(F.lit(0), F.size(seq) - min_run), window))

    cut_text = docs.filter(F.contains("text", F.lit("\n"))) if min_run > 1 else docs
    placed = cut_text.select("doc_id", text_key(F.col("text")).alias("key"), let(F.filter(lines, lambda x: x.isNotNull()), cut).alias("w"))
    return placed.select("doc_id", "key", F.inline("w"))


def later_lines(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, key, removed): the numbers of the lines to delete, for each text that loses any."""
    cut = stage(windows(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), min_run), "line-windows")
    hot = hot_values(cut, ["fingerprint", "window"])
    shared = cut.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fingerprint")
    matched = _joined(cut, shared, "fingerprint", hot, "left_semi")
    place = F.struct("doc_id", "key", "start")
    first = matched.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.filter("first < last").select("window", "first")
    later = _joined(matched, first, "window", hot, "inner").filter(place > F.col("first"))
    # A text holds at most as many windows as lines, so its own list is bounded by the text.
    return later.groupBy("doc_id", "key").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("removed"))


def _joined(rows: DataFrame, counted: DataFrame, key: str, hot: Mapping[str, Hot], how: str) -> DataFrame:
    """The join on ``key``, with the rows of hot keys spread and the one counted row of each repeated."""
    if not hot[key]:
        return rows.join(counted, key, how)
    dealt, copies = spread(rows, key, hot[key], "_piece"), copy_to_pieces(counted, key, hot[key], "_piece")
    return dealt.join(copies, [key, "_piece"], how).drop("_piece")


def dedup(docs: DataFrame, min_run: int = MIN_RUN, removed: str = "n_removed", total: str = "n_lines") -> DataFrame:
    """All rows and columns with the repeated runs deleted from ``text``, and the numbers of lines removed and had."""
    key, gone, their_id, their_key = free_names(docs, "_key", "_gone", "_their_id", "_their_key")
    losses = later_lines(docs, min_run).toDF(their_id, their_key, gone)
    keyed = docs.withColumn(key, text_key(F.coalesce("text", F.lit(""))))
    joined = keyed.join(losses, F.col("doc_id").eqNullSafe(F.col(their_id)) & (F.col(key) == F.col(their_key)), "left")
    lines = F.split("text", "\n")
    kept = let(
        lines,
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone)), lambda i: x[i]), "\n"
        ),
    )
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    n_lines = F.size(F.filter(lines, lambda line: F.trim(line, F.lit(SPACE)) != ""))
    out = [text.alias(c) if c == "text" else quoted([c])[0] for c in docs.columns]
    return joined.select(
        *out,
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed),
        F.coalesce(n_lines, F.lit(0)).cast("long").alias(total),
    )


def report(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Per row: lines, lines removed, and the digest of the text that is left."""
    done = dedup(docs.select("doc_id", "text"), min_run)
    return done.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )
