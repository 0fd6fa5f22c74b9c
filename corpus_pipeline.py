"""The corpus pipeline: raw documents to token ids, stage by stage.

Every stage but the last returns the columns of ``documents``; each works on all that the one before kept. Where a
stage changes a text and the table has ``n_chars``, that column follows the text.

1. quality rules: documents that a rule rejects go.
2. line dedup: later repeated runs of lines are deleted; a document of which no word is left goes.
3. near-dedup: one document of each group of near copies stays.
4. decontamination: contaminated documents go; full benchmark windows are cut out of the others.
5. BPE: the token ids of the kept texts are written to the shared folder; the stage returns a report on that table, with
   the digests of the ids and of the texts decoded from them (``inputFiles()`` says where the table is).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from tallymark.llm.common import SPACE, free_names, load, quoted, stage
from tallymark.llm.queries import tokenizer_file

TOKENIZER = "byte_bpe_50k.json"


def _with_lengths(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that an earlier document has; emptied documents go."""
    removed, total = free_names(docs, "_removed", "_total")
    done = line_dedup.dedup(docs, removed=removed, total=total)
    left = (F.col(removed) == 0) | (F.trim("text", F.lit(SPACE)) != "")
    return _with_lengths(done.filter(left).select(*quoted(docs.columns)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return _with_lengths(decontaminate.clean(docs, load(spark, sf_dir, "benchmark")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, their digest, and the digest of the decoded text of each document, next to its ids."""
    written = stage(bpe.token_ids(docs, tokenizer_file(TOKENIZER)), "token-ids")
    return written.drop("ids")


STAGES = [
    ("quality rules", good_quality),
    ("line dedup", new_lines),
    ("near-dedup", one_of_each),
    ("decontamination", unseen),
    ("bpe", token_ids),
]
# Encoding is not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what one returns is written to the shared folder and read by the next."""
    docs = load(spark, sf_dir, "documents")
    for number, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
