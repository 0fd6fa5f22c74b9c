"""Tables with columns that are named like the operators' own, and repeated rows: the same results."""

import pytest
from pyspark.sql import functions as F

from tallymark.llm import bpe, chat_format, importance_resampling, language_model, quality_rules, substring_dedup, token_counts
from tallymark.llm.queries import tokenizer_file

CLASH = ["block", "payload", "key", "shard", "content", "n_tokens", "n_bytes", "score", "window", "kept", "copies", "total", "bucket", "weight"]
TEXT = "The committee met on Tuesday and agreed that the bridge should be repaired before the winter sets in, at last."

OPERATORS = {
    "op4": language_model.scores,
    "op7": lambda df: bpe.report(df, tokenizer_file("byte_bpe_50k.json")),
    "op8": quality_rules.report,
    "op9": substring_dedup.report,
    "op10": lambda df: token_counts.report(df, tokenizer_file("word_bpe_49k.json")),
    "op12": lambda df: importance_resampling.resample(df, df.limit(1)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_and_repeated_rows(spark, documents, name):
    run = OPERATORS[name]
    df = documents((1, TEXT), (1, TEXT), (1, TEXT), (2, None), (3, "short"), (None, TEXT))
    plain = sorted(map(str, run(df).collect()))
    assert len(plain) == 6
    clashing = df.withColumns({c: F.lit("x") for c in CLASH})
    assert sorted(map(str, run(clashing).collect())) == plain


def test_conversations_with_clashing_names(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    clash = df.withColumns({c: F.lit("x") for c in ("starts", "ends", "edge", "spans", "n_turns", "chars", "place", "first_start")})
    assert chat_format.report(clash).collect() == chat_format.report(df).collect()
