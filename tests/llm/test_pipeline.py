import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as p
from tallymark.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from tallymark.llm.queries import tokenizer_file
from tests.llm import test_bpe, test_line_dedup, test_near_dedup

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the supplied tables are not here")


def test_registered():
    assert set(contract.queries()) >= {"pipeline", *(f"op{n}" + s for n, s in [(1, "_line_dedup"), (10, "_token_counts")])}
    assert 4 <= len(p.STAGES) <= 5


def test_stages_equal_brute_force(spark):
    """Every stage on what the one before kept, against plain Python."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    docs = p.good_quality(spark, docs, SF_DIR)
    assert docs.columns == columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    judged = {r["doc_id"]: r["kept"] for r in quality_rules.report(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    assert kept == {i: t for i, t in texts.items() if judged[i]} and 0 < len(kept) < len(texts)

    docs = p.new_lines(spark, docs, SF_DIR)
    assert docs.columns == columns
    want = test_line_dedup.brute(list(kept.items()))
    want = {i: t for i, (t, n) in want.items() if not n or t.split()}
    rows = docs.collect()
    kept = {r["doc_id"]: r["text"] for r in rows}
    assert kept == want and all(r["n_chars"] == len(r["text"]) for r in rows)

    docs = p.one_of_each(spark, docs, SF_DIR)
    assert docs.columns == columns
    stays = {i for i, _, _, first in test_near_dedup.brute(list(kept.items())) if first}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == stays

    docs = p.unseen(spark, docs, SF_DIR)
    assert docs.columns == columns
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    words = {w for _, t in bench for w in decontaminate.words_of(t)}
    near = [(i, t) for i, t in kept.items() if len(words & set(decontaminate.words_of(t))) > 4]
    from tests.llm.test_decontaminate import brute as hits

    bad = {row[0] for row in hits(near, bench, decontaminate.WINDOW) if row[5]}
    assert {r["doc_id"] for r in docs.collect()} == set(kept) - bad

    final = {r["doc_id"]: tuple(r)[1:] for r in p.token_ids(spark, docs, SF_DIR).collect()}
    assert final == {r["doc_id"]: test_bpe.library(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in p.run(spark, SF_DIR).collect()} == final


def test_extra_columns_empty_tables_and_nulls(spark, documents):
    clash = {c: F.lit(1) for c in ("mask", "key", "n_words", "_key", "_gone", "node", "component", "kept")}
    text = "The committee met on Tuesday and agreed that the bridge should be repaired before the winter sets in."
    for df in (documents(), documents((None, text), (1, text), (1, text), (2, None), (3, ""))):
        df = df.withColumns(clash)
        for _, apply in p.STAGES[:-1]:
            out = apply(spark, df, SF_DIR)
            assert out.columns == df.columns
            df = out
        rows = p.token_ids(spark, df, SF_DIR).collect()
        assert len(rows) <= 1


def test_defaults_are_those_of_the_contract():
    assert (near_dedup.PERCENT, near_dedup.SHINGLE, decontaminate.WINDOW, decontaminate.COVERAGE) == (80, 2, 13, 20)
    assert line_dedup.MIN_RUN == 3


def test_token_ids_are_written(spark, documents):
    """The ids next to the report are the library's."""
    texts = ["The committee met on Tuesday.", "", "x" * 5000, "é 中文 <|endoftext|>", None]
    report = p.token_ids(spark, documents(*enumerate(texts), (None, "no id"), (0, texts[0])), SF_DIR)
    assert report.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    (folder,) = {os.path.dirname(f) for f in report.inputFiles()}
    written = spark.read.parquet(folder)
    library = bpe.tokenizer(tokenizer_file(p.TOKENIZER))
    rows = written.collect()
    assert len(rows) == 7 and {r["doc_id"] for r in rows} == {None, 0, 1, 2, 3, 4}
    for r in rows:
        text = "no id" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == test_bpe.library(text)
