"""The pipeline on the smallest tables: its stages' decisions take effect, and each works on what the one before kept."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == ids
            break
        assert out.columns == columns
        out = out.cache()
        now = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert now <= ids and out.count() <= before
        docs, ids, before = out, now, out.count()


def test_copies_of_one_row_leave_one(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text, "en", "s", 5), (3, "other words that are here alone in this row", "en", "s", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(str(r["doc_id"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect())
    assert got == ["1", "3", "None"]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _pii string, `text_key` long, score double"


def test_stages_on_an_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    words = "A plain sentence of many words that says what it means and goes on for long enough to count . "
    rows = [(i, words * 8 + f"Row {i} has words of its own {i * 7}, and mail to a{i}@b.example.com.", "en", "s", 1, "own", i, 0.5) for i in range(4)]
    rows += [(None, None, None, None, None, None, None, None), (7, "", "en", "s", 0, "", 0, 0.0), (1, rows[1][1], "en", "s", 1, "own", 9, 0.5)]
    full = spark.createDataFrame(rows, SCHEMA)
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, empty, DATA).count() == 0
        out = stage(spark, full, DATA)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == full.columns and out.schema.simpleString() == full.schema.simpleString()
            assert {r["_pii"] for r in out.collect()} <= {"own", "", None}


def test_run_agrees_with_the_stages_one_by_one(spark):
    """Rows of run() against the operators' own verdicts, and packed ids against the tokenizer."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from quillstrata.llm import ngram_jaccard, pii, quality_classifier, quality_rules, queries

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = quality_classifier.learnable(spark.read.parquet(f"{DATA}/labels.parquet"))
    good = {r["doc_id"] for r in quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect() if r["score"] >= 0.5}
    kept = docs.where(docs.doc_id.isin(*good))
    passed = {r["doc_id"] for r in quality_rules.judge(kept, quality_rules.fit(kept)).collect() if r["kept"]}
    kept = docs.where(docs.doc_id.isin(*passed))
    first = {r["doc_id"] for r in ngram_jaccard.near_duplicates(kept).collect() if r["component_id"] == r["doc_id"]}
    new = {r["doc_id"]: r["text"] for r in pii.replace(docs.where(docs.doc_id.isin(*first)), queries.PII_KEY).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in new.items()}
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"] for r in rows} == first
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) for r in rows)
