"""Findings of the third round: whole plans, and rows that are dealt out."""

import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstrata.functions import markdown as M
from quillstrata.functions import text as X
from quillstrata.operators import review as V
from quillstrata.plans import measures as S
from quillstrata.plans import relations as L
from quillstrata.registry import QUERIES
from quillstrata.sources import files as R

EVENTS = "id long, at long, verdict string, note string, drops array<string>, sha1 string"


def many(spark):
    """More targets than the former limit of 25,000, with their texts."""
    ids = spark.range(25_001)
    return ids, ids.select("id", F.lit("s").alias("sha1"))


def test_a_plan_has_no_most_articles(spark):
    ids, texts = many(spark)
    plan = V.bulk_plan("drop_articles", ids, texts, spark.createDataFrame([], EVENTS), "id")
    assert plan.where("verdict = 'drop'").count() == 25_001
    assert V.apply(plan, V.token(plan), 7).count() == 25_001


def test_an_undo_has_no_most_articles(spark):
    ids, texts = many(spark)
    empty = F.array().cast("array<string>")
    first = ids.select("id", F.lit(1).cast("long").alias("at"), F.lit("keep").alias("verdict"), F.lit("").alias("note"), empty.alias("drops"), F.lit("s").alias("sha1"))
    log = first.union(first.withColumns({"at": F.lit(2).cast("long"), "verdict": F.lit("drop")}))
    assert V.bulk_plan("undo", ids, texts, log, "id").where("verdict = 'keep'").count() == 25_001


@pytest.mark.parametrize("name", ["htm2_reference_sections", "htm5_blocks", "htm6_lists", "htm7_tables", "htm8_formulas"])
def test_made_pages_are_dealt_to_all_tasks(spark, name):
    assert QUERIES[name](spark, oracle.DATA).select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_blocks_are_made_in_slices_and_once_for_equal_pages(spark, monkeypatch):
    pages = ["<p>a</p>" * 9, None, "", "<p>" + "b " * 900, "<p>c</p>"]
    monkeypatch.setattr(M, "SLICE_BYTES", 100)
    assert list(M._slices(pa.array(pages))) == [(0, 3), (3, 4), (4, 5)]
    read = []
    monkeypatch.setattr(M, "blocks_of", lambda x: read.append(x) or [M.Block("item", "x\ny", 1, "- ")])
    assert M.blocks_of_pages(["<p>a", "<p>b", "<p>a", None]).to_pylist() == [[{"kind": "item", "level": 1, "lead": "- ", "text": "x\n  y"}]] * 4
    assert read == ["<p>a", "<p>b", ""]
    monkeypatch.undo()
    got = {r["k"]: r["blocks"] for r in M.html_blocks(spark.createDataFrame(list(zip("vwxyz", pages, strict=True)), "k string, h string"), "k", "h").collect()}
    assert [len(got[k]) for k in "vwxyz"] == [9, 0, 0, 1, 1]


@pytest.mark.parametrize("frequent", [0, 2, 3, 9])
def test_bits_do_not_depend_on_which_words_go_to_every_task(spark, monkeypatch, frequent):
    from math import log2

    monkeypatch.setattr(S, "FREQUENT", frequent)
    texts = {1: "a a a b b c", 2: "b d", 3: "12 !", 4: None}
    got = {r["k"]: (r["bits"], r["bytes"]) for r in S.unigram_bits(spark.createDataFrame(list(texts.items()), "k int, t string"), "k", "t").collect()}
    counts = {"a": 3, "b": 3, "c": 1, "d": 1}
    want = {k: sum(-log2((counts[w] + 1) / 12) for w in (x or "").split() if w in counts) for k, x in texts.items()}
    assert {k: bits for k, (bits, _) in got.items()} == pytest.approx(want)
    assert got[3][1] == 4 and got[4][1] is None


def test_texts_of_a_second_run_are_dealt_to_all_tasks(spark, monkeypatch):
    given, bits = [], S.unigram_bits
    monkeypatch.setattr(S, "unigram_bits", lambda rows, key, text: given.append(rows) or bits(rows, key, text))
    QUERIES["sco8_controls"](spark, oracle.DATA)
    assert given[2].rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) != 7


@pytest.mark.parametrize("name", ["sco5_flags", "sco6_robust_z", "cls7_review_types"])
def test_scores_are_made_once(spark, monkeypatch, name):
    given = []
    for f in ("percentile_rank", "robust_z"):
        monkeypatch.setattr(S, f, lambda rows, *a, f=getattr(S, f): given.append(rows) or f(rows, *a))
    QUERIES[name](spark, oracle.DATA)
    assert len(given) == 2 and all(hasattr(rows, "stored_at") for rows in given)


@pytest.mark.parametrize("name", ["str6_stale_caches", "qc5_copies_equal"])
def test_copies_are_dealt_to_no_fixed_number_of_tasks(spark, monkeypatch, name):
    from pyspark.sql.classic.dataframe import DataFrame

    given, deal = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: given.append(a) or deal(self, *a))
    QUERIES[name](spark, oracle.DATA)
    assert given == [("doc_id",)]


def test_a_dump_has_as_many_files_as_tasks(spark, tmp_path):
    from quillstrata.plans.files import dumped

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    dumped(spark.range(500).select("id", F.lit("<page/>").alias("page")), str(tmp_path / "d"))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(list((tmp_path / "d").glob("part-*"))) == 11


def test_whole_numbers_beside_nulls_are_exact(spark, tmp_path):
    (tmp_path / "d.sql").write_text("INSERT INTO `t` VALUES (9007199254740993,1,'a\\n\\n''b'),(NULL,NULL,NULL);\nINSERT INTO `t` VALUES (2,0.5,'');\n")
    got = sorted(map(tuple, R.read_sql_dump(spark, str(tmp_path / "d.sql"), "id long, share double, name string").collect()), key=str)
    assert got == [(2, 0.5, ""), (9007199254740993, 1.0, "a\n\n'b"), (None, None, None)]


def test_script_mix_counts_runs(spark):
    mix = X.script_mix(F.col("t"))
    assert "regexp_count" not in str(mix)
    text = "aéɏ×" * 3 + "କ଼" * 5000 + "Ωж漢́" + "𝔸" + "x" * 20000 + " 12"
    r = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(mix.alias("m")).collect()
    n = 9 + 10000 + 5 + 20000
    assert tuple(r[0]["m"]) == pytest.approx((10000 / n, 20009 / n, 5 / n))
    assert tuple(r[1]["m"]) == tuple(r[2]["m"]) == (0.0, 0.0, 0.0)


def test_shuffled_words_are_sorted_without_a_comparator(spark):
    assert "array_sort" not in str(X.shuffled_words(F.col("t"), 7))


def test_residue_of_some_names(spark):
    d = spark.createDataFrame([(1, "see www.x && &amp; 12px"), (2, "no"), (3, None)], "k int, t string")
    assert sorted(tuple(r)[:2] for r in S.residue(d, "k", "t", names=("URL", "HTML entity", "category link")).collect()) == [(1, "HTML entity"), (1, "URL")]


@pytest.mark.parametrize("known", [0, 10**6])
def test_pool_rows_without_enough_of_the_probe_are_left_out_early(spark, monkeypatch, known):
    import random

    monkeypatch.setattr(L, "MOST_KNOWN", known)
    draw = random.Random(5)
    sets = {side: {i: set(draw.sample(range(24), draw.randint(1, 12))) for i in range(40)} for side in "pq"}
    rows = {s: spark.createDataFrame([(i, g) for i, x in sets[s].items() for g in x], f"{s} int, gram int") for s in "pq"}
    want = {(p, q): round(len(a & b) / len(a | b), 6) for p, a in sets["p"].items() for q, b in sets["q"].items() if len(a & b) >= 0.5 * len(a | b)}
    assert want and {(r["p"], r["q"]): r["jaccard"] for r in L.near_copies(rows["p"], rows["q"]).collect()} == want
