"""Every query against its SQL on the smallest tables; the two without SQL against the converter in plain Python."""

import oracle
import pytest

from quillstrata.functions.markdown import blocks_of
from quillstrata.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert oracle.differs(spark, QUERIES[name], ORACLES[name]) is None


def test_every_other_query_is_tested_here():
    assert set(QUERIES) - set(ORACLES) == {"htm1_blocks", "htm18_markdown"}


def test_blocks_and_markdown_of_pages(spark):
    pages = {r["page_id"]: blocks_of(r["html"]) for r in spark.read.parquet(f"{oracle.DATA}/pages.parquet").collect()}
    got = sorted((r["page_id"], r["kind"], r["level"], r["text"]) for r in QUERIES["htm1_blocks"](spark, oracle.DATA).collect())
    assert got == sorted((i, b.kind, b.level, b.line[len(b.lead) :]) for i, blocks in pages.items() for b in blocks)
    for r in QUERIES["htm18_markdown"](spark, oracle.DATA).collect():
        text, before = "", None
        for b in pages[r["page_id"]]:
            text += ("" if before is None else "\n" if before == b.kind == "item" else "\n\n") + b.line
            before = b.kind
        assert r["markdown"] == text


def test_log_lists_and_views_agree_on_larger_tables(spark):
    for name in ("agg4_groups", "jon14_near_copies", "api1_browse", "win3_percentile", "sco5_flags", "cls7_review_types"):
        assert oracle.differs(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.01") is None, name
