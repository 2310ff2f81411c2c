"""Operators on small tables: nulls, empty values, refusals, and what SQL can't express."""

import pytest
from pyspark.sql import functions as F

from quillstrata.functions import text as X
from quillstrata.functions.markdown import Block, blocks_of, cells, grid, unwanted_template, with_bounded_indent
from quillstrata.operators import browse as B
from quillstrata.plans.filters import interleave, shards
from quillstrata.operators.ranks import percentile_rank
from quillstrata.plans.relations import near_copies, restricted, walk
from quillstrata.sources import files as R


SHELF = "shelf string, `no. of \"pages\"` int, heavy boolean, price double, topics array<string>, bought string, id int"


@pytest.fixture(scope="module")
def books(spark):
    """A shelf with nulls in most columns, a column whose name needs quotes, and values that look like SQL and like a pattern."""
    data = [
        ("north", 310, False, None, ["tides", "birds"], "2019-03-02", 11),
        (None, 95, None, 7.25, [], None, 12),
        ("x' OR ''='", 0, True, 41.0, None, "2021-11-30", 13),
        ("NORTH%", None, True, 7.25, ["Birds", None], "2021-12-01", 14),
        ("çédille", 310, None, -1.0, ["tides"], "", 15),
    ]
    return spark.createDataFrame(data, SHELF)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    ("items", "want"),
    [
        ([("is.heavy", "true")], [13, 14]),
        ([("is.heavy", "false")], [11]),
        ([('min.no. of "pages"', "95"), ('max.no. of "pages"', "200")], [12]),
        ([("min.bought", "2021")], [13, 14]),
        ([("max.price", "7.25"), ("min.price", "0")], [12, 14]),
        ([("in.shelf", "north"), ("in.shelf", "__null__")], [11, 12]),
        ([("in.shelf", "x' OR ''='")], [13]),
        ([("any.topics", "birds"), ("any.topics", "Birds")], [11, 14]),
        ([("any.topics", "nothing")], []),
        ([("has.shelf", "north%")], [14]),
        ([("has.topics", "BIRD")], [11, 14]),
        ([("null.price", "1")], [11]),
        ([("null.topics", "0")], [11, 12, 14, 15]),
        ([("min.price", ""), ("any.topics", "")], [11, 12, 13, 14, 15]),
    ],
)
def test_filters(books, items, want):
    assert ids(B.filters(books, items)) == want


@pytest.mark.parametrize("items", [[("is.colour", "true")], [("is.price", "true")], [("max.price", "cheap")], [("max.price", "NaN")], [("any.shelf", "north")], [("null.price", "maybe")], [("is.heavy", "1")]])
def test_bad_filters_are_refused(books, items):
    with pytest.raises(B.BadFilter):
        B.filters(books, items)


def test_nulls_sort_last_both_ways(books):
    assert [r["id"] for r in B.ordered(books, "price").collect()] == [15, 12, 14, 13, 11]
    assert [r["id"] for r in B.ordered(books, "price", True).collect()] == [13, 12, 14, 15, 11]


@pytest.mark.parametrize(("page", "size"), [(0, 10), (1, 0), (1, 501)])
def test_bad_pages_are_refused(page, size):
    with pytest.raises(B.BadFilter):
        B.paging(page, size)


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("text", ["", "a", " \n ", "one two three", "x" * 2500, "a " * 900, "  lead and trail  ", "wörd " * 300 + "😀" * 1200, "w" * 999 + "  " + "v" * 999 + "\t\n" * 600 + "end", "ab cde\n" * 400])
def test_chunks_equal_a_walk_over_words(spark, text):
    import re

    want, held = [], ""
    for part in re.split(r"([ \t-\r]+)", text):
        if len(held) + len(part) > 1000 and held.strip(" \t\n\x0b\x0c\r"):
            want.append(held)
            held = ""
        held += part
    want = [p.strip(" \t\n\x0b\x0c\r") for p in [*want, held]]
    assert one(spark, X.chunks, text) == [p for p in want if p]


def test_text_functions_on_nulls_and_ties(spark):
    assert one(spark, lambda c: X.script_share(c, "a-z"), "") == 0.0
    assert one(spark, lambda c: X.script_share(c, "a-z"), None) == 0.0
    assert one(spark, X.common_share, "the the of a") is None
    assert one(spark, X.common_share, "the the of a Zebra's") == pytest.approx(0.8)
    assert one(spark, X.trigram_repeat, "a b c " * 4) == pytest.approx(0.7)
    assert one(spark, X.heading_key, "==  Notes : ==") == "notes"
    assert one(spark, lambda c: X.excerpt(c, 3), "a\nb") == "a ⏎…"
    assert one(spark, X.normalize_native, "ଯ଼") == "ୟ"


@pytest.mark.parametrize(("flavour", "text", "kind"), [("app", "# H", "heading"), ("app", "| a |", "table"), ("score", "  - x", "list"), ("build", "1. x", "list item"), ("annotate", "  - x", "prose"), ("app", "$$x$$", "math"), ("build", "", "paragraph")])
def test_block_kinds(spark, flavour, text, kind):
    assert one(spark, lambda c: X.block_kind(c, flavour), text) == kind


def test_interleave_takes_turns_and_no_id_twice(spark):
    c = spark.createDataFrame([("a", 1, "s1", 9.0), ("a", 2, "s2", 8.0), ("b", 1, "s3", 7.0), ("b", 3, "s4", 6.0), ("b", 4, "s2", 5.0)], "kind string, id long, signature string, severity double")
    got = [(r["kind"], r["id"]) for r in interleave(c).orderBy("rank").collect()]
    assert got == [("a", 1), ("b", 3), ("a", 2)]


@pytest.mark.parametrize("most", [1, 5, 30])
def test_interleave_equals_a_walk(spark, most):
    """Shared ids and signatures, ties, missing signatures: the thinned candidates give what all of them would."""
    import random

    rnd = random.Random(most)
    rows = [(rnd.choice("abc"), rnd.randint(1, 40), rnd.choice(["s%d" % rnd.randint(1, 25), None]), float(rnd.randint(1, 30))) for _ in range(600)]
    got = [(r["kind"], r["id"], r["signature"]) for r in interleave(spark.createDataFrame(rows, "kind string, id long, signature string, severity double"), most).orderBy("rank").collect()]
    best = {}
    for kind, i, s, v in rows:
        best[kind, i, s] = max(v, best.get((kind, i, s), 0.0))
    lists = {k: sorted(((-v, i, s or "", s) for (kk, i, s), v in best.items() if kk == k)) for k in "abc"}
    ids, signatures, want = set(), set(), []
    moved = True
    while moved and len(want) < most:
        moved = False
        for k in "abc":
            for _, i, _, s in lists[k]:
                if len(want) < most and i not in ids and (s is None or s not in signatures):
                    ids.add(i)
                    signatures.add(s)
                    want.append((k, i, s))
                    moved = True
                    break
    assert got == want


def test_quantiles_and_ranks_of_groups(spark):
    from quillstrata.operators import ranks as K

    rows = [("a", 1.0), ("a", 1.0), ("a", 4.0), ("a", None), ("b", 7.0), (None, 2.0), (None, 8.0), ("c", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    assert {r["g"]: list(r["q"]) for r in K.quantiles(d, ["g"], "v", [0.0, 0.25, 0.5, 1.0]).collect()} == {"a": [1.0, 1.0, 1.0, 4.0], "b": [7.0] * 4, None: [2.0, 3.5, 5.0, 8.0]}
    assert {(r["g"], r["med"], round(r["spread"], 6)) for r in K.robust_spread(d, ["g"], "v").collect()} == {("a", 1.0, 0.0), ("b", 7.0, 0.0), (None, 5.0, round(3 * 1.4826, 6))}
    z = {(r["g"], r["v"]): r["z"] for r in K.robust_z(d, ["g"], "v").collect()}
    assert z["a", 4.0] is None and z[None, 8.0] == pytest.approx(1 / 1.4826) and z["c", None] is None
    assert K.quantiles(d.where("v is null"), [], "v", [0.5]).first()["q"][0] is None
    many = spark.range(2000).selectExpr("id % 3 as g", "cast(id * 7919 % 2000 as double) as v")
    import numpy as np

    pdf = many.toPandas()
    for r in K.quantiles(many, ["g"], "v", [0.1, 0.5, 0.9]).collect():
        assert list(r["q"]) == pytest.approx(list(np.quantile(pdf[pdf.g == r["g"]].v, [0.1, 0.5, 0.9])))


def test_walk_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "child int, parent int")
    got = {(r["node"], r["depth"]) for r in walk(edges, spark.createDataFrame([(1,)], "root int")).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_percentile_rank_of_ties_and_nulls(spark):
    d = spark.createDataFrame([(1, "g", 5), (2, "g", 5), (3, "g", 7), (4, "g", None)], "id int, g string, v int")
    got = {r["id"]: r["p"] for r in percentile_rank(d, ["g"], "v", "p").collect()}
    assert got[1] == got[2] == pytest.approx(0.5)
    assert got[3] == pytest.approx(1.0)
    assert got[4] is None


def test_restricted_refuses_lost_ids(spark):
    with pytest.raises(ValueError, match="1 ids"):
        restricted(spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1,), (2,)], "id int"), "id")


def test_near_copies_of_nothing(spark):
    grams = "p int, gram string"
    assert near_copies(spark.createDataFrame([], grams), spark.createDataFrame([], "q int, gram string")).count() == 0


def test_shards_of_ties(spark):
    d = spark.createDataFrame([(i, 10) for i in range(10)], "id int, n long")
    assert sorted(r["shard"] for r in shards(d, "n", 50, "id").collect()) == [0] * 5 + [1] * 5


def test_sql_tuples():
    assert R.sql_tuples(r"INSERT INTO `t` VALUES (7,'say \"a\"; (b), \\ and \b',NULL),(-8,'O''Hara\Z\%',2.5e-3);", 3) == [(7, 'say "a"; (b), \\ and \b', None), (-8, "O'Hara\x1a\\%", 0.0025)]
    assert R.sql_tuples("INSERT INTO `t` (`a`) VALUES ('');", 1) == [("",)]
    for bad in ("INSERT INTO `t` VALUES (1,2);", "INSERT INTO `t` VALUES (1,2,'x", "INSERT INTO `t` VALUES (1,2,3", "INSERT INTO `t` VALUES (1,2,what);", "INSERT INTO `t` VALUES (1,2,3) x (4,5,6);"):
        with pytest.raises(ValueError):
            R.sql_tuples(bad, 3)


def test_columns_of_a_dump_come_from_its_own_statement(spark, tmp_path):
    (tmp_path / "d.sql").write_text("-- a dump\nCREATE TABLE `t` (\n  `id` int(10) unsigned NOT NULL,\n  `share` decimal(5,2) DEFAULT NULL,\n  `name` varbinary(255) NOT NULL,\n  PRIMARY KEY (`id`)\n);\nINSERT INTO `t` VALUES (1,0.5,'a'),(2,NULL,'b');\nINSERT INTO `t` VALUES (3,1,'c\\'d');\n")
    got = R.read_sql_dump(spark, str(tmp_path / "d.sql"))
    assert got.schema.simpleString() == "struct<id:bigint,share:double,name:string>"
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0.5, "a"), (2, None, "b"), (3, 1.0, "c'd")]


def test_file_names_are_safe_bounded_and_unique(spark):
    titles = ["a/b: c?", "A/B: C?", "ଓ" * 100, "ଓ" * 101, "...", "", "x" * 300, " y. "]
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    names = {r["id"]: r["name"] for r in R.file_names(rows, "id", "title").collect()}
    assert len({n.lower() for n in names.values()}) == len(titles)
    assert all(len(n.encode()) <= 180 and n.endswith(".md") and not set(n) & set('\\/:*?"<>|') and "\ufffd" not in n for n in names.values())
    assert names[0] == "a_b_ c_.md" and names[1] == "A_B_ C_ 1.md" and names[7] == "y.md"
    wanted = spark.createDataFrame([(n,) for n in list(names.values())[:3]], "name string")
    assert R.stale_files(spark.createDataFrame([(n,) for n in names.values()], "name string"), wanted).count() == len(names) - 3


def test_log_keeps_bad_lines_apart(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "log.json").write_text('{"id": 1}\n{"id": 2, "v"\n\n{"id": 3}')
    good, bad = R.read_log(spark, str(tmp_path), T.StructType([T.StructField("id", T.LongType())]))
    assert ids(good) == [1, 3]
    assert bad.count() == 1


def md(html):
    return [b.line for b in blocks_of(html)]


def test_html_blocks():
    assert md("<h2>T</h2><p>a <b>b</b><p>c<ul><li>x<li>y</ul><nav>no</nav><table class=wikitable><tr><td rowspan=2>r<td>1<tr><td>2</table><script>z</script># d") == ["## T", "a b", "c", "- x", "- y", "| r | 1 |\n|---|---|\n| r | 2 |", "\\# d"]
    assert md("") == md("<p>  </p>") == md("<h2>only a heading</h2>") == md("<!-- c --><p>।</p>") == []
    assert md("<p>a<br>- b<br>c</p>") == ["a\n\\- b\nc"]


def test_html_sections_and_templates():
    assert md("<section><h2>A</h2><p>x</p><section><h3>See also</h3><ul><li>y</ul></section></section>") == ["## A", "x"]
    assert md("<h2>Notes</h2><p>x</p><h3>B</h3><p>y</p><h2>C</h2><p>z</p>") == ["## C", "z"]
    assert md("<h3>B</h3><h2>C</h2><h3>D</h3><p>z</p><h3>E</h3>") == ["## C", "### D", "z"]
    names = {"webarchive": True, "cleanup list": True, "geo-stub": True, "stub": True, "maine": False, "ipac-en": True, "info box": False, "for": True, "fore": False}
    assert {n: unwanted_template(n) for n in names} == names
    made = "<span about='#t' typeof='mw:Transclusion' data-mw='{}'>Template:X</span><i about='#t'>more</i>"
    assert md(f"<p>a {made} b <strong class='error'>Error: c</strong></p>") == ["a b"]
    assert md("<p>a <span typeof='mw:Transclusion' data-mw='nonsense'>kept</span></p>") == ["a kept"]


def test_html_lists():
    assert md("<ul><li><ul><li>a</ul><li>b<ol><li>c<li>d</ol>e</ul>") == ["- a", "- b", "  1. c", "  2. d", "  e"]
    assert md("<ol>" + "<li>x" * 10 + "<ul><li>y</ul></ol>")[-1] == "    - y"
    assert md("<ul><li>ଓଡ଼ିଆ ପାଠ <a rel='mw:ExtLink'>x</a><li><a rel='mw:ExtLink'>English</a></ul>") == ["- ଓଡ଼ିଆ ପାଠ x"]
    stranded = [Block("item", "a", 1, "- "), Block("item", "b", 3, "      - ")]
    assert [b.line for b in with_bounded_indent(stranded)] == ["- a", "  - b"]


def test_table_cells():
    at = cells([[("a", 3, 1), ("b", 1, 2)], [("c", 2, 1)], [("d", 9, 1)]])
    assert at == {(0, 0): "a", (1, 0): "a", (2, 0): "a", (0, 1): "b", (0, 2): "", (1, 1): "c", (2, 1): "c", (2, 2): "d"}
    assert grid([[("a", 1, 1)]]) is None and grid([[("a", 1, 1)], [("", 1, 1)]]) is None
    assert grid([[("h", 1, 1), ("empty", 1, 1), ("k", 1, 1)], [("1", 1, 1), ("", 1, 1), ("2", 1, 1)]]) == "| h | k |\n|---|---|\n| 1 | 2 |"
    wide = md("<table class=wikitable><tr><td colspan=900>a<td>b<tr><td>c<td>d</table>")
    assert wide == ["| a |  |\n|---|---|\n| c | d |"]


def test_formulas():
    assert md("<p>x<sup>2</sup> and 10<sup>-7</sup> m, 5.15×10<sup>18</sup>, CO<sub>2</sub>, T<sub>max</sub><sup>+</sup></p>") == ["x$^2$ and $10^{-7}$ m, $5.15 \\times 10^{18}$, CO$_2$, T$_{\\mathrm{max}}^+$"]
    assert md("<p>a<sup>not a number</sup></p>") == ["anot a number"]
    assert md("<p>so <span class='mwe-math-element'><math alttext='{\\displaystyle y_1}'></math></span> is * it</p>") == ["so $y_1$ is \\* it"]
    assert md("<p><span typeof='mw:Extension/chem' data-mw='{\"body\":{\"extsrc\":\"H2O\"},\"attrs\":{\"display\":\"block\"}}'></span> x</p>") == ["$$\\ce{H2O}$$ x"]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
