"""Queries of HTML conversion (HTM2-8, HTM12, HTM17, WIN6): pages are made of table rows, so that SQL can say what must come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import residue as H
from ..functions.markdown import assembled, html_blocks
from .base import query
from .text import lines


def tags(*parts: str | Column) -> Column:
    """HTML of literal tags and of columns, whose text is escaped."""
    escaped = lambda c: F.replace(F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.concat(*[F.lit(p) if isinstance(p, str) else escaped(p) for p in parts])


def one_of(*choices: str) -> Column:
    """A choice by p_size."""
    return F.element_at(F.array(*map(F.lit, choices)), (F.col("p_size") % len(choices) + 1).cast("int"))


def made_blocks(t, html: Column) -> DataFrame:
    """p_partkey and blocks of a page made of each part. Rows are few bytes and pages take long: they are dealt to all tasks, however few files hold them."""
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    parts = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size").repartition(tasks, "p_partkey")
    return html_blocks(parts.select("p_partkey", html.alias("html")), "p_partkey", "html")


def markdown_of(t, html: Column) -> DataFrame:
    """p_partkey and the Markdown of a page made of each part."""
    return made_blocks(t, html).select("p_partkey", assembled(F.col("blocks")).alias("markdown"))


def part_columns() -> tuple[Column, Column, Column]:
    return F.col("p_name"), F.col("p_type"), F.col("p_brand")


BREAK = "chr(10) || chr(10)"


@query("htm2_reference_sections", f"SELECT p_partkey, CASE WHEN p_size % 6 IN (2, 5) THEN '## History' || {BREAK} || p_name || {BREAK} || '### Deep' || {BREAK} || p_type || {BREAK} ELSE '' END || '## Life' || {BREAK} || p_brand AS markdown FROM part")
def htm2(t):
    """As sections that are elements, and as headings that follow each other."""
    name, kind, brand = part_columns()
    head = one_of("References", "See also:", "History", "ବାହାର ଆଧାର", "== Further reading ==", "History")
    nested = F.concat(F.lit("<section><h2>"), head, F.lit("</h2>"), tags("<p>", name, "</p><section><h3>Deep</h3><p>", kind, "</p></section></section><section><h2>Life</h2><p>", brand, "</p></section>"))
    flat = F.concat(F.lit("<h2>"), head, F.lit("</h2>"), tags("<p>", name, "</p><h3>Deep</h3><p>", kind, "</p><h2>Life</h2><p>", brand, "</p>"))
    return markdown_of(t, F.when(F.col("p_partkey") % 2 == 0, nested).otherwise(flat))


@query("htm3_templates", f"SELECT p_partkey, CASE WHEN p_size % 7 IN (2, 6) THEN p_type || {BREAK} || p_name || {BREAK} ELSE '' END || p_brand || CASE WHEN p_size % 7 = 6 THEN ' India' ELSE '' END AS markdown FROM part")
def htm3(t):
    """Exact names, beginnings, endings, output that is an error, links to missing templates; all elements of one template go together."""
    name, kind, brand = part_columns()
    made_by = one_of("Webarchive", "Cleanup section", "Infobox_thing", "Geo-stub", "Sister_project_links", "Missing", "Flag")
    shown = F.when(F.col("p_size") % 7 == 5, F.concat(F.lit("Template:"), kind)).otherwise(kind)
    data = F.concat(F.lit("<p about='#m1' typeof='mw:Transclusion' data-mw='{\"parts\":[{\"template\":{\"target\":{\"wt\":\""), made_by, F.lit("\"}}}]}'>"))
    link = F.when(F.col("p_size") % 7 == 6, " <a>Template:Country data India</a>").otherwise(" <a>Template:Gone</a>")
    return markdown_of(t, F.concat(data, shown, tags("</p><p about='#m1'>", name, "</p><p>", brand), link, F.lit("<span style='color: red'>Error: bad</span></p>")))


@query("htm4_dropped", f"SELECT p_partkey, CASE WHEN p_size % 8 IN (0, 7) THEN p_name || {BREAK} ELSE '' END || p_brand AS markdown FROM part")
def htm4(t):
    """By class, role, kind, hidden style and tag."""
    name, kind, brand = part_columns()
    opened = one_of("<div class='plain'>", "<div class='wide infobox'>", "<div role='navigation'>", "<div style='Display : None'>", "<div typeof='mw:File/Thumb'>", "<figure>", "<table>", "<div title='infobox'>")
    closed = one_of(*["</div>"] * 5, "</figure>", "</table>", "</div>")
    return markdown_of(t, F.concat(opened, tags("<p>", name, "</p>"), closed, tags("<p>", brand, "</p>")))


_ROWS = "SELECT p_partkey, unnest([{{'kind': 'heading', 'level': 2, 'line': '## ' || p_name}}, {{'kind': 'paragraph', 'level': 0, 'line': p_type || chr(10) || p_brand}}, {{'kind': 'item', 'level': 1, 'line': '- ' || p_size}}, {{'kind': 'table', 'level': 0, 'line': '| ' || p_name || ' |' || chr(10) || '|---|' || chr(10) || '| ' || p_size || ' |'}}], recursive := true) FROM part".replace("{{", "{").replace("}}", "}")


@query("htm5_blocks", _ROWS)
def htm5(t):
    name, kind, brand = part_columns()
    html = tags("<h2>", name, "</h2><p>", kind, "<br> ", brand, "<ul><li>", F.col("p_size"), "</ul><table class=wikitable><tr><th>", name, "<tr><td>", F.col("p_size"), "</table><nav>", name, "</nav>")
    return made_blocks(t, html).select("p_partkey", F.explode("blocks").alias("b")).select("p_partkey", "b.kind", "b.level", F.concat("b.lead", "b.text").alias("line"))


@query("htm6_lists", "SELECT p_partkey, '1. ' || p_name || chr(10) || '   - ' || p_type || chr(10) || '   - ' || p_brand || CASE WHEN p_size % 3 = 0 THEN chr(10) || '2. plain ' || p_size || chr(10) || '3. end' ELSE chr(10) || '2. end' END AS markdown FROM part")
def htm6(t):
    """Numbers count what is left: items that are links out or citations alone go."""
    name, kind, brand = part_columns()
    third = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("plain "), F.col("p_size").cast("string"))).when(F.col("p_size") % 3 == 1, "<a rel='mw:ExtLink' href='x'>a link</a>").otherwise("Book, ISBN 1")
    return markdown_of(t, F.concat(tags("<ol><li>", name, "<ul><li>", kind, "<li>", brand, "</ul><li>"), third, F.lit("<li>end</ol>")))


@query("htm7_tables", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '| a | b | d |' || chr(10) || '|---|---|---|' || chr(10) || '| ' || p_name || ' | 1 | 2 |' || chr(10) || '| ' || p_name || ' | w\\|x |  |' ELSE p_brand END AS markdown FROM part".replace("\\\\", "\\"))
def htm7(t):
    """A cell over two rows, one over two columns, an empty column, a bar; a table of one row is none."""
    name, kind, brand = part_columns()
    whole = tags("<table class=wikitable><tr><th>a<th>b<th>c<th>d<tr><td rowspan=2>", name, "<td>1<td><td>2<tr><td colspan=3>w|x</table>")
    return markdown_of(t, F.when(F.col("p_size") % 2 == 0, whole).otherwise(tags("<table class=wikitable><tr><td>", name, "</table><p>", brand, "</p>")))


_EXP = "CASE WHEN p_size < 10 THEN p_size::VARCHAR ELSE '{' || p_size || '}' END"


@query("htm8_formulas", f"SELECT p_partkey, 'mass $6 \\times 10^' || {_EXP} || '$ km$^2$ H$_2$O NO$_3^-$ L$_{{\\mathrm{{sol}}}}$ word(ofmany)' || {BREAK} || '$$a^' || p_size || '$$' || {BREAK} || 'so $a b$ end' AS markdown FROM part".replace("\\\\", "\\"))
def htm8(t):
    """Exponents with and without a base, indices, formulas side by side, and one that stands alone."""
    math = lambda tex: F.concat(F.lit("<span typeof='mw:Extension/math' data-mw='{\"body\":{\"extsrc\":\""), tex, F.lit("\"}}'></span>"))
    size = F.col("p_size").cast("string")
    first = F.concat(F.lit("<p>mass 6×10<sup>"), size, F.lit("</sup> km<sup>2</sup> H<sub>2</sub>O NO<sub>3</sub><sup>−</sup> L<sub>sol</sub> word<sup>(of</sup>many)</p>"))
    return markdown_of(t, F.concat(first, F.lit("<p>"), math(F.concat(F.lit("a^"), size)), F.lit("</p><p>so "), math(F.lit("a")), math(F.lit("b")), F.lit(" end</p>")))


# HTM12: what each case becomes, by number
_ESCAPES = [
    (r"# a", r"\# a"), (r"> a", r"\> a"), (r"| a |", r"\| a |"), (r"- a", r"\- a"), (r"+ a", r"\+ a"), (r"12. a", r"12\. a"), (r"3) a", r"3\) a"), (r"==", r"\=="), (r"a*b`c$d", r"a\*b\`c\$d"),
    (r"_a_ b_c", r"\_a\_ b_c"), (r"a <b> < c", r"a \<b> < c"), (r"[a](b)", r"[a\](b)"), (r"~~a~ b", r"\~~a~ b"), (r"a\*b \c", r"a\\\*b \c"), (r"-a #b", r"-a #b"),
]
_sql = lambda values: ", ".join("'" + v.replace("'", "''") + "'" for v in values)


@query("htm12_escape", f"SELECT p_partkey, (ARRAY[{_sql(b for _, b in _ESCAPES)}])[p_partkey % {len(_ESCAPES)} + 1] || chr(10) || 'x ' || p_name || chr(10) || '\\# y' AS escaped FROM part")
def htm12(t):
    """Eleven rules: six anywhere, five at the start of a line."""
    name, kind, brand = part_columns()
    text = F.concat(F.element_at(F.array(*[F.lit(a) for a, _ in _ESCAPES]), (F.col("p_partkey") % len(_ESCAPES) + 1).cast("int")), F.lit("\nx "), name, F.lit("\n# y"))
    return t.part.select("p_partkey", H.escape_markdown(text).alias("escaped"))


def surviving(blocks: DataFrame, doc: str, at: str, level: str, deepest: int = 6) -> DataFrame:
    """WIN6, HTM17: blocks with `survives`; level is 0 for what is no heading. A heading survives if content comes before the next heading of its level or above.

    Rows are read from the end of each document, so that minima over what follows are kept up row by row.
    """
    later = W.partitionBy(doc).orderBy(F.desc(at)).rowsBetween(W.unboundedPreceding, -1)
    content = F.min(F.when(F.col(level) == 0, F.col(at))).over(later)
    closing = F.array(*[F.min(F.when(F.col(level).between(1, m), F.col(at))).over(later) for m in range(1, deepest + 1)])
    closes = F.when(F.col(level) > 0, F.element_at(closing, F.greatest(F.col(level).cast("int"), F.lit(1))))
    marked = blocks.withColumns({"_content": content, "_closes": closes})
    return marked.withColumn("survives", (F.col(level) == 0) | (F.col("_content").isNotNull() & (F.col("_closes").isNull() | (F.col("_content") < F.col("_closes"))))).drop("_content", "_closes")


def leveled(t) -> DataFrame:
    """Lines as blocks whose level is their length modulo 4."""
    return lines(t).select("doc_id", "para", F.pmod(F.length("line"), F.lit(4)).alias("level"))


_B = "b AS (SELECT doc_id, unnest(range(len(l))) AS para, length(unnest(l)) % 4 AS level FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
_LATER = "OVER (PARTITION BY doc_id ORDER BY para ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
_SURVIVES = f"WITH {_B}, n AS (SELECT *, min(CASE WHEN level = 0 THEN para END) {_LATER} AS content, CASE level WHEN 1 THEN min(CASE WHEN level = 1 THEN para END) {_LATER} WHEN 2 THEN min(CASE WHEN level IN (1, 2) THEN para END) {_LATER} ELSE min(CASE WHEN level > 0 THEN para END) {_LATER} END AS closes FROM b), s AS (SELECT *, level = 0 OR (content IS NOT NULL AND (closes IS NULL OR content < closes)) AS survives FROM n) "


@query("win6_headings", _SURVIVES + "SELECT doc_id, count(*) FILTER (WHERE survives)::BIGINT AS n FROM s GROUP BY doc_id")
def win6(t):
    return surviving(leveled(t), "doc_id", "para", "level", 3).groupBy("doc_id").agg(F.count_if("survives").alias("n"))


@query("htm17_orphan_headings", _SURVIVES + "SELECT doc_id, count(*) FILTER (WHERE NOT survives)::BIGINT AS orphans FROM s GROUP BY doc_id")
def htm17(t):
    return surviving(leveled(t), "doc_id", "para", "level", 3).groupBy("doc_id").agg(F.count_if(~F.col("survives")).alias("orphans"))
