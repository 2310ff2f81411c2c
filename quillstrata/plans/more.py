"""Queries of residue rules, views, catalog status, resumable work and consistency: HTM9-13, API, QC3, SRC13, SNK2-3, STR3-10."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import residue as H
from ..functions import text as X
from ..sources import catalog as K
from ..sources import files as R
from ..streaming import log as S
from .base import query
from .files import place, written
from .filters import CASCADE_SQL, cascade
from .measures import _bins_sql, facet, histogram
from .relations import latest_events, partition_check
from .reviews import _KIND
from .reviews import _LINES as _PARAS
from .text import lines

N = lambda name="n": F.count("*").alias(name)
_L = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


# what each sample becomes, by number
_STRIPPED = [
    ('x <a href="y" class="cx-link">link</a> z', "x link z"), ("a &amp; b&#13;&#10;c", "a & b c"), ("{| a | b | c | d |}", ""), ("{| a |- b", " a  b"), ("see Infobox|width= 3|name = q", "see "), ("a | name = q", "a | name = q"),
    ('cell style="x" end', "cell  end"), ("in Category:Living people] x", "in  x"), ("Category:Towns", "Towns"), ("plain text", "plain text"),
]
_CLEAN = [
    ("a [[b]] ''c'' [2] d", "a b c d"), ("see (https://x.y/z) or www.q.r now", "see or now"), ("__NOTOC__ <poem>verse</poem> 70px", "verse"), ("ଓଡ଼ିଆ | ପାଠ || ", "ଓଡ଼ିଆ । ପାଠ ॥"), ("name (; , ) and (, x) and (y ;)", "name and (x) and (y)"), ("pic.jpg | thumb", ""),
    ("|| a || b", ""), ("... !", ""), ("Template:Gone", ""), ("[[Category: x]]", ""), ("a\n।\nb", "a\nb"), ("x[1] y [୧୨]", "x[1] y"),
]
_POWERS = [("6.1 x 108 ppb", r"$6.1 \times 10^{8}$ ppb"), ("6×1021 t", r"$6 \times 10^{21}$ t"), ("5.15×10\u22125", r"$5.15 \times 10^{-5}$"), ("2 x 105 MW", "2 x 105 MW"), ("22 x 1012", "22 x 1012"), ("1,2 x 1012", "1,2 x 1012"), ("2.5 * 10-12 m", r"$2.5 \times 10^{-12}$ m"), ("3 x 1012.5", "3 x 1012.5")]
_HEADS = [("One. ==Two== three", "0One. |2Two|0 three"), ("'== Two == x", "2Two|0 x"), ("a, ==b==, c", "0a, b, c"), ("x ===y===", "0x y"), ("end: ===y===", "0end: |3y"), ("plain", "0plain")]


def samples(t, pairs: list[tuple[str, str]]):
    """p_partkey and a sample by number."""
    return t.part.select("p_partkey", F.element_at(F.array(*[F.lit(a) for a, _ in pairs]), (F.col("p_partkey") % len(pairs) + 1).cast("int")).alias("s"))


def _wanted(name: str, pairs: list[tuple[str, str]]) -> str:
    quoted = ", ".join("'" + b.replace("'", "''") + "'" for _, b in pairs)
    return f"SELECT p_partkey, (ARRAY[{quoted}])[p_partkey % {len(pairs)} + 1] AS {name} FROM part"


@query("htm9_residue", _wanted("stripped", _STRIPPED))
def htm9(t):
    """Every rule, what it leaves alone, and a table typed as text."""
    return samples(t, _STRIPPED).select("p_partkey", H.strip_residue(F.col("s")).alias("stripped"))


@query("htm9_counts", "SELECT sum(len(regexp_extract_all(html, '<a\\s[^<>]*>|</a>')))::BIGINT AS anchors, sum(len(regexp_extract_all(html, '&amp;')))::BIGINT AS entities, sum(len(regexp_extract_all(html, '\\b(?:style|class|align|width|bgcolor|colspan|rowspan|valign|cellpadding|border)\\s*=\\s*\"[^\"]*\"')))::BIGINT AS attributes FROM pages")
def htm9_counts(t):
    """How often rules fire, over whole pages."""
    c = t.pages.select(H.residue_counts(F.col("html")).alias("c"))
    return c.agg(F.sum("c.anchor tags").alias("anchors"), F.sum("c.entity &amp;").alias("entities"), F.sum("c.attributes").alias("attributes"))


@query("htm10_clean_block", _wanted("cleaned", _CLEAN))
def htm10(t):
    return samples(t, _CLEAN).select("p_partkey", H.clean_block(F.col("s")).alias("cleaned"))


@query("htm11_typed_powers", _wanted("formula", _POWERS))
def htm11(t):
    return samples(t, _POWERS).select("p_partkey", H.typed_powers(F.col("s")).alias("formula"))


@query("htm13_split_headings", _wanted("blocks", _HEADS))
def htm13(t):
    """Headings after a sentence and at the start; elsewhere the signs alone go."""
    blocks = samples(t, _HEADS).select("p_partkey", H.split_headings(F.col("s")).alias("b"))
    return blocks.select("p_partkey", F.array_join(F.transform("b", lambda x: F.concat(x["level"].cast("string"), x["text"])), "|").alias("blocks"))


_CHARS = _bins_sql("chars", "n_chars", "documents")


@query("api4_overview", f"SELECT 'total' AS section, 'documents' AS name, '' AS option, count(*)::DOUBLE AS n FROM documents UNION ALL SELECT 'total', 'characters', '', sum(n_chars)::DOUBLE FROM documents UNION ALL SELECT 'histogram', 'n_chars', bin::VARCHAR, n::DOUBLE FROM ({_CHARS}) UNION ALL SELECT 'facet', 'lang', lang, count(*)::DOUBLE FROM documents GROUP BY lang UNION ALL SELECT 'facet', 'source', source, count(*)::DOUBLE FROM documents GROUP BY source UNION ALL SELECT 'nulls', 'quality', '', count(*)::DOUBLE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'annotation', 'labels', 'matched', count(*)::DOUBLE FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT 'warning', 'labels', 'corpus articles have no row', count(*)::DOUBLE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'warning', 'labels', 'ids are not in this corpus', count(*)::DOUBLE FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) HAVING count(*) > 0")
def api4(t):
    """Totals, distributions, facets, nulls, the status of an annotation and its warnings, as one table."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    empty, number = F.lit(""), lambda c: F.col(c).cast("double").alias("n")
    row = lambda df, section, name, option, n: df.select(F.lit(section).alias("section"), name.alias("name"), option.alias("option"), number(n))
    totals = d.agg(N(), F.sum("n_chars").alias("c"))
    both = d.select("doc_id", F.lit(1).alias("d")).join(t.labels.select("doc_id", F.lit(1).alias("l")).distinct(), "doc_id", "full_outer")
    status = both.agg(F.count_if(F.col("d").isNotNull() & F.col("l").isNotNull()).alias("matched"), F.count_if(F.col("l").isNull()).alias("missing"), F.count_if(F.col("d").isNull()).alias("orphans"))
    facets = facet(d, "lang").union(facet(d, "source"))
    parts = [
        row(totals, "total", F.lit("documents"), empty, "n"), row(totals, "total", F.lit("characters"), empty, "c"), row(histogram(d, "n_chars"), "histogram", F.lit("n_chars"), F.col("bin").cast("string"), "n"), row(facets, "facet", F.col("facet"), F.col("option"), "n"),
        row(status, "nulls", F.lit("quality"), empty, "missing"), row(status, "annotation", F.lit("labels"), F.lit("matched"), "matched"),
        row(status.where("missing > 0"), "warning", F.lit("labels"), F.lit("corpus articles have no row"), "missing"), row(status.where("orphans > 0"), "warning", F.lit("labels"), F.lit("ids are not in this corpus"), "orphans"),
    ]
    return functools.reduce(DataFrame.union, parts)


@query("api6_para_search", f"SELECT doc_id, para, kind, n, found, chars FROM (SELECT doc_id, para, {_KIND} AS kind, len(h)::BIGINT AS n, array_to_string(h[1:12], '|') AS found, length(line)::INT AS chars FROM (SELECT *, regexp_extract_all(line, '[0-9]+') AS h FROM ({_PARAS}))) WHERE n > 0 AND kind IN ('para', 'list') ORDER BY doc_id, para LIMIT 50 OFFSET 50")
def api6(t):
    """The second page of paragraphs of two kinds that match, with their first twelve hits. Totals by kind are AGG27."""
    hits = F.regexp_extract_all("line", F.lit("[0-9]+"), F.lit(0))
    p = lines(t).where(F.col("line").rlike("[0-9]+")).withColumn("kind", X.block_kind(F.col("line"))).where(F.col("kind").isin("para", "list"))
    page = p.orderBy("doc_id", "para").offset(50).limit(50)
    return page.select("doc_id", "para", "kind", F.size(hits).cast("long").alias("n"), F.array_join(F.slice(hits, 1, 12), "|").alias("found"), F.length("line").alias("chars"))


@query("api8_undo", "SELECT user_id, nth_value(event_type, 2) OVER w AS verdict FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def api8(t):
    """The state that an undo of each last decision would append; null where there is none before it."""
    last = latest_events(t.events.select("user_id", "event_id"), "user_id", "event_id")
    before = t.events.join(last.select("user_id", F.col("event_id").alias("last")), "user_id").where("event_id < last").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("verdict"))
    return last.select("user_id").join(before, "user_id", "left")


_EX = f"SELECT doc_id, regexp_replace(reason, ' of [0-9]+$', '') AS reason, nullif(regexp_extract(reason, ' of ([0-9]+)$', 1), '') AS named FROM ({CASCADE_SQL}) WHERE reason IS NOT NULL"


@query("api9_excluded_summary", f"WITH x AS ({_EX}), k AS (SELECT doc_id FROM ({CASCADE_SQL}) WHERE reason IS NULL) SELECT reason, count(*)::BIGINT AS n, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels))::BIGINT AS labelled, count(*) FILTER (WHERE named IS NOT NULL AND named::BIGINT IN (SELECT doc_id FROM k))::BIGINT AS named_kept, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM k))::BIGINT AS contradictions FROM x GROUP BY reason")
def api9(t):
    """Reasons with checks: how many are annotated, name an id that was kept, or were kept themselves."""
    c = cascade(t.documents)
    kept = c.where("reason is null").select(F.col("doc_id").alias("_k"), F.lit(1).alias("_kept"))
    x = c.where("reason is not null").select("doc_id", F.regexp_replace("reason", " of [0-9]+$", "").alias("reason"), F.nullif(F.regexp_extract("reason", " of ([0-9]+)$", 1), F.lit("")).cast("long").alias("named"))
    both = x.join(t.labels.select("doc_id", F.lit(1).alias("l")).distinct(), "doc_id", "left").join(kept, F.col("named") == F.col("_k"), "left").withColumnRenamed("_kept", "_n").drop("_k").join(kept, F.col("doc_id") == F.col("_k"), "left")
    return both.groupBy("reason").agg(N(), F.count("l").alias("labelled"), F.count("_n").alias("named_kept"), F.count("_kept").alias("contradictions"))


@query("api9_removed_blocks", f"SELECT b.doc_id, para, length(line)::INT AS chars, x.reason, x.doc_id IS NULL AS article_kept FROM ({_PARAS}) b LEFT JOIN ({_EX}) x USING (doc_id) WHERE regexp_matches(line, '[0-9]{{16}}') AND contains(lower(line), 'e') ORDER BY chars DESC, b.doc_id, para LIMIT 40")
def api9_blocks(t):
    """Blocks that were removed, searched and sorted, with what became of their article."""
    why = cascade(t.documents).where("reason is not null").select("doc_id", F.regexp_replace("reason", " of [0-9]+$", "").alias("reason"), F.lit(True).alias("_out"))
    b = lines(t).where(F.col("line").rlike("[0-9]{16}") & F.contains(F.lower("line"), F.lit("e"))).select("doc_id", "para", F.length("line").alias("chars"))
    page = b.orderBy(F.desc("chars"), "doc_id", "para").limit(40)
    return page.join(why, "doc_id", "left").select("doc_id", "para", "chars", "reason", F.col("_out").isNull().alias("article_kept"))


@query("qc3_consistency", f"WITH c AS ({CASCADE_SQL}), l AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) SELECT (SELECT count(*) FROM documents)::BIGINT AS ids, count(*) FILTER (WHERE reason IS NULL)::BIGINT AS kept, count(*) FILTER (WHERE reason IS NOT NULL)::BIGINT AS excluded, (SELECT count(*) FROM l WHERE n > 1)::BIGINT AS repeated, (SELECT count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM documents))::BIGINT AS strangers, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l))::BIGINT AS lost FROM c")
def qc3(t):
    """The lists of a finished build, written as files and read again."""
    c = cascade(t.documents)
    kept, out = (R.read_json_lines(t.spark, written(t, c.where(p).select("doc_id")), "doc_id long") for p in ("reason is null", "reason is not null"))
    return partition_check(t.documents, kept, out, "doc_id")


@query("src13_discover", "SELECT dataset, kind, name, detail, rows FROM (VALUES ('one', 'newest', 'docs-20260201', 'jsonl', 'd'), ('one', 'versions', '2', '', ''), ('one', 'annotation', 'quality', 'article', 'l'), ('one', 'annotation', 'lines', 'paragraph', 'l'), ('one', 'ignored', 'annotations/odd', 'no id', ''), ('one', 'ignored', 'extra', 'no id and text', ''), ('two', 'newest', 'any', 'parquet', 'd'), ('two', 'versions', '1', '', '')) v(dataset, kind, name, detail, r) JOIN (SELECT 'd' AS r, count(*)::BIGINT AS rows FROM documents UNION ALL SELECT 'l', count(*) FROM labels UNION ALL SELECT '', 0) USING (r)")
def src13(t):
    """Folders with two versions in three formats, annotations of articles and of paragraphs, and files that are neither; a folder without a corpus is none."""
    root = place(t)
    docs, labels = t.documents.select(F.col("doc_id").alias("id"), "text"), t.labels.select(F.col("doc_id").alias("id"), "quality")
    docs.write.parquet(f"{root}/one/docs-20250101.parquet")
    docs.write.parquet(f"{root}/one/docs-20260201.parquet")
    R.write_json_lines(docs, f"{root}/one/docs-20260201.jsonl")
    R.write_json_lines(labels.select("quality"), f"{root}/one/extra.jsonl")
    R.write_json_lines(labels, f"{root}/one/annotations/quality.jsonl")
    labels.withColumn("para", F.lit(1)).write.parquet(f"{root}/one/annotations/lines.parquet")
    labels.select("quality").write.parquet(f"{root}/one/annotations/odd.parquet")
    docs.write.parquet(f"{root}/two/any.parquet")
    labels.write.parquet(f"{root}/three/labels.parquet")
    out = []
    for name, ds in K.discover(t.spark, root).items():
        out += [(name, "newest", ds.newest.stem, ds.newest.ending[1:], K.open_table(t.spark, ds.newest).count()), (name, "versions", str(len(ds.versions)), "", 0)]
        out += [(name, "annotation", a, level, K.open_table(t.spark, f).count()) for a, (f, level) in ds.annotations.items()]
        out += [(name, "ignored", f, why, 0) for f, why in ds.ignored.items()]
    return t.spark.createDataFrame(out, "dataset string, kind string, name string, detail string, rows long")


@query("snk2_replaced", "SELECT doc_id FROM labels")
def snk2(t):
    """Written twice to one place: the second write replaces the first as a whole."""
    path = place(t)
    R.write_json_lines(t.documents.select("doc_id"), path)
    R.write_json_lines(t.labels.select("doc_id"), path)
    return R.read_json_lines(t.spark, path, "doc_id long")


@query("snk3_gzip_equal", "SELECT 'again' AS copy, true AS same FROM labels HAVING count(*) > 0 UNION ALL SELECT 'edited', count(*) FILTER (WHERE doc_id % 9 = 1) = 0 FROM labels")
def snk3(t):
    """Packed copies written one after the other are the same bytes; an edited table's are not."""
    rows = t.labels.select("doc_id", "quality").orderBy("doc_id").coalesce(1)
    digest = lambda df: t.spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(written(t, df, True)).agg(F.sort_array(F.collect_list(F.sha1("content"))).alias("h")).first()[0]
    first = digest(rows)
    edited = rows.withColumn("quality", F.when(F.col("doc_id") % 9 == 1, 7).otherwise(F.col("quality")))
    return t.spark.createDataFrame([("again", digest(rows) == first), ("edited", digest(edited) == first)], "copy string, same boolean")


@query("str3_resumed", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN CASE WHEN page_id % 10 = 4 THEN 404 ELSE 200 END ELSE 200 END AS status, CASE WHEN page_id % 2 = 0 AND page_id % 10 <> 6 THEN 1 ELSE 2 END AS run FROM pages")
def str3(t):
    """Half of the work is there, some of it failed for good and some not: only what is missing or may be tried again is done and added."""
    path = place(t)
    first = t.pages.where("page_id % 2 = 0").select("page_id", F.when(F.col("page_id") % 10 == 6, 503).when(F.col("page_id") % 10 == 4, 404).otherwise(200).alias("status"), F.lit(1).alias("run"))
    first.write.parquet(path)
    done = t.spark.read.schema(first.schema).parquet(path)
    final = done.where(F.col("status").isin(200, 403, 404, 410))
    again = t.pages.select("page_id").join(final.select("page_id"), "page_id", "left_anti").select("page_id", F.lit(200).alias("status"), F.lit(2).alias("run"))
    again.write.mode("append").parquet(path)
    return S.latest(t.spark.read.schema(first.schema).parquet(path), ["page_id"], "run")


@query("str5_manifest", "SELECT * FROM (VALUES ('first', false), ('same', true), ('after that', true)) v(input, resumed) UNION ALL SELECT 'edited', count(*) FILTER (WHERE doc_id % 9 = 1) = 0 FROM labels")
def str5(t):
    """A checkpoint counts only for the input that its manifest names."""
    path, rows = place(t), t.labels.select("doc_id", "quality")
    edited = rows.withColumn("quality", F.when(F.col("doc_id") % 9 == 1, 7).otherwise(F.col("quality")))
    said = [(name, K.resumable(t.spark, path, df)) for name, df in (("first", rows), ("same", rows.repartition(4)), ("edited", edited), ("after that", edited))]
    return t.spark.createDataFrame(said, "input string, resumed boolean")


@query("str6_stale_caches", "SELECT 'of labels' AS cache, count(*) FILTER (WHERE doc_id % 9 = 1) > 0 AS stale FROM labels UNION ALL SELECT 'of documents', false UNION ALL SELECT 'of both', count(*) FILTER (WHERE doc_id % 9 = 1) > 0 FROM labels")
def str6(t):
    """Caches of which a source is edited afterwards."""
    docs, rows = K.state_of(t.documents.select("doc_id", "text")), t.labels.select("doc_id", "quality")
    labels = K.state_of(rows)
    made = {"of labels": {"labels": labels}, "of documents": {"documents": docs}, "of both": {"labels": labels, "documents": docs}}
    now = {"labels": K.state_of(rows.withColumn("quality", F.when(F.col("doc_id") % 9 == 1, 7).otherwise(F.col("quality")))), "documents": K.state_of(t.documents.repartition("doc_id").select("text", "doc_id"))}
    return t.spark.createDataFrame(list(K.stale(made, now).items()), "cache string, stale boolean")


@query("str10_snapshot", "SELECT count(*)::BIGINT AS pinned, (SELECT count(*) FROM documents)::BIGINT AS newest, sum(doc_id)::BIGINT AS pinned_sum FROM labels")
def str10(t):
    """A reader keeps the snapshot that it has opened while the table is replaced by another."""
    root = place(t)
    K.publish(t.labels.select("doc_id"), root)
    pinned = K.snapshot(t.spark, root)
    K.publish(t.documents.select("doc_id"), root)
    return pinned.agg(N("pinned"), F.sum("doc_id").alias("pinned_sum")).join(F.broadcast(K.snapshot(t.spark, root).agg(N("newest"))))


@query("api12_home", "SELECT 'one' AS dataset, '20260201' AS version, (SELECT count(*) FROM documents)::BIGINT AS articles, (SELECT sum(n_chars) FROM documents)::BIGINT AS chars, 1::BIGINT AS annotations, (SELECT count(*) FROM labels)::BIGINT AS annotated, (SELECT count(*) FROM benchmark)::BIGINT AS review_first")
def api12(t):
    """The counts of the first page: each dataset's newest version, its annotations, and how many items its review queue holds."""
    root, docs = place(t), t.documents.select(F.col("doc_id").alias("id"), "text")
    docs.write.parquet(f"{root}/one/docs-20260201.parquet")
    t.labels.select(F.col("doc_id").alias("id"), "quality").write.parquet(f"{root}/one/annotations/quality.parquet")
    t.benchmark.select(F.concat(F.lit("## "), F.col("item_id").cast("string"), F.lit(". Item ("), F.col("item_id").cast("string"), F.lit(")\n")).alias("value")).coalesce(1).write.text(f"{root}/one/quality")
    ds = K.discover(t.spark, root)["one"]
    queue = R.read_queue(t.spark, f"{root}/one/quality").agg(N("review_first"))
    rows = K.open_table(t.spark, ds.newest).agg(N("articles"), F.sum(F.length("text")).alias("chars"))
    marked = K.open_table(t.spark, ds.annotations["quality"][0]).agg(F.count_distinct("id").alias("annotated"))
    return rows.join(F.broadcast(marked)).join(F.broadcast(queue)).select(F.lit(ds.folder).alias("dataset"), F.lit(max(ds.versions)).alias("version"), "articles", "chars", F.lit(len(ds.annotations)).cast("long").alias("annotations"), "annotated", "review_first")
