"""Queries of readers, writers, streams and HTML conversion: SRC, SNK, STR, HTM."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markdown import assembled, html_blocks
from ..functions.statements import best_ranked
from ..operators.review import decision_states
from ..sources import catalog as K
from ..sources import files as R
from ..sources.shared import shared_dir, stored
from ..streaming import log as S
from .base import query
from .reviews import STATES_SQL, decisions_of, texts_of
from .text import lines


def place(t) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(t.spark)}/{uuid.uuid4().hex}"


def written(t, df: DataFrame, compressed: bool = False) -> str:
    path = place(t)
    R.write_json_lines(df, path, compressed)
    return path


def dumped(pages: DataFrame, path: str) -> None:
    """A dump of pages (id, page): XML files of one root each, written partition by partition. A file is a task to its reader, so that there are as many as the session deals to."""
    files = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def whole(batches):
        yield pd.DataFrame({"value": ["<dump>"]})
        for batch in batches:
            yield pd.DataFrame({"value": batch["page"]})
        yield pd.DataFrame({"value": ["</dump>"]})

    pages.repartition(files, "id").mapInPandas(whole, "value string").write.text(path)


_DOC = "SELECT doc_id, lang, source, n_chars FROM documents"


@query("src1_json_lines", _DOC)
def src1(t):
    path = written(t, t.documents.select("doc_id", "lang", "source", "n_chars"), True)
    return R.read_json_lines(t.spark, path, "doc_id long, lang string, source string, n_chars long")


@query("src2_typed", "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS o_orderdate FROM orders")
def src2(t):
    path = written(t, t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")))
    return R.read_json_lines(t.spark, path, "o_orderkey long, o_orderdate string")


@query("src3_inferred", "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS o_orderdate, o_totalprice FROM orders")
def src3(t):
    path = written(t, t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice"))
    return R.read_json_lines(t.spark, path)


@query("src4_parquet", "SELECT r_regionkey, r_name FROM region")
def src4(t):
    return t.region.select("r_regionkey", "r_name")


@query("src5_chunks", "SELECT page_id, length(html)::INT AS n FROM pages")
def src5(t):
    path = place(t)
    t.pages.select("page_id", "html").repartitionByRange(4, "page_id").write.option("compression", "gzip").json(path)
    return R.read_json_lines(t.spark, path, "page_id long, html string").select("page_id", F.length("html").alias("n"))


@query("src8_sql_dump", "SELECT doc_id, source, n_chars, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id / 4 END AS share, md5(text) AS text FROM documents")
def src8(t):
    """Columns from the dump's CREATE TABLE; texts with quotes, backslashes and line breaks; nulls and fractions; two rows a statement."""
    path = place(t)
    quoted = lambda c: F.concat(F.lit("'"), F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("'"))
    share = F.when(F.col("doc_id") % 5 == 0, "NULL").otherwise((F.col("doc_id") / 4).cast("string"))
    row = F.concat_ws(",", F.col("doc_id").cast("string"), quoted(F.col("source")), F.col("n_chars").cast("string"), share, quoted(F.col("text")))
    t.spark.createDataFrame([("CREATE TABLE `docs` (",), ("  `doc_id` bigint(20) unsigned NOT NULL,",), ("  `source` varbinary(255) NOT NULL,",), ("  `n_chars` int(10) DEFAULT NULL,",), ("  `share` decimal(9,2) DEFAULT NULL,",), ("  `text` longblob,",), ("  PRIMARY KEY (`doc_id`)",), (");",)], "value string").coalesce(1).write.text(path)
    t.documents.select(F.concat(F.lit("INSERT INTO `docs` VALUES ("), row, F.lit(");")).alias("value")).write.mode("append").text(path)
    return R.read_sql_dump(t.spark, path).withColumn("text", F.md5("text"))


@query("src12_statements", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Q1,Q' || (p_partkey + 100) WHEN 1 THEN 'Q' || (p_partkey + 100) WHEN 2 THEN 'Q7' ELSE '' END AS items FROM part")
def src12(t):
    """Normal statements, a preferred one beside them, a deprecated one, and none with a value; repeats count once."""
    one = lambda rank, item: F.concat(F.lit('{"rank":"' + rank + '","mainsnak":{"snaktype":"value","datavalue":{"value":{"id":"'), item, F.lit('"}}}}'))
    own, q = F.concat(F.lit("Q"), (F.col("p_partkey") + 100).cast("string")), F.lit("Q1")
    cases = F.element_at(F.array(F.concat_ws(",", one("normal", q), one("normal", own), one("normal", q)), F.concat_ws(",", one("normal", q), one("preferred", own), one("deprecated", F.lit("Q3"))), F.concat_ws(",", one("deprecated", own), one("normal", F.lit("Q7")), one("normal", F.lit("P7"))), F.lit('{"rank":"normal","mainsnak":{"snaktype":"novalue"}}')), (F.col("p_size") % 4 + 1).cast("int"))
    made = t.part.select("p_partkey", F.concat(F.lit('{"P31":['), cases, F.lit('],"P106":[]}')).alias("claims"))
    return made.select("p_partkey", F.array_join(best_ranked(F.col("claims"), "P31"), ",").alias("items"))


@query("src6_pages_xml", "SELECT doc_id AS id, source AS title, length(text)::INT AS n, doc_id % 4 = 1 AS stub, doc_id % 6 = 2 AS cleanup FROM documents WHERE doc_id % 10 <> 0 AND doc_id % 10 <> 7")
def src6(t):
    """Redirects and other namespaces are left out; of several revisions the last counts; flags come from the templates in its text."""
    path = place(t)
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\r"), F.lit("&#13;"))
    i = F.col("doc_id")
    text = F.concat(F.when(i % 4 == 1, "{{Stub|x}}").otherwise("{{Main}}"), F.when(i % 6 == 2, "{{cleanup section}}").otherwise(""), F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "?"))
    old = F.lit("<revision><id>1</id><timestamp>2025</timestamp><text>{{Stub}} old</text></revision>")
    page = F.concat(F.lit("<page><title>"), esc("source"), F.lit("</title><ns>"), F.when(i % 10 == 7, "1").otherwise("0"), F.lit("</ns><id>"), i.cast("string"), F.lit("</id>"), F.when(i % 10 == 0, '<redirect title="x"/>').otherwise(""), F.lit("<revision><id>2</id><timestamp>2026</timestamp><text>"), esc(text), F.lit("</text></revision>"), old, F.lit("</page>"))
    dumped(t.documents.select(i.alias("id"), page.alias("page")), path)
    got = R.read_pages_xml(t.spark, path, {"stub": ["stub", "*-stub"], "cleanup": ["cleanup*"]})
    bare = F.regexp_replace("text", r"^\{\{[^}]*\}\}(\{\{cleanup section\}\})?", "")
    return got.select("id", "title", F.length(bare).alias("n"), "stub", "cleanup")


@query("src7_history_xml", "SELECT conv_id AS page, turn AS rev, CASE role WHEN 'system' THEN NULL WHEN 'user' THEN 'ip:10.0.0.1' ELSE role END AS user, strlen(text)::BIGINT AS bytes FROM conversations")
def src7(t):
    path = place(t)
    who = F.when(F.col("role") == "system", '<contributor deleted="deleted"/>').when(F.col("role") == "user", "<contributor><ip>10.0.0.1</ip></contributor>").otherwise(F.concat(F.lit("<contributor><username>"), "role", F.lit("</username><id>7</id></contributor>")))
    rev = F.concat(F.lit("<revision><id>"), F.col("turn").cast("string"), F.lit("</id><timestamp>2026</timestamp>"), who, F.lit('<text bytes="'), F.octet_length("text").cast("string"), F.lit('"/></revision>'))
    pages = t.conversations.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(rev)), "").alias("r")).select(F.col("conv_id").alias("id"), F.concat(F.lit("<page><id>"), F.col("conv_id").cast("string"), F.lit("</id>"), "r", F.lit("</page>")).alias("page"))
    dumped(pages, path)
    return R.read_history_xml(t.spark, path).select("page", "rev", "user", "bytes")


@query("src14_newest", "SELECT 'a' AS stem, 'a.jsonl' AS file, count(*)::BIGINT AS rows FROM labels UNION ALL SELECT 'b', 'b.parquet', count(*)::BIGINT FROM documents UNION ALL SELECT 'c', 'c.jsonl.gz', count(*)::BIGINT FROM labels")
def src14(t):
    """Files of one table in several formats: the newest, and of equally new ones plain before packed lines before Parquet."""
    path, labels, docs = place(t), t.labels.select("doc_id"), t.documents.select("doc_id")
    fs = K.Store(t.spark)
    for name, rows in (("a.parquet", docs), ("a.jsonl", labels), ("b.jsonl", labels), ("b.parquet", docs), ("c.parquet", docs), ("c.jsonl.gz", labels)):
        rows.write.parquet(f"{path}/{name}") if name.endswith("parquet") else R.write_json_lines(rows, f"{path}/{name}", name.endswith("gz"))
    files = [K.File(f.path, f.size, {"a": 5, "c": 5}.get(f.stem, 9 if f.name == "b.parquet" else 1)) for f in fs.listed(path)]
    found = K.picked(files)
    return t.spark.createDataFrame([(stem, f.name, K.open_table(t.spark, f, "doc_id long").count()) for stem, f in found.items()], "stem string, file string, rows long")


@query("src15_labels", "SELECT doc_id, quality FROM labels")
def src15(t):
    path = place(t)
    t.labels.select("doc_id", "quality").write.option("sep", "\t").option("header", "true").csv(path)
    return R.read_labels(t.spark, path, "doc_id long, quality int", [])


@query("src16_missing_columns", "SELECT doc_id, NULL::VARCHAR AS detail, NULL::INT AS article_kept, quality, 'detail,article_kept' AS missing FROM labels")
def src16(t):
    """Columns that a side table lacks are nulls, and are named."""
    path = written(t, t.labels.select("doc_id", "quality"))
    rows, missing = K.with_columns(R.read_json_lines(t.spark, path), "doc_id long, detail string, article_kept int, quality int")
    return rows.withColumn("missing", F.lit(",".join(missing)))


@query("src17_log", "SELECT event_id, event_type FROM events WHERE event_id % 7 <> 3")
def src17(t):
    path = place(t)
    line = F.when(F.col("event_id") % 7 == 3, '{"event_id": 3, "event_ty').otherwise(F.to_json(F.struct("event_id", "event_type")))
    t.events.select(line.alias("value")).write.text(path)
    from pyspark.sql import types as T

    return R.read_log(t.spark, path, T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())]))[0]


@query("src19_queue", "SELECT row_number() OVER (ORDER BY item_id)::INT AS rank, 'Item ' || item_id AS title, item_id AS id, trim(regexp_replace(text, '[#\n]', '', 'g')) AS body FROM benchmark")
def src19(t):
    path = place(t)
    from pyspark.sql import Window as W

    item = t.benchmark.select("item_id", F.row_number().over(W.orderBy("item_id")).alias("rank"), F.trim(F.regexp_replace("text", "[#\n]", "")).alias("body"))
    item.orderBy("rank").coalesce(1).select(F.format_string("## %d. Item %d (%d)\n\n%s\n", "rank", "item_id", "item_id", "body").alias("value")).write.text(path)
    return R.read_queue(t.spark, path).select("rank", "title", "id", "body")


@query("src13_kinds", "SELECT 'lang' AS column, 'category' AS kind UNION ALL SELECT 'source', 'category' UNION ALL SELECT 'text', 'text'")
def src13(t):
    return R.kinds_of(t.documents.select("lang", "source", "text"))


@query("snk1_round_trip", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)")
def snk1(t):
    path = written(t, t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality"))
    return R.read_json_lines(t.spark, path, "doc_id long, quality int")


@query("snk4_markdown_files", "SELECT p_partkey, CASE WHEN p_partkey = min(p_partkey) OVER (PARTITION BY p_name) THEN p_name || '.md' ELSE p_name || ' ' || p_partkey || '.md' END AS name, '---' || chr(10) || 'id: ' || p_partkey || chr(10) || 'title: \"' || p_name || '\"' || chr(10) || '---' || chr(10) || chr(10) || p_type AS content FROM part")
def snk4(t):
    return R.markdown_files(t.part.select("p_partkey", "p_name", "p_type"), "p_partkey", "p_name", "p_type")


@query("snk5_annotation", "SELECT 'first' AS write, count(*)::BIGINT AS rows, 'monday' AS created FROM labels UNION ALL SELECT 'same', count(*), 'monday' FROM labels UNION ALL SELECT 'edited', count(*), CASE WHEN count(*) FILTER (WHERE doc_id % 9 = 1) > 0 THEN 'wednesday' ELSE 'monday' END FROM labels UNION ALL SELECT 'repeated keys', count(*), 'refused' FROM labels")
def snk5(t):
    """An annotation with its sidecar: `created` stays while the rows are the same, whatever their order; repeated keys are refused."""
    path, rows = f"{place(t)}/quality", t.labels.select("doc_id", "quality")
    said = []
    for name, day, df in (("first", "monday", rows), ("same", "tuesday", rows.repartition(5)), ("edited", "wednesday", rows.withColumn("quality", F.when(F.col("doc_id") % 9 == 1, 7).otherwise(F.col("quality"))))):
        side = K.write_annotation(df, path, ["doc_id"], {"description": "quality"}, day)
        said.append((name, R.read_json_lines(t.spark, f"{path}.jsonl", "doc_id long, quality int").count(), side["created"]))
    try:
        K.write_annotation(rows.union(rows), path, ["doc_id"], {}, "thursday")
        said.append(("repeated keys", 0, "taken"))
    except ValueError:
        said.append(("repeated keys", rows.count(), "refused"))
    return t.spark.createDataFrame(said, "write string, rows long, created string")


@query("snk6_report", "SELECT '| source | documents | characters |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || source || ' | ' || n || ' | ' || c || ' |', chr(10) ORDER BY n DESC, source) AS report FROM (SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS c FROM documents GROUP BY source)")
def snk6(t):
    by = t.documents.groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters")).orderBy(F.desc("documents"), "source")
    return t.spark.createDataFrame([(R.markdown_table(by),)], "report string")


@query("snk7_append", "SELECT event_id FROM events")
def snk7(t):
    path = place(t)
    for k in range(2):
        R.append_events(t.events.where(F.col("event_id") % 2 == k).select("event_id"), path)
    return R.read_json_lines(t.spark, path, "event_id long")


@query("snk8_export", f"SELECT 'lines' AS form, doc_id, verdict, note FROM ({STATES_SQL}) WHERE state <> 'cleared' UNION ALL SELECT 'array', doc_id, verdict, note FROM ({STATES_SQL})")
def snk8(t):
    """Decisions by id, as JSON lines without the cleared ones, and as one JSON array with them."""
    path, states = place(t), decision_states(decisions_of(t), texts_of(t), "doc_id").select("doc_id", "verdict", "note", "state")
    R.export_decisions(states, "doc_id", f"{path}/lines", cleared=False)
    R.export_decisions(states, "doc_id", f"{path}/array", array=True)
    read = lambda form: R.read_json_lines(t.spark, f"{path}/{form}", "doc_id long, verdict string, note string")
    whole = t.spark.read.option("multiLine", "true").schema("doc_id long, verdict string, note string").json(f"{path}/array")
    return read("lines").select(F.lit("lines").alias("form"), "*").union(whole.select(F.lit("array"), "*"))


@query("snk9_batches", "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 50)::BIGINT AS batch FROM documents")
def snk9(t):
    return R.work_batches(t.documents.select("doc_id"), "doc_id", 50)


@query("str1_replay", "SELECT 'grown' AS log, user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id UNION ALL SELECT 'shrunken', user_id, max(event_id), max_by(event_type, event_id) FROM events WHERE event_id % 2 = 0 GROUP BY user_id")
def str1(t):
    """A log that grows between two runs is read on; one that has shrunk is replayed as a whole."""
    path, state = place(t), place(t)
    log = t.events.select("user_id", "event_id", "event_type")
    even, odd = log.where("event_id % 2 = 0"), log.where("event_id % 2 = 1")
    even.repartition(3, "event_id").write.json(path)
    S.replayed(t.spark, path, log.schema, state)
    odd.repartition(2, "event_id").write.mode("append").json(path)
    grown = S.latest(stored(S.replayed(t.spark, path, log.schema, state)), ["user_id"], "event_id")
    even.repartition(2, "event_id").write.mode("overwrite").json(path)
    shrunken = S.latest(stored(S.replayed(t.spark, path, log.schema, state)), ["user_id"], "event_id")
    return grown.select(F.lit("grown").alias("log"), "*").unionByName(shrunken.select(F.lit("shrunken").alias("log"), "*"))


@query("str2_changes", "SELECT * FROM (VALUES (1, 'a.parquet', 'new'), (1, 'b.jsonl', 'new'), (1, 'c.parquet', 'new'), (2, 'a.parquet', 'kept'), (2, 'b.jsonl', 'changed'), (2, 'c.parquet', 'broken'), (2, 'd.parquet', 'new'), (3, 'b.jsonl', 'kept'), (3, 'c.parquet', 'broken'), (3, 'd.parquet', 'kept'), (3, 'a.parquet', 'gone')) v(look, file, said) CROSS JOIN (SELECT count(*)::BIGINT AS broken_rows FROM labels)")
def str2(t):
    """Three looks at a folder: what is new, changed, kept or gone; a file that breaks keeps its last good table."""
    path, store = place(t), K.Store(t.spark)
    labels, docs = t.labels.select("doc_id"), t.documents.select("doc_id")
    labels.write.parquet(f"{path}/a.parquet")
    R.write_json_lines(labels, f"{path}/b.jsonl")
    labels.coalesce(1).write.parquet(f"{path}/c.parquet")
    watch, said = K.Watch(t.spark, path, 60.0), []
    said += [(1, k, v) for k, v in watch.refresh().items()]
    assert watch.refresh() == {}, "a second look within the pause"
    R.write_json_lines(docs, f"{path}/b.jsonl")
    docs.write.parquet(f"{path}/d.parquet")
    held = watch.tables["c.parquet"]
    kept = labels.count()
    store.delete(f"{path}/c.parquet")
    store.write_text(f"{path}/c.parquet", "this is no table")
    said += [(2, k, v) for k, v in watch.refresh(force=True).items()]
    assert watch.tables["c.parquet"] is held
    store.delete(f"{path}/a.parquet")
    said += [(3, k, v) for k, v in watch.refresh(force=True).items()]
    return t.spark.createDataFrame([(*x, kept) for x in said], "look int, file string, said string, broken_rows long")


@query("stream_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def stream_windows(t):
    """An extension: tumbling windows."""
    return S.windowed(t.events, "ts", "1 hour", "1 hour", ["event_type"])


@query("str4_unseen", "SELECT DISTINCT sha1(text) AS sha FROM documents WHERE sha1(text) NOT IN (SELECT sha1(text) FROM documents JOIN labels USING (doc_id))")
def str4(t):
    store = t.documents.join(t.labels, "doc_id", "left_semi").select(F.sha1("text").alias("sha"))
    return S.unseen(t.documents.select(F.sha1("text").alias("sha")), store, "sha")


@query("str7_no_repeats", "SELECT user_id, event_id FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def str7(t):
    return S.without_repeats(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id", ["event_type"]).select("user_id", "event_id")


@query("str9_carried_over", "SELECT doc_id, sha FROM (SELECT doc_id, sha1(unnest(string_split(text, chr(10)))) AS sha FROM documents) WHERE sha NOT IN (SELECT sha1(unnest(string_split(text, chr(10)))) FROM documents WHERE doc_id % 2 = 0)")
def str9(t):
    """Drops whose text is gone stay recorded."""
    drops = lines(t).select("doc_id", F.sha1("line").alias("sha"))
    return drops.join(lines(t).where("doc_id % 2 = 0").select(F.sha1("line").alias("sha")), "sha", "left_anti").select("doc_id", "sha")


@query("htm1_blocks")
def htm1(t):
    """Blocks of every page by the DOM walk."""
    return html_blocks(t.pages, "page_id", "html").select("page_id", F.explode("blocks").alias("b")).select("page_id", "b.kind", "b.level", "b.text")


@query("htm18_markdown")
def htm18(t):
    """Each page as Markdown."""
    return html_blocks(t.pages, "page_id", "html").select("page_id", assembled(F.col("blocks")).alias("markdown"))
