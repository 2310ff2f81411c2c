"""Readers of files: JSON lines, labels, logs, dumps, queues; and writers. Schemas are declared; absent columns read as null."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import stored

CORRUPT = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """SRC1-3, SRC5: plain or gzip by name. Without a schema all rows are read for types, and date-like values stay strings."""
    reader = spark.read.option("inferTimestamp", "false").option("prefersDate", "false")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_labels(spark: SparkSession, path: str, schema: str, lists: list[str]) -> DataFrame:
    """SRC15: tab-separated hand labels with # comments; the cells of `lists` hold several values with commas."""
    out = spark.read.option("sep", "\t").option("comment", "#").option("header", "true").schema(schema).csv(path)
    return out.withColumns({c: F.filter(F.split(F.coalesce(c, F.lit("")), ",", -1), lambda x: x != "") for c in lists})


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """SRC17: events of an append-only log, and its bad lines (a half-written tail among them)."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = stored(spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_pages_xml(spark: SparkSession, path: str, flags: dict[str, list[str]] | None = None) -> DataFrame:
    """SRC6: pages of the main namespace that are no redirects, with their last revision; plain, gzip or bz2.

    flags: a column for each name, whether the text uses one of its templates (in lower case; a star stands for any beginning or end).
    """
    pages = spark.read.format("xml").option("rowTag", "page").option("attributePrefix", "_").schema("title string, ns long, id long, redirect struct<_title:string>, revision array<struct<id:long,timestamp:string,text:struct<_VALUE:string>>>").load(path)
    last = F.element_at(F.array_sort(F.transform("revision", lambda r: F.struct(r["timestamp"].alias("timestamp"), r["id"].alias("revid"), r["text"]["_VALUE"].alias("text")))), -1)
    rows = pages.where((F.col("ns") == 0) & F.col("redirect").isNull()).withColumn("_l", last).select("id", "title", "_l.revid", "_l.timestamp", "_l.text")
    form = lambda n: "".join("[^|{}]*" if ch == "*" else "[ _]" if ch == " " else re.escape(ch) for ch in n)
    return rows.withColumns({name: F.coalesce(F.col("text").rlike(r"(?i)\{\{\s*(?:" + "|".join(map(form, names)) + r")\s*(?:\||\}\})"), F.lit(False)) for name, names in (flags or {}).items()})


def read_history_xml(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: a row for each revision; a deleted contributor is null, an address becomes ip:<address>."""
    kind = "id long, parentid long, timestamp string, contributor struct<username:string,id:long,ip:string>, comment string, text struct<_bytes:long>"
    pages = spark.read.format("xml").option("rowTag", "page").option("attributePrefix", "_").schema(f"id long, revision array<struct<{kind.replace(' long', ':long').replace(' string', ':string').replace(' struct', ':struct')}>>").load(path)
    r = pages.select(F.col("id").alias("page"), F.explode("revision").alias("r"))
    user = F.coalesce("r.contributor.username", F.concat(F.lit("ip:"), "r.contributor.ip"))
    return r.select("page", F.col("r.id").alias("rev"), F.col("r.parentid").alias("parent"), F.col("r.timestamp").alias("ts"), user.alias("user"), F.col("r.contributor.id").alias("uid"), F.col("r.text._bytes").alias("bytes"))


# What a backslash and a letter stand for in the server's string literals; other letters stand for themselves.
_ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a", "%": "\\%", "_": "\\_"}


def _literal(text: str, at: int) -> tuple[str, int]:
    """The string whose first character is at `at`, and the place after its closing quote. Two quotes are one."""
    out, quote = [], -1
    while True:
        if quote < at:
            quote = text.find("'", at)
        if quote < 0:
            raise ValueError(f"no end of the string at {at}")
        back = text.find("\\", at, quote)
        if back >= 0:
            out += [text[at:back], _ESCAPES.get(text[back + 1], text[back + 1])]
            at = back + 2
        elif text[quote + 1 : quote + 2] == "'":
            out += [text[at:quote], "'"]
            at = quote + 2
        else:
            return "".join([*out, text[at:quote]]), quote + 1


def _plain(word: str) -> int | float | str | None:
    """A value without quotes: NULL, a whole number, another number; what is none of these is refused."""
    if word.upper() == "NULL":
        return None
    return int(word) if word.lstrip("+-").isdigit() else float(word)


def sql_tuples(statement: str, columns: int) -> list[tuple]:
    """SRC8: rows of one INSERT statement; a row of another length is an error."""
    out: list[tuple] = []
    row: list | None = None
    at = statement.index("VALUES") + len("VALUES")
    while at < len(statement):
        ch = statement[at]
        if row is None:
            if ch == "(":
                row = []
            elif ch not in ", ;\n":
                raise ValueError(f"{ch!r} between rows at {at}")
            at += 1
        elif ch == "'":
            value, at = _literal(statement, at + 1)
            row.append(value)
        elif ch == ")":
            if len(row) != columns:
                raise ValueError(f"{len(row)} values for {columns} columns")
            out.append(tuple(row))
            row, at = None, at + 1
        elif ch in ", ":
            at += 1
        else:
            end = min((e for e in (statement.find(",", at), statement.find(")", at)) if e >= 0), default=len(statement))
            row.append(_plain(statement[at:end].strip()))
            at = end
    if row is not None:
        raise ValueError("the statement ends within a row")
    return out


#: Kinds of columns by what their declared type begins with; all others are strings.
_COLUMN_KINDS = ((("bigint", "int", "mediumint", "smallint", "tinyint"), "bigint"), (("double", "float", "decimal", "numeric", "real"), "double"))


#: What a number without quotes becomes in a column of a kind.
_OF_KIND = {"bigint": int, "double": float}
#: Characters of statements whose rows a worker holds at once.
STATEMENT_CHARS = 1 << 20


def sql_schema(spark: SparkSession, path: str) -> str:
    """SRC8: names and kinds of the columns from the dump's CREATE TABLE."""
    declared = r"^\s+`([^`]+)`\s+([A-Za-z]+)"
    lines = spark.read.text(path).where(F.col("value").rlike(declared)).select(F.monotonically_increasing_id().alias("i"), F.regexp_extract("value", declared, 1).alias("name"), F.lower(F.regexp_extract("value", declared, 2)).alias("type"))
    rows = sorted(lines.collect())
    if not rows:
        raise ValueError("the dump declares no columns")
    return ", ".join(f"`{r['name']}` " + next((kind for types, kind in _COLUMN_KINDS if r["type"] in types), "string") for r in rows)


def read_sql_dump(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """SRC8 over any store that Spark reads: statements as lines, their tuples in Arrow batches; without a schema the dump's own."""
    kinds = T._parse_datatype_string(schema or sql_schema(spark, path))
    names = [f.name for f in kinds.fields]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [[None if v is None else of(v) for v in c] if (of := _OF_KIND.get(f.dataType.simpleString())) else c for c, f in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for line in batch.column(0):
                statement = line.as_py()
                rows += sql_tuples(statement, len(names))
                held += len(statement)
                if rows and held > STATEMENT_CHARS:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    return spark.read.text(path).where(F.col("value").startswith("INSERT INTO")).select("value").mapInArrow(run, kinds)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """SRC19: items of a Markdown queue: "## rank. title (id)" and what follows up to the next."""
    whole = spark.read.text(path, wholetext=True)
    items = F.regexp_extract_all("value", F.lit(r"(?ms)^(## [0-9]+\. .*?)(?=^## |\z)"), F.lit(1))
    head = r"^## ([0-9]+)\. (.*?) \(([0-9]+)\)"
    return whole.select(F.explode(items).alias("i")).select(F.regexp_extract("i", head, 1).cast("int").alias("rank"), F.regexp_extract("i", head, 2).alias("title"), F.regexp_extract("i", head, 3).cast("long").alias("id"), F.btrim(F.regexp_replace("i", r"^[^\n]*\n?", ""), F.lit(" \t\r\n")).alias("body"))


def kinds_of(df: DataFrame, most: int = 40) -> DataFrame:
    """Semantic kinds of string columns in one pass: date if all values look like ISO dates, category if few differ, else text."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    one = df.agg(*[F.struct(F.count_distinct(c).alias("d"), F.count(c).alias("n"), F.count_if(~F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}")).alias("odd"), F.count("*").alias("all")).alias(c) for c in strings])
    kind = lambda s: F.when((s["n"] > 0) & (s["odd"] == 0), "date").when((s["d"] <= most) & ((s["d"] < s["n"]) | (s["n"] > 80)), "category").otherwise("text")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), kind(F.col(c)).alias("kind")) for c in strings])
    return one.select(F.explode(pairs).alias("p")).select("p.column", "p.kind")


def write_json_lines(df: DataFrame, path: str, compressed: bool = False) -> None:
    """SNK1, SNK3, SNK7: nulls are written; Spark's commit protocol replaces the folder as a whole."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.option("compression", "gzip") if compressed else writer).json(path)


def append_events(df: DataFrame, path: str) -> None:
    """SNK7."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def work_batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """SNK9: numbered batches of about equal size, dealt by ranges of the key, so that no window spans all rows.

    The ranged rows are written once, each with its range, so that counts and numbers speak of the same ranges, whose
    number is that of the session's shuffle partitions: the counts of ranges are a bounded broadcast.
    """
    from pyspark.sql import Window as W

    if rows.isEmpty():
        return rows.withColumn("batch", F.lit(0).cast("long"))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(ranges, key).withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_before"))
    numbered = ranged.join(F.broadcast(before), "_p").withColumn("_k", F.row_number().over(W.partitionBy("_p").orderBy(key)))
    return numbered.withColumn("batch", F.floor((F.col("_before") + F.col("_k") - 1) / size).cast("long")).drop("_p", "_k", "_before")


def file_names(rows: DataFrame, key: str, title: str, most: int = 180) -> DataFrame:
    """SNK4: rows with `name`: the title without signs that file systems refuse, of `most` bytes of UTF-8 at most with its ending, unique without regard to case."""
    safe = F.trim(F.regexp_replace(F.regexp_replace(title, r"[\\/:*?\"<>|\x00-\x1f]+", "_"), r"^[. ]+|[. ]+$", ""))
    tail = F.concat(F.lit(" "), F.col(key).cast("string"), F.lit(".md"))
    room = F.lit(most) - F.octet_length(tail)
    # whole characters as long as they fit
    start = F.struct(F.lit("").alias("text"), F.lit(True).alias("open"))

    def add(a: Column, ch: Column) -> Column:
        fits = a["open"] & (F.octet_length(a["text"]) + F.octet_length(ch) <= room)
        return F.struct(F.when(fits, F.concat(a["text"], ch)).otherwise(a["text"]).alias("text"), fits.alias("open"))

    short = F.when(F.octet_length(safe) <= room, safe).otherwise(F.rtrim(F.aggregate(F.split(F.substring(safe, 1, most), ""), start, add, lambda a: a["text"])))
    named = rows.withColumn("_s", F.when(short == "", "_").otherwise(short)).withColumn("_l", F.lower("_s"))
    first = named.groupBy("_l").agg(F.min(key).alias("_first"))
    return named.join(first, "_l").withColumn("name", F.concat("_s", F.when(F.col(key) == F.col("_first"), ".md").otherwise(tail))).select(*rows.columns, "name")


def markdown_files(rows: DataFrame, key: str, title: str, text: str) -> DataFrame:
    """SNK4: name and content, with a head in YAML, of a file for each row."""
    named = file_names(rows, key, title)
    head = F.concat(F.lit("---\nid: "), F.col(key).cast("string"), F.lit("\ntitle: "), F.regexp_extract(F.to_json(F.struct(F.col(title).alias("t"))), r'(?s)^\{"t":(.*)\}$', 1), F.lit("\n---\n\n"))
    return named.select(key, "name", F.concat(head, F.col(text)).alias("content"))


def stale_files(there: DataFrame, wanted: DataFrame) -> DataFrame:
    """SNK4: names of files that no row asks for any more."""
    return there.select("name").join(wanted.select("name"), "name", "left_anti")


def content_state(df: DataFrame) -> tuple[int, int]:
    """SNK5: row count and order-free hash; what was written before stays if they are the same."""
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """SNK6: a small result as a Markdown table; a larger one is refused."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows are no report")
    rows = [df.columns, ["---"] * len(df.columns), *[[cell(v) for v in r] for r in found]]
    return "\n".join("| " + " | ".join(r) + " |" for r in rows)


def export_decisions(decisions: DataFrame, key: str, path: str, cleared: bool = True, array: bool = False) -> None:
    """SNK8: the last decision of each id, sorted by id, as JSON lines or as one array; without the cleared ones if `cleared` is false."""
    rows = (decisions if cleared else decisions.where(F.col("state") != "cleared")).drop("state").orderBy(key)
    if not array:
        rows.write.option("ignoreNullFields", "false").json(path)
        return
    # one file, a line for each element: what stands before and after it depends on whether it is the first or the last
    lines = rows.select(key, F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("j"))
    ends = lines.agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    framed = lines.join(F.broadcast(ends)).select(key, F.concat(F.when(F.col(key) == F.col("_a"), "[").otherwise(" "), "j", F.when(F.col(key) == F.col("_b"), "]").otherwise(",")).alias("value"))
    framed.repartition(1).sortWithinPartitions(key).select("value").write.text(path)
