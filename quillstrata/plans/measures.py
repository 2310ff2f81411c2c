"""Queries of aggregates, scores, classification and quality gates: AGG, SCO, CLS, QC, API."""

from __future__ import annotations

import functools
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.markdown import html_blocks
from ..operators import classify as C
from ..operators.ranks import medians, percentile_rank, quantiles, robust_spread, robust_z
from ..sources.shared import stored
from .base import query
from .relations import latest_events, repeated_groups
from .reviews import STATES_SQL, decision_states, decisions_of
from .text import lines

R6 = lambda c: F.round(c, 6)
N = lambda name="n": F.count("*").alias(name)


@query("agg1_statistics", "SELECT count(*)::BIGINT AS docs, sum(n_chars)::BIGINT AS chars, count(*) FILTER (WHERE lang = 'en')::BIGINT AS english, count(DISTINCT source)::BIGINT AS sources FROM documents")
def agg1(t):
    return t.documents.agg(N("docs"), F.sum("n_chars").alias("chars"), F.count_if(F.col("lang") == "en").alias("english"), F.count_distinct("source").alias("sources"))


@query("agg2_counts", "SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def agg2(t):
    return t.documents.groupBy("source").agg(N()).orderBy(F.desc("n"), F.asc_nulls_last("source"))


@query("agg3_filtered", "SELECT event_type, count(DISTINCT user_id)::BIGINT AS users, count(*) FILTER (WHERE value > 50)::BIGINT AS large FROM events GROUP BY event_type")
def agg3(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("large"))


_L = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


_KEYED = "(SELECT doc_id, line, substr(sha1(regexp_replace(line, '[0-9]+', '#', 'g')), 1, 16) AS key, CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'heading' WHEN regexp_matches(line, '^[|]') THEN 'table' WHEN regexp_matches(line, '^ {0,12}([-*+]|[0-9]+[.)]) ') THEN 'list' WHEN regexp_matches(line, '^[$][$]') THEN 'math' ELSE 'para' END AS kind FROM " + _L + " WHERE length(line) > 0)"


@query("agg4_groups", f"SELECT key, count(*)::BIGINT AS paragraphs, count(DISTINCT doc_id)::BIGINT AS articles, count(DISTINCT line)::BIGINT AS variants, floor(avg(length(line)))::BIGINT AS chars, (SELECT kind FROM (SELECT key AS k, kind, count(*) AS c FROM {_KEYED} GROUP BY ALL) m WHERE m.k = g.key ORDER BY c DESC, kind LIMIT 1) AS kind FROM {_KEYED} g GROUP BY key HAVING count(DISTINCT doc_id) >= 2 ORDER BY articles DESC, key")
def agg4(t):
    return repeated_groups(lines(t).where(F.length("line") > 0), "line", "doc_id").orderBy(F.desc("articles"), "key")


@query("agg5_templated", rf"WITH p AS (SELECT doc_id, sha1(regexp_replace(line, '[0-9]+', 'N', 'g')) AS frame, len(regexp_extract_all(line, '[^ \t-\r]+')) AS w FROM {_L}), f AS (SELECT frame FROM p GROUP BY frame HAVING count(DISTINCT doc_id) >= 5) SELECT doc_id, round(sum(CASE WHEN f.frame IS NOT NULL THEN w ELSE 0 END) / greatest(sum(w), 1), 3) AS share FROM p LEFT JOIN f ON p.frame = f.frame GROUP BY doc_id")
def agg5(t):
    """Share of a document's words in frames that five documents or more use."""
    p = lines(t).select("doc_id", F.sha1(X.mask_digits(F.col("line"), "N")).alias("frame"), F.regexp_count("line", F.lit(r"[^ \t-\r]+")).alias("w"))
    frames = p.groupBy("frame").agg(F.count_distinct("doc_id").alias("articles")).where("articles >= 5").select("frame", F.lit(1).alias("_in"))
    return p.join(frames, "frame", "left").groupBy("doc_id").agg(F.round(F.sum(F.when(F.col("_in") == 1, F.col("w")).otherwise(0)) / F.greatest(F.sum("w"), F.lit(1)), 3).alias("share"))


@query("agg6_pooled", "SELECT l_returnflag, round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 6) AS ratio FROM lineitem GROUP BY l_returnflag")
def agg6(t):
    return t.lineitem.groupBy("l_returnflag").agg(R6(F.sum(F.col("l_extendedprice") * F.col("l_discount")) / F.sum("l_extendedprice")).alias("ratio"))


@query("agg7_rollup", "SELECT l_orderkey, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS quantity, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 2) AS returned, count(*) FILTER (WHERE l_discount >= 0.09)::BIGINT AS high FROM lineitem GROUP BY l_orderkey")
def agg7(t):
    return t.lineitem.groupBy("l_orderkey").agg(N(), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)), 2).alias("returned"), F.count_if(F.col("l_discount") >= 0.09).alias("high"))


@query("agg8_distinct_back", "SELECT p_partkey, n FROM part JOIN (SELECT p_brand, count(DISTINCT p_type)::BIGINT AS n FROM part GROUP BY p_brand) USING (p_brand)")
def agg8(t):
    return t.part.join(t.part.groupBy("p_brand").agg(F.count_distinct("p_type").alias("n")), "p_brand").select("p_partkey", "n")


@query("agg9_document_frequency", "SELECT word, count(DISTINCT doc_id)::BIGINT AS df FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY word HAVING count(DISTINCT doc_id) >= 20")
def agg9(t):
    w = t.documents.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    return w.groupBy("word").agg(F.count_distinct("doc_id").alias("df")).where("df >= 20")


_QS = (0.01, 0.02, 0.05, 0.25, 0.5, 0.75, 0.95, 0.98, 0.99)


@query("agg10_percentiles", "SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS p{round(q * 100)}" for q in _QS) + " FROM lineitem GROUP BY l_returnflag")
def agg10(t):
    found = quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", list(_QS))
    return found.select("l_returnflag", *[F.round(F.col("q")[i], 4).alias(f"p{round(q * 100)}") for i, q in enumerate(_QS)])


@query("agg11_spread", "WITH m AS (SELECT lang, ln(n_chars) AS v, median(ln(n_chars)) OVER (PARTITION BY lang) AS med FROM documents) SELECT lang, round(any_value(med), 6) AS med, round(1.4826 * median(abs(v - med)), 6) AS spread FROM m GROUP BY lang")
def agg11(t):
    return robust_spread(t.documents.select("lang", F.ln("n_chars").alias("v")), ["lang"], "v").select("lang", R6("med").alias("med"), R6("spread").alias("spread"))


@query("agg12_exact_mean", "SELECT l_partkey, round(CASE WHEN min(l_discount) = max(l_discount) THEN min(l_discount) ELSE avg(l_discount) END, 6) AS v FROM lineitem GROUP BY l_partkey")
def agg12(t):
    return t.lineitem.groupBy("l_partkey").agg(R6(F.when(F.min("l_discount") == F.max("l_discount"), F.min("l_discount")).otherwise(F.avg("l_discount"))).alias("v"))


@query("agg13_consistency", "SELECT round(median(d), 6) AS med, round(quantile_cont(d, 0.95), 6) AS p95, round(max(d), 6) AS largest, round(avg(s), 6) AS signed, count(*) FILTER (WHERE d = 0)::BIGINT AS same FROM (SELECT abs(round(l_tax - l_discount, 6)) AS d, l_tax - l_discount AS s FROM lineitem)")
def agg13(t):
    s = F.col("l_tax") - F.col("l_discount")
    d = t.lineitem.select(F.abs(F.round(s, 6)).alias("d"), s.alias("s"))
    q = quantiles(d, [], "d", [0.5, 0.95])
    one = d.agg(R6(F.max("d")).alias("largest"), R6(F.avg("s")).alias("signed"), F.count_if(F.col("d") == 0).alias("same"))
    return q.join(F.broadcast(one)).select(R6(F.col("q")[0]).alias("med"), R6(F.col("q")[1]).alias("p95"), "largest", "signed", "same")


def histogram(rows: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """AGG14: bin, low, high and n of the bins that hold anything; the last one is closed.

    Bins are logarithmic where the values are skewed (lo > 0, hi / lo > 100, hi / median > 20), one for each whole number where
    there are no more than `bins` of them, else of equal width; one value has a bin of width 1.
    """
    v = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    s = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.bool_and(F.col("v") == F.floor("v")).alias("whole")).join(F.broadcast(medians(v, [], "v")))
    log = (F.col("lo") > 0) & (F.col("hi") > 100 * F.col("lo")) & (F.col("hi") > 20 * F.col("med"))
    kind = F.when(F.col("lo") == F.col("hi"), "one").when(log, "log").when(F.col("whole") & (F.col("hi") - F.col("lo") + 1 <= bins), "whole").otherwise("equal")
    s = s.withColumn("kind", kind).withColumn("last", F.when(F.col("kind") == "one", 0).when(F.col("kind") == "whole", F.col("hi") - F.col("lo")).otherwise(bins - 1))
    place = F.when(F.col("kind").isin("one", "whole"), F.col("v") - F.col("lo")).when(F.col("kind") == "log", F.log10(F.col("v") / F.col("lo")) / F.log10(F.col("hi") / F.col("lo")) * bins).otherwise((F.col("v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins))
    binned = v.join(F.broadcast(s)).groupBy(F.least(F.floor(place), F.col("last")).cast("int").alias("bin"), "lo", "hi", "kind").agg(N())
    edge = lambda i: F.when(F.col("kind").isin("one", "whole"), F.col("lo") + i).when(F.col("kind") == "log", F.col("lo") * F.pow(F.col("hi") / F.col("lo"), i / bins)).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) / bins * i)
    return binned.select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "n")


def _bins_sql(name: str, value: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS of, bin::INT AS bin, round(CASE kind WHEN 'whole' THEN lo + bin WHEN 'log' THEN lo * pow(hi / lo, bin / 40) ELSE lo + (hi - lo) / 40 * bin END, 1) AS low, round(CASE kind WHEN 'whole' THEN lo + bin + 1 WHEN 'log' THEN lo * pow(hi / lo, (bin + 1) / 40) ELSE lo + (hi - lo) / 40 * (bin + 1) END, 1) AS high, count(*)::BIGINT AS n FROM "
        f"(SELECT *, least(floor(CASE kind WHEN 'whole' THEN v - lo WHEN 'log' THEN log10(v / lo) / log10(hi / lo) * 40 ELSE (v - lo) / ((hi - lo) / 40) END), CASE kind WHEN 'whole' THEN hi - lo ELSE 39 END) AS bin FROM "
        f"(SELECT *, CASE WHEN lo > 0 AND hi > 100 * lo AND hi > 20 * med THEN 'log' WHEN whole AND hi - lo + 1 <= 40 THEN 'whole' ELSE 'equal' END AS kind FROM (SELECT {value}::DOUBLE AS v FROM {table}), (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi, median({value})::DOUBLE AS med, bool_and({value} = floor({value})) AS whole FROM {table}))) GROUP BY ALL"
    )


@query("agg14_histogram", " UNION ALL ".join(_bins_sql(*x) for x in (("price", "o_totalprice", "orders"), ("chars", "n_chars", "documents"), ("size", "p_size % 30", "part"))))
def agg14(t):
    """Equal bins, logarithmic ones, and one for each whole number."""
    parts = [("price", t.orders, "o_totalprice"), ("chars", t.documents, "n_chars"), ("size", t.part.withColumn("s", F.col("p_size") % 30), "s")]
    return functools.reduce(DataFrame.union, [histogram(d, c).select(F.lit(n).alias("of"), "bin", F.round("low", 1).alias("low"), F.round("high", 1).alias("high"), "n") for n, d, c in parts])


def facet(rows: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """AGG15: facet, option and n: the most frequent values; of a list, of its elements."""
    listed = isinstance(rows.schema[name].dataType, T.ArrayType)
    options = rows.select((F.explode(name) if listed else F.col(name)).alias("option"))
    return options.groupBy("option").agg(N()).orderBy(F.desc("n"), F.asc_nulls_last("option")).limit(most or (400 if listed else 200)).select(F.lit(name).alias("facet"), F.col("option").cast("string").alias("option"), "n")


@query("agg15_facets", "SELECT 'lang' AS facet, lang AS option, count(*)::BIGINT AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*)::BIGINT FROM documents GROUP BY source UNION ALL (SELECT 'words', w, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY w ORDER BY n DESC, w LIMIT 400)")
def agg15(t):
    both = [facet(t.documents, "lang"), facet(t.documents, "source"), facet(t.part.select(F.split("p_type", " ").alias("words")), "words")]
    return functools.reduce(DataFrame.union, both)


@query("agg16_ranges", "SELECT min(n_chars) AS lo, max(n_chars) AS hi, (count(*) - count(quality))::BIGINT AS nulls FROM documents LEFT JOIN labels USING (doc_id)")
def agg16(t):
    return t.documents.join(t.labels, "doc_id", "left").agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"), (F.count("*") - F.count("quality")).alias("nulls"))


@query("agg17_groups", "SELECT 'all' AS grp, count(*)::BIGINT AS n FROM orders UNION ALL SELECT 'large', count(*) FILTER (WHERE o_totalprice > 100000)::BIGINT FROM orders UNION ALL SELECT 'urgent', count(*) FILTER (WHERE o_orderpriority = '1-URGENT')::BIGINT FROM orders")
def agg17(t):
    """Groups that overlap, counted in one pass."""
    one = t.orders.agg(N("all"), F.count_if(F.col("o_totalprice") > 100000).alias("large"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return one.select(F.expr("stack(3, 'all', `all`, 'large', large, 'urgent', urgent) as (grp, n)"))


@query("agg18_years", "SELECT CASE WHEN year(o_orderdate) <= 1993 THEN '<=1993' ELSE year(o_orderdate)::VARCHAR END AS period, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def agg18(t):
    y = F.year("o_orderdate")
    return t.orders.groupBy(F.when(y <= 1993, "<=1993").otherwise(y.cast("string")).alias("period")).agg(N())


@query("agg19_two_keys", "SELECT lang, quality, count(*)::BIGINT AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def agg19(t):
    return t.documents.join(t.labels, "doc_id").groupBy("lang", "quality").agg(N())


@query("agg20_topics", "SELECT word, count(*)::BIGINT AS n, round(avg(p_retailprice), 4) AS price FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_retailprice FROM part) GROUP BY word")
def agg20(t):
    return t.part.select(F.explode(F.split("p_name", " ", -1)).alias("word"), "p_retailprice").groupBy("word").agg(N(), F.round(F.avg("p_retailprice"), 4).alias("price"))


@query("agg21_lengths", r"SELECT CASE WHEN w < 50 THEN '<50' WHEN w < 200 THEN '50-199' WHEN w < 500 THEN '200-499' WHEN w < 2000 THEN '500-1999' ELSE '2000+' END AS bin, count(*)::BIGINT AS n FROM (SELECT len(regexp_extract_all(text, '[^ \t-\r]+')) AS w FROM documents) GROUP BY 1")
def agg21(t):
    w = F.regexp_count("text", F.lit(r"[^ \t-\r]+"))
    return t.documents.groupBy(F.when(w < 50, "<50").when(w < 200, "50-199").when(w < 500, "200-499").when(w < 2000, "500-1999").otherwise("2000+").alias("bin")).agg(N())


@query("agg22_editors", "SELECT conv_id, role, n, row_number() OVER (PARTITION BY conv_id ORDER BY first)::INT AS seen FROM (SELECT conv_id, role, count(*)::BIGINT AS n, min(turn) AS first FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS least FROM conversations) WHERE turn > least GROUP BY conv_id, role)")
def agg22(t):
    """Who wrote after the first turn, how often, in the order in which they are first seen."""
    least = t.conversations.groupBy("conv_id").agg(F.min("turn").alias("least"))
    later = t.conversations.join(least, "conv_id").where("turn > least").groupBy("conv_id", "role").agg(N(), F.min("turn").alias("first"))
    return later.select("conv_id", "role", "n", F.row_number().over(W.partitionBy("conv_id").orderBy("first")).alias("seen"))


@query("agg23_growth", "WITH d AS (SELECT conv_id, length(text) - coalesce(lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS g, length(text) AS n FROM conversations) SELECT conv_id, round(least(1.0, sum(greatest(0, g)) / sum(n)), 4) AS share FROM d GROUP BY conv_id")
def agg23(t):
    g = F.length("text") - F.coalesce(F.lag(F.length("text")).over(W.partitionBy("conv_id").orderBy("turn")), F.lit(0))
    return t.conversations.select("conv_id", g.alias("g"), F.length("text").alias("n")).groupBy("conv_id").agg(F.round(F.least(F.lit(1.0), F.sum(F.greatest(F.lit(0), F.col("g"))) / F.sum("n")), 4).alias("share"))


@query("agg24_evidence", "SELECT o_custkey, o_orderpriority, round(sum(CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.4 ELSE 0.5 END), 4) AS score, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS sources, min(o_orderkey) AS first FROM orders GROUP BY ALL")
def agg24(t):
    weight = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.4).otherwise(0.5)
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.round(F.sum(weight), 4).alias("score"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("sources"), F.min("o_orderkey").alias("first"))


_WILSON = "round((hits / n + 3.8416 / (2 * n) {} 1.96 * sqrt(hits / n * (1 - hits / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6)"


@query("agg25_precision", f"SELECT *, {_WILSON.format('-')} AS low, {_WILSON.format('+')} AS high FROM (SELECT sample, predicted, count(*)::BIGINT AS n, count(*) FILTER (WHERE quality = predicted)::BIGINT AS hits FROM (SELECT doc_id % 3 AS sample, quality, (NOT regexp_matches(text, '[*#$%&]{{3}}|!!| [|] '))::INT AS predicted FROM labels JOIN documents USING (doc_id)) GROUP BY GROUPING SETS ((sample, predicted), (sample), (predicted)))")
def agg25(t):
    """Precision of each sample, of each predicted class, and of both, with its interval."""
    p = t.labels.join(t.documents, "doc_id").select((F.col("doc_id") % 3).alias("sample"), "quality", (~F.col("text").rlike(r"[*#$%&]{3}|!!| \| ")).cast("int").alias("predicted"))
    k = p.groupingSets([["sample", "predicted"], ["sample"], ["predicted"]], "sample", "predicted").agg(N(), F.count_if(F.col("quality") == F.col("predicted")).alias("hits"))
    return k.withColumn("w", X.wilson(F.col("hits"), F.col("n"))).select("sample", "predicted", "n", "hits", R6("w.low").alias("low"), R6("w.high").alias("high"))


@query("agg26_decisions", "SELECT count(*) FILTER (WHERE state = 'keep')::BIGINT AS keep, count(*) FILTER (WHERE state = 'drop')::BIGINT AS drop, count(*) FILTER (WHERE state = 'fix')::BIGINT AS fix, count(*) FILTER (WHERE state = 'none')::BIGINT AS none, count(*) FILTER (WHERE state = 'cleared')::BIGINT AS cleared, count(*) FILTER (WHERE drops > 0)::BIGINT AS with_paragraphs, count(*) FILTER (WHERE stale)::BIGINT AS stale, count(*) FILTER (WHERE missing)::BIGINT AS not_in_version, count(*)::BIGINT AS total FROM (" + STATES_SQL + ")")
def agg26(t):
    s = decision_states(decisions_of(t), t.documents.select("doc_id", F.sha1("text").alias("sha1")), "doc_id")
    of = lambda name: F.count_if(F.col("state") == name).alias(name)
    return s.agg(*map(of, ("keep", "drop", "fix", "none", "cleared")), F.count_if(F.size("drops") > 0).alias("with_paragraphs"), F.count_if("stale").alias("stale"), F.count_if("missing").alias("not_in_version"), N("total"))


@query("agg27_search_totals", f"SELECT kind, count(*)::BIGINT AS paragraphs, count(DISTINCT doc_id)::BIGINT AS articles, sum(len(regexp_extract_all(line, '[0-9]{{4}}')))::BIGINT AS matches FROM {_KEYED} WHERE regexp_matches(line, '[0-9]{{4}}') GROUP BY ROLLUP (kind)")
def agg27(t):
    """Totals, and by kind of paragraph."""
    hit = lines(t).where(F.col("line").rlike("[0-9]{4}")).withColumn("kind", X.block_kind(F.col("line")))
    # of each document first: one row a kind, from which distinct documents are counted without a row for each line
    each = hit.groupBy("kind", "doc_id").agg(N("paragraphs"), F.sum(F.regexp_count("line", F.lit("[0-9]{4}"))).alias("matches"))
    of = lambda d: d.agg(F.sum("paragraphs").alias("paragraphs"), F.count("*").alias("articles"), F.sum("matches").alias("matches"))
    whole = each.groupBy("doc_id").agg(F.sum("paragraphs").alias("paragraphs"), F.sum("matches").alias("matches"))
    return of(each.groupBy("kind")).union(of(whole.groupBy()).select(F.lit(None).cast("string"), "paragraphs", "articles", "matches"))


@query("agg28_page_totals", "SELECT p_partkey, count(*) OVER ()::BIGINT AS n, round(sum(p_retailprice) OVER (), 2) AS total FROM part WHERE p_size < 10 ORDER BY p_partkey LIMIT 25")
def agg28(t):
    rows = t.part.where("p_size < 10")
    return rows.select("p_partkey").orderBy("p_partkey").limit(25).join(F.broadcast(rows.agg(N(), F.round(F.sum("p_retailprice"), 2).alias("total"))))


@query("agg29_reasons", "SELECT reason, count(*)::BIGINT AS n, array_to_string(list(doc_id ORDER BY doc_id)[1:5], ',') AS examples FROM (SELECT doc_id, CASE WHEN n_chars < 100 THEN 'short' WHEN lang <> 'en' THEN 'foreign' ELSE 'other' END AS reason FROM documents) GROUP BY reason")
def agg29(t):
    """Reasons with the five least ids of each: ranks above five are dropped before the shuffle."""
    reason = F.when(F.col("n_chars") < 100, "short").when(F.col("lang") != "en", "foreign").otherwise("other")
    rows = t.documents.select("doc_id", reason.alias("reason"))
    five = rows.withColumn("k", F.row_number().over(W.partitionBy("reason").orderBy("doc_id"))).where("k <= 5").groupBy("reason").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("examples"))
    return rows.groupBy("reason").agg(N()).join(five, "reason")


@query("agg30_rollup_total", "SELECT lang, count(*)::BIGINT AS n FROM documents GROUP BY ROLLUP (lang)")
def agg30(t):
    return t.documents.rollup("lang").agg(N())


# scores: bits are those of a unigram model of letters, which stands in for the external scorer


#: Words whose costs every task gets.
FREQUENT = 100_000


def unigram_bits(rows: DataFrame, key: str, text: str) -> DataFrame:
    """SCO1: key, bits and bytes by a model whose tokens are lower-case words, with add-one smoothing; any scorer with these columns can take its place.

    The costs of the FREQUENT words go to every task, so that a text's words of these are summed where the text is; words that
    are rarer, a small share of all, meet their costs by the word, and none of them is in many texts.
    """
    w = rows.select(key, F.explode_outer(F.regexp_extract_all(F.lower(text), F.lit("[a-zà-ÿ]+"), F.lit(0))).alias("w")).where("w is not null")
    freq = stored(w.groupBy("w").agg(F.count("*").alias("c")))
    # a row for each count that occurs: of n words in all, at most the root of 2 n
    counts = sorted(tuple(r) for r in freq.groupBy("c").agg(F.count("*").alias("n")).collect())
    cost = freq.select("w", "c", (-F.log2((F.col("c") + 1) / F.lit(sum((c + 1) * n for c, n in counts)))).alias("cost"))
    least, taken = None, 0
    for c, n in reversed(counts):
        if (taken := taken + n) > FREQUENT:
            break
        least = c
    frequent = cost.where(F.col("c") >= least if least is not None else F.lit(False)).select("w", "cost")
    each = w.join(F.broadcast(frequent), "w", "left")
    parts = stored(each.groupBy(key, F.when(F.col("cost").isNull(), F.col("w")).alias("w")).agg(F.sum("cost").alias("_s"), F.count("*").alias("_k")))
    rare = parts.where("w is not null").join(cost, "w").select(key, (F.col("_k") * F.col("cost")).alias("_s"))
    bits = parts.where("w is null").select(key, "_s").union(rare).groupBy(key).agg(F.sum("_s").alias("bits"))
    return rows.select(key, F.octet_length(text).cast("long").alias("bytes")).join(bits, key, "left").select(key, F.coalesce("bits", F.lit(0.0)).alias("bits"), "bytes")


_BITS = "WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zà-ÿ]+')) AS w FROM documents), f AS (SELECT w, count(*) AS c FROM w GROUP BY w), s AS (SELECT sum(c) AS total, count(*) AS kinds FROM f), b AS (SELECT doc_id, sum(-log2((c + 1) / (total + kinds))) AS bits FROM w JOIN f USING (w), s GROUP BY doc_id), d AS (SELECT doc_id, lang, strlen(text)::BIGINT AS bytes, coalesce(bits, 0) AS bits FROM documents LEFT JOIN b USING (doc_id)) "


@query("sco1_bits", _BITS + "SELECT doc_id, round(bits, 3) AS bits, bytes FROM d")
def sco1(t):
    return unigram_bits(t.documents, "doc_id", "text").select("doc_id", F.round("bits", 3).alias("bits"), "bytes")


@query("sco2_sums", "SELECT l_orderkey, round(sum(l_extendedprice) / ln(2), 3) AS bits, sum(l_quantity)::BIGINT AS bytes, sum(l_linenumber)::BIGINT AS tokens, count(*)::BIGINT AS pieces FROM lineitem GROUP BY l_orderkey")
def sco2(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice") / F.ln(F.lit(2.0)), 3).alias("bits"), F.sum("l_quantity").cast("long").alias("bytes"), F.sum("l_linenumber").alias("tokens"), N("pieces"))


@query("sco3_bpb", _BITS + "SELECT doc_id, round(CASE WHEN bytes > 0 THEN bits / bytes END, 5) AS bpb FROM d")
def sco3(t):
    return unigram_bits(t.documents, "doc_id", "text").select("doc_id", F.round(F.try_divide("bits", "bytes"), 5).alias("bpb"))


def comparison_groups(rows: DataFrame, kind: str, size: str, least: int) -> DataFrame:
    """SCO4: kind and band; the rows of bands of fewer than `least` rows share one group of their kind."""
    banded = rows.withColumn("band", X.band_of(F.col(size)))
    small = banded.groupBy(kind, "band").agg(F.count("*").alias("_n"))
    return banded.join(small, [kind, "band"]).withColumn("grp", F.concat_ws("/", kind, F.when(F.col("_n") < least, "pooled").otherwise(F.col("band")))).drop("_n")


_BAND = "CASE WHEN bytes < 100 THEN '<100' WHEN bytes < 300 THEN '100-299' WHEN bytes < 1000 THEN '300-999' WHEN bytes < 3000 THEN '1000-2999' ELSE '3000+' END"
_GRP = f"g AS (SELECT *, lang || '/' || CASE WHEN count(*) OVER (PARTITION BY lang, {_BAND}) < 20 THEN 'pooled' ELSE {_BAND} END AS grp FROM d)"


def scored(t) -> DataFrame:
    return comparison_groups(unigram_bits(t.documents, "doc_id", "text").join(t.documents.select("doc_id", "lang"), "doc_id"), "lang", "bytes", 20)


@query("sco4_groups", _BITS + f", {_GRP} SELECT doc_id, grp FROM g")
def sco4(t):
    return scored(t).select("doc_id", "grp")


_PCT = "(rank() OVER ({0} ORDER BY bpb) + (count(*) OVER ({0}{1} bpb) - 1) / 2) / count(*) OVER ({0})"
_EL = "e AS (SELECT *, round(bits / bytes, 9) AS bpb FROM g WHERE bytes >= 100 AND bits > 0), m AS (SELECT *, " + _PCT.format("PARTITION BY grp", ",") + " AS pct, median(ln(bpb)) OVER (PARTITION BY grp) AS med FROM e), z AS (SELECT *, CASE WHEN pct >= 0.99 THEN 'high' WHEN pct <= 0.01 THEN 'low' END AS flag, (ln(bpb) - med) / nullif(1.4826 * median(abs(ln(bpb) - med)) OVER (PARTITION BY grp), 0) AS z FROM m)"


def flagged(t) -> DataFrame:
    """SCO5: percentile, robust z and flag of bits per byte within the group, for documents of 100 bytes or more that have bits."""
    e = scored(t).where("bytes >= 100 and bits > 0").withColumn("bpb", F.round(F.col("bits") / F.col("bytes"), 9)).withColumn("lbpb", F.ln("bpb"))
    # stored, as ranks and spreads read them several times
    ranked = robust_z(stored(percentile_rank(stored(e), ["grp"], "bpb")), ["grp"], "lbpb")
    return ranked.withColumn("flag", F.when(F.col("pct") >= 0.99, "high").when(F.col("pct") <= 0.01, "low"))


@query("sco5_flags", _BITS + f", {_GRP}, {_EL} SELECT doc_id, round(pct, 6) AS pct, round(z, 4) AS z, flag FROM z")
def sco5(t):
    return flagged(t).select("doc_id", R6("pct").alias("pct"), F.round("z", 4).alias("z"), "flag")


@query("sco6_robust_z", _BITS + ", e AS (SELECT doc_id, round(bits / bytes, 9) AS bpb FROM d WHERE bytes >= 500 AND bits > 0), m AS (SELECT *, (rank() OVER (ORDER BY bpb) + (count(*) OVER (PARTITION BY bpb) - 1) / 2) / count(*) OVER () AS pct, median(ln(bpb)) OVER () AS med FROM e) SELECT doc_id, round(pct, 6) AS pct, round((ln(bpb) - med) / (1.4826 * median(abs(ln(bpb) - med)) OVER ()), 4) AS z FROM m")
def sco6(t):
    """Documents as a whole, of 500 bytes or more: one group."""
    e = unigram_bits(t.documents, "doc_id", "text").where("bytes >= 500 and bits > 0").withColumn("bpb", F.round(F.col("bits") / F.col("bytes"), 9)).withColumn("lbpb", F.ln("bpb"))
    return robust_z(stored(percentile_rank(stored(e), [], "bpb")), [], "lbpb").select("doc_id", R6("pct").alias("pct"), F.round("z", 4).alias("z"))


@query("sco8_controls", _BITS + "SELECT count(*)::BIGINT AS documents, count(*) FILTER (WHERE bits > 0)::BIGINT AS scored, count(*)::BIGINT AS shuffled_same, count(*)::BIGINT AS again_same, count(*)::BIGINT AS single_close FROM d")
def sco8(t):
    """Controls of a scorer: words in another order (a model of single words must not care), a second run over other partitions, and sums in single precision."""
    d = t.documents.select("doc_id", "text")
    first = unigram_bits(d, "doc_id", "text").select("doc_id", "bits")
    mixed = unigram_bits(d.select("doc_id", X.shuffled_words(F.col("text"), 3).alias("text")), "doc_id", "text").select("doc_id", F.col("bits").alias("mixed"))
    again = unigram_bits(d.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "doc_id"), "doc_id", "text").select("doc_id", F.col("bits").alias("again"))
    close = lambda a, b, by: F.count_if(F.abs(a - b) <= by * F.greatest(F.abs(a), F.lit(1.0)))
    both = first.join(mixed, "doc_id").join(again, "doc_id")
    bits = F.col("bits")
    return both.agg(N("documents"), F.count_if(bits > 0).alias("scored"), close(bits, F.col("mixed"), 1e-9).alias("shuffled_same"), close(bits, F.col("again"), 1e-9).alias("again_same"), close(bits, bits.cast("float").cast("double"), 1e-6).alias("single_close"))


@query("sco7_cost", "SELECT lang, round(sum(strlen(text) / CASE WHEN lang = 'en' THEN 6.7 ELSE 2.3 END), 3) AS tokens FROM documents GROUP BY lang")
def sco7(t):
    return t.documents.groupBy("lang").agg(F.round(F.sum(F.octet_length("text") / F.when(F.col("lang") == "en", 6.7).otherwise(2.3)), 3).alias("tokens"))


# rules


RULES = [
    C.Rule(("science", "economy"), ("BRASS$$", "COPPER$$")),
    C.Rule(("economy",), ("PROMO",), "weak"),
    C.Rule(("arts",), ("~NISHED TIN", "ANODIZED$")),
    C.Rule(("history",), ("LARGE P", "MEDIUM"), "person", True),
    C.Rule(("geography",), ("STEEL$", "NICK$")),
]


@query("cls1_rules", "SELECT p_partkey, CASE r WHEN 1 THEN 'science,economy' WHEN 2 THEN 'economy' WHEN 3 THEN 'arts' WHEN 4 THEN 'history' WHEN 5 THEN 'geography' END AS topics, CASE WHEN r > 0 THEN r = 4 END AS person, CASE r WHEN 2 THEN 'weak' WHEN 4 THEN 'person' WHEN 1 THEN 'strong' WHEN 3 THEN 'strong' WHEN 5 THEN 'strong' END AS kind FROM (SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(^|[^A-Z])(BRASS|COPPER)$') THEN 1 WHEN regexp_matches(p_type, '(^|[^A-Z])PROMO') THEN 2 WHEN regexp_matches(p_type, 'NISHED TIN|(^|[^A-Z])ANODIZED($|[^A-Z])') THEN 3 WHEN regexp_matches(p_type, '(^|[^A-Z])(LARGE P|MEDIUM)') THEN 4 WHEN regexp_matches(p_type, '(^|[^A-Z])STEEL($|[^A-Z])') THEN 5 ELSE 0 END AS r FROM part)")
def cls1(t):
    """The first rule in order decides; its words stand at starts, anywhere, at ends of words or of the name."""
    d = t.part.select("p_partkey", C.decided(F.col("p_type"), RULES).alias("d"))
    return d.select("p_partkey", F.array_join("d.topics", ",").alias("topics"), "d.person", "d.kind")


_EVIDENCE = "SELECT o_custkey, topic, round(sum(w), 6) AS score, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, min(o_orderkey) AS first FROM (SELECT o_custkey, o_orderkey, source, unnest(topics) AS topic, weight / len(topics) AS w FROM (SELECT *, CASE source WHEN 'date' THEN 3.0 WHEN 'title' THEN 1.5 ELSE CASE WHEN o_orderpriority LIKE '5%' THEN 0.4 WHEN source = 'category' THEN 1.0 ELSE 0.5 END END AS weight FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'date' WHEN o_orderkey % 5 = 0 THEN 'title' WHEN o_orderstatus = 'F' THEN 'category' ELSE 'parent_category' END AS source, CASE WHEN o_orderpriority LIKE '1%' THEN ['science', 'health'] WHEN o_orderpriority LIKE '2%' THEN ['arts'] WHEN o_orderpriority LIKE '3%' THEN ['history', 'politics', 'arts'] ELSE ['geography'] END AS topics FROM orders))) GROUP BY o_custkey, topic"


def names_found(t) -> DataFrame:
    """Names of each customer, in order: categories, parents, titles and dates with their topics."""
    key, p = F.col("o_orderkey"), F.col("o_orderpriority")
    source = F.when(key % 11 == 0, "date").when(key % 5 == 0, "title").when(F.col("o_orderstatus") == "F", "category").otherwise("parent_category")
    listed = lambda *x: F.array(*map(F.lit, x))
    topics = F.when(p.startswith("1"), listed("science", "health")).when(p.startswith("2"), listed("arts")).when(p.startswith("3"), listed("history", "politics", "arts")).otherwise(listed("geography"))
    return t.orders.select("o_custkey", key.alias("pos"), source.alias("source"), C.weight(source == "category", p.startswith("5"), source).alias("weight"), topics.alias("topics"))


@query("cls2_weights", _EVIDENCE)
def cls2(t):
    """All six weights; topics of one name share its weight."""
    e = C.evidence(names_found(t), "o_custkey")
    return e.select("o_custkey", "topic", "score", F.array_join("sources", ",").alias("sources"), "first")


_CLASSES = {"TIN": "economy", "BRASS": "arts", "PLATED": "science", "SMALL": "society"}
_WORKS = {"gizmo": "technology", "widget": "economy", "red": "arts", "blue": "sports"}
_pick = lambda table, word: "CASE " + word + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
_NAMED = f"SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN ['health'] ELSE [] END || list_filter(list_transform(string_split(p_type, ' '), lambda x: {_pick(_CLASSES, 'x')}), lambda x: x IS NOT NULL) AS c, CASE WHEN list_contains(string_split(p_type, ' '), 'STANDARD') THEN list_filter(list_transform(string_split(p_name, ' '), lambda x: {_pick(_WORKS, 'x')}), lambda x: x IS NOT NULL) ELSE [] END AS o FROM part"
_ITEMS = f"SELECT p_partkey, topic, round(sum(w), 6) AS score, min(pos)::INT AS first FROM (SELECT p_partkey, unnest(c) AS topic, 1.0 / len(c) AS w, unnest(range(len(c))) AS pos FROM ({_NAMED}) UNION ALL SELECT p_partkey, unnest(o), 1.5 / len(o), unnest(range(len(o))) + len(c) FROM ({_NAMED})) GROUP BY p_partkey, topic"


def items_found(t) -> DataFrame:
    parts = t.part.select("p_partkey", F.split("p_type", " ").alias("classes"), F.split("p_name", " ").alias("occupations"), (F.col("p_size") % 7 == 0).alias("heals"))
    return C.item_evidence(parts, "p_partkey", _CLASSES, _WORKS, "STANDARD", "health")


@query("cls3_shares", _ITEMS)
def cls3(t):
    """Classes share 1.0, occupations of humans 1.5, and what treats an illness is of health first."""
    return items_found(t)


_ORDER = ["science", "health", "economy", "technology", "arts", "sports", "history", "politics", "society", "geography"]
_PLACE = "CASE topic " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(_ORDER)) + " END"
_OWN = f"SELECT o_custkey AS key, topic, score, sources, first, bool_or(strong) OVER (PARTITION BY o_custkey) AS strong FROM (SELECT *, o_custkey % 4 = 0 AND contains(sources, 'category') AND NOT contains(sources, 'parent') AS strong FROM ({_EVIDENCE}))"
_BOTH = f"WITH own AS ({_OWN}), more AS (SELECT p_partkey AS key, topic, score, first FROM ({_ITEMS}) WHERE p_partkey NOT IN (SELECT key FROM own WHERE strong)), u AS (SELECT key, topic, score, sources, first AS f_own, NULL AS f_item FROM own UNION ALL SELECT key, topic, score, 'item', NULL, first FROM more), s AS (SELECT key, topic, round(sum(score), 6) AS score, string_agg(sources, ',') AS src, min(f_own) AS f_own, min(f_item) AS f_item FROM u GROUP BY key, topic), f AS (SELECT *, CASE WHEN bool_or(f_item IS NOT NULL) OVER (PARTITION BY key) THEN coalesce(f_item, 100 + coalesce(f_own, 0)) ELSE f_own END AS first FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, first, {_PLACE}) AS rn, max(score) OVER (PARTITION BY key) AS top FROM f) "


@query("cls4_decision", _BOTH + "SELECT key, string_agg(topic, ',' ORDER BY rn) FILTER (WHERE rn = 1 OR score >= greatest(0.5, 0.35 * top)) AS topics, max(CASE WHEN rn = 1 THEN topic END) AS \"primary\", max(CASE WHEN rn = 1 THEN array_to_string(list_sort(list_distinct(string_split(src, ','))), '+') END) AS source FROM r GROUP BY key")
def cls4(t):
    """Items count only where no rule matched a name of the customer's own."""
    own = C.evidence(names_found(t), "o_custkey").withColumnRenamed("o_custkey", "key")
    own = own.withColumn("strong", (F.col("key") % 4 == 0) & F.array_contains("sources", "category") & ~F.array_contains("sources", "parent_category"))
    d = C.decide(own, items_found(t).withColumnRenamed("p_partkey", "key"), "key", _ORDER)
    return d.select("key", F.array_join("topics", ",").alias("topics"), "primary", "source")


_SUBJECTS = ", ".join(f"'{x}'" for x in C.SCHOOL_TOPICS)
_PERSONS = ", ".join(f"'{x}'" for x in C.SCHOOL_PERSON_TOPICS)
_TOPICS = [*_ORDER, "religion", "literature", None]
_TOPIC_SQL = "CASE c_custkey % 13 " + " ".join(f"WHEN {i} THEN " + (f"'{x}'" if x else "NULL") for i, x in enumerate(_TOPICS)) + " END"


@query("cls5_relevant", f"SELECT c_custkey, CASE WHEN topic IS NULL THEN false WHEN c_nationkey < 8 THEN topic IN ({_PERSONS}) ELSE topic IN ({_SUBJECTS}) OR (c_acctbal > 0 AND topic IN ('arts', 'religion')) END AS relevant FROM (SELECT *, {_TOPIC_SQL} AS topic FROM customer)")
def cls5(t):
    """Every topic for persons and others, in the region and outside it."""
    topic = F.element_at(F.array(*[F.lit(x) for x in _TOPICS]), (F.col("c_custkey") % 13 + 1).cast("int"))
    return t.customer.select("c_custkey", C.school_relevant(topic, F.col("c_nationkey") < 8, F.col("c_acctbal") > 0).alias("relevant"))


@query("cls6_region", "SELECT p_partkey, len(list_filter(string_split(p_type, ' '), lambda x: regexp_matches(x, 'TIN$|^ECO'))) > 0 OR regexp_matches(p_name, 'TIN$|^ECO|blue') AS flagged FROM part")
def cls6(t):
    return t.part.select("p_partkey", (C.regional(F.split("p_type", " "), F.col("p_name"), "TIN$|^ECO") | F.col("p_name").rlike("blue")).alias("flagged"))


_REVIEWED = r"r AS (SELECT d.doc_id, d.bytes, z.z, z.flag, z.doc_id IS NOT NULL AS eligible, CASE WHEN contains(t.text, ' | ') THEN 'table' ELSE 'text' END AS kind, nullif(array_to_string(list_distinct(regexp_extract_all(t.text, '[*#$%&]{3}')), ','), '') AS markup, len(string_split(t.text, chr(10))) >= 3 AND list_max(list_transform(string_split(t.text, chr(10)), lambda x: length(x))) < 200 AS verse, t.lang = 'en' AND d.doc_id % 5 = 0 AS english, t.lang = 'de' AND d.doc_id % 5 = 1 AS foreign_, d.doc_id % 2 = 0 AS copied FROM d JOIN documents t USING (doc_id) LEFT JOIN z USING (doc_id)), k AS (SELECT *, CASE WHEN markup IS NOT NULL THEN 'markup' WHEN kind = 'table' AND flag IS NOT NULL THEN 'table' WHEN eligible AND kind <> 'table' AND english THEN 'english' WHEN eligible AND kind <> 'table' AND foreign_ THEN 'script' WHEN eligible AND kind <> 'table' AND flag = 'high' THEN 'garbled' WHEN eligible AND kind <> 'table' AND flag = 'low' THEN 'templated' END AS type, coalesce(z, 0) AS y, log10(greatest(bytes, 100) / 100) AS big FROM r) "


@query("cls7_review_types", _BITS + f", {_GRP}, {_EL}, {_REVIEWED} SELECT doc_id, type, round(CASE type WHEN 'markup' THEN 1 + length(markup) - length(replace(markup, ',', '')) + 0.3 * greatest(y, 0) + big WHEN 'table' THEN abs(y) + 0.5 * big WHEN 'english' THEN 1 + big + 0.3 * greatest(y, 0) WHEN 'script' THEN 1 + big + 0.3 * greatest(y, 0) WHEN 'garbled' THEN (abs(y) + 0.5 * big) * CASE WHEN verse THEN 0.5 ELSE 1 END WHEN 'templated' THEN abs(y) + 0.5 * big + CASE WHEN copied THEN 1.5 ELSE 0 END END, 4) AS severity FROM k")
def cls7(t):
    """All six types with their severities, from the flags of SCO5."""
    text = F.col("text")
    z = flagged(t).select("doc_id", "z", "flag", F.lit(True).alias("eligible"))
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit("[*#$%&]{3}"), F.lit(0)))
    r = t.documents.select(
        "doc_id", F.octet_length(text).cast("long").alias("bytes"), F.when(F.contains(text, F.lit(" | ")), "table").otherwise("text").alias("kind"), F.when(F.size(hits) > 0, F.array_join(hits, ",")).alias("markup"),
        X.is_verse(text, F.lit("text")).alias("verse"), ((F.col("lang") == "en") & (F.col("doc_id") % 5 == 0)).alias("english"), ((F.col("lang") == "de") & (F.col("doc_id") % 5 == 1)).alias("foreign"),
    ).join(z, "doc_id", "left")
    k = r.withColumn("type", C.review_type(F.col("markup"), F.col("kind"), F.coalesce("eligible", F.lit(False)), F.col("flag"), F.col("english"), F.col("foreign")))
    return k.select("doc_id", "type", F.round(C.severity(F.col("type"), F.col("markup"), F.col("z"), F.col("bytes"), F.col("verse"), F.col("doc_id") % 2 == 0), 4).alias("severity"))


@query("cls8_candidates", "WITH s AS (SELECT l_orderkey, count(*) AS n, round(sum(l_extendedprice), 2) AS price, sum(CASE WHEN l_discount >= 0.08 THEN l_quantity ELSE 0 END) / sum(l_quantity) AS share FROM lineitem GROUP BY 1), p AS (SELECT *, (rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2) / count(*) OVER () AS pct FROM s) SELECT l_orderkey, round(pct, 6) AS pct, round(share, 6) AS share FROM p WHERE pct >= 0.99 OR pct <= 0.01 OR (share >= 0.5 AND n >= 3)")
def cls8(t):
    """Both tails of the percentiles, and orders whose larger part is extreme."""
    s = t.lineitem.groupBy("l_orderkey").agg(N(), F.round(F.sum("l_extendedprice"), 2).alias("price"), (F.sum(F.when(F.col("l_discount") >= 0.08, F.col("l_quantity")).otherwise(0)) / F.sum("l_quantity")).alias("share"))
    return percentile_rank(s, [], "price").where(C.article_candidate(F.col("pct"), F.col("share"), F.col("n"))).select("l_orderkey", R6("pct").alias("pct"), R6("share").alias("share"))


def pairs(t) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.col("text").alias("a"), F.lead("text").over(W.partitionBy("conv_id").orderBy("turn")).alias("b")).where("b is not null")


_PAIRS = "(SELECT * FROM (SELECT conv_id, turn, text AS a, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) WHERE b IS NOT NULL)"


@query("cls9_checks", f"SELECT conv_id, turn, len(list_filter(regexp_extract_all(a, '[0-9]+'), lambda x: NOT list_contains(regexp_extract_all(b, '[0-9]+'), x))) = 0 AS digits, NOT regexp_matches(b, '[Ͱ-ϿЀ-ӿ]') AS script, len(regexp_extract_all(b, '[a-m]')) >= 0.5 * (len(regexp_extract_all(b, '[a-m]')) + len(regexp_extract_all(b, '[n-zA-Z]'))) AS own_share, length(b) / greatest(length(a), 1) BETWEEN 0.5 AND 2.5 AS length, NOT contains(b, 'the') AS spelling FROM {_PAIRS}")
def cls9(t):
    """Five checks of a translation: its numbers, no neighbouring script, enough letters of its own, its length, and no spelling in two parts (for which "the" stands here)."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0))
    own, other = F.regexp_count("b", F.lit("[a-m]")), F.regexp_count("b", F.lit("[n-zA-Z]"))
    return pairs(t).select(
        "conv_id", "turn", (F.size(F.array_except(numbers("a"), numbers("b"))) == 0).alias("digits"), (~F.col("b").rlike("[Ͱ-ϿЀ-ӿ]")).alias("script"), (own >= 0.5 * (own + other)).alias("own_share"),
        (F.length("b") / F.greatest(F.length("a"), F.lit(1))).between(0.5, 2.5).alias("length"), (~F.contains("b", F.lit("the"))).alias("spelling"),
    )


def same_shape(a: Column, b: Column) -> Column:
    """CLS10: the same lines: as many, none blank within, each with the same indent and marker, or as many cells, and the same table rules."""
    lead, rule = r"^\s*(?:- |\d+\. )?", r"^\|(?:\s*:?-+:?\s*\|)+$"
    rows = F.arrays_zip(F.split(a, "\n", -1).alias("x"), F.split(b, "\n", -1).alias("y"))

    def like(z: Column) -> Column:
        x, y = z["x"], z["y"]
        in_table = x.startswith("|") | y.startswith("|")
        cells = lambda v: F.regexp_count(v, F.lit(r"(?<!\\)\|"))
        table = (cells(x) == cells(y)) & (~F.trim(x).rlike(rule) | (x == y))
        prose = F.regexp_extract(x, lead, 0) == F.regexp_extract(y, lead, 0)
        return x.isNotNull() & y.isNotNull() & F.when(in_table, table).otherwise(prose)

    return ~F.contains(F.btrim(b, F.lit(" \t\n\x0b\x0c\r")), F.lit("\n\n")) & F.coalesce(F.forall(rows, like), F.lit(False))


@query("cls10_shape", "SELECT p_partkey, p_size % 8 IN (0, 3) AS same FROM part")
def cls10(t):
    """Eight pairs: alike, other marker, other indent, alike tables, other cells, another rule, a line more, a blank line within."""
    name = F.col("p_name")
    forms = [("- {}\n  2. {}", "- x {}\n  2. y"), ("- {}", "1. {}"), ("  - {}", "- {}"), ("| {} | a |\n|---|---|\n| b | c |", "| x | {} |\n|---|---|\n| {} | y |"), ("| {} | a |", "| {} \\| a |"), ("| {} |\n|---|", "| {} |\n|:--|"), ("{}", "{}\n{}"), ("{}\nb\nc", "{}\n\nc")]
    made = lambda k: F.element_at(F.array(*[F.replace(F.lit(f[k]), F.lit("{}"), name) for f in forms]), (F.col("p_size") % 8 + 1).cast("int"))
    return t.part.select("p_partkey", same_shape(made(0), made(1)).alias("same"))


# quality gates and views

# What must not occur in finished text, by name. The last three of the first group need Java's lookarounds.
RESIDUE = {
    "wikitext outside math": r"\{\{|\}\}|\[\[|\]\]|(?<![=<>!])={2,6}[^=\n|]{1,80}={2,6}(?!=)",
    "file/image options": r"\|\s*thumb|\.jpe?g\s*\||(?<![\w.])\d{1,4}px\b",
    "URL": r"https?://|www\.",
    "category link": r"(?m)Category:|ଶ୍ରେଣୀ:(?:\S|$)",
    "Content Translation markup": r"cx-link|data-linkid|data-cx=|mw-redirect",
    "HTML entity": r"&(?:amp|lt|gt|quot|nbsp|#1[03]);",
    "template error message": r"Error: (?:\{\{|Lang|This is not a valid|Transliteration)",
    "adjacent inline math": r"(?<![$\\])\$[^$\n]+\$\$[^$\n]+\$(?!\$)",
    "native digit": "[୦-୯]",
    "unassigned danda": "[୤୥]",
    "letter in two parts": "ଯ଼",
    "control character": r"[\x00-\x08\x0b-\x1f\x7f-\x9f]",
}


def residue(rows: DataFrame, key: str, text: str, before: int = 20, after: int = 40, names: Collection[str] = RESIDUE.keys()) -> DataFrame:
    """QC4: key, name and context of the first hit of every pattern of `names` in every text, all in one pass; formulas are masked for the wikitext. The context is cut only where there is a hit."""

    def of(name: str, pattern: str) -> Column:
        where = F.regexp_replace(text, X.MATH, "MATH") if name.startswith("wikitext") else F.col(text)
        at = F.regexp_instr(where, F.lit(pattern))
        start = F.greatest(F.lit(1), at - before)
        return F.when(where.rlike(pattern), F.struct(F.lit(name).alias("name"), F.substr(where, start, at - start + after).alias("context")))

    hits = F.array(*[of(name, p) for name, p in RESIDUE.items() if name in names])
    # outer, as Spark looks into an array for rows beforehand otherwise, and searches the texts twice
    return rows.select(key, F.explode_outer(hits).alias("h")).where("h is not null").select(key, "h.name", "h.context")


_SAMPLES = ["a [[b]] c", "x |  thumb y", "see www.x", "Category:Q", "data-cx=1", "a&nbsp;b", "Error: Lang z", "so $a$$b$ so", "୧", "a୤b", "ଯ଼", "a\x07b", "nothing here", "== H ==", "12px", "$ {{ $ ok"]
_HIT = dict(enumerate([*RESIDUE, None, "wikitext outside math", "file/image options", None]))


@query("qc4_residue", "SELECT p_partkey, name, ctx AS context FROM (SELECT p_partkey, CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in _HIT.items() if x) + " END AS name, CASE p_partkey % 16 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_SAMPLES) if i != 11) + " WHEN 11 THEN 'a' || chr(7) || 'b' END AS ctx FROM part) WHERE name IS NOT NULL")
def qc4(t):
    """All twelve patterns with their context, on samples that hold each, and some that hold none."""
    made = t.part.select("p_partkey", F.element_at(F.array(*map(F.lit, _SAMPLES)), (F.col("p_partkey") % 16 + 1).cast("int")).alias("text"))
    return residue(made, "p_partkey", "text")


@query("qc4_residue_counts", "SELECT 'URL' AS name, count(*)::BIGINT AS n FROM documents WHERE regexp_matches(text, 'https?://|www[.]') HAVING count(*) > 0 UNION ALL SELECT 'HTML entity', count(*)::BIGINT FROM documents WHERE regexp_matches(text, '&(amp|lt|gt|quot|nbsp|#1[03]);') HAVING count(*) > 0 UNION ALL SELECT 'category link', count(*)::BIGINT FROM documents WHERE regexp_matches(text, 'Category:') HAVING count(*) > 0")
def qc4_counts(t):
    """Documents by residue."""
    return residue(t.documents, "doc_id", "text", names=("URL", "HTML entity", "category link")).groupBy("name").agg(N())


def expected_blocks(text: Column) -> Column:
    """QC1: headings, tables and list items that a Markdown parser should find, by lines."""
    lines_ = F.split(text, "\n", -1)
    count = lambda p, extra=lambda x: F.lit(True): F.size(F.filter(lines_, lambda x: x.rlike(p) & extra(x)))
    return F.struct(count("^#{1,6} ").alias("headings"), count(r"^\|(?:---\|)+$").alias("tables"), count(r"^\s*(?:- |[0-9]+\. )", lambda x: ~x.startswith("|")).alias("items"))


_EXPECTED = "len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{}')))::INT"


@query("qc1_expected", "SELECT doc_id, " + _EXPECTED.format("^#{1,6} ") + " AS headings, " + _EXPECTED.format(r"^[|](---[|])+$") + " AS tables, " + _EXPECTED.format(r"^[ \t\n\r\f\v]*(- |[0-9]+[.] )") + " AS items, false AS differs FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '# ' || source || chr(10) || chr(10) || '- a' || chr(10) || '- b' || chr(10) || '  1. c' WHEN 1 THEN '| a |' || chr(10) || '|---|' || chr(10) || '| b |' || chr(10) || chr(10) || '## ' || source ELSE '1. ' || source || chr(10) || '   - x' END AS text FROM documents)")
def qc1(t):
    """Counts by lines beside those of the converter's own blocks, from the same pages in HTML."""
    lang, k = F.col("source"), F.col("doc_id") % 3
    html = F.when(k == 0, F.concat(F.lit("<h1>"), lang, F.lit("</h1><ul><li>a<li>b<ol><li>c</ol></ul>"))).when(k == 1, F.concat(F.lit("<table class=wikitable><tr><td>a<tr><td>b</table><h2>"), lang, F.lit("</h2><p>.</p>"))).otherwise(F.concat(F.lit("<ol><li>"), lang, F.lit("<ul><li>x</ul></ol>")))
    md = F.when(k == 0, F.concat(F.lit("# "), lang, F.lit("\n\n- a\n- b\n  1. c"))).when(k == 1, F.concat(F.lit("| a |\n|---|\n| b |\n\n## "), lang)).otherwise(F.concat(F.lit("1. "), lang, F.lit("\n   - x")))
    both = html_blocks(t.documents.select("doc_id", F.concat(html, F.when(k == 1, "<h2>End</h2><p>text</p>").otherwise("<p>text</p>")).alias("html")), "doc_id", "html").join(t.documents.select("doc_id", expected_blocks(md).alias("e"), k.alias("k")), "doc_id")
    of = lambda kind: F.size(F.filter("blocks", lambda b: b["kind"] == kind))
    # the page of every third document has a heading of its own at the end, and one without content that goes
    differs = (of("heading") != F.col("e.headings")) | (of("table") != F.col("e.tables")) | (of("item") != F.col("e.items"))
    return both.select("doc_id", "e.headings", "e.tables", "e.items", differs.alias("differs"))


@query("qc5_copies_equal", "SELECT 'same' AS copy, count(*)::BIGINT AS rows, true AS equal FROM documents UNION ALL SELECT 'edited', count(*), count(*) FILTER (WHERE doc_id % 10 = 3) = 0 FROM documents UNION ALL SELECT 'shorter', count(*) FILTER (WHERE doc_id % 2 = 0), count(*) = count(*) FILTER (WHERE doc_id % 2 = 0) FROM documents UNION ALL SELECT 'doubled', 2 * count(*), count(*) = 0 FROM documents")
def qc5(t):
    """Copies of a table by row count and by an order-free hash: the same rows, edited ones, fewer, and each twice."""
    base = t.documents.select("doc_id", "text")
    copies = {"same": base.repartition("doc_id"), "edited": base.withColumn("text", F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit(" "))).otherwise(F.col("text"))), "shorter": base.where("doc_id % 2 = 0"), "doubled": base.union(base)}
    state = lambda d: d.agg(N("rows"), F.sum(F.xxhash64("doc_id", "text").cast("decimal(38,0)")).alias("h"))
    of = state(base).select(F.col("rows").alias("_r"), F.col("h").alias("_h"))
    every = functools.reduce(DataFrame.union, [state(d).select(F.lit(name).alias("copy"), "rows", "h") for name, d in copies.items()])
    return every.join(F.broadcast(of)).select("copy", "rows", ((F.col("rows") == F.col("_r")) & (F.col("h") == F.col("_h"))).alias("equal"))


@query("qc6_pairs", f"SELECT count(*)::BIGINT AS pairs, count(*) FILTER (WHERE a = '' OR b = '' OR a = b OR a <> trim(a) OR regexp_matches(b, '[{{}}|]'))::BIGINT AS malformed, (count(*) - count(DISTINCT (a, b)))::BIGINT AS repeated FROM {_PAIRS}")
def qc6(t):
    """The form of pairs: neither side empty, the same as the other, with outer blanks or residue; and none twice."""
    bad = (F.col("a") == "") | (F.col("b") == "") | (F.col("a") == F.col("b")) | (F.col("a") != F.trim("a")) | F.col("b").rlike("[{}|]")
    kinds = pairs(t).groupBy(F.sha2(F.concat_ws("\x1f", "a", "b"), 256)).agg(N("n"), F.count_if(bad).alias("bad"))
    return kinds.agg(F.sum("n").alias("pairs"), F.sum("bad").alias("malformed"), F.sum(F.col("n") - 1).alias("repeated"))


def position_of(rows: DataFrame, sort: str, key: str, wanted: int) -> DataFrame:
    """API3: key, position, and the neighbours' keys of one row in a list by `sort` descending: counts and extremes of what comes before and after, in one aggregate."""
    own = rows.where(F.col(key) == wanted).select(F.col(sort).alias("_s"))
    before = (F.col(sort) > F.col("_s")) | ((F.col(sort) == F.col("_s")) & (F.col(key) < wanted))
    after = (F.col(sort) < F.col("_s")) | ((F.col(sort) == F.col("_s")) & (F.col(key) > wanted))
    place = F.struct(sort, -F.col(key))
    one = rows.select(key, sort).join(F.broadcast(own)).agg((F.count_if(before) + 1).alias("position"), F.min_by(key, F.when(before, place)).alias("previous"), F.max_by(key, F.when(after, place)).alias("next"), N("of"))
    return one.select(F.lit(wanted).cast("long").alias(key), "position", "previous", "next", "of")


@query("api3_position", "SELECT * FROM (SELECT doc_id, row_number() OVER w AS position, lag(doc_id) OVER w AS previous, lead(doc_id) OVER w AS next, (count(*) OVER ())::BIGINT AS of FROM documents WHERE lang = 'fr' WINDOW w AS (ORDER BY n_chars DESC, doc_id)) WHERE doc_id = (SELECT max(doc_id) FROM documents WHERE lang = 'fr')")
def api3(t):
    """Where the French document of the greatest id is in the list by length."""
    rows = t.documents.where("lang = 'fr'")
    return position_of(rows, "n_chars", "doc_id", rows.agg(F.max("doc_id")).first()[0])


def groups_page(groups: DataFrame, kinds: list[str], least: int, page: int, size: int) -> DataFrame:
    """API5: a page of repeated groups of some kinds in `least` documents or more, with totals over all of them."""
    found = groups.where(F.col("kind").isin(kinds) & (F.col("articles") >= least))
    totals = found.agg(N("groups"), F.sum("paragraphs").alias("in_groups"))
    return found.orderBy(F.desc("articles"), F.desc("paragraphs"), "key").offset((page - 1) * size).limit(size).join(F.broadcast(totals))


@query("api5_templates", f"SELECT key, paragraphs, articles, variants, count(*) OVER ()::BIGINT AS groups, (sum(paragraphs) OVER ())::BIGINT AS in_groups FROM (SELECT key, count(*)::BIGINT AS paragraphs, count(DISTINCT doc_id)::BIGINT AS articles, count(DISTINCT line)::BIGINT AS variants, (SELECT kind FROM (SELECT key AS k, kind, count(*) AS c FROM {_KEYED} GROUP BY ALL) m WHERE m.k = g.key ORDER BY c DESC, kind LIMIT 1) AS kind FROM {_KEYED} g GROUP BY key) WHERE articles >= 3 AND kind IN ('para', 'list') ORDER BY articles DESC, paragraphs DESC, key LIMIT 20 OFFSET 20")
def api5_groups(t):
    """The second page of groups in three documents or more."""
    page = groups_page(stored(repeated_groups(lines(t).where(F.length("line") > 0), "line", "doc_id", 3)), ["para", "list"], 3, 2, 20)
    return page.select("key", "paragraphs", "articles", "variants", "groups", "in_groups")


@query("api5_template", f"WITH p AS {_KEYED}, top AS (SELECT key FROM p GROUP BY key ORDER BY count(DISTINCT doc_id) DESC, key LIMIT 1) SELECT doc_id, count(*)::BIGINT AS n, count(DISTINCT line)::BIGINT AS variants, min(line) AS example FROM p WHERE key = (SELECT key FROM top) GROUP BY doc_id")
def api5(t):
    """Documents of the largest group of repeated paragraphs, with an example."""
    p = lines(t).where(F.length("line") > 0)
    top = repeated_groups(p, "line", "doc_id", 1).orderBy(F.desc("articles"), "key").limit(1).select("key")
    of = p.withColumn("key", X.content_key(X.mask_digits(F.col("line")))).join(F.broadcast(top), "key", "left_semi")
    return of.groupBy("doc_id", "line").agg(N("c")).groupBy("doc_id").agg(F.sum("c").alias("n"), F.count("*").alias("variants"), F.min("line").alias("example"))
