"""Queries of filters, order and paging: FLT, PRJ, ORD, API1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import browse as B
from .base import query
from .text import lines

_PART = "SELECT p_partkey FROM part WHERE "
_EV = "(SELECT *, regexp_extract_all(event_type, '[a-z]+') AS tags, value > 50 AS flag FROM events)"


def events(t) -> DataFrame:
    return t.events.withColumn("tags", F.regexp_extract_all("event_type", F.lit("[a-z]+"), F.lit(0))).withColumn("flag", F.col("value") > 50)


@query("flt1_is", f"SELECT event_id FROM {_EV} WHERE flag = true")
def flt1(t):
    return B.filters(events(t), [("is.flag", "true")]).select("event_id")


@query("flt2_range", _PART + "p_size >= 10 AND p_size <= 20 AND p_brand >= 'Brand#2'")
def flt2(t):
    return B.filters(t.part, [("min.p_size", "10"), ("max.p_size", "20"), ("min.p_brand", "Brand#2")]).select("p_partkey")


@query("flt3_in", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IN (0) OR quality IS NULL")
def flt3(t):
    return B.filters(t.documents.join(t.labels, "doc_id", "left"), [("in.quality", "0"), ("in.quality", B.NULL_ITEM)]).select("doc_id")


@query("flt4_any", f"SELECT event_id FROM {_EV} WHERE list_has_any(tags, ['click', 'purchase'])")
def flt4(t):
    return B.filters(events(t), [("any.tags", "click"), ("any.tags", "purchase")]).select("event_id")


@query("flt5_has", f"SELECT event_id FROM {_EV} WHERE contains(lower(event_type), lower('LI')) AND len(list_filter(tags, lambda x: contains(x, 'c'))) > 0")
def flt5(t):
    return B.filters(events(t), [("has.event_type", "LI"), ("has.tags", "C")]).select("event_id")


@query("flt6_null", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def flt6(t):
    return B.filters(t.documents.join(t.labels, "doc_id", "left"), [("null.quality", "1")]).select("doc_id")


@query("flt7_title", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'e')")
def flt7(t):
    return t.part.where(F.contains(F.lower("p_name"), F.lit("e"))).select("p_partkey")


@query("flt8_text", "SELECT doc_id, ((length(text) - length(replace(lower(text), 'token', ''))) // 5)::BIGINT AS n, len(regexp_extract_all(text, '[0-9]{4}-[A-Z]?'))::BIGINT AS pattern, len(regexp_extract_all(text, '(?i)the [a-f]'))::BIGINT AS any_case FROM documents WHERE contains(lower(text), 'token')")
def flt8(t):
    """Substrings, a pattern, and one without regard to case."""
    text = F.col("text")
    rows = t.documents.select("doc_id", B.Search("token").matches(text).alias("n"), B.Search("[0-9]{4}-[A-Z]?", "regex", False).matches(text).alias("pattern"), B.Search("the [a-f]", "regex").matches(text).alias("any_case"))
    return rows.where("n > 0")


@query("flt9_pattern", "SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE sha1(regexp_replace(line, '[0-9]+', '#', 'g')) IN (SELECT sha1(regexp_replace(line, '[0-9]+', '#', 'g')) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) > 0 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)")
def flt9(t):
    keyed = lines(t).where(F.length("line") > 0).select("doc_id", F.sha1(F.regexp_replace("line", "[0-9]+", "#")).alias("k"))
    groups = keyed.groupBy("k").agg(F.count_distinct("doc_id").alias("n")).where("n >= 5")
    return keyed.join(groups, "k", "left_semi").select("doc_id").distinct()


@query("flt10_whitelist", "SELECT * FROM (VALUES ('is.nothing=true', 'refused'), ('is.p_size=true', 'refused'), ('min.p_size=x', 'refused'), ('min.p_size=nan', 'refused'), ('in.p_name`; drop=a', 'refused'), ('any.p_name=a', 'refused')) v(item, verdict) UNION ALL SELECT 'min.p_size=25', count(*)::VARCHAR FROM part WHERE p_size >= 25 UNION ALL SELECT 'has.p_name=' || chr(39) || ';--', count(*)::VARCHAR FROM part WHERE contains(lower(p_name), chr(39) || ';--')")
def flt10(t):
    """Columns that aren't there, wrong kinds and bad values are refused; values are bound, whatever is in them."""
    said = []
    for item in ("is.nothing=true", "is.p_size=true", "min.p_size=x", "min.p_size=nan", "in.p_name`; drop=a", "any.p_name=a", "min.p_size=25", "has.p_name=';--"):
        try:
            said.append((item, str(B.filters(t.part, [tuple(item.split("=", 1))]).count())))
        except B.BadFilter:
            said.append((item, "refused"))
    return t.spark.createDataFrame(said, "item string, verdict string")


@query("flt11_combine", _PART + "p_size IN (1, 2, 3) AND p_size <= 2")
def flt11(t):
    return B.filters(t.part, [("in.p_size", "1"), ("in.p_size", "2"), ("in.p_size", "3"), ("max.p_size", "9"), ("max.p_size", "2"), ("min.p_size", "")]).select("p_partkey")


#: Beginnings of names that keep house rather than tell a subject.
MAINTENANCE = ["articles?", "all ", "cs1", "pages?", "use ", "webarchive", "stub categories", "lists of", "user ", "cite", "unsourced", "orphan", "hidden", "tracking", "maintenance"]


def visible(name: Column, hidden: Column, native: str, topical: str, maintenance: list[str] = MAINTENANCE) -> Column:
    """FLT12: not hidden, not housekeeping, and not without the corpus's script unless it names a subject."""
    return ~hidden & ~name.rlike("(?i)^(?:" + "|".join(maintenance) + ")") & (name.rlike(native) | name.rlike(topical))


@query("flt12_visible", "SELECT p_partkey, name FROM (SELECT p_partkey, p_brand, CASE p_partkey % 6 WHEN 0 THEN 'Articles of ' || p_name WHEN 1 THEN 'ଓଡ଼ିଆ ' || p_name WHEN 2 THEN 'hidden ଓ' WHEN 3 THEN 'Physics ' || p_type ELSE p_type END AS name FROM part) WHERE NOT regexp_matches(name, '(?i)^(articles?|hidden)') AND (regexp_matches(name, '[ଅ-୿]') OR regexp_matches(name, 'Physics|TIN$')) AND p_brand NOT IN (SELECT p_brand FROM part GROUP BY p_brand HAVING max(p_size) > 48)")
def flt12(t):
    """Names that are hidden by a list, that keep house, that are foreign, and foreign ones of a subject."""
    k, name = F.col("p_partkey") % 6, F.col("p_name")
    made = F.when(k == 0, F.concat(F.lit("Articles of "), name)).when(k == 1, F.concat(F.lit("ଓଡ଼ିଆ "), name)).when(k == 2, "hidden ଓ").when(k == 3, F.concat(F.lit("Physics "), "p_type")).otherwise(F.col("p_type"))
    listed = t.part.groupBy("p_brand").agg(F.max("p_size").alias("m")).where("m > 48").select("p_brand", F.lit(True).alias("_hidden"))
    rows = t.part.select("p_partkey", "p_brand", made.alias("name")).join(listed, "p_brand", "left")
    return rows.where(visible(F.col("name"), F.coalesce("_hidden", F.lit(False)), "[ଅ-୿]", "Physics|TIN$")).select("p_partkey", "name")


@query("flt13_least", r"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[^ \t-\r]+')) >= 5 AND length(text) >= 30")
def flt13(t):
    return t.documents.where((F.regexp_count("text", F.lit(r"[^ \t-\r]+")) >= 5) & (F.length("text") >= 30)).select("doc_id")


@query("flt14_gutted", "SELECT doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id HAVING sum(CASE WHEN regexp_matches(line, '[à-ÿ]') THEN 0 ELSE length(regexp_replace(line, '[^A-Za-z]', '', 'g')) END) >= 20 * greatest(sum(CASE WHEN regexp_matches(line, '[à-ÿ]') THEN len(regexp_extract_all(line, '[a-zà-ÿ]+')) ELSE 0 END), 1) AND sum(CASE WHEN regexp_matches(line, '[à-ÿ]') THEN len(regexp_extract_all(line, '[a-zà-ÿ]+')) ELSE 0 END) < 25")
def flt14(t):
    """Documents of which almost nothing is left once foreign lines are removed."""
    own = F.col("line").rlike("[à-ÿ]")
    rows = lines(t).groupBy("doc_id").agg(F.sum(F.when(own, 0).otherwise(F.regexp_count("line", F.lit("[A-Za-z]")))).alias("gone"), F.sum(F.when(own, F.regexp_count("line", F.lit("[a-zà-ÿ]+"))).otherwise(0)).alias("left"))
    return rows.where((F.col("left") < 25) & (F.col("gone") >= 20 * F.greatest("left", F.lit(1)))).select("doc_id")


# Titles of pages of years, of days and of films of a year.
MONTHS = "(?:ଜାନୁଆରୀ|ଫେବୃଆରୀ|ମାର୍ଚ୍ଚ|ଅପ୍ରେଲ|ମଇ|ଜୁନ|ଜୁଲାଇ|ଅଗଷ୍ଟ|ସେପ୍ଟେମ୍ବର|ଅକ୍ଟୋବର|ନଭେମ୍ବର|ଡିସେମ୍ବର)"
YEAR_TITLE = r"[0-9]+(?:\s*(?:ଖ୍ରୀଷ୍ଟପୂର୍ବ|ଖ୍ରୀ\.?\s*ପୂ\.?))?(?:\s*\(ମସିହା\))?"
DATE_TITLE = rf"[0-9]{{1,2}}\s*{MONTHS}|{MONTHS}\s*[0-9]{{1,2}}"
FILM_TITLE = r"[0-9]{4}ର ଓଡ଼ିଆ (?:କଥାଚିତ୍ର|ଚଳଚ୍ଚିତ୍ର|ସିନେମା)"
FREE_WORDS = 25


def boilerplate(title: Column, free_words: Column) -> Column:
    """FLT15: why a page is a frame alone: a page of a year, or one of a day or of a year's films that says little; the whole title counts."""
    whole = lambda p: title.rlike(rf"\A(?:{p})\z")
    return F.when(whole(YEAR_TITLE), "year page").when(whole(DATE_TITLE) & (free_words < FREE_WORDS), "date page without events").when(whole(FILM_TITLE) & (free_words < FREE_WORDS), "empty list page")


@query("flt15_boilerplate", "SELECT p_partkey, CASE WHEN p_partkey % 8 IN (0, 1) THEN 'year page' WHEN p_partkey % 8 IN (2, 3) AND p_size < 25 THEN 'date page without events' WHEN p_partkey % 8 = 4 AND p_size < 25 THEN 'empty list page' END AS reason FROM part")
def flt15(t):
    n = F.col("p_size").cast("string")
    made = F.element_at(F.array(n, F.concat(n, F.lit(" ଖ୍ରୀ. ପୂ. (ମସିହା)")), F.concat(n, F.lit(" ମଇ")), F.concat(F.lit("ଡିସେମ୍ବର "), n), F.lit("1999ର ଓଡ଼ିଆ ସିନେମା"), F.concat(n, F.lit(" ଲୋକ")), F.concat(F.lit("ମଇ "), n, F.lit(" x")), F.lit("1999ର ଓଡ଼ିଆ ସିନେମା ଘର")), (F.col("p_partkey") % 8 + 1).cast("int"))
    return t.part.select("p_partkey", boilerplate(made, F.col("p_size")).alias("reason"))


CASCADE_SQL = r"""
WITH d AS (SELECT doc_id, text, sha1(text) AS h, len(regexp_extract_all(text, '[^ \t-\r]+')) AS words, length(text) AS chars FROM documents),
 e AS (SELECT *, CASE WHEN chars = 0 THEN 'not rendered' WHEN doc_id = 0 THEN 'main page' WHEN regexp_matches(text, '[*#$%&]{3}') THEN 'markup' WHEN words < 5 THEN 'too few words' END AS early FROM d),
 f AS (SELECT *, CASE WHEN early IS NULL THEN min(CASE WHEN early IS NULL THEN doc_id END) OVER (PARTITION BY h) END AS winner FROM e)
SELECT doc_id, coalesce(early, CASE WHEN winner <> doc_id THEN 'duplicate of ' || winner WHEN chars < 60 THEN 'too few characters' END) AS reason FROM f"""


def cascade(docs: DataFrame) -> DataFrame:
    """FLT16: doc_id and the first reason that excludes it, null if it is kept. Duplicates count among those alive before them."""
    d = docs.select("doc_id", F.sha1("text").alias("h"), F.regexp_count("text", F.lit(r"[^ \t-\r]+")).alias("words"), F.length("text").alias("chars"), F.col("text").rlike("[*#$%&]{3}").alias("marked"))
    early = F.when(F.col("chars") == 0, "not rendered").when(F.col("doc_id") == 0, "main page").when(F.col("marked"), "markup").when(F.col("words") < 5, "too few words")
    e = d.withColumn("early", early)
    winners = e.where("early is null").groupBy("h").agg(F.min("doc_id").alias("winner"))
    late = F.when(F.col("winner") != F.col("doc_id"), F.concat(F.lit("duplicate of "), F.col("winner").cast("string"))).when(F.col("chars") < 60, "too few characters")
    return e.join(winners, "h", "left").select("doc_id", F.coalesce("early", late).alias("reason"))


@query("flt16_cascade", CASCADE_SQL)
def flt16(t):
    return cascade(t.documents)


@query("flt17_eligible", "SELECT doc_id, kind FROM (SELECT doc_id, text, CASE WHEN contains(text, ' | ') THEN 'table' ELSE 'text' END AS kind FROM documents) WHERE strlen(text) >= CASE kind WHEN 'table' THEN 200 ELSE 100 END")
def flt17(t):
    kind = F.when(F.contains("text", F.lit(" | ")), "table").otherwise("text")
    return t.documents.withColumn("kind", kind).where(F.octet_length("text") >= F.when(F.col("kind") == "table", 200).otherwise(100)).select("doc_id", "kind")


def training_pairs(pairs: DataFrame, native: str, order: list[str]) -> DataFrame:
    """FLT18: pairs (source, target, kept_as_is, junk, checks) with verdict: the first rule that they fail, or kept. Of equal pairs the first in order is kept.

    Escapes are taken off the source outside formulas, digits of the target become ASCII.
    """
    plain = F.trim(F.regexp_replace("source", r"(\$[^$\n]+\$)|\\([!-/:-@\[-`{-~])", "$1$2"))
    p = pairs.withColumns({"_a": plain, "_b": F.trim(F.translate(F.coalesce("target", F.lit("")), "୦୧୨୩୪୫୬୭୮୯", "0123456789"))})
    failed = F.when(F.col("junk") | F.col("kept_as_is"), "junk or kept as it is").when(F.coalesce(F.size("checks"), F.lit(0)).isin(0, -1) | F.exists("checks", lambda c: ~c), "failed a check").when(F.col("_a").rlike(native), "own script in the source").when((F.col("_b") == "") | (F.col("_a") == F.col("_b")), "the same on both sides").when(F.contains("_a", F.lit("|")) | F.contains("_a", F.lit("{{")), "residue")
    p = p.withColumn("_failed", failed).withColumn("_pair", F.sha2(F.concat_ws("\x1f", "_a", "_b"), 256))
    first = p.where("_failed is null").groupBy("_pair").agg(F.min(F.struct(*order)).alias("_first"))
    return p.join(first, "_pair", "left").select(*pairs.columns, F.coalesce("_failed", F.when(F.struct(*order) == F.col("_first"), "kept").otherwise("duplicate")).alias("verdict"))


_V = "CASE WHEN junk OR asis THEN 'junk or kept as it is' WHEN NOT ok THEN 'failed a check' WHEN regexp_matches(a, '[à-ÿ]') THEN 'own script in the source' WHEN b = '' OR a = b THEN 'the same on both sides' WHEN contains(a, '|') OR contains(a, '{{') THEN 'residue' END"


@query("flt18_pairs", f"SELECT verdict, count(*)::BIGINT AS n FROM (SELECT coalesce(v, CASE WHEN row_number() OVER (PARTITION BY v, a, b ORDER BY conv_id, turn) = 1 THEN 'kept' ELSE 'duplicate' END) AS verdict FROM (SELECT *, {_V} AS v FROM (SELECT conv_id, turn, trim(s) AS a, trim(coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '')) AS b, conv_id % 11 = 3 AS junk, conv_id % 13 = 5 AS asis, conv_id % 7 <> 2 AS ok FROM (SELECT *, CASE WHEN conv_id % 5 = 1 THEN '* same' ELSE text END AS s FROM conversations)))) GROUP BY verdict")
def flt18(t):
    """Training pairs with the first rule that each fails; a fifth of the sources are equal but for an escape."""
    from pyspark.sql import Window as W

    i = F.col("conv_id")
    target = F.lead("text").over(W.partitionBy("conv_id").orderBy("turn"))
    pairs = t.conversations.select("conv_id", "turn", F.when(i % 5 == 1, "\\* same").otherwise(F.col("text")).alias("source"), target.alias("target"), (i % 13 == 5).alias("kept_as_is"), (i % 11 == 3).alias("junk"), F.array(F.lit(True), i % 7 != 2).alias("checks"))
    return training_pairs(pairs, "[à-ÿ]", ["conv_id", "turn"]).groupBy("verdict").agg(F.count("*").alias("n"))


@query("flt19_excluded", f"SELECT * FROM ({CASCADE_SQL}) WHERE reason IS NOT NULL AND (contains(reason, 'duplicate') OR doc_id = 24)")
def flt19(t):
    return cascade(t.documents).where(F.col("reason").isNotNull() & (F.contains("reason", F.lit("duplicate")) | (F.col("doc_id") == 24)))


@query("flt20_removed", "SELECT doc_id, para::INT AS para FROM (SELECT doc_id, unnest(range(len(l))) AS para, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE regexp_matches(line, '[0-9]{16}') AND doc_id IN (SELECT doc_id FROM labels)")
def flt20(t):
    return lines(t).where(F.col("line").rlike("[0-9]{16}")).join(t.labels, "doc_id", "left_semi").select("doc_id", F.col("para").cast("int").alias("para"))


@query("prj1_pick", "SELECT doc_id, upper(lang) AS lang, source, n_chars FROM documents")
def prj1(t):
    return t.documents.withColumns({"lang": F.upper("lang")}).drop("text").select("doc_id", "lang", "source", "n_chars")


def default_columns(df: DataFrame, known: list[str], more: int = 3) -> list[str]:
    """PRJ2: the known columns that the table has, in their order, then the first others that can be filtered: numbers, truth values, lists and strings of few words."""
    kinds = (T.BooleanType, T.ArrayType, T.IntegerType, T.LongType, T.DoubleType, T.ShortType, T.FloatType)
    rest = [f.name for f in df.schema.fields if f.name not in known and isinstance(f.dataType, kinds)]
    return [c for c in known if c in df.columns] + rest[:more]


@query("prj2_default_columns", "SELECT doc_id, lang, n_chars, quality, toxic, length(text)::INT AS c1 FROM documents LEFT JOIN labels USING (doc_id)")
def prj2(t):
    """Known columns of the view, then the first three that can be filtered; a known one that is absent, texts, maps and the fourth are left out."""
    view = t.documents.join(t.labels, "doc_id", "left").withColumns({"m": F.create_map("lang", "source"), "c1": F.length("text"), "c2": F.lit(True)})
    return view.select(*default_columns(view, ["doc_id", "title", "lang", "n_chars"]))


@query("ord1_nulls_last", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality DESC NULLS LAST, doc_id LIMIT 100")
def ord1(t):
    return B.ordered(t.documents.join(t.labels, "doc_id", "left"), "quality", True, "doc_id").select("doc_id").limit(100)


@query("ord2_matches", "SELECT doc_id, len(regexp_extract_all(text, 'th'))::BIGINT AS n FROM documents ORDER BY n DESC, doc_id LIMIT 50")
def ord2(t):
    return t.documents.select("doc_id", B.Search("th", "regex", False).matches(F.col("text")).alias("n")).orderBy(F.desc("n"), "doc_id").limit(50)


@query("ord3_page", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 40")
def ord3(t):
    offset, limit = B.paging(3, 20)
    return B.ordered(t.orders, "o_totalprice", True, "o_orderkey").select("o_orderkey").offset(offset).limit(limit)


@query("ord4_ties", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS rank FROM orders ORDER BY rank LIMIT 100")
def ord4(t):
    from pyspark.sql import Window as W

    top = t.orders.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey").limit(100)
    return top.select("o_orderkey", F.row_number().over(W.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")).cast("long").alias("rank"))


@query("ord5_output_order", "SELECT doc_id, reason FROM (" + CASCADE_SQL + ") WHERE reason IS NOT NULL ORDER BY reason, doc_id")
def ord5(t):
    return cascade(t.documents).where("reason is not null").orderBy("reason", "doc_id")


@query("ord6_extremes", "SELECT l_returnflag, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 12")
def ord6(t):
    from pyspark.sql import Window as W

    w = W.partitionBy("l_returnflag").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return t.lineitem.withColumn("rn", F.row_number().over(w)).where("rn <= 12").select("l_returnflag", "l_orderkey", "l_linenumber")


@query("ord7_ranking", "WITH s AS (SELECT o_custkey, o_orderpriority, round(sum(o_totalprice), 2) AS score, min(o_orderkey) AS first FROM orders GROUP BY ALL), k AS (SELECT *, max(score) OVER (PARTITION BY o_custkey) AS top FROM s) SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, first)::INT AS rank FROM k WHERE score >= 0.35 * top")
def ord7(t):
    from pyspark.sql import Window as W

    s = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("score"), F.min("o_orderkey").alias("first"))
    k = s.withColumn("top", F.max("score").over(W.partitionBy("o_custkey"))).where("score >= 0.35 * top")
    return k.select("o_custkey", "o_orderpriority", F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("score"), "first")).alias("rank"))


def interleave(candidates: DataFrame, most: int = 200) -> DataFrame:
    """ORD8: kinds take turns, each giving its most severe candidate whose id and signature aren't yet taken, until `most` are.

    A kind's next candidate is passed over only if its id or its signature is taken, and at most `most` ids and `most`
    signatures ever are. So of each (kind, id) only the first most + 1 candidates with different signatures can matter, of
    each (kind, signature) only the first most + 1 with different ids, and of each kind only its first 2 * most * (most + 1)
    + most of what is left. The sequential step gets these alone: a bounded number a kind.
    """
    import pandas as pd
    from pyspark.sql import Window as W

    strongest = candidates.groupBy("kind", "id", "signature").agg(F.max("severity").alias("severity"))
    rank = lambda d, keys, n: d.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("severity"), "id", F.asc_nulls_first("signature")))).where(F.col("_r") <= n).drop("_r")
    thin = rank(rank(strongest, ["kind", "id"], most + 1), ["kind", "signature"], most + 1)
    thin = rank(thin, ["kind"], 2 * most * (most + 1) + most)

    def take(group: pd.DataFrame) -> pd.DataFrame:
        lists = {k: iter(g.sort_values(["severity", "id", "signature"], ascending=[False, True, True], na_position="first").itertuples(index=False)) for k, g in group.groupby("kind")}
        ids, signatures, out = set(), set(), []
        while lists and len(out) < most:
            for kind in sorted(lists):
                row = next((r for r in lists[kind] if r.id not in ids and (r.signature is None or r.signature not in signatures)), None)
                if row is None:
                    del lists[kind]
                elif len(out) < most:
                    ids.add(row.id)
                    signatures.add(row.signature)
                    out.append((len(out) + 1, kind, row.id, row.signature))
        return pd.DataFrame(out, columns=["rank", "kind", "id", "signature"])

    return thin.groupBy(F.lit(1).alias("_all")).applyInPandas(take, "rank long, kind string, id long, signature string")


@query("ord8_interleave", "SELECT row_number() OVER (ORDER BY turn, kind) AS rank, kind, id FROM (SELECT o_orderpriority AS kind, o_orderkey AS id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS turn FROM orders WHERE o_totalprice > 100000) QUALIFY row_number() OVER (ORDER BY turn, kind) <= 200")
def ord8(t):
    """Kinds that share no id: each gives its candidates in turn. (Shared ids and signatures are tested against a walk in Python.)"""
    c = t.orders.where("o_totalprice > 100000").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderkey").alias("id"), F.lit(None).cast("string").alias("signature"), F.col("o_totalprice").alias("severity"))
    return interleave(c).select("rank", "kind", "id")


def reasons(found: DataFrame, key: str, most: int = 5) -> DataFrame:
    """ORD9: of each key its reasons in order: the primary one, then the most severe up to `most`, what the context says, and how many more there are. found: key, reason, severity, first (whether primary) and context (of the key).

    Ranks beyond the list are dropped before rows of a key are gathered.
    """
    from pyspark.sql import Window as W

    order = W.partitionBy(key).orderBy(F.desc("first"), F.desc("severity"), "reason")
    ranked = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
    lists = ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "reason"))), lambda x: x["reason"]).alias("reasons"))
    counts = found.groupBy(key).agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"), F.max("context").alias("context"))
    whole = F.concat("reasons", F.when(F.col("context").isNotNull(), F.array("context")).otherwise(F.array().cast("array<string>")), F.when(F.col("more") > 0, F.array(F.concat(F.col("more").cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>")))
    return lists.join(counts, key).select(key, F.array_join(whole, "; ").alias("reasons"))


@query("ord9_reasons", "SELECT l_suppkey, array_to_string(list(reason ORDER BY primary_ DESC, l_extendedprice DESC, reason)[1:5] || CASE WHEN l_suppkey % 2 = 0 THEN ['context'] ELSE [] END || CASE WHEN count(*) > 5 THEN [(count(*) - 5) || ' more'] ELSE [] END, '; ') AS reasons FROM (SELECT l_suppkey, l_orderkey || '-' || l_linenumber AS reason, l_extendedprice, l_discount >= 0.1 AND l_quantity > 45 AS primary_ FROM lineitem) GROUP BY l_suppkey")
def ord9(t):
    rows = t.lineitem.select("l_suppkey", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("reason"), F.col("l_extendedprice").alias("severity"), ((F.col("l_discount") >= 0.1) & (F.col("l_quantity") > 45)).alias("first"), F.when(F.col("l_suppkey") % 2 == 0, "context").alias("context"))
    return reasons(rows, "l_suppkey")


@query("ord10_sample", "SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 50")
def ord10(t):
    """A seeded sample, the same for any partitioning."""
    return t.documents.select("doc_id").orderBy(F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))), "doc_id").limit(50)


@query("ord11_slice", "SELECT doc_id, array_to_string(string_split(text, ' ')[1:12], ' ') AS head FROM documents")
def ord11(t):
    return t.documents.select("doc_id", F.array_join(F.slice(F.split("text", " ", -1), 1, 12), " ").alias("head"))


def shards(rows: DataFrame, size: str, most: int, key: str) -> DataFrame:
    """ORD12: longest first, cut where the running sum passes a multiple of `most`. Sums by size come first, so that no window spans all rows."""
    from pyspark.sql import Window as W

    by_size = rows.groupBy(size).agg(F.sum(size).alias("_s"))
    before = by_size.withColumn("_before", F.sum("_s").over(W.orderBy(F.desc(size))) - F.col("_s")).drop("_s")
    placed = rows.join(before, size).withColumn("_k", F.row_number().over(W.partitionBy(size).orderBy(key)))
    return placed.withColumn("shard", F.floor((F.col("_before") + (F.col("_k") - 1) * F.col(size)) / most).cast("long")).drop("_before", "_k")


@query("ord12_shards", "SELECT doc_id, ((sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id) - n_chars) // 50000)::BIGINT AS shard FROM documents")
def ord12(t):
    return shards(t.documents.select("doc_id", "n_chars"), "n_chars", 50_000, "doc_id").select("doc_id", "shard")


@query("api1_browse", "SELECT doc_id, lang, n_chars, count(*) OVER ()::BIGINT AS _rows, (sum(m) OVER ())::BIGINT AS _total, substr(flat, greatest(1, at_ - 70), at_ - greatest(1, at_ - 70) + 75) AS _snippet FROM (SELECT *, replace(text, chr(10), ' ') AS flat, instr(lower(replace(text, chr(10), ' ')), 'token') AS at_, ((length(text) - length(replace(lower(text), 'token', ''))) // 5)::BIGINT AS m FROM documents WHERE n_chars >= 200 AND lang IN ('en', 'fr')) WHERE m > 0 ORDER BY m DESC, doc_id LIMIT 10")
def api1(t):
    page = B.browse(t.documents, [("min.n_chars", "200"), ("in.lang", "en"), ("in.lang", "fr"), ("text", "token"), ("size", "10")], "source", "text", "doc_id")
    return page.select("doc_id", "lang", "n_chars", "_rows", "_total", "_snippet")


@query("api1_second_page", "SELECT o_orderkey, o_orderstatus, count(*) OVER ()::BIGINT AS _rows FROM orders WHERE contains(lower(o_orderpriority), 'urgent') AND o_totalprice <= 200000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 20")
def api1_second(t):
    page = B.browse(t.orders, [("max.o_totalprice", "200000"), ("q", "URGENT"), ("sort", "o_totalprice"), ("dir", "desc"), ("size", "20"), ("page", "2")], "o_orderpriority", "o_orderpriority", "o_orderkey")
    return page.select("o_orderkey", "o_orderstatus", "_rows")
