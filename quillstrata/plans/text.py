"""Queries of text functions: TXT, HTM columns, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .base import Tables, query

R6 = lambda c: F.round(c, 6)
NATIVE = "a-zà-ÿ"
_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


def lines(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para", "line"))


@query("txt1_normalize", "SELECT doc_id, length(replace(text || 'ଯ଼', 'ଯ଼', 'ୟ')) AS n FROM documents")
def txt1(t):
    return t.documents.select("doc_id", F.length(X.normalize_native(F.concat("text", F.lit(X.NATIVE_PAIR)))).cast("long").alias("n"))


@query("txt2_script_share", r"SELECT doc_id, round(len(regexp_extract_all(t, '[଀-୿।॥]')) / nullif(length(regexp_replace(t, '[ \t-\r]', '', 'g')), 0), 6) AS share, round(len(regexp_extract_all(text, '[a-zà-ÿ]')) / nullif(length(regexp_replace(text, '[ \t-\r]', '', 'g')), 0), 6) AS own FROM (SELECT doc_id, text, 'ଓଡ଼ିଆ ଅ । ॥ ' || text AS t FROM documents)")
def txt2(t):
    return t.documents.select("doc_id", R6(X.script_share(F.concat(F.lit("ଓଡ଼ିଆ ଅ । ॥ "), "text"), X.NATIVE_CLASS + "।॥")).alias("share"), R6(X.script_share(F.col("text"), NATIVE)).alias("own"))


@query("txt3_other_script_share", r"SELECT doc_id, round(len(regexp_extract_all(text, '[A-Za-z]')) / nullif(length(regexp_replace(text, '[ \t-\r]', '', 'g')), 0), 6) AS latin, round(len(regexp_extract_all(text, '[à-ÿ]')) / nullif(length(regexp_replace(text, '[ \t-\r]', '', 'g')), 0), 6) AS other FROM documents")
def txt3(t):
    return t.documents.select("doc_id", R6(X.script_share(F.col("text"), "A-Za-z")).alias("latin"), R6(X.script_share(F.col("text"), "à-ÿ")).alias("other"))


@query("txt4_words", "SELECT doc_id, len(w)::BIGINT AS n, w[1] AS first FROM (SELECT doc_id, regexp_extract_all(text, '[a-zà-ÿ]+') AS w FROM documents)")
def txt4(t):
    return t.documents.select("doc_id", X.words(F.col("text"), NATIVE).alias("w")).select("doc_id", F.size("w").cast("long").alias("n"), F.try_element_at("w", F.lit(1)).alias("first"))


@query("txt5_numbers", "SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[0-9][0-9.,]*'), lambda x: regexp_replace(x, '[.,]', '', 'g')), ' ') AS numbers FROM documents")
def txt5(t):
    return t.documents.select("doc_id", F.array_join(X.numbers(F.col("text")), " ").alias("numbers"))


@query("txt6_digits", "SELECT doc_id, translate(doc_id::VARCHAR || '୧', '୦୧୨୩୪୫୬୭୮୯', '0123456789') AS digits FROM documents")
def txt6(t):
    return t.documents.select("doc_id", X.ascii_digits(F.concat(F.col("doc_id").cast("string"), F.lit("୧"))).alias("digits"))


_UNIT = "len(list_filter(range(1, length(text) - {n} + 1), lambda i: substr(text, i, {k}) = substr(text, i + {k}, {k}) AND substr(text, i, {k}) = substr(text, i + 2 * {k}, {k}) AND substr(text, i, {k}) = substr(text, i + 3 * {k}, {k}) AND regexp_full_match(substr(text, i, {k}), '[a-zà-ÿ]+'))) > 0"


@query("txt7_repeat_run", "SELECT doc_id, " + " OR ".join(_UNIT.format(k=k, n=4 * k - 1) for k in (1, 2, 3)) + " AS runs FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'hahahaha ' ELSE '' END || source || text AS text FROM documents WHERE length(text) < 3000 UNION ALL SELECT doc_id, 'aaaa' FROM documents WHERE length(text) >= 3000)")
def txt7(t):
    """A third of the texts have such a run put in front; of long ones (their SQL would take too long) a run alone is judged."""
    made = F.when(F.length("text") < 3000, F.concat(F.when(F.col("doc_id") % 3 == 0, "hahahaha ").otherwise(""), "source", "text")).otherwise("aaaa")
    return t.documents.select("doc_id", X.has_repeat_run(made, NATIVE).alias("runs"))


@query("txt8_options", r"SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'ABC|' || p_name || '|' || p_type || '|' || p_brand WHEN 1 THEN '12345|a|' || p_name || '|c: d|e|' || p_size END AS options FROM part")
def txt8(t):
    """Clean sequences of letters and of digits; two labels, a gap in the sequence, and an empty option are none."""
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    made = F.element_at(F.array(F.concat(F.lit("A: "), name, F.lit(" B:"), kind, F.lit("\nC:  "), brand), F.concat(F.lit("1: a 2: "), name, F.lit(" 3: c: d 4: e 5: "), F.col("p_size").cast("string")), F.concat(F.lit("A: "), name, F.lit(" B: "), kind), F.concat(F.lit("A: "), name, F.lit(" C: x D: "), kind), F.concat(F.lit("A: "), name, F.lit(" B: C: "), kind)), (F.col("p_size") % 5 + 1).cast("int"))
    found = t.part.select("p_partkey", X.options(made).alias("o"))
    return found.select("p_partkey", F.when(F.col("o").isNotNull(), F.concat_ws("|", F.array_join("o.labels", ""), "o.texts")).alias("options"))


@query("txt9_fold", "SELECT doc_id, replace(lower(source), '_', ' ') || '\u0b21\u0b22\u0b3f\u0b41\u0b07\u0b09\u0b2f\u0b71 07\u0b02\u0b15' AS key FROM documents")
def txt9(t):
    return t.documents.select("doc_id", X.fold_key(F.concat("source", F.lit("\u0b5c\u0b5d\u0b40\u0b42\u0b08\u0b0a\u0b5f\u0b35_\u0b66\u0b6d\u0b19\u0b4d\u200d\u0b15\u0b3c"))).alias("key"))


@query("txt10_heading_key", r"SELECT p_partkey, lower(trim(regexp_replace(trim(regexp_replace(regexp_replace('== ' || p_name || ': ==', '^=+|=+$', '', 'g'), '[ \t-\r]+', ' ', 'g')), '[ :]+$', '', 'g'))) AS key FROM part")
def txt10(t):
    return t.part.select("p_partkey", X.heading_key(F.concat(F.lit("== "), "p_name", F.lit(": =="))).alias("key"))


@query("txt11_script_mix", r"SELECT doc_id, round(o / n, 6) AS native, round(l / n, 6) AS latin, round(x / n, 6) AS other FROM (SELECT *, o + l + x AS n FROM (SELECT doc_id, len(regexp_extract_all(t, '[଀-୿]')) AS o, len(regexp_extract_all(t, '[A-Za-zÀ-ÖØ-öø-ɏ]')) AS l, len(regexp_extract_all(t, '[Ͱ-ϿЀ-ӿ一-鿿]')) AS x FROM (SELECT doc_id, text || ' ଓଡ଼ Ωж漢 é×' AS t FROM documents)))")
def txt11(t):
    made = F.concat("text", F.lit(" ଓଡ଼ Ωж漢 é×"))
    return t.documents.select("doc_id", X.script_mix(made).alias("m")).select("doc_id", R6("m.native").alias("native"), R6("m.latin").alias("latin"), R6("m.other").alias("other"))


_COMMON = ", ".join(f"'{w}'" for w in X.COMMON_ENGLISH)


@query("txt12_common_share", f"SELECT doc_id, CASE WHEN len(w) >= 5 THEN round(len(list_filter(w, lambda x: lower(x) IN ({_COMMON}))) / len(w), 6) END AS share FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-zÀ-ɏ'']+') AS w FROM documents)")
def txt12(t):
    return t.documents.select("doc_id", R6(X.common_share(F.col("text"))).alias("share"))


@query("txt13_markup_hits", r"SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '[[, {{, }}' WHEN 1 THEN '120px, <span class=, Category:, class=' WHEN 2 THEN '&nbsp;' WHEN 3 THEN 'https://, {|' END AS hits FROM part")
def txt13(t):
    """Formulas are no markup, escaped tags are none, more than four kinds are cut."""
    made = F.element_at(F.array(*map(F.lit, ("{{a}} [[b {{", "<span class=x1> Category:y class= 120px", "a&nbsp;b &nbsp; $x{{y$", "{| http s https://x $$a}}b$$", "plain $a|}$ text", "a \\<b> c"))), (F.col("p_size") % 6 + 1).cast("int"))
    return t.part.select("p_partkey", X.markup_hits(made).alias("hits"))


@query("txt14_verse", "SELECT doc_id, len(l) >= 3 AND list_max(list_transform(l, lambda x: length(x))) < 200 AS verse FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def txt14(t):
    return t.documents.select("doc_id", X.is_verse(F.col("text"), F.lit("text")).alias("verse"))


@query("txt15_trigram_repeat", r"SELECT doc_id, CASE WHEN len(w) >= 12 THEN round(1 - len(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) / (len(w) - 2), 6) ELSE 0 END::DOUBLE AS share FROM (SELECT doc_id, regexp_extract_all(text, '[^ \t-\r]+') AS w FROM documents)")
def txt15(t):
    return t.documents.select("doc_id", R6(X.trigram_repeat(F.col("text"))).alias("share"))


_TOKENS = r"list_prepend([0, 0, 0], list_transform(regexp_extract_all(text, '[^ \t-\r]+|[ \t-\r]+'), lambda x: [length(x), regexp_matches(x, '[^ \t-\r]')::INT]))"
_CUTS = f"SELECT doc_id, text, list_reduce({_TOKENS}, lambda s, x: CASE WHEN s[1] + x[1] > 1000 AND s[2] = 1 THEN [x[1], x[2], s[3] + x[1]] || s[4:] || [s[3]] ELSE [s[1] + x[1], greatest(s[2], x[2]), s[3] + x[1]] || s[4:] END) AS s FROM documents"
_ENDS = f"SELECT doc_id, text, list_prepend(0, s[4:] || [s[3]]) AS e FROM ({_CUTS})"
_PIECES = rf"SELECT doc_id, list_filter(list_transform(range(1, len(e)), lambda i: regexp_replace(substr(text, e[i] + 1, e[i + 1] - e[i]), '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), lambda x: x <> '') AS p FROM ({_ENDS})"


@query("txt16_chunks", f"SELECT doc_id, len(p)::BIGINT AS pieces, list_max(list_transform(p, lambda x: length(x)))::BIGINT AS longest FROM ({_PIECES})")
def txt16(t):
    p = t.documents.select("doc_id", X.chunks(F.col("text")).alias("p"))
    return p.select("doc_id", F.size("p").cast("long").alias("pieces"), F.array_max(F.transform("p", F.length)).cast("long").alias("longest"))


@query("txt17_piece_bytes", f"SELECT doc_id, coalesce(list_sum(list_transform(p, lambda x: strlen(x))), 0)::BIGINT AS bytes FROM ({_PIECES})")
def txt17(t):
    return t.documents.select("doc_id", X.piece_bytes(F.col("text")).alias("bytes"))


@query("txt18_excerpt", "SELECT doc_id, CASE WHEN length(f) > 40 THEN rtrim(substr(f, 1, 40)) || '…' ELSE f END AS excerpt FROM (SELECT doc_id, replace(text, chr(10), ' ⏎ ') AS f FROM documents)")
def txt18(t):
    return t.documents.select("doc_id", X.excerpt(F.col("text"), 40).alias("excerpt"))


@query("txt19_top_words", "SELECT p_partkey, CASE WHEN s >= 0.9999 THEN 'top 0.01%' WHEN s <= 0.0001 THEN 'bottom 0.01%' WHEN s >= 0.999 THEN 'top 0.1%' WHEN s <= 0.001 THEN 'bottom 0.1%' WHEN s >= 0.995 THEN 'top 0.5%' WHEN s <= 0.005 THEN 'bottom 0.5%' WHEN s >= 0.99 THEN 'top 1%' WHEN s <= 0.01 THEN 'bottom 1%' WHEN s >= 0.95 THEN 'top 5%' WHEN s <= 0.05 THEN 'bottom 5%' ELSE round(s * 100)::INT || 'th percentile' END AS said FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN 0.0 WHEN p_size = 2 THEN 1.0 ELSE (p_partkey % 1009) / 1009.0 END AS s FROM part)")
def txt19(t):
    share = F.when(F.col("p_size") == 1, 0.0).when(F.col("p_size") == 2, 1.0).otherwise((F.col("p_partkey") % 1009) / 1009.0)
    return t.part.select("p_partkey", X.top_words(share).alias("said"))


@query("txt20_band", "SELECT doc_id, CASE WHEN strlen(text) < 100 THEN '<100' WHEN strlen(text) < 300 THEN '100-299' WHEN strlen(text) < 1000 THEN '300-999' WHEN strlen(text) < 3000 THEN '1000-2999' ELSE '3000+' END AS band FROM documents")
def txt20(t):
    return t.documents.select("doc_id", X.band_of(F.octet_length("text")).alias("band"))


@query("txt21_count_substring", "SELECT doc_id, ((length(text) - length(replace(text, 'the', ''))) // 3)::BIGINT AS n FROM documents")
def txt21(t):
    return t.documents.select("doc_id", X.count_substring(F.col("text"), "the").alias("n"))


@query("txt22_count_pattern", "SELECT doc_id, len(regexp_extract_all(text, '(?i)[aeiou]{3}'))::BIGINT AS n, regexp_matches(text, '[0-9]{16}') AS hit FROM documents")
def txt22(t):
    return t.documents.select("doc_id", X.count_pattern(F.col("text"), "[aeiou]{3}", True).alias("n"), F.col("text").rlike("[0-9]{16}").alias("hit"))


def kwic(rows: DataFrame, text: str, pattern: str, context: int = 70, most: int = 3, slack: int = 20) -> DataFrame:
    """TXT23: rows with `snippets`: up to `most` hits with pre, match and post, each `context` characters wide and cut at a blank within `slack` more.

    Expressions alone: hits from regexp_extract_all, what is between them from split, places from running sums of lengths.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, most + 1)
    sizes = F.transform(F.slice(gaps, 1, most), F.length)
    place = lambda k: F.aggregate(F.slice(F.col("_sizes"), 1, k + 1), F.lit(0), lambda a, x: a + x) + F.aggregate(F.slice(F.col("_hits"), 1, k), F.lit(0), lambda a, x: a + F.length(x))
    flat = lambda x: F.replace(x, F.lit("\n"), F.lit(" ⏎ "))

    def of(hit: Column, k: Column) -> Column:
        return F.element_at(F.transform(F.array(place(k)), lambda at: around(hit, at)), 1)

    def around(hit: Column, at: Column) -> Column:
        wide = F.greatest(F.lit(0), at - context - slack)
        far = F.substr(F.col(text), wide + 1, F.greatest(F.lit(0), at - context - wide))  # what lies before the context
        blank = F.length(far) - F.length(F.substring_index(far, " ", -1))  # place of its last blank
        start = F.when(F.contains(far, F.lit(" ")), wide + blank).otherwise(F.greatest(F.lit(0), at - context))
        end = at + F.length(hit) + context
        rest = F.substr(F.col(text), end + 1, F.lit(slack))
        more = F.when(F.contains(rest, F.lit(" ")), F.length(F.substring_index(rest, " ", 1))).otherwise(0)
        pre, post = F.substr(F.col(text), start + 1, at - start), F.substr(F.col(text), at + F.length(hit) + 1, F.lit(context) + more)
        return F.struct(flat(pre).alias("pre"), hit.alias("match"), flat(post).alias("post"))

    return rows.withColumns({"_hits": F.slice(hits, 1, most), "_sizes": sizes}).withColumn("snippets", F.transform("_hits", of)).drop("_hits", "_sizes")


_KWIC = "FROM (SELECT doc_id, text, unnest(range(1, least(3, len(h)) + 1)) AS k, h, string_split_regex(text, '[0-9]{16}') AS g FROM (SELECT doc_id, text, regexp_extract_all(text, '[0-9]{16}') AS h FROM documents WHERE regexp_matches(text, '[0-9]{16}')))"
_AT = "list_sum(list_transform(g[1:k], lambda x: length(x)))::BIGINT + 16 * (k - 1)"
_FAR = "substr(text, greatest(0, p - 90) + 1, greatest(0, p - 70 - greatest(0, p - 90)))"


@query("txt23_kwic", f"SELECT doc_id, replace(substr(text, s + 1, p - s), chr(10), ' ⏎ ') AS pre, h[k] AS match, replace(substr(text, p + 17, 70 + m), chr(10), ' ⏎ ') AS post FROM (SELECT *, CASE WHEN contains(far, ' ') THEN greatest(0, p - 90) + length(far) - instr(reverse(far), ' ') + 1 ELSE greatest(0, p - 70) END AS s, CASE WHEN contains(rest, ' ') THEN instr(rest, ' ') - 1 ELSE 0 END AS m FROM (SELECT *, {_FAR} AS far, substr(text, p + 87, 20) AS rest FROM (SELECT *, {_AT} AS p {_KWIC})))")
def txt23(t):
    rows = t.documents.where(F.col("text").rlike("[0-9]{16}")).select("doc_id", "text")
    return kwic(rows, "text", "[0-9]{16}").select("doc_id", F.explode("snippets").alias("s")).select("doc_id", "s.pre", "s.match", "s.post")


@query("txt24_hashes", "SELECT doc_id, sha1(text) AS text_sha1, substr(sha1(text), 1, 16) AS key FROM documents")
def txt24(t):
    return t.documents.select("doc_id", F.sha1("text").alias("text_sha1"), X.content_key(F.col("text")).alias("key"))


@query("txt25_quote", "SELECT p_partkey, url_encode(replace(p_name, ' ', '_')) AS part_url FROM part")
def txt25(t):
    return t.part.select("p_partkey", X.quote_title(F.col("p_name")).alias("part_url"))


@query("txt26_links", "SELECT page_id, array_to_string(list_distinct(['About us', 'Ä ' || page_id, 'a+b']), '|') AS links FROM pages WHERE false UNION ALL SELECT page_id, 'About us|Ä ' || page_id || '|a+b' FROM pages")
def txt26(t):
    """Links put in front of each page: a namespace in two languages, escapes, repeats, and links that are no category."""
    made = F.concat(F.lit('<a href="./Category:About_us">x</a><a href="./ଶ୍ରେଣୀ:%C3%84_'), F.col("page_id").cast("string"), F.lit('#top">y</a><a href="./Page">no</a><a href="./Category:About%20us">again</a><a href="./Category:a+b?x=1">z</a>'), F.col("html"))
    return t.pages.select("page_id", F.array_join(X.category_links(made, r"\./", "Category|ଶ୍ରେଣୀ"), "|").alias("links"))


@query("txt27_shuffle", r"SELECT doc_id, md5(array_to_string(list_sort(regexp_extract_all(text, '[^ \t-\r]+')), ' ')) AS words, md5(regexp_replace(text, '[^ \t-\r]+', 'x', 'g')) AS gaps, len(list_distinct(regexp_extract_all(text, '[^ \t-\r]+'))) > 20 AS moved FROM documents")
def txt27(t):
    """The same words between the same gaps, and in another order where there are enough of them."""
    s = t.documents.select("doc_id", "text", X.shuffled_words(F.col("text"), 7).alias("s"))
    ws = F.regexp_extract_all("s", F.lit(r"[^ \t-\r]+"), F.lit(0))
    many = F.size(F.array_distinct(ws)) > 20
    return s.select("doc_id", F.md5(F.array_join(F.sort_array(ws), " ")).alias("words"), F.md5(F.regexp_replace("s", r"[^ \t-\r]+", "x")).alias("gaps"), (many & (F.col("s") != F.col("text"))).alias("moved"))


@query("txt28_origin", "SELECT page_id, nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), '') AS origin, CASE page_id % 3 WHEN 0 THEN 'https://fr.wikipedia.org' WHEN 1 THEN 'https://zh-min-nan.wikipedia.org' END AS dump FROM pages")
def txt28(t):
    name = F.element_at(F.array(F.lit("frwiki-20250101-pages.xml.bz2"), F.lit("zh_min_nanwiki-20250101"), F.lit("notes.txt")), (F.col("page_id") % 3 + 1).cast("int"))
    return t.pages.select("page_id", X.origin(F.col("url")).alias("origin"), X.origin_of_dump(name).alias("dump"))


@query("txt29_wilson", "SELECT lang, round((k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS low, round((k / n + 3.8416 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS high FROM (SELECT lang, count(*)::DOUBLE AS n, count(*) FILTER (WHERE quality = 1)::DOUBLE AS k FROM documents JOIN labels USING (doc_id) GROUP BY lang)")
def txt29(t):
    k = t.documents.join(t.labels, "doc_id").groupBy("lang").agg(F.count_if(F.col("quality") == 1).alias("k"), F.count("*").alias("n"))
    return k.select("lang", X.wilson(F.col("k"), F.col("n")).alias("w")).select("lang", R6("w.low").alias("low"), R6("w.high").alias("high"))


#: Lines by kind, as the builder's tests tell them: p, li, t and h.
_KINDS_SQL = "CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'h' WHEN regexp_matches(line, '^\\|') THEN 't' WHEN regexp_matches(line, '^ {0,12}([-*+]|[0-9]+[.)]) ') THEN 'li' ELSE 'p' END".replace("\\\\", "\\")


def block_lines(t):
    """Lines of documents with a kind: every fourth document's lines are made headings, tables or items."""
    mark = F.element_at(F.array(F.lit(""), F.lit("# "), F.lit("| "), F.lit("- ")), (F.col("doc_id") % 4 + 1).cast("int"))
    marked = lines(t).withColumn("line", F.concat(mark, F.col("line")))
    kind = F.replace(F.replace(F.replace(F.replace(X.block_kind(F.col("line"), "build"), F.lit("list item"), F.lit("li")), F.lit("heading"), F.lit("h")), F.lit("table"), F.lit("t")), F.lit("paragraph"), F.lit("p"))
    return marked.withColumn("kind", kind)


_MARKED = "(SELECT *, " + _KINDS_SQL + " AS kind FROM (SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN '# ' WHEN 2 THEN '| ' WHEN 3 THEN '- ' ELSE '' END || line AS line FROM " + _LINES + "))"


@query("htm14_dominant", f"SELECT doc_id, count(*) FILTER (WHERE l >= CASE kind WHEN 'li' THEN 10 WHEN 'h' THEN 5 ELSE 30 END AND l > 2 * o AND NOT (kind = 't' AND o >= 200))::BIGINT AS dominant FROM (SELECT doc_id, kind, length(regexp_replace(line, '[^A-Za-z]', '', 'g')) AS l, length(regexp_replace(line, '[^à-ÿ]', '', 'g')) AS o FROM {_MARKED}) GROUP BY doc_id")
def htm14(t):
    """Lines dominated by a foreign script; what is enough of it depends on the kind, and a table of much own text stays."""
    foreign, own = F.regexp_count("line", F.lit("[A-Za-z]")), F.regexp_count("line", F.lit("[à-ÿ]"))
    enough = F.when(F.col("kind") == "li", 10).when(F.col("kind") == "h", 5).otherwise(30)
    return block_lines(t).groupBy("doc_id").agg(F.count_if((foreign >= enough) & (foreign > 2 * own) & ~((F.col("kind") == "t") & (own >= 200))).alias("dominant"))


# What tells a citation in any block, in list items, and publishers, who tell one together with a year.
CITATION = r"\b(?:ISBN|ISSN|doi|OCLC)\b|\bpp?\.\s*\d|[Vv]ol\.\s*\d|\bRetrieved\b|^\s*[A-Z][A-Za-z'-]+,\s+(?:[A-Z]\.\s*){1,3}[,(&]|^\s*[A-Z][A-Za-z'-]+,\s+[A-Z][a-z]+(?:\s+[A-Z]\.?)*\s*\((?:1[5-9]|20)\d\d\)"
CITATION_ITEM = CITATION + r"|\((?:1[5-9]|20)\d\d\)\.\s"
PUBLISHER = r"\b(?:[Pp]ress|[Pp]ublishers?|[Pp]ublications|[Jj]ournal|[Pp]roceedings|[Ee]dited by)\b|\(eds?\.\)"
YEAR = r"\b(?:1[5-9]|20)\d\d\b"


def is_citation(text: Column, kind: Column) -> Column:
    """HTM15: stricter for list items, where publishers with a year count, too."""
    return F.when(kind == "li", text.rlike(CITATION_ITEM) | (text.rlike(PUBLISHER) & text.rlike(YEAR))).otherwise(text.rlike(CITATION))


_Q = lambda p: "'" + p.replace("'", "''") + "'"


@query("htm15_citation", f"SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN regexp_matches(x, {_Q(CITATION_ITEM)}) OR (regexp_matches(x, {_Q(PUBLISHER)}) AND regexp_matches(x, {_Q(YEAR)})) ELSE regexp_matches(x, {_Q(CITATION)}) END AS citation FROM (SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'Doe, J. K. (1999) ' || p_name WHEN 1 THEN p_name || ' (1999). ' || p_type WHEN 2 THEN p_name || ' Press, 2001' WHEN 3 THEN p_name || ' vol. 3' WHEN 4 THEN 'see ISBN 3' WHEN 5 THEN 'Smith, John A. (2005) ' || p_name WHEN 6 THEN p_name || ' Press' ELSE p_name || ' pp. 7' END AS x FROM part)")
def htm15(t):
    """Every other block is a list item."""
    name, kind = F.col("p_name"), F.col("p_type")
    made = F.element_at(F.array(F.concat(F.lit("Doe, J. K. (1999) "), name), F.concat(name, F.lit(" (1999). "), kind), F.concat(name, F.lit(" Press, 2001")), F.concat(name, F.lit(" vol. 3")), F.lit("see ISBN 3"), F.concat(F.lit("Smith, John A. (2005) "), name), F.concat(name, F.lit(" Press")), F.concat(name, F.lit(" pp. 7"))), (F.col("p_size") % 8 + 1).cast("int"))
    return t.part.select("p_partkey", is_citation(made, F.when(F.col("p_partkey") % 2 == 0, "li").otherwise("p")).alias("citation"))


_ROUTE = "CASE WHEN regexp_matches(line, '\\bISBN\\b') THEN 'removed: citation' WHEN NOT is_foreign THEN 'kept' WHEN kind IN ('p', 'h') AND item_id IS NULL THEN 'removed: awaiting translation' WHEN kind IN ('p', 'h') AND item_id % 3 = 0 THEN 'removed: junk' WHEN kind IN ('p', 'h') AND item_id % 3 = 1 THEN 'replaced' ELSE 'kept' END".replace("\\\\", "\\")


@query("htm16_routing", f"SELECT route, count(*)::BIGINT AS n FROM (SELECT {_ROUTE} AS route FROM (SELECT kind, line, len(regexp_extract_all(line, '[A-Za-z]')) >= 30 AND length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 2 * length(regexp_replace(line, '[^à-ÿ]', '', 'g')) AS is_foreign, item_id FROM (SELECT * FROM {_MARKED}) l LEFT JOIN (SELECT min(item_id) AS item_id, text AS btext FROM benchmark GROUP BY text) b ON regexp_replace(l.line, '^# ', '') = b.btext)) GROUP BY route")
def htm16(t):
    """Foreign blocks: citations go; paragraphs and headings are replaced by their translation, found by content hash, dropped if it says junk, kept if it is empty, and set aside if there is none; other blocks stay."""
    known = t.benchmark.groupBy(F.sha1("text").alias("sha")).agg(F.min("item_id").alias("item_id"))
    b = block_lines(t).withColumn("sha", F.sha1(F.regexp_replace("line", "^# ", ""))).join(known, "sha", "left")
    foreign = (F.regexp_count("line", F.lit("[A-Za-z]")) >= 30) & (F.regexp_count("line", F.lit("[A-Za-z]")) > 2 * F.regexp_count("line", F.lit("[à-ÿ]")))
    prose = F.col("kind").isin("p", "h")
    route = F.when(F.col("line").rlike(r"\bISBN\b"), "removed: citation").when(~foreign, "kept").when(prose & F.col("item_id").isNull(), "removed: awaiting translation").when(prose & (F.col("item_id") % 3 == 0), "removed: junk").when(prose & (F.col("item_id") % 3 == 1), "replaced").otherwise("kept")
    return b.groupBy(route.alias("route")).agg(F.count("*").alias("n"))


@query("htm19_block_kind", "SELECT kind, count(*)::BIGINT AS n FROM (SELECT CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'heading' WHEN regexp_matches(line, '^\\|') THEN 'table' WHEN regexp_matches(line, '^ {0,12}([-*+]|[0-9]+[.)]) ') THEN 'list' WHEN regexp_matches(line, '^\\$\\$') THEN 'math' ELSE 'para' END AS kind FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY kind".replace("\\\\", "\\"))
def htm19(t):
    return lines(t).groupBy(X.block_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"))


@query("prj3_paragraphs", "SELECT doc_id, (unnest(range(len(l))))::INT AS para, length(unnest(l))::INT AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def prj3(t):
    return lines(t).select("doc_id", F.col("para").cast("int").alias("para"), F.length("line").alias("n"))


@query("t1_mask_build", "SELECT p_partkey, 'TITLE is N of TITLE, or N: TITLE' AS mask FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'TITLE, ' || p_type || ' is N of TITLE, or N: TITLE' FROM part WHERE p_partkey % 2 = 1")
def t1(t):
    """The title, it without its bracket, and its part before a comma."""
    name, odd = F.concat(F.lit("Mr "), "p_name"), F.col("p_partkey") % 2 == 1
    title = F.when(odd, F.concat(name, F.lit(", x"))).otherwise(F.concat(name, F.lit(" (town)")))
    text = F.concat(F.when(odd, F.concat(name, F.lit(", "), "p_type")).otherwise(title), F.lit(" is "), F.col("p_size").cast("string"), F.lit(".5 of "), name, F.lit(", or 1,000: "), name)
    return t.part.select("p_partkey", X.mask_build(text, title).alias("mask"))


def skeletons(rows: DataFrame, key: str, text: str, rare_below: int = 20, least: int = 4) -> DataFrame:
    """T2: words of fewer than rare_below rows become one sign, runs of it collapse; null under `least` kept words."""
    words_ = rows.select(key, F.posexplode(F.split(F.regexp_replace(text, "[0-9]", "0"), " +")).alias("at", "word"))
    frequent = words_.select("word", key).distinct().groupBy("word").agg(F.count("*").alias("df")).where(F.col("df") >= rare_below).select("word", F.lit(True).alias("kept"))
    marked = words_.join(frequent, "word", "left").withColumn("shown", F.when(F.col("kept"), F.col("word")).otherwise("<W>"))
    rows_ = marked.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "shown"))), lambda s: s["shown"]), " ").alias("s"), F.count_if("kept").alias("n_kept"))
    return rows_.select(key, F.when(F.col("n_kept") >= least, F.regexp_replace("s", "<W>(?: <W>)+", "<W>")).alias("skeleton"))


@query("t2_skeletons", "WITH w AS (SELECT item_id, unnest(range(len(l))) AS pos, unnest(l) AS word FROM (SELECT item_id, regexp_split_to_array(regexp_replace(text, '[0-9]', '0', 'g'), ' +') AS l FROM benchmark)), f AS (SELECT word FROM w GROUP BY word HAVING count(DISTINCT item_id) >= 20) SELECT item_id, CASE WHEN count(f.word) >= 4 THEN regexp_replace(string_agg(coalesce(f.word, '<W>'), ' ' ORDER BY pos), '<W>( <W>)+', '<W>', 'g') END AS skeleton FROM w LEFT JOIN f ON w.word = f.word GROUP BY item_id")
def t2(t):
    return skeletons(t.benchmark, "item_id", "text")


@query("t3_mask_app", "SELECT doc_id, sha1(replace(regexp_replace(text, '[0-9]+', '#', 'g'), regexp_replace(source, '[0-9]+', '#', 'g'), '⟨title⟩')) AS mask FROM documents")
def t3(t):
    return t.documents.select("doc_id", F.sha1(X.mask_app(F.col("text"), F.col("source"))).alias("mask"))
