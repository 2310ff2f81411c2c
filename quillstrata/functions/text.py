"""Text primitives as column expressions. Every pattern is written for Java's dialect with explicit classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The native script's decomposed letter and its single code point, digits, and word range.
NATIVE_PAIR, NATIVE_LETTER = "ଯ଼", "ୟ"
NATIVE_DIGITS = "୦୧୨୩୪୫୬୭୮୯"
NATIVE_CLASS = "଀-୿"
#: Length bands in bytes: upper bounds and names.
BANDS = ((100, "<100"), (300, "100-299"), (1000, "300-999"), (3000, "1000-2999"))
#: Wording of a share from either end.
TOP_WORDS = ((0.0001, "0.01%"), (0.001, "0.1%"), (0.005, "0.5%"), (0.01, "1%"), (0.05, "5%"))


def normalize_native(text: Column) -> Column:
    """TXT1: one spelling of a letter that has two; no other normal form."""
    return F.replace(text, F.lit(NATIVE_PAIR), F.lit(NATIVE_LETTER))


def script_share(text: Column, chars: str) -> Column:
    """TXT2, TXT3: characters of a class among those that aren't white space; 0 if there are none."""
    solid = F.length(F.regexp_replace(text, r"[ \t-\r]", ""))
    return F.when(solid > 0, F.regexp_count(text, F.lit(f"[{chars}]")) / solid).otherwise(0.0)


def words(text: Column, chars: str) -> Column:
    """TXT4: maximal runs of a class."""
    return F.regexp_extract_all(text, F.lit(f"[{chars}]+"), F.lit(0))


def numbers(text: Column) -> Column:
    """TXT5: numbers in ASCII digits, without separators."""
    found = F.regexp_extract_all(F.translate(text, NATIVE_DIGITS, "0123456789"), F.lit(r"[0-9][0-9.,]*"), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(x, "[.,]", ""))


def ascii_digits(text: Column) -> Column:
    """TXT6."""
    return F.translate(text, NATIVE_DIGITS, "0123456789")


def has_repeat_run(text: Column, chars: str) -> Column:
    """TXT7: a unit of one to three characters, four times or more in a row."""
    return text.rlike(rf"([{chars}]{{1,3}})\1{{3,}}")


# Spellings that stand for one (vowel lengths, variant letters), signs that go, digits; and a pair of signs for one.
FOLD_FROM = "\u0b5c\u0b5d\u0b5f\u0b35\u0b40\u0b42\u0b08\u0b0a_" + NATIVE_DIGITS + "\u0b3c\u200c\u200d"
FOLD_TO = "\u0b21\u0b22\u0b2f\u0b71\u0b3f\u0b41\u0b07\u0b09 0123456789"
FOLD_PAIR, FOLD_SIGN = "ଙ୍", "ଂ"


def fold_key(text: Column, lower: bool = True) -> Column:
    """TXT9: variants of a spelling under one key; signs beyond the end of FOLD_TO go."""
    out = F.replace(F.translate(text, FOLD_FROM, FOLD_TO), F.lit(FOLD_PAIR), F.lit(FOLD_SIGN))
    return F.lower(out) if lower else out


def heading_key(text: Column) -> Column:
    """TXT10."""
    bare = F.regexp_replace(F.regexp_replace(text, "^=+|=+$", ""), "[ \t-\r]+", " ")
    return F.lower(F.trim(F.regexp_replace(F.trim(bare), "[ :]+$", "")))


def script_mix(text: Column, native: str = NATIVE_CLASS) -> Column:
    """TXT11: shares of native, Latin and other among letters and marks. Latin: ASCII letters and U+00C0 to U+024F; joiners don't count."""
    # what is lost without them: runs go at once, where a match for each letter takes an array of letters
    count = lambda c, chars: F.length(c) - F.length(F.regexp_replace(c, f"{chars}++", ""))
    bare = F.regexp_replace(text, r"[\x00-\x7f]++", "")
    latin = count(text, "[A-Za-z]") + count(bare, r"[\x{C0}-\x{24F}&&[\p{L}\p{M}]]")
    other = count(bare, rf"[\p{{L}}\p{{M}}&&[^\x{{C0}}-\x{{24F}}{native}]]")

    def shares(n: Column) -> Column:
        total = n["native"] + n["latin"] + n["other"]
        return F.struct(*[F.when(total > 0, n[k] / total).otherwise(0.0).alias(k) for k in ("native", "latin", "other")])

    # by way of an array, as each count would be made again wherever a share names it
    counts = F.struct(count(text, f"[{native}]").alias("native"), latin.alias("latin"), other.alias("other"))
    return F.element_at(F.transform(F.array(counts), shares), 1)


# Common English words.
COMMON_ENGLISH = """the of and in to a is was for on as with by he she his her at from that which it an are were be has have had this their its or
not but also who after first one two been into during they them other more most when than all only over under film born known about""".split()


def common_share(text: Column, common: list[str] = COMMON_ENGLISH, least: int = 5) -> Column:
    """TXT12: share of Latin words that are common ones; null under `least` words."""
    found = words(text, "A-Za-zÀ-ɏ'")
    return F.when(F.size(found) >= least, F.size(F.filter(found, lambda x: F.lower(x).isin(common))) / F.size(found))


# Formulas, and what conversion leaves behind.
MATH = r"(?s)\$\$.+?\$\$|(?<!\\)\$[^$\n]+?(?<!\\)\$"
MARKUP = (
    r"(?<!\\)<[A-Za-z/!][^>\n]{0,80}>|\{\{|\}\}|\[\[|\]\]|\{\||\|\}|\b\d+px\b|&[a-z]{2,8};|data-mw|\bmw-|class=|style=|thumb\||https?://|www\."
    r"|(?<![଀-୿])(?:ଛାଞ୍ଚ|ଚିତ୍ର|ଶ୍ରେଣୀ):|\b(?:File|Image|Category|Template):"
)


def markup_hits(text: Column, pattern: str = MARKUP) -> Column:
    """TXT13: distinct hits outside formulas in order, the first four, each cut to twelve characters; null without any."""
    hits = F.regexp_extract_all(F.regexp_replace(text, MATH, " "), F.lit(pattern), F.lit(0))
    shown = F.slice(F.array_sort(F.array_distinct(F.transform(hits, lambda x: F.substring(x, 1, 12)))), 1, 4)
    return F.when(F.size(hits) > 0, F.array_join(shown, ", "))


def is_verse(text: Column, kind: Column) -> Column:
    """TXT14: text of three lines or more, none of 200 characters."""
    lines = F.split(text, "\n", -1)
    return (kind == "text") & (F.size(lines) >= 3) & (F.array_max(F.transform(lines, F.length)) < 200)


def trigram_repeat(text: Column) -> Column:
    """TXT15: share of word trigrams that repeat one; 0 under twelve words."""

    def of(w: Column) -> Column:
        # hashes of the words, put together place by place: no string is built for a triple
        h = F.transform(w, lambda x: F.xxhash64(x))
        return F.element_at(F.transform(F.array(h), triples), 1)

    def triples(h: Column) -> Column:
        n = F.size(h) - 2
        tri = F.zip_with(F.zip_with(F.slice(h, 1, n), F.slice(h, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.slice(h, 3, n), lambda x, c: F.xxhash64(x["a"], x["b"], c))
        return F.when(F.size(h) >= 12, 1 - F.size(F.array_distinct(tri)) / n).otherwise(0.0)

    return F.element_at(F.transform(F.array(F.regexp_extract_all(text, F.lit(r"[^ \t-\r]+"), F.lit(0))), of), 1)


_WHITE = " \t\n\x0b\x0c\r"


def chunks(text: Column, most: int = 1000) -> Column:
    """TXT16: pieces filled greedily with words and the white space between them, up to `most` characters; a longer word is a piece of its own.

    A fold over the lengths of words and gaps finds the places of the cuts; the text itself is cut once for each piece.
    """
    unit = F.transform(F.regexp_extract_all(text, F.lit(r"[^ \t-\r]+|[ \t-\r]+"), F.lit(0)), lambda x: F.struct(F.length(x).alias("n"), (F.btrim(x, F.lit(_WHITE)) != "").alias("solid")))
    start = F.struct(F.array().cast("array<int>").alias("cuts"), F.lit(0).alias("held"), F.lit(False).alias("solid"), F.lit(0).alias("at"))

    def add(a: Column, x: Column) -> Column:
        full = (a["held"] + x["n"] > most) & a["solid"]
        return F.struct(
            F.when(full, F.array_append(a["cuts"], a["at"])).otherwise(a["cuts"]).alias("cuts"),
            F.when(full, x["n"]).otherwise(a["held"] + x["n"]).alias("held"),
            F.when(full, x["solid"]).otherwise(a["solid"] | x["solid"]).alias("solid"),
            (a["at"] + x["n"]).alias("at"),
        )

    def cut(ends: Column) -> Column:
        return F.transform(ends, lambda e, i: F.btrim(F.substr(text, F.when(i == 0, 1).otherwise(F.get(ends, i - 1) + 1), e - F.when(i == 0, 0).otherwise(F.get(ends, i - 1))), F.lit(_WHITE)))

    ends = F.aggregate(unit, start, add, lambda a: F.array_append(a["cuts"], a["at"]))
    return F.filter(F.element_at(F.transform(F.array(ends), cut), 1), lambda x: x != "")


def piece_bytes(text: Column, most: int = 1000) -> Column:
    """TXT17: UTF-8 bytes of the pieces."""
    return F.aggregate(F.transform(chunks(text, most), lambda x: F.octet_length(x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)


def options(text: Column) -> Column:
    """TXT8: labels and texts of "A: ... B: ... C: ..." on one line: three or more of A to E, or of 1 to 5, in sequence, none empty; else null."""
    label = r"(?:^|\s)([A-E1-5]):\s*"

    def of(x: Column) -> Column:
        n = F.size(x["labels"])
        joined = F.array_join(x["labels"], "")
        clean = (n >= 3) & (joined.isin(*[w[:k] for w in ("ABCDE", "12345") for k in (3, 4, 5)])) & ~F.exists(x["texts"], lambda v: v == "")
        return F.when(clean, x)

    texts = F.transform(F.slice(F.split(text, label, -1), 2, 2**30), lambda v: F.btrim(v, F.lit(_WHITE)))
    both = F.struct(F.regexp_extract_all(text, F.lit(label), F.lit(1)).alias("labels"), texts.alias("texts"))
    return F.element_at(F.transform(F.array(both), of), 1)


def excerpt(text: Column, n: int) -> Column:
    """TXT18: at most n characters, with a sign for line breaks and for what is left out."""
    flat = F.replace(text, F.lit("\n"), F.lit(" ⏎ "))
    return F.when(F.length(flat) > n, F.concat(F.rtrim(F.substring(flat, 1, n)), F.lit("…"))).otherwise(flat)


def top_words(share: Column) -> Column:
    """TXT19: "top 1%", "bottom 1%" or "37th percentile" of a percentile rank from 0 to 1."""
    out = F.concat(F.round(share * 100).cast("int").cast("string"), F.lit("th percentile"))
    for bound, said in reversed(TOP_WORDS):
        out = F.when(share >= 1 - bound, f"top {said}").when(share <= bound, f"bottom {said}").otherwise(out)
    return out


def band_of(size: Column) -> Column:
    """TXT20."""
    out = F.lit("3000+")
    for bound, said in reversed(BANDS):
        out = F.when(size < bound, said).otherwise(out)
    return out


def count_substring(text: Column, needle: str) -> Column:
    """TXT21: occurrences that don't overlap."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def count_pattern(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """TXT22."""
    return F.regexp_count(text, F.lit(("(?i)" if ignore_case else "") + pattern)).cast("long")


def content_key(text: Column) -> Column:
    """TXT24: the first sixteen digits of a text's sha1."""
    return F.substring(F.sha1(text), 1, 16)


def quote_title(title: Column) -> Column:
    """TXT25: a title as part of a URL."""
    return F.replace(F.url_encode(F.replace(title, F.lit(" "), F.lit("_"))), F.lit("%2F"), F.lit("/"))


def category_links(html: Column, prefix: str, namespace: str = "") -> Column:
    """TXT26: decoded targets of links below a prefix, without the namespace before their colon, blanks for underscores, each once, in order."""
    found = F.regexp_extract_all(html, F.lit(f'href="{prefix}([^"#?]*)'), F.lit(1))
    plain = lambda x: F.replace(F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), F.lit("_"), F.lit(" "))
    own = F.filter(F.transform(found, plain), lambda x: x.rlike(f"^(?:{namespace}):") if namespace else F.lit(True))
    return F.array_distinct(F.transform(own, lambda x: F.regexp_replace(x, f"^(?:{namespace}):", "") if namespace else x))


def shuffled_words(text: Column, seed: int) -> Column:
    """TXT27: words in a seeded order, the white space between them where it was."""
    word, gap = F.regexp_extract_all(text, F.lit(r"[^ \t-\r]+"), F.lit(0)), F.split(text, r"[^ \t-\r]+", -1)
    mixed = F.transform(F.sort_array(F.transform(word, lambda w, i: F.struct(F.xxhash64(w, i, F.lit(seed)).alias("h"), i.alias("i"), w.alias("w")))), lambda s: s["w"])
    return F.array_join(F.zip_with(gap, mixed, lambda g, w: F.concat(F.coalesce(g, F.lit("")), F.coalesce(w, F.lit("")))), "")


def origin(url: Column) -> Column:
    """TXT28."""
    return F.nullif(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1), F.lit(""))


def origin_of_dump(name: Column) -> Column:
    """TXT28: the origin of the site that a dump's name tells: "frwiki-20250101" is from https://fr.wikipedia.org."""
    lang = F.regexp_extract(name, r"^([a-z][a-z_]*?)wiki-[0-9]{8}", 1)
    return F.when(lang != "", F.concat(F.lit("https://"), F.translate(lang, "_", "-"), F.lit(".wikipedia.org")))


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """TXT29: 95 % interval of a share; null without trials."""
    p, zz = k / n, z * z
    mid, half = p + zz / (2 * n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    bound = lambda x: F.when(n > 0, x / (1 + zz / n))
    return F.struct(bound(mid - half).alias("low"), bound(mid + half).alias("high"))


def block_kind(text: Column, flavour: str = "app") -> Column:
    """HTM19: the kind of a Markdown block, as the builder, the scorer, the application or the annotator tells it."""
    names = {"build": ("heading", "table", "list item", None, "paragraph"), "score": ("heading", "table", "list", "math", "text"), "app": ("heading", "table", "list", "math", "para"), "annotate": ("heading", "table", "list", None, "prose")}[flavour]
    indent = "" if flavour == "annotate" else " {0,12}"
    out = F.when(text.rlike("^#{1,6} "), names[0]).when(text.rlike(r"^\|"), names[1]).when(text.rlike(rf"^{indent}(?:[-*+]|[0-9]+[.)]) "), names[2])
    return (out.when(text.rlike(r"^\$\$"), names[3]) if names[3] else out).otherwise(names[4])


def mask_digits(text: Column, to: str = "#", runs: str = "[0-9]+") -> Column:
    return F.regexp_replace(text, runs, to)


def mask_build(paragraph: Column, title: Column) -> Column:
    """T1: the title, it without its bracket, and its part before a comma, longest first; then numbers."""
    forms = [title, F.trim(F.regexp_replace(title, r"\(.*\)", "")), F.trim(F.substring_index(title, ",", 1))]
    out = paragraph
    for form in forms:
        out = F.when(F.length(form) >= 2, F.replace(out, form, F.lit("TITLE"))).otherwise(out)
    return F.regexp_replace(out, "[0-9][0-9.,]*", "N")


def mask_app(paragraph: Column, title: Column) -> Column:
    """T3: digits, then the title if it has two solid characters."""
    out = mask_digits(paragraph)
    bare = F.regexp_replace(mask_digits(title), r"[#\s\p{P}]", "")
    return F.when(F.length(bare) >= 2, F.replace(out, mask_digits(title), F.lit("⟨title⟩"))).otherwise(out)
