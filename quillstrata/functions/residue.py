"""Residue of markup in converted text (HTM9-13) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What conversion leaves behind, by name, in the order in which it is taken out, and what stands for it.
FIXES = {
    "spelling": (r"ପରୁଷ(?=ୋତ୍ତମ|ଙ୍କ|ମାନ|\s+(?:ହୋଇଥିବା|ଓ\s))", "ପୁରୁଷ"),
    "anchor tags": (r"<a\s[^<>]*>|</a>", ""),
    "entity &amp;": (r"&amp;", "&"),
    "entity &#13;": (r"&#13;", ""),
    "entity &#10;": (r"&#10;", " "),
    "table marks": (r"\{\||\|\}|(?:^|(?<=\s))\|-(?=\s|$)", ""),
    "template parameters": (r"(?:\b[A-Z][A-Za-z ]{0,30})?(?:\|\s*[A-Za-z_]+\s*=\s*[^|\n]*)+", ""),
    "attributes": (r"\b(?:style|class|align|width|bgcolor|colspan|rowspan|valign|cellpadding|border)\s*=\s*\"[^\"]*\"", ""),
    "category text": (r"Category:Articles containing potentially dated statements(?: from)?\s*|Category:[^\]\n]*\]|\bCategory:", ""),
}
#: Only where this is found are parameters of templates taken out.
PARAMETERS_HINT = r"\|\s*(?:width|bgcolor|align|style|class|quote|border)\s*="
# What makes a whole block residue.
FILE = r"(?im)\.(?:jpe?g|png|svg|gif|tiff?|webp)\s*\||(?:^|\|)\s*(?:thumb|thumbnail|frameless|\d+px)\s*[|\]]"
TABLE = r"(?m)\|\|[^|\n]*\|\||^\s*\{?\|[-+}]?"
HTML = r"data-(?:mw|cx)=|about=\"#mwt|typeof=\"mw:"
TEMPLATE_LINE = r"\A(?:ଛାଞ୍ଚ|Template):[^\n]*\z"
CATEGORY_LINE = r"\A\[*\s*(?:Category\s*:[^\n]*|ଶ୍ରେଣୀ\s*:(?:\S[^\n]*?)?)\s*\]*\z"
WORD = r"(?U)\w"
# What goes from within a block, in this order.
GOING = (
    r"__(?:LEAD_SECTION|NOTOC|TOC|FORCETOC|NOEDITSECTION|NEWSECTIONLINK|NONEWSECTIONLINK|NOGALLERY|HIDDENCAT|INDEX|NOINDEX|DISAMBIG|STATICREDIRECT)__",
    r"(?i)</?(?:span|div|br|small|big|center|font|p|ref|references|sup|sub|b|i|u|s|poem|right|left|meta|nowiki|gallery|onlyinclude|includeonly|noinclude|math|chem|ce|templatestyles|section|abbr|del|ins|mark|tt|strike|em|strong|blockquote)\b[^<>]*/?>",
    r"\S*\|\s*(?:thumb|thumbnail|frameless|upright)\b\S*",
    r"\s*\(\s*(?:https?://|www\.)[^\s)]+\s*\)|(?:https?://|www\.)\S+",
    r"(?<![\w.])\d{1,4}px\b",
    r"(?<![A-Za-z0-9_])\s*\[\s*[0-9୦-୯]{1,3}\s*\]",
    r"\[\[|\]\]|\{\{|\}\}|'{2,}",
)


def _has_table_marks(text: Column) -> Column:
    return text.rlike(FIXES["table marks"][0])


def whole_table(text: Column) -> Column:
    """HTM9: whether a block is a table typed as text: marks of one, and three cells or more."""
    return _has_table_marks(text) & (F.regexp_count(text, F.lit(r" \| ")) >= 3)


def strip_residue(text: Column) -> Column:
    """HTM9; a whole table typed as text is empty."""
    out = text
    for name, (pattern, to) in FIXES.items():
        if name == "table marks":
            out = F.when(whole_table(out), "").otherwise(F.regexp_replace(out, pattern, to))
        elif name == "template parameters":
            out = F.when(out.rlike(PARAMETERS_HINT), F.regexp_replace(out, pattern, to)).otherwise(out)
        else:
            out = F.regexp_replace(out, pattern, to)
    return out


def residue_counts(text: Column) -> Column:
    """HTM9: hits of each rule on the text as it comes, and whether it is a table as a whole."""
    hits = [F.when(text.rlike(PARAMETERS_HINT), F.regexp_count(text, F.lit(p))).otherwise(0).alias(n) if n == "template parameters" else F.regexp_count(text, F.lit(p)).alias(n) for n, (p, _) in FIXES.items()]
    return F.struct(*hits, whole_table(text).cast("int").alias("whole tables"))


def clean_block(text: Column) -> Column:
    """HTM10: a block without residue, addresses, marks and empty brackets; "" if it is residue as a whole or no word is left."""
    fixed = strip_residue(text)
    whole = fixed.rlike(FILE) | fixed.rlike(TABLE) | fixed.rlike(HTML) | ~fixed.rlike(WORD) | fixed.rlike(TEMPLATE_LINE) | fixed.rlike(CATEGORY_LINE)
    out = fixed
    for pattern in GOING:
        out = F.regexp_replace(out, pattern, "")
    out = F.array_join(F.filter(F.split(out, "\n", -1), lambda x: x.rlike(WORD)), "\n")
    bar = r"(?m)(?<=[\u0B00-\u0B7F)\]\"'”’])(\s?){}(?=\s|$)"
    out = F.regexp_replace(F.regexp_replace(out, bar.format(r"\|\|"), "$1॥"), bar.format(r"\|"), "$1।")
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(out, r" ?\([\s,;:]*\)", ""), r"\((?:\s*[,;:])+\s*", "("), r"\s*(?:[,;:]\s*)+\)", ")")
    out = F.btrim(F.regexp_replace(out, r"[ \t]{2,}", " "), F.lit(" \t\r\n"))
    return F.when(whole | ~out.rlike(WORD), "").otherwise(out)


def typed_powers(text: Column) -> Column:
    """HTM11: "6.1 x 108" as a formula: a mantissa with a point, or of one digit before an exponent of two; other products stay."""
    sign, end = "[-\u2212]?", r"(?!\d)(?![.,]\d)"
    out = F.regexp_replace(text, rf"(?<![\d.,])(\d+\.\d+)\s?[x×*]\s?10({sign}[1-9]\d?){end}", r"\$$1 \\times 10^{$2}\$")
    out = F.regexp_replace(out, rf"(?<![\d.,])(\d)\s?[x×*]\s?10({sign}[1-9]\d){end}", r"\$$1 \\times 10^{$2}\$")
    return F.regexp_replace(out, "(times 10\\^\\{)\u2212", "$1-")


# What Markdown would read as markup, anywhere and at the start of a line, and what stands for it.
ESCAPED_ANYWHERE = ((r"\\(?=[!-/:-@\[-`{-~])", r"\\\\"), (r"([*`$])", r"\\$1"), (r"(?<![0-9A-Za-z\u0b00-\u0b7f])_|_(?![0-9A-Za-z\u0b00-\u0b7f])", r"\\_"), (r"<(?=[A-Za-z/!?])", r"\\<"), (r"\](?=[(\[])", r"\\]"), (r"~(?=~)", r"\\~"))
ESCAPED_LINE_STARTS = ((r"(?m)^(#{1,6})(?=\s|$)", r"\\$1"), (r"(?m)^([>|])", r"\\$1"), (r"(?m)^([-+])(?=\s|$)", r"\\$1"), (r"(?m)^([0-9]{1,9})([.)])(?=\s|$)", r"$1\\$2"), (r"(?m)^([=-])(?=[=-]*[ \t]*$)", r"\\$1"))


def escape_markdown(text: Column, line_starts: bool = True) -> Column:
    """HTM12."""
    for pattern, to in ESCAPED_ANYWHERE + (ESCAPED_LINE_STARTS if line_starts else ()):
        text = F.regexp_replace(text, pattern, to)
    return text


_HEADING = r"'?(={2,6})\s*([^=\n|]{1,80}?)\s*\1(?!=)"
_BREAK = "\x01"


def split_headings(text: Column) -> Column:
    """HTM13: a paragraph as an array of blocks (level and text; level 0 is no heading): headings typed in equals signs at its start or after a sentence; elsewhere the signs alone go."""
    marked = F.regexp_replace(text, rf"(?<=^|[।.!?॥:\n])(\s{{0,9}}){_HEADING.replace(chr(92) + '1', chr(92) + '2')}", f"$1{_BREAK}$2 $3{_BREAK}")

    def one(piece: Column) -> Column:
        level = F.length(F.regexp_extract(piece, r"^(={2,6}) ", 1))
        plain = F.regexp_replace(piece, _HEADING, "$2")
        return F.struct(level.alias("level"), F.when(level > 0, F.substr(piece, level + 2)).otherwise(plain).alias("text"))

    return F.filter(F.transform(F.split(marked, _BREAK, -1), one), lambda b: F.btrim(b["text"], F.lit(" \t\r\n")) != "")
