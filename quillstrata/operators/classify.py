"""Rules of topics, evidence and decisions (CLS1-6) as column expressions and aggregates. Rules are a parameter: an ordered list.

A word of a rule is found at the start of a word of the name; with ~ in front anywhere; with $ behind, the name's word must
end there, with $$ the name itself. The first rule, in order, of which a word is found decides topics, person and kind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Weights of evidence: a category of its own, a place, a parent category, a title's bracket, a title that is a date.
CATEGORY, PLACE, PARENT, BRACKET, DATE = 1.0, 0.4, 0.5, 1.5, 3.0
#: Shares of an item's classes, and of a person's occupations.
CLASSES, OCCUPATIONS = 1.0, 1.5
LEAST_SCORE, LEAST_SHARE = 0.5, 0.35
#: Subjects that schools teach, and those for which persons count.
SCHOOL_TOPICS = "science biology health mathematics technology geography history politics economy literature society education".split()
SCHOOL_PERSON_TOPICS = "science biology health mathematics technology history literature".split()
REGIONAL_TOPICS = ("arts", "religion")


@dataclass(frozen=True)
class Rule:
    """words: what is looked for; kind: strong, weak or person."""

    topics: tuple[str, ...]
    words: tuple[str, ...]
    kind: str = "strong"
    person: bool = False

    def pattern(self, letters: str = r"\p{L}\p{M}") -> str:
        parts = []
        for w in self.words:
            end = "$" if w.endswith("$$") else f"(?![{letters}])" if w.endswith("$") else ""
            parts.append(("" if w.startswith("~") else f"(?<![{letters}])") + re.escape(w.strip("~$")) + end)
        return "|".join(parts)


def decided(name: Column, rules: list[Rule]) -> Column:
    """CLS1: topics, person and kind of the first rule whose word is in the name; null if there is none."""
    out = F.lit(None).cast("struct<topics:array<string>,person:boolean,kind:string>")
    for r in reversed(rules):
        said = F.struct(F.array(*map(F.lit, r.topics)).cast("array<string>").alias("topics"), F.lit(r.person).alias("person"), F.lit(r.kind).alias("kind"))
        out = F.when(name.rlike(r.pattern()), said).otherwise(out)
    return out


def weight(own: Column, place: Column, source: Column) -> Column:
    """CLS2: what one name counts for: a title that is a date, the bracket of a title, a place, a category, a parent."""
    return F.when(source == "date", DATE).when(source == "title", BRACKET).when(place, PLACE).when(own, CATEGORY).otherwise(PARENT)


def evidence(found: DataFrame, key: str) -> DataFrame:
    """CLS2, AGG24: key, topic, score, sources and first place. found: key, pos, source, weight and topics, which share the weight."""
    each = found.select(key, "pos", "source", F.explode("topics").alias("topic"), (F.col("weight") / F.size("topics")).alias("w"))
    return each.groupBy(key, "topic").agg(F.round(F.sum("w"), 6).alias("score"), F.array_sort(F.collect_set("source")).alias("sources"), F.min("pos").alias("first"))


def item_evidence(items: DataFrame, key: str, classes: dict[str, str], occupations: dict[str, str], human: str, heals: str) -> DataFrame:
    """CLS3: key, topic, score and first place from an item's statements. items: key, classes and occupations (arrays of ids) and heals, whether it treats anything.

    Classes with a topic share CLASSES, occupations of humans share OCCUPATIONS; what treats an illness is of the topic `heals` first.
    """
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    named = lambda c, d: F.filter(F.transform(c, lambda x: F.try_element_at(table(d), x)), lambda x: x.isNotNull())
    of_class = named(F.col("classes"), classes)
    of_class = F.when(F.col("heals"), F.concat(F.array(F.lit(heals)), of_class)).otherwise(of_class)
    of_work = F.when(F.array_contains("classes", human), named(F.col("occupations"), occupations)).otherwise(F.array().cast("array<string>"))
    both = items.select(key, of_class.alias("_c"), of_work.alias("_o"))
    parts = F.concat(F.transform("_c", lambda x, i: F.struct(x.alias("topic"), (F.lit(CLASSES) / F.size("_c")).alias("w"), i.alias("at"))), F.transform("_o", lambda x, i: F.struct(x.alias("topic"), (F.lit(OCCUPATIONS) / F.size("_o")).alias("w"), (i + F.size("_c")).alias("at"))))
    each = both.select(key, F.explode(parts).alias("_p")).select(key, "_p.*")
    return each.groupBy(key, "topic").agg(F.round(F.sum("w"), 6).alias("score"), F.min("at").alias("first"))


def decide(own: DataFrame, items: DataFrame, key: str, order: list[str]) -> DataFrame:
    """CLS4, ORD7: key, topics in order of rank, primary and source.

    own: key, topic, score, sources, first and strong (whether a rule matched a name of the key's own); items: key, topic,
    score and first, added only where nothing is strong. Ties go to the earlier statement, then to `order`. Kept are topics of
    LEAST_SHARE of the best score and LEAST_SCORE; the best one always.
    """
    strong = own.groupBy(key).agg(F.bool_or("strong").alias("_strong"))
    more = items.join(strong, key, "left").where(~F.coalesce("_strong", F.lit(False))).select(key, "topic", "score", F.array(F.lit("item")).alias("sources"), "first", F.lit(True).alias("_item"))
    had = own.select(key, "topic", "score", "sources", "first", F.lit(False).alias("_item"))
    one = had.unionByName(more).groupBy(key, "topic").agg(F.round(F.sum("score"), 6).alias("score"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"), F.min(F.when(F.col("_item"), F.col("first"))).alias("_of_item"), F.min(F.when(~F.col("_item"), F.col("first"))).alias("_of_own"), F.max("_item").alias("_item"))
    whole = W.partitionBy(key)
    added = F.max("_item").over(whole)
    ranked = one.withColumn("_first", F.when(added, F.coalesce(F.col("_of_item"), 100 + F.coalesce("_of_own", F.lit(0)))).otherwise(F.col("_of_own")))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("topic"))
    by = whole.orderBy(F.desc("score"), F.col("_first"), place)
    numbered = ranked.withColumn("_rank", F.row_number().over(by)).withColumn("_top", F.max("score").over(whole))
    kept = numbered.where((F.col("_rank") == 1) | (F.col("score") >= F.greatest(F.lit(LEAST_SCORE), LEAST_SHARE * F.col("_top"))))
    return kept.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "topic"))), lambda x: x["topic"]).alias("topics"), F.max(F.when(F.col("_rank") == 1, F.col("topic"))).alias("primary"), F.max(F.when(F.col("_rank") == 1, F.array_join("sources", "+"))).alias("source"))


def school_relevant(primary: Column, person: Column, regional: Column) -> Column:
    """CLS5."""
    return F.when(primary.isNull(), F.lit(False)).when(person, primary.isin(SCHOOL_PERSON_TOPICS)).otherwise(primary.isin(SCHOOL_TOPICS) | (regional & primary.isin(*REGIONAL_TOPICS)))


def regional(names: Column, title: Column, pattern: str) -> Column:
    """CLS6: a word of the region in any visible name or the title."""
    return F.coalesce(F.exists(names, lambda x: x.rlike(pattern)), F.lit(False)) | title.rlike(pattern)


def review_type(markup: Column, kind: Column, eligible: Column, flag: Column, english: Column, foreign: Column) -> Column:
    """CLS7: markup whatever the score; extreme tables; then, of eligible ones that are no tables, English, another script, the least and the most likely."""
    prose = eligible & (kind != "table")
    return F.when(markup.isNotNull(), "markup").when((kind == "table") & flag.isNotNull(), "table").when(prose & english, "english").when(prose & foreign, "script").when(prose & (flag == "high"), "garbled").when(prose & (flag == "low"), "templated")


def severity(type_: Column, markup: Column, z: Column, size: Column, verse: Column, copied: Column) -> Column:
    """CLS7: size in bytes counts as its power of ten above 100."""
    z, large = F.coalesce(z, F.lit(0.0)), F.log10(F.greatest(size, F.lit(100)) / 100)
    up, far = 0.3 * F.greatest(z, F.lit(0.0)), F.abs(z) + 0.5 * large
    return (
        F.when(type_ == "markup", 1 + F.regexp_count(markup, F.lit(",")) + up + large)
        .when(type_ == "table", far)
        .when(type_.isin("english", "script"), 1 + large + up)
        .when(type_ == "garbled", F.when(verse, 0.5 * far).otherwise(far))
        .when(type_ == "templated", far + F.when(copied, 1.5).otherwise(0.0))
    )


def article_candidate(pct: Column, share: Column, paragraphs: Column, tail: float = 0.01) -> Column:
    """CLS8: an article at either end of its percentiles, or one of three paragraphs or more with half of its bytes in extreme ones."""
    return (pct >= 1 - tail) | (pct <= tail) | ((share >= 0.5) & (paragraphs >= 3))
