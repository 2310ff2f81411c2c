"""Decisions of reviewers as an append-only log: current state, views, bulk plans, tokens (API7, API8, FLT21, STR8).

An event holds id, at (its place in the log), verdict, note, drops (the hashes of paragraphs that go) and sha1 (of the text
that was seen). The last event of an id is its decision; one without verdict, note and drops is cleared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("verdict", "note", "drops", "sha1")


class BadPlan(ValueError):
    """A bulk action that can't be planned, or a plan that no longer holds."""


def current(events: DataFrame, key: str) -> DataFrame:
    """The last event of each id, by one aggregate with map-side combine."""
    last = events.groupBy(key).agg(F.max_by(F.struct(*FIELDS), "at").alias("_e"), F.max("at").alias("at"))
    return last.select(key, "at", "_e.*")


def before_last(events: DataFrame, key: str) -> DataFrame:
    """API8: what an undo would append: the decision before the last one, or a cleared one."""
    last = events.groupBy(key).agg(F.max("at").alias("_last"))
    earlier = events.join(last, key).where("at < _last").groupBy(key).agg(F.max_by(F.struct(*FIELDS), "at").alias("_e"))
    return last.select(key).join(earlier, key, "left").select(key, "_e.*")


def empty(verdict: Column, note: Column, drops: Column) -> Column:
    return verdict.isNull() & (F.coalesce(note, F.lit("")) == "") & (F.coalesce(F.size(drops), F.lit(0)) <= 0)


def decision_states(decisions: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """FLT21, AGG26: decisions with state (keep, drop, fix, none or cleared), stale (made for another text) and missing (no such text). texts: key and sha1."""
    now = texts.select(key, F.col("sha1").alias("_now"))
    joined = decisions.join(now, key, "left")
    state = F.coalesce("verdict", F.when(empty(F.col("verdict"), F.col("note"), F.col("drops")), "cleared").otherwise("none"))
    return joined.select(*decisions.columns, state.alias("state"), F.coalesce(F.col("_now") != F.col("sha1"), F.lit(False)).alias("stale"), F.col("_now").isNull().alias("missing"))


def view(states: DataFrame, name: str) -> DataFrame:
    """FLT21: keep, drop, fix, none, cleared, decided, paras or stale."""
    special = {"decided": F.col("state").isin("keep", "drop", "fix"), "paras": F.size("drops") > 0, "stale": F.col("stale")}
    if name not in special and name not in ("keep", "drop", "fix", "none", "cleared"):
        raise BadPlan(f"no view {name!r}")
    return states.where(special.get(name, F.col("state") == name))


def bulk_plan(action: str, targets: DataFrame, texts: DataFrame, events: DataFrame, key: str, note: str = "") -> DataFrame:
    """API7: the events that an action would append: key, FIELDS and added (new drops).

    targets: key, and for drop_paragraphs also para and sha1 of the paragraphs that match; texts: key and sha1. Paragraph 0,
    the title, is never dropped; recorded drops stay; ids without a text, and decisions that would not change, have no event.
    """
    if action not in ("drop_paragraphs", "drop_articles", "undo", "clear"):
        raise BadPlan(f"no action {action!r}")
    if action == "drop_paragraphs" and "para" not in targets.columns:
        raise BadPlan("drop_paragraphs needs paragraphs")
    ids = targets.select(key).distinct()
    had = current(events, key).select(key, *[F.col(c).alias(f"_{c}") for c in FIELDS], F.lit(True).alias("_had"))
    of = ids.join(texts.select(key, "sha1"), key).join(had, key, "left")
    old_drops = F.coalesce("_drops", F.array().cast("array<string>"))
    if action == "undo":
        past = before_last(events, key).select(key, F.col("verdict").alias("_v"), F.coalesce("note", F.lit("")).alias("_n"), F.coalesce("drops", F.array().cast("array<string>")).alias("_d"), F.lit(True).alias("_any"))
        new = of.join(past, key).select("*", F.col("_v").alias("verdict"), F.col("_n").alias("note"), F.col("_d").alias("drops"), F.lit(0).alias("added"))
    elif action == "clear":
        new = of.select("*", F.lit(None).cast("string").alias("verdict"), F.lit("").alias("note"), F.array().cast("array<string>").alias("drops"), F.lit(0).alias("added"))
    else:
        if action == "drop_paragraphs":
            wanted = targets.where("para > 0").groupBy(key, "sha1").agg(F.min("para").alias("_p")).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "sha1"))), lambda x: x["sha1"]).alias("_w"))
            of = of.join(wanted, key, "left")
            more, verdict = F.array_except(F.coalesce("_w", F.array().cast("array<string>")), old_drops), F.col("_verdict")
        else:
            more, verdict = F.array().cast("array<string>"), F.lit("drop")
        old_note = F.coalesce("_note", F.lit(""))
        said = F.when(F.lit(note == "") | F.contains(old_note, F.lit(note)), old_note).when(old_note == "", F.lit(note)).otherwise(F.concat(old_note, F.lit("\n" + note)))
        new = of.select("*", verdict.alias("verdict"), said.alias("note"), F.concat(old_drops, more).alias("drops"), F.size(more).alias("added"))
    same = F.when(F.col("_had"), F.col("verdict").eqNullSafe(F.col("_verdict")) & (F.col("note") == F.coalesce("_note", F.lit(""))) & (F.col("drops") == old_drops) & F.col("sha1").eqNullSafe(F.col("_sha1"))).otherwise(empty(F.col("verdict"), F.col("note"), F.col("drops")))
    return new.where(~same).select(key, *FIELDS, "added")


def token(plan: DataFrame) -> str:
    """STR8: names the events of a plan, in any order: a plan holds as long as planning anew gives the same token."""
    r = plan.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*[F.to_json(F.struct(c)) for c in plan.columns]).cast("decimal(38,0)")).alias("h")).first()
    return f"{r['n']}-{r['h'] or 0}"


def apply(plan: DataFrame, seen: str, at: int) -> DataFrame:
    """The events to append, numbered from `at`; refused if the plan isn't the one that was seen."""
    if token(plan) != seen:
        raise BadPlan("the data or the decisions have changed since the plan was shown")
    return plan.drop("added").withColumn("at", F.lit(at).cast("long"))


def relocated(scored: DataFrame, paragraphs: DataFrame, key: str) -> DataFrame:
    """API11: scored (key, para, sha1 or null) with found and state.

    same: the text is still there; moved: it is at another place, the nearest; changed: it is nowhere, but the place exists;
    gone: there is no such place; unverified: without a hash the place is taken as it is. paragraphs: key, para and sha1.
    """
    now = paragraphs.select(key, F.col("para").alias("_at"), F.col("sha1").alias("_sha"))
    sizes = paragraphs.groupBy(key).agg(F.count("*").alias("_n"))
    places = scored.join(now, (scored[key] == now[key]) & (scored["sha1"] == now["_sha"]), "left").select(scored["*"], "_at")
    nearest = places.groupBy(key, "para", "sha1").agg(F.min_by("_at", F.struct(F.abs(F.col("_at") - F.col("para")), "_at")).alias("_found"))
    known = nearest.join(sizes, key, "left")
    there = F.col("para") < F.coalesce("_n", F.lit(0))
    state = F.when(F.col("sha1").isNull(), F.when(there, "unverified").otherwise("gone")).when(F.col("_found") == F.col("para"), "same").when(F.col("_found").isNotNull(), "moved").when(there, "changed").otherwise("gone")
    return known.select(key, "para", F.when(F.col("sha1").isNotNull() & F.col("_found").isNotNull(), F.col("_found")).when(there, F.col("para")).alias("found"), state.alias("state"))


def annotation_status(corpus: DataFrame, annotation: DataFrame, key: str) -> DataFrame:
    """API10: matched, orphans, missing, stale, fresh and out_of_range of an annotation of paragraphs. corpus: key, sha1 and paragraphs; annotation: key, para and sha1."""
    a = annotation.join(corpus.select(key, F.col("sha1").alias("_now"), "paragraphs"), key, "left")
    ids = a.groupBy(key).agg(F.bool_or(F.col("_now").isNull()).alias("_orphan"), F.bool_or(F.coalesce(F.col("sha1") != F.col("_now"), F.lit(False))).alias("_stale"), F.count_if((F.col("para") < 0) | (F.col("para") >= F.col("paragraphs"))).alias("_out"))
    one = ids.agg(F.count_if(~F.col("_orphan")).alias("matched"), F.count_if("_orphan").alias("orphans"), F.count_if(~F.col("_orphan") & F.col("_stale")).alias("stale"), F.sum("_out").alias("out_of_range"))
    return one.join(F.broadcast(corpus.agg(F.count("*").alias("_all")))).select("matched", "orphans", (F.col("_all") - F.col("matched")).alias("missing"), "stale", (F.col("matched") - F.col("stale")).alias("fresh"), F.coalesce("out_of_range", F.lit(0)).alias("out_of_range"))
