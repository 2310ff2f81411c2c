"""Queries of decisions, bulk plans, annotation status and article detail (API2, API4, API7, API8, API10, API11, FLT21, STR8). Decisions are made of events, so that SQL can say what they are."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import review as V
from ..operators.review import decision_states
from .base import query
from .text import lines

_VERDICT = {"purchase": "keep", "click": "drop", "signup": "fix"}
_VERDICT_SQL = "CASE event_type WHEN 'purchase' THEN 'keep' WHEN 'click' THEN 'drop' WHEN 'signup' THEN 'fix' END"


def log_of(t) -> DataFrame:
    """Events of a review log: of each user's document; some have a note, some a recorded drop, some were made for another text."""
    shas = t.documents.select("doc_id", F.sha1("text").alias("now"))
    e = t.events.select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("at"), "event_type").join(shas, "doc_id", "left")
    verdict = F.try_element_at(F.create_map(*[F.lit(x) for kv in _VERDICT.items() for x in kv]), F.col("event_type"))
    drops = F.when(F.col("at") % 3 == 0, F.array(F.concat(F.lit("gone "), (F.col("at") % 7).cast("string")))).otherwise(F.array().cast("array<string>"))
    return e.select("doc_id", "at", verdict.alias("verdict"), F.when(F.col("at") % 4 == 0, F.concat(F.lit("note "), (F.col("at") % 5).cast("string"))).otherwise("").alias("note"), drops.alias("drops"), F.when(F.col("at") % 5 == 0, "old").otherwise(F.coalesce("now", F.lit("none"))).alias("sha1"))


LOG_SQL = f"SELECT user_id AS doc_id, event_id AS ev, {_VERDICT_SQL} AS verdict, CASE WHEN event_id % 4 = 0 THEN 'note ' || (event_id % 5) ELSE '' END AS note, CASE WHEN event_id % 3 = 0 THEN ['gone ' || (event_id % 7)] ELSE [] END AS drop_list, CASE WHEN event_id % 5 = 0 THEN 'old' ELSE coalesce(sha1(text), 'none') END AS seen, sha1(text) AS now, d.doc_id IS NULL AS missing FROM events LEFT JOIN documents d ON d.doc_id = user_id"
_CURRENT = f"SELECT * FROM ({LOG_SQL}) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ev DESC) = 1"
STATES_SQL = f"SELECT *, len(drop_list) AS drops, coalesce(verdict, CASE WHEN note = '' AND len(drop_list) = 0 THEN 'cleared' ELSE 'none' END) AS state, coalesce(now <> seen, false) AS stale FROM ({_CURRENT})"


def decisions_of(t) -> DataFrame:
    return V.current(log_of(t), "doc_id")


def texts_of(t) -> DataFrame:
    return t.documents.select("doc_id", F.sha1("text").alias("sha1"))


_VIEWS = ("keep", "drop", "fix", "none", "cleared", "decided", "paras", "stale")


@query("flt21_decisions", " UNION ALL ".join(f"SELECT '{v}' AS view, doc_id FROM ({STATES_SQL}) WHERE " + {"decided": "state IN ('keep', 'drop', 'fix')", "paras": "drops > 0", "stale": "stale"}.get(v, f"state = '{v}'") for v in _VIEWS))
def flt21(t):
    """All eight views."""
    states = decision_states(decisions_of(t), texts_of(t), "doc_id")
    return functools.reduce(DataFrame.union, [V.view(states, v).select(F.lit(v).alias("view"), "doc_id") for v in _VIEWS])


def matching_lines(t, pattern: str) -> DataFrame:
    return lines(t).where(F.col("line").rlike(pattern)).select("doc_id", "para", F.sha1("line").alias("sha1"))


_LINES = "SELECT doc_id, unnest(range(len(l)))::INT AS para, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
_WANTED = f"SELECT doc_id, list(sha ORDER BY para) AS w FROM (SELECT doc_id, sha1(line) AS sha, min(para) AS para FROM ({_LINES}) WHERE para > 0 AND regexp_matches(line, '[0-9]{{16}}') GROUP BY ALL) GROUP BY doc_id"
_DROPPING = f"SELECT m.doc_id, c.verdict, coalesce(c.note, '') AS old, c.doc_id IS NOT NULL AS had, c.seen, sha1(d.text) AS sha1, coalesce(c.drop_list, []) AS old_drops, list_filter(coalesce(w, []), lambda x: NOT list_contains(coalesce(c.drop_list, []), x)) AS more FROM (SELECT DISTINCT doc_id FROM ({_LINES}) WHERE regexp_matches(line, '[0-9]{{16}}')) m JOIN documents d USING (doc_id) LEFT JOIN ({_WANTED}) USING (doc_id) LEFT JOIN ({_CURRENT}) c ON c.doc_id = m.doc_id"


@query("api7_bulk_plan", f"SELECT doc_id, verdict, CASE WHEN contains(old, 'cards') THEN old WHEN old = '' THEN 'cards' ELSE old || chr(10) || 'cards' END AS note, array_to_string(old_drops || more, ',') AS drops, sha1, len(more)::INT AS added FROM ({_DROPPING})")
def api7(t):
    """Paragraphs that match a pattern are dropped beside those recorded; never paragraph 0."""
    plan = V.bulk_plan("drop_paragraphs", matching_lines(t, "[0-9]{16}"), texts_of(t), log_of(t), "doc_id", "cards")
    return plan.select("doc_id", "verdict", "note", F.array_join("drops", ",").alias("drops"), "sha1", "added")


@query("api7_bulk_undo", f"SELECT l.doc_id, b.verdict, coalesce(b.note, '') AS note, array_to_string(coalesce(b.drop_list, []), ',') AS drops FROM labels l JOIN documents d USING (doc_id) JOIN ({_CURRENT}) c ON c.doc_id = l.doc_id LEFT JOIN (SELECT * FROM ({LOG_SQL}) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ev DESC) = 2) b ON b.doc_id = l.doc_id WHERE NOT (b.verdict IS NOT DISTINCT FROM c.verdict AND coalesce(b.note, '') = c.note AND coalesce(b.drop_list, []) = c.drop_list AND sha1(d.text) = c.seen)")
def api7_undo(t):
    plan = V.bulk_plan("undo", t.labels.select("doc_id"), texts_of(t), log_of(t), "doc_id")
    return plan.select("doc_id", "verdict", "note", F.array_join("drops", ",").alias("drops"))


@query("api7_bulk_apply", f"WITH c AS ({_CURRENT}), a AS (SELECT l.doc_id FROM (SELECT DISTINCT doc_id FROM labels) l JOIN documents USING (doc_id)), n AS (SELECT doc_id, 'drop' AS state FROM a UNION ALL SELECT doc_id, coalesce(verdict, CASE WHEN note = '' AND len(drop_list) = 0 THEN 'cleared' ELSE 'none' END) FROM c WHERE doc_id NOT IN (SELECT doc_id FROM a)) SELECT state, count(*)::BIGINT AS n, true AS refused FROM n GROUP BY state")
def api7_apply(t):
    """A plan to drop whole articles, applied with the token that was shown; the same plan is refused once its events are in the log."""
    log, targets = log_of(t), t.labels.select("doc_id")
    plan = V.bulk_plan("drop_articles", targets, texts_of(t), log, "doc_id")
    shown = V.token(plan)
    new = V.apply(plan, shown, 1 << 40)
    after = log.unionByName(new.select(log.columns))
    try:
        V.apply(V.bulk_plan("drop_articles", targets, texts_of(t), after, "doc_id"), shown, 1 << 41)
        refused = False
    except V.BadPlan:
        refused = True
    states = decision_states(V.current(after, "doc_id"), texts_of(t), "doc_id")
    return states.groupBy("state").agg(F.count("*").alias("n")).withColumn("refused", F.lit(refused))


@query("str8_plan_token", f"SELECT doc_id, seen, coalesce(now = seen, false) AS current FROM ({_CURRENT})")
def str8(t):
    """Decisions carry the hash of the text that was seen; they hold while the text is the same."""
    s = decision_states(decisions_of(t), texts_of(t), "doc_id")
    return s.select("doc_id", F.col("sha1").alias("seen"), (~F.col("stale") & ~F.col("missing")).alias("current"))


def scored_paragraphs(t) -> DataFrame:
    """An annotation of paragraphs, made for other texts: every sixth place has moved by one, every seventh text was edited, some lie beyond the end, some have no hash, some documents are unknown."""
    p = lines(t).select("doc_id", "para", F.sha1("line").alias("sha1"))
    k = F.pmod(F.col("doc_id") + F.col("para"), F.lit(6))
    sha = F.when(k == 1, F.lit("edited")).when(k == 2, F.lit(None).cast("string")).otherwise(F.col("sha1"))
    return p.select((F.col("doc_id") + F.when(F.col("doc_id") % 11 == 0, 10_000_000).otherwise(0)).alias("doc_id"), (F.col("para") + F.when(k == 0, 1).when(k == 3, 1000).otherwise(0)).alias("para"), sha.alias("sha1"))


_P = f"SELECT doc_id, para, sha1(line) AS sha FROM ({_LINES})"
_SCORED = f"SELECT doc_id + CASE WHEN doc_id % 11 = 0 THEN 10000000 ELSE 0 END AS doc_id, para + CASE (doc_id + para) % 6 WHEN 0 THEN 1 WHEN 3 THEN 1000 ELSE 0 END AS para, CASE (doc_id + para) % 6 WHEN 1 THEN 'edited' WHEN 2 THEN NULL ELSE sha END AS sha FROM ({_P})"


@query("api10_annotation_status", f"WITH s AS ({_SCORED}), c AS (SELECT doc_id, count(*) AS n FROM ({_P}) GROUP BY 1), w AS (SELECT doc_id, sha1(text) AS now FROM documents), a AS (SELECT s.*, c.n, w.now FROM s LEFT JOIN c USING (doc_id) LEFT JOIN w USING (doc_id)), i AS (SELECT doc_id, bool_or(n IS NULL) AS orphan, bool_or(coalesce(sha <> now, false)) AS stale, count(*) FILTER (WHERE para >= n) AS beyond FROM (SELECT a.*, p.sha AS there FROM a LEFT JOIN ({_P}) p USING (doc_id, para)) x GROUP BY 1) SELECT count(*) FILTER (WHERE NOT orphan)::BIGINT AS matched, count(*) FILTER (WHERE orphan)::BIGINT AS orphans, (SELECT count(*) FROM documents) - count(*) FILTER (WHERE NOT orphan)::BIGINT AS missing, count(*) FILTER (WHERE NOT orphan AND stale)::BIGINT AS stale, count(*) FILTER (WHERE NOT orphan AND NOT stale)::BIGINT AS fresh, sum(beyond)::BIGINT AS out_of_range FROM i")
def api10(t):
    """By the hash of the whole text; half of the documents were annotated as they are."""
    corpus = lines(t).groupBy("doc_id").agg(F.count("*").alias("paragraphs")).join(texts_of(t), "doc_id")
    return V.annotation_status(corpus, scored_paragraphs(t), "doc_id")


@query("api11_relocate", f"WITH s AS (SELECT DISTINCT * FROM ({_SCORED})), p AS ({_P}), c AS (SELECT doc_id, count(*) AS n FROM p GROUP BY 1), f AS (SELECT s.doc_id, s.para, s.sha, min_by(p.para, (abs(p.para - s.para), p.para)) AS hit FROM s LEFT JOIN p ON p.doc_id = s.doc_id AND p.sha = s.sha GROUP BY ALL) SELECT f.doc_id, f.para, CASE WHEN sha IS NOT NULL AND hit IS NOT NULL THEN hit WHEN f.para < coalesce(n, 0) THEN f.para END AS found, CASE WHEN sha IS NULL THEN CASE WHEN f.para < coalesce(n, 0) THEN 'unverified' ELSE 'gone' END WHEN hit = f.para THEN 'same' WHEN hit IS NOT NULL THEN 'moved' WHEN f.para < coalesce(n, 0) THEN 'changed' ELSE 'gone' END AS state FROM f LEFT JOIN c ON c.doc_id = f.doc_id")
def api11(t):
    """Where paragraphs that were scored are now."""
    return V.relocated(scored_paragraphs(t).distinct(), lines(t).select("doc_id", "para", F.sha1("line").alias("sha1")), "doc_id")


def article(t, wanted: DataFrame) -> DataFrame:
    """API2: the paragraphs of the wanted documents, with kind, hash, size and what an annotation says of each, and whether that was said of this text."""
    of = t.documents.join(F.broadcast(wanted), "doc_id", "left_semi")
    p = of.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para", "line"))
    ann = scored_paragraphs(t).join(F.broadcast(wanted), "doc_id", "left_semi").dropDuplicates(["doc_id", "para", "sha1"]).groupBy("doc_id", "para").agg(F.max("sha1").alias("scored"), F.count("*").alias("rows"))
    both = p.withColumn("sha1", F.sha1("line")).join(ann, ["doc_id", "para"], "left").join(decisions_of(t).select("doc_id", "verdict", "drops"), "doc_id", "left").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    stale = F.when(F.col("scored").isNotNull(), F.col("scored") != F.col("sha1"))
    return both.select("doc_id", "para", X.block_kind(F.col("line")).alias("kind"), "sha1", F.length("line").alias("chars"), stale.alias("stale"), F.col("rows").isNotNull().alias("annotated"), "quality", "verdict", F.coalesce(F.array_contains("drops", F.col("sha1")), F.lit(False)).alias("dropped"))


_KIND = "CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'heading' WHEN regexp_matches(line, '^[|]') THEN 'table' WHEN regexp_matches(line, '^ {0,12}([-*+]|[0-9]+[.)]) ') THEN 'list' WHEN regexp_matches(line, '^[$][$]') THEN 'math' ELSE 'para' END"


@query("api2_article", f"WITH w AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 3), a AS (SELECT doc_id, para, max(sha) AS scored FROM ({_SCORED}) GROUP BY ALL) SELECT l.doc_id, l.para, {_KIND} AS kind, sha1(line) AS sha1, length(line)::INT AS chars, CASE WHEN scored IS NOT NULL THEN scored <> sha1(line) END AS stale, a.doc_id IS NOT NULL AS annotated, quality, verdict, coalesce(list_contains(drop_list, sha1(line)), false) AS dropped FROM ({_LINES}) l JOIN w USING (doc_id) LEFT JOIN a ON a.doc_id = l.doc_id AND a.para = l.para LEFT JOIN ({_CURRENT}) c ON c.doc_id = l.doc_id LEFT JOIN labels q ON q.doc_id = l.doc_id")
def api2(t):
    """The three longest documents in detail."""
    return article(t, t.documents.select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(3).select("doc_id"))
