"""Queries of joins, sets, windows, duplicates and graphs: JON, SET, WIN, DUP, GRA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import block_kind
from ..operators.ranks import percentile_rank, robust_spread
from ..sources.catalog import Store
from ..sources.shared import stored
from .base import query
from .filters import CASCADE_SQL, cascade
from .text import lines


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """WIN1, WIN2: the first row of each key, by aggregation with map-side combine rather than a window over the key's rows."""
    rest = [c for c in rows.columns if c not in keys]
    least = rows.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_r"))
    return least.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def latest_events(events: DataFrame, key: str, at: str) -> DataFrame:
    """WIN10, STR7: the last event of each key in append order."""
    rest = [c for c in events.columns if c not in (key, at)]
    return events.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("_e")).select(key, *[F.col(f"_e.{c}").alias(c) for c in (at, *rest)])


_LATEST = "(SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id)"


@query("jon1_view", f"SELECT d.doc_id, l.doc_id IS NOT NULL AS present, quality, e.event_type AS verdict FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN {_LATEST} e ON e.user_id = d.doc_id")
def jon1(t):
    own = t.labels.select("doc_id", "quality", F.lit(True).alias("present"))
    reviews = latest_events(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("verdict"))
    return t.documents.select("doc_id").join(own, "doc_id", "left").join(reviews, "doc_id", "left").select("doc_id", F.coalesce("present", F.lit(False)).alias("present"), "quality", "verdict")


@query("jon2_dedup_side", "SELECT l_orderkey, l_linenumber, s_name FROM lineitem LEFT JOIN (SELECT s_nationkey, min_by(s_name, s_suppkey) AS s_name FROM supplier GROUP BY s_nationkey) s ON s_nationkey = l_suppkey % 25")
def jon2(t):
    side = first_per_key(t.supplier.select("s_nationkey", "s_suppkey", "s_name"), ["s_nationkey"], ["s_suppkey"]).select(F.col("s_nationkey").cast("long").alias("k"), "s_name")
    return t.lineitem.withColumn("k", F.col("l_suppkey") % 25).join(side, "k", "left").select("l_orderkey", "l_linenumber", "s_name")


@query("jon3_store", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def jon3(t):
    return t.orders.join(t.customer.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@query("jon4_status", "SELECT count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL)::BIGINT AS matched, count(*) FILTER (WHERE l.doc_id IS NULL)::BIGINT AS missing, count(*) FILTER (WHERE d.doc_id IS NULL)::BIGINT AS orphans FROM documents d FULL JOIN (SELECT doc_id FROM labels UNION ALL SELECT -1) l ON d.doc_id = l.doc_id")
def jon4(t):
    labels = t.labels.select(F.col("doc_id").alias("l")).union(t.spark.range(1).select(F.lit(-1).cast("long")))
    both = t.documents.select(F.col("doc_id").alias("d")).join(labels, F.col("d") == F.col("l"), "full")
    return both.agg(F.count_if(F.col("d").isNotNull() & F.col("l").isNotNull()).alias("matched"), F.count_if(F.col("l").isNull()).alias("missing"), F.count_if(F.col("d").isNull()).alias("orphans"))


_NUMBERED = "(SELECT doc_id, unnest(range(len(l)))::INT AS para, sha1(unnest(l)) AS sha FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"


@query("jon5_stale", f"SELECT count(*) FILTER (WHERE n.sha = o.sha)::BIGINT AS fresh, count(*) FILTER (WHERE n.sha <> o.sha)::BIGINT AS stale, count(*) FILTER (WHERE n.sha IS NULL)::BIGINT AS gone FROM (SELECT doc_id, para + (doc_id % 3)::INT AS para, sha FROM {_NUMBERED}) o LEFT JOIN {_NUMBERED} n USING (doc_id, para)")
def jon5(t):
    now = lines(t).select("doc_id", "para", F.sha1("line").alias("now"))
    then = lines(t).select("doc_id", (F.col("para") + (F.col("doc_id") % 3).cast("int")).alias("para"), F.sha1("line").alias("then"))
    return then.join(now, ["doc_id", "para"], "left").agg(F.count_if(F.col("now") == F.col("then")).alias("fresh"), F.count_if(F.col("now") != F.col("then")).alias("stale"), F.count_if(F.col("now").isNull()).alias("gone"))


@query("jon6_lookup", "SELECT count(*)::BIGINT AS n, count(b.item_id)::BIGINT AS found FROM (SELECT sha1(unnest(string_split(text, chr(10)))) AS h FROM documents) l LEFT JOIN (SELECT sha1(text) AS h, min(item_id) AS item_id FROM benchmark GROUP BY 1) b USING (h)")
def jon6(t):
    known = t.benchmark.groupBy(F.sha1("text").alias("h")).agg(F.min("item_id").alias("item_id"))
    return lines(t).select(F.sha1("line").alias("h")).join(known, "h", "left").agg(F.count("*").alias("n"), F.count("item_id").alias("found"))


@query("jon7_two_keys", "SELECT (SELECT count(*) FROM lineitem l WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_linenumber = 1 AND o_orderstatus = 'F'))::BIGINT AS applied, (SELECT count(*) FROM orders o WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1))::BIGINT AS not_found")
def jon7(t):
    entries = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    items = t.lineitem.select("l_orderkey", "l_linenumber")
    applied = items.join(entries, ["l_orderkey", "l_linenumber"], "left_semi").agg(F.count("*").alias("applied"))
    return applied.crossJoin(F.broadcast(entries.join(items, ["l_orderkey", "l_linenumber"], "left_anti").agg(F.count("*").alias("not_found"))))


@query("jon8_chain", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1")
def jon8(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation.where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("jon9_missing", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jon9(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("jon10_recheck", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def jon10(t):
    return t.documents.join(t.labels.where("quality = 0"), "doc_id", "left_semi").select("doc_id")


@query("jon11_star", "SELECT r_name, count(*)::BIGINT AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def jon11(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"))


def restricted(rows: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """JON12: rows of the kept ids; fails if an id has no row."""
    lost = keep.join(rows, key, "left_anti").count()
    if lost:
        raise ValueError(f"{lost} ids have no row")
    return rows.join(keep, key, "left_semi")


@query("jon12_restrict", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) ORDER BY doc_id")
def jon12(t):
    return restricted(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), "doc_id").orderBy("doc_id")


@query("jon13_positions", "SELECT conv_id, bool_and(a.h = b.h) AS equal FROM (SELECT conv_id, turn, sha1(text) AS h FROM conversations) a FULL JOIN (SELECT conv_id, turn, sha1(text) AS h FROM conversations WHERE turn < 100) b USING (conv_id, turn) GROUP BY conv_id")
def jon13(t):
    side = lambda name, d: d.select("conv_id", "turn", F.sha1("text").alias(name))
    return side("a", t.conversations).join(side("b", t.conversations.where("turn < 100")), ["conv_id", "turn"], "full").groupBy("conv_id").agg(F.bool_and(F.col("a") == F.col("b")).alias("equal"))


def bigrams(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, gram: hashes of the distinct word pairs of each row, digits masked."""
    w = F.transform(F.split(F.lower(F.regexp_replace(text, "[0-9]", "0")), r"[ \t-\r]+"), lambda x: F.xxhash64(x))
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.xxhash64(a, b))
    return rows.select(key, w.alias("w")).where(F.size("w") >= 2).select(key, F.explode(F.array_distinct(pairs)).alias("gram"))


#: Distinct grams of a probe that go to every task; more of them are joined by the gram, with the same result.
MOST_KNOWN = 1_000_000


def near_copies(probe: DataFrame, pool: DataFrame, least: float = 0.5) -> DataFrame:
    """JON14, DUP4: probe rows p and pool rows q whose bigram sets have a Jaccard of `least` or more.

    Pairs share grams of the probe alone, and no fewer than `least` of either set. So a pool row is its number of grams and
    those that any probe row has, too few of which rule it out where it is made; the others' grams are never shuffled.
    What is left is ordered by how many rows hold a gram, the rarest first. Two sets that are alike enough share one of their
    first s - least * n + 1 of s grams, so that only these meet; sizes rule pairs out, and whole sets decide. A gram that many
    rows hold comes into a prefix only where nothing rarer is left.
    """
    probe = stored(probe)
    known = stored(probe.select("gram").distinct())
    few = known.limit(MOST_KNOWN + 1).count() <= MOST_KNOWN
    marked = pool.join((F.broadcast if few else lambda d: d)(known.withColumn("_known", F.col("gram"))), "gram", "left")
    sets = marked.groupBy("q").agg(F.count("*").alias("nq"), F.collect_list("_known").alias("_g"))
    kept = stored(sets.where((F.size("_g") > 0) & (F.size("_g") >= F.col("nq") * least)))
    common = probe.select("gram").union(kept.select(F.explode("_g"))).groupBy("gram").agg(F.count("*").alias("_df"))

    def ranked(rows: DataFrame, key: str, *more: Column) -> DataFrame:
        listed = rows.join(common, "gram").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_df", "gram"))).alias("_g"), *more)
        return listed.select(key, f"n{key}", F.transform("_g", lambda x: x["gram"]).alias(f"_{key}"))

    def prefix(sets: DataFrame, key: str) -> DataFrame:
        return sets.select(key, f"n{key}", F.explode(F.slice(f"_{key}", 1, (F.size(f"_{key}") - F.ceil(F.col(f"n{key}") * least) + 1).cast("int"))).alias("gram"))

    p = stored(ranked(probe, "p", F.count("*").alias("np")))
    q = stored(ranked(kept.select("q", "nq", F.explode("_g").alias("gram")), "q", F.first("nq").alias("nq")))
    sizes = (F.col("np") >= F.col("nq") * least) & (F.col("nq") >= F.col("np") * least)
    met = prefix(p, "p").join(prefix(q, "q"), "gram").where(sizes).select("p", "q").distinct()
    both = met.join(p, "p").join(q, "q").withColumn("_c", F.size(F.array_intersect("_p", "_q")))
    j = both.withColumn("jaccard", F.col("_c") / (F.col("np") + F.col("nq") - F.col("_c")))
    return j.where(F.col("jaccard") >= least).select("p", "q", F.round("jaccard", 6).alias("jaccard"))


_BIGRAM = r"(SELECT DISTINCT {k}, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT {k}, w, unnest(range(1, len(w))) AS i FROM (SELECT {k}, regexp_split_to_array(lower(regexp_replace({x}, '[0-9]', '0', 'g')), '[ \t-\r]+') AS w FROM {t})))"
_P = _BIGRAM.format(k="item_id", x="text", t="benchmark")
_Q = _BIGRAM.format(k="sha", x="line", t="(SELECT DISTINCT sha1(line) AS sha, line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) >= 50)")


@query("jon14_near_copies", f"WITH p AS {_P}, q AS {_Q}, np AS (SELECT item_id, count(*) AS np FROM p GROUP BY 1), nq AS (SELECT sha, count(*) AS nq FROM q GROUP BY 1) SELECT item_id AS p, sha AS q, round(c / (np + nq - c), 6) AS jaccard FROM (SELECT item_id, sha, count(*) AS c FROM p JOIN q USING (gram) GROUP BY 1, 2) JOIN np USING (item_id) JOIN nq USING (sha) WHERE c / (np + nq - c) >= 0.5")
def jon14(t):
    pool = lines(t).where(F.length("line") >= 50).select(F.sha1("line").alias("q"), "line").distinct()
    return near_copies(bigrams(t.benchmark.select(F.col("item_id").alias("p"), "text"), "p", "text"), bigrams(pool, "q", "line"))


@query("jon15_mark", "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents")
def jon15(t):
    return t.documents.select("doc_id").join(t.labels.select("doc_id", F.lit(True).alias("_l")).distinct(), "doc_id", "left").select("doc_id", F.col("_l").isNotNull().alias("labelled"))


@query("jon16_scalar", "SELECT c_custkey, (SELECT min(o_orderstatus) FROM orders WHERE o_custkey = c_custkey) AS status FROM customer")
def jon16(t):
    return t.customer.join(t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderstatus").alias("status")), "c_custkey", "left").select("c_custkey", "status")


@query("jon17_using", "SELECT doc_id, source, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) JOIN documents USING (doc_id) WHERE length(line) > 0 GROUP BY ALL")
def jon17(t):
    return lines(t).where(F.length("line") > 0).join(t.documents.select("doc_id", "source"), "doc_id").groupBy("doc_id", "source").agg(F.count("*").alias("n"))


@query("jon18_queue", f"SELECT item_id, l.quality, e.event_type FROM benchmark LEFT JOIN labels l ON l.doc_id = item_id LEFT JOIN {_LATEST} e ON e.user_id = item_id")
def jon18(t):
    reviews = latest_events(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id").select(F.col("user_id").alias("item_id"), "event_type")
    return t.benchmark.select("item_id").join(t.labels.select(F.col("doc_id").alias("item_id"), "quality"), "item_id", "left").join(reviews, "item_id", "left")


def with_context(base: DataFrame, contexts: dict[str, DataFrame | None], key: str) -> DataFrame:
    """JON19: contexts joined where there is one; its columns have its name in front. An absent context adds nothing."""
    for name, rows in contexts.items():
        if rows is not None:
            base = base.join(rows.select(key, *[F.col(c).alias(f"{name}_{c}") for c in rows.columns if c != key]), key, "left")
    return base


@query("jon19_optional", "SELECT doc_id, quality AS labels_quality, toxic AS labels_toxic FROM documents LEFT JOIN labels USING (doc_id)")
def jon19(t):
    """One context whose file is there, and one whose file is not."""
    there = {f.stem for f in Store(t.spark).listed(t.sf_dir)}
    contexts = {name: getattr(t, name) if name in there else None for name in ("labels", "translation")}
    return with_context(t.documents.select("doc_id"), contexts, "doc_id")


@query("jon20_labels_predictions", "SELECT quality, predicted, count(*)::BIGINT AS n FROM (SELECT quality, (NOT regexp_matches(text, '[*#$%&]{3}|!!'))::INT AS predicted FROM labels JOIN documents USING (doc_id)) GROUP BY ALL")
def jon20(t):
    return t.labels.join(t.documents, "doc_id").groupBy("quality", (~F.col("text").rlike("[*#$%&]{3}|!!")).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


@query("jon21_full", "SELECT k, coalesce(a, 0)::BIGINT AS a, coalesce(b, 0)::BIGINT AS b FROM (SELECT c_nationkey AS k, count(*) AS a FROM customer WHERE c_acctbal > 9000 GROUP BY 1) x FULL JOIN (SELECT s_nationkey AS k, count(*) AS b FROM supplier GROUP BY 1) y USING (k)")
def jon21(t):
    a = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("a"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("b"))
    return a.join(b, "k", "full_outer").select("k", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))


BOT_NAME = r"(?i)bot\b|^bot"


@query("jon22_bots", "SELECT c_custkey, c_custkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) OR name LIKE '%7Bot' OR name LIKE 'bot%' AS bot FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN c_name || '7Bot' WHEN c_custkey % 10 = 3 THEN 'botany ' || c_name WHEN c_custkey % 10 = 4 THEN 'Robotics ' || c_name ELSE c_name END AS name FROM customer)")
def jon22(t):
    """Users in a group's table, or whose name says so at its start or at a word's end."""
    k = F.col("c_custkey") % 10
    name = F.when(k == 7, F.concat("c_name", F.lit("7Bot"))).when(k == 3, F.concat(F.lit("botany "), "c_name")).when(k == 4, F.concat(F.lit("Robotics "), "c_name")).otherwise(F.col("c_name"))
    listed = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("c_custkey"), F.lit(True).alias("_l")).distinct()
    return t.customer.join(listed, "c_custkey", "left").select("c_custkey", (F.col("_l").isNotNull() | name.rlike(BOT_NAME)).alias("bot"))


def partition_check(ids: DataFrame, kept: DataFrame, out: DataFrame, key: str) -> DataFrame:
    """SET1: ids, kept, excluded, repeated (ids listed more than once, in one or in both), strangers (listed, but no ids) and lost (ids that neither lists), by one aggregate of tagged rows."""
    tagged = ids.select(key, F.lit("i").alias("_t")).union(kept.select(key, F.lit("k"))).union(out.select(key, F.lit("o")))
    of = tagged.groupBy(key).agg(*[F.count_if(F.col("_t") == x).alias(x) for x in "iko"])
    listed = F.col("k") + F.col("o")
    return of.agg(F.count_if(F.col("i") > 0).alias("ids"), F.coalesce(F.sum("k"), F.lit(0)).alias("kept"), F.coalesce(F.sum("o"), F.lit(0)).alias("excluded"), F.count_if(listed > 1).alias("repeated"), F.count_if((listed > 0) & (F.col("i") == 0)).alias("strangers"), F.count_if((listed == 0) & (F.col("i") > 0)).alias("lost"))


_SPLIT = f"WITH c AS ({CASCADE_SQL}), k AS (SELECT doc_id FROM c WHERE reason IS NULL AND doc_id % 13 <> 5 UNION ALL SELECT doc_id FROM c WHERE reason IS NULL AND doc_id % 17 = 3), o AS (SELECT CASE WHEN doc_id % 7 = 2 THEN doc_id + 100000000 ELSE doc_id END AS doc_id FROM c WHERE reason IS NOT NULL UNION ALL SELECT doc_id FROM c WHERE reason IS NULL AND doc_id % 19 = 4), l AS (SELECT doc_id, count(*) AS n FROM (SELECT * FROM k UNION ALL SELECT * FROM o) GROUP BY doc_id)"


@query("set1_consistency", _SPLIT + " SELECT (SELECT count(*) FROM c)::BIGINT AS ids, (SELECT count(*) FROM k)::BIGINT AS kept, (SELECT count(*) FROM o)::BIGINT AS excluded, (SELECT count(*) FROM l WHERE n > 1)::BIGINT AS repeated, (SELECT count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM c))::BIGINT AS strangers, (SELECT count(*) FROM c WHERE doc_id NOT IN (SELECT doc_id FROM l))::BIGINT AS lost")
def set1(t):
    """A cascade whose lists were damaged: ids left out, listed twice, on both sides, and unknown ones."""
    c = cascade(t.documents)
    good, bad = c.where("reason is null"), c.where("reason is not null")
    kept = good.where("doc_id % 13 <> 5").select("doc_id").union(good.where("doc_id % 17 = 3").select("doc_id"))
    out = bad.select(F.when(F.col("doc_id") % 7 == 2, F.col("doc_id") + 100_000_000).otherwise(F.col("doc_id")).alias("doc_id")).union(good.where("doc_id % 19 = 4").select("doc_id"))
    return partition_check(t.documents, kept, out, "doc_id")


@query("set2_union", "SELECT doc_id, 'store' AS of FROM labels UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def set2(t):
    return t.labels.select("doc_id", F.lit("store").alias("of")).unionByName(t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", F.lit("new").alias("of")))


@query("set3_union_missing", "SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def set3(t):
    return t.labels.select("doc_id", "quality").unionByName(t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id"), allowMissingColumns=True)


@query("set4_except", "SELECT c_nationkey::INT AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def set4(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).subtract(t.supplier.where("s_acctbal > 0").select("s_nationkey"))


@query("set5_key_union", "SELECT DISTINCT k FROM (SELECT o_orderstatus AS k FROM orders UNION ALL SELECT l_linestatus FROM lineitem)")
def set5(t):
    a, b = t.orders.select(F.col("o_orderstatus").alias("k")).distinct(), t.lineitem.select(F.col("l_linestatus").alias("k")).distinct()
    return a.join(b, "k", "full_outer").select("k")


@query("set6_symmetric", "(SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer)")
def set6(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("k")).distinct(), t.supplier.select(F.col("s_nationkey").alias("k")).distinct()
    return a.exceptAll(b).union(b.exceptAll(a))


@query("set7_contained", "SELECT doc_id, len(list_filter(list_distinct(regexp_extract_all(text, '[0-9]')), lambda x: NOT contains(doc_id::VARCHAR, x))) = 0 AS contained FROM documents")
def set7(t):
    a = F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit("[0-9]"), F.lit(0)))
    return t.documents.select("doc_id", (F.size(F.array_except(a, F.split(F.col("doc_id").cast("string"), ""))) == 0).alias("contained"))


@query("set8_distinct", "SELECT DISTINCT p_brand, p_size FROM part")
def set8(t):
    return t.part.select("p_brand", "p_size").distinct()


@query("win1_first", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1")
def win1(t):
    return first_per_key(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])


@query("win2_one", "SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def win2(t):
    return first_per_key(t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber"), ["l_orderkey"], ["l_partkey", "l_linenumber"])


@query("win3_percentile", "SELECT p_partkey, round((rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2) / count(*) OVER (PARTITION BY p_brand), 6) AS pct FROM part")
def win3(t):
    return percentile_rank(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size").select("p_partkey", F.round("pct", 6).alias("pct"))


@query("win4_median_mad", "WITH m AS (SELECT p_partkey, p_brand, p_size, median(p_size) OVER (PARTITION BY p_brand) AS med FROM part) SELECT p_partkey, round(med, 6) AS med, round(median(abs(p_size - med)) OVER (PARTITION BY p_brand), 6) AS mad FROM m")
def win4(t):
    s = robust_spread(t.part, ["p_brand"], "p_size", 1.0)
    return t.part.join(s, "p_brand").select("p_partkey", F.round("med", 6).alias("med"), F.round("spread", 6).alias("mad"))


@query("win5_total", "SELECT o_orderkey, count(*) OVER ()::BIGINT AS n FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20")
def win5(t):
    rows = t.orders.where("o_orderstatus = 'P'")
    return rows.select("o_orderkey").orderBy("o_orderkey").limit(20).join(F.broadcast(rows.agg(F.count("*").alias("n"))))


@query("win7_neighbours", "SELECT o_orderkey, lag(o_orderkey) OVER w AS prev, lead(o_orderkey) OVER w AS next FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)")
def win7(t):
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.select("o_orderkey", F.lag("o_orderkey").over(w).alias("prev"), F.lead("o_orderkey").over(w).alias("next"))


@query("win8_previous", "SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before, length(text) - coalesce(lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS grown FROM conversations")
def win8(t):
    w = W.partitionBy("conv_id").orderBy("turn")
    return t.conversations.select("conv_id", "turn", F.lag("turn").over(w).alias("before"), (F.length("text") - F.coalesce(F.lag(F.length("text")).over(w), F.lit(0))).cast("long").alias("grown"))


@query("win9_first_last", "SELECT conv_id, min_by(role, turn) AS first, max_by(role, turn) AS last FROM conversations GROUP BY conv_id")
def win9(t):
    return t.conversations.groupBy("conv_id").agg(F.min_by("role", "turn").alias("first"), F.max_by("role", "turn").alias("last"))


@query("win10_latest", f"SELECT * FROM {_LATEST}")
def win10(t):
    return latest_events(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("win11_undo", "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 2")
def win11(t):
    """The event before the last: the two greatest of each key."""
    top = t.events.groupBy("user_id").agg(F.max("event_id").alias("last"))
    rest = t.events.join(top, "user_id").where("event_id < last")
    return rest.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))


@query("win12_group_size", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_size)::BIGINT AS n FROM part")
def win12(t):
    return t.part.join(t.part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n")), ["p_brand", "p_size"]).select("p_partkey", "n")


_DUP = "SELECT doc_id, min(doc_id) OVER (PARTITION BY sha1(text)) AS winner FROM documents"


@query("win13_winner", _DUP)
def win13(t):
    keyed = t.documents.select("doc_id", F.sha1("text").alias("h"))
    return keyed.join(keyed.groupBy("h").agg(F.min("doc_id").alias("winner")), "h").select("doc_id", "winner")


@query("dup1_exact", f"SELECT doc_id, 'duplicate of ' || winner AS reason FROM ({_DUP}) WHERE winner <> doc_id")
def dup1(t):
    return win13(t).where("doc_id <> winner").select("doc_id", F.concat(F.lit("duplicate of "), F.col("winner").cast("string")).alias("reason"))


@query("dup2_pairs", "SELECT role, sha1(text) AS h, min(conv_id) AS conv_id FROM conversations GROUP BY ALL")
def dup2(t):
    return t.conversations.groupBy("role", F.sha1("text").alias("h")).agg(F.min("conv_id").alias("conv_id"))


_MASKED = "SELECT doc_id, line, substr(sha1(regexp_replace(line, '[0-9]+', '#', 'g')), 1, 16) AS key FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) > 0"


def repeated_groups(rows: DataFrame, line: str, doc: str, least: int = 2, norm: bool = False) -> DataFrame:
    """DUP3, AGG4: lines alike but for their digits, in `least` documents or more: key, counts, mean length and the most frequent kind.

    Two aggregates with one distinct column each, of hashes, so that no row is doubled and no line is shuffled; with `norm`
    the masked line of the groups that are left comes from another pass.
    """
    masked = F.regexp_replace(line, "[0-9]+", "#")
    keyed = rows.select(doc, F.substring(F.sha1(masked), 1, 16).alias("key"), F.xxhash64(line).alias("_h"), F.length(line).alias("_n"), block_kind(F.col(line)).alias("_kind"))
    of_doc = keyed.groupBy("key", doc, "_h", "_kind").agg(F.count("*").alias("_c"), F.sum("_n").alias("_n"))
    articles = of_doc.groupBy("key").agg(F.sum("_c").alias("paragraphs"), F.count_distinct(doc).alias("articles"), F.floor(F.sum("_n") / F.sum("_c")).cast("long").alias("chars")).where(F.col("articles") >= least)
    variants = of_doc.groupBy("key", "_h", "_kind").agg(F.sum("_c").alias("_c")).groupBy("key", "_kind").agg(F.count("*").alias("_v"), F.sum("_c").alias("_c")).groupBy("key").agg(F.sum("_v").alias("variants"), F.min_by("_kind", F.struct(-F.col("_c"), "_kind")).alias("kind"))
    out = articles.join(variants, "key").select("key", "paragraphs", "articles", "variants", "chars", "kind")
    if norm:
        out = rows.select(masked.alias("norm"), F.substring(F.sha1(masked), 1, 16).alias("key")).join(out.select("key"), "key", "left_semi").groupBy("key").agg(F.min("norm").alias("norm")).join(out, "key")
    return out


@query("dup3_masked_groups", f"SELECT key, min(regexp_replace(line, '[0-9]+', '#', 'g')) AS norm, count(*)::BIGINT AS paragraphs, count(DISTINCT doc_id)::BIGINT AS articles, floor(avg(length(line)))::BIGINT AS chars, count(DISTINCT line)::BIGINT AS variants FROM ({_MASKED}) GROUP BY key HAVING count(DISTINCT doc_id) >= 2")
def dup3(t):
    return repeated_groups(lines(t).where(F.length("line") > 0), "line", "doc_id", norm=True).drop("kind")


@query("dup4_near", f"WITH p AS {_P}, n AS (SELECT item_id, count(*) AS n FROM p GROUP BY 1) SELECT a.item_id AS p, b.item_id AS q, round(count(*) / (any_value(x.n) + any_value(y.n) - count(*)), 6) AS jaccard FROM p a JOIN p b USING (gram) JOIN n x ON x.item_id = a.item_id JOIN n y ON y.item_id = b.item_id WHERE a.item_id < b.item_id GROUP BY ALL HAVING count(*) / (any_value(x.n) + any_value(y.n) - count(*)) >= 0.05")
def dup4(t):
    grams = lambda name: bigrams(t.benchmark.select(F.col("item_id").alias(name), "text"), name, "text")
    return near_copies(grams("p"), grams("q"), 0.05).where("p < q")


@query("dup5_header", "SELECT split_part(text, chr(10), 1) AS header, count(DISTINCT doc_id)::BIGINT AS n FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2")
def dup5(t):
    return t.documents.groupBy(F.substring_index("text", "\n", 1).alias("header")).agg(F.count_distinct("doc_id").alias("n")).where("n >= 2")


@query("dup6_self", r"SELECT doc_id, len(l) - len(list_distinct(l)) AS again FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")
def dup6(t):
    lines_ = F.split("text", "\n", -1)
    return t.documents.select("doc_id", (F.size(lines_) - F.size(F.array_distinct(lines_))).cast("long").alias("again"))


@query("dup7_shared_drop", f"SELECT doc_id, para FROM {_NUMBERED} WHERE para > 0 AND sha IN (SELECT sha FROM {_NUMBERED} WHERE para > 0 GROUP BY sha HAVING count(*) >= 3)")
def dup7(t):
    """A drop of one paragraph holds for all that are equal, never for paragraph 0."""
    p = lines(t).where("para > 0").select("doc_id", F.col("para").cast("int").alias("para"), F.sha1("line").alias("sha"))
    return p.join(p.groupBy("sha").agg(F.count("*").alias("n")).where("n >= 3"), "sha", "left_semi").select("doc_id", "para")


def walk(edges: DataFrame, roots: DataFrame, depth: int = 3) -> DataFrame:
    """GRA1: root, node and least depth of what a bounded walk up the edges reaches. A node counts once a root, at its first level."""
    seen = level = roots.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth"))
    for d in range(1, depth + 1):
        level = level.join(edges, level["node"] == edges["child"]).select("root", F.col("parent").alias("node"), F.lit(d).alias("depth")).dropDuplicates(["root", "node"]).join(seen.select("root", "node"), ["root", "node"], "left_anti")
        seen = seen.unionByName(level)
    return seen


@query("gra1_walk", "WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS child, (s_suppkey % 25)::INT AS parent FROM supplier), w AS (SELECT n_nationkey AS root, n_nationkey AS node, 0 AS depth FROM nation UNION SELECT root, e.parent, depth + 1 FROM w JOIN e ON e.child = w.node WHERE depth < 3) SELECT root, node, min(depth) AS depth FROM w GROUP BY ALL")
def gra1(t):
    edges = t.supplier.select(F.col("s_nationkey").alias("child"), (F.col("s_suppkey") % 25).cast("int").alias("parent")).distinct()
    return walk(edges, t.nation.select(F.col("n_nationkey").alias("root")))


@query("gra2_superclass", "SELECT c_custkey, coalesce(CASE WHEN n_name < 'C' THEN n_name END, r_name) AS topic FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def gra2(t):
    up = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return up.select("c_custkey", F.coalesce(F.when(F.col("n_name") < "C", F.col("n_name")), F.col("r_name")).alias("topic"))


@query("gra3_closure", "WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS child, (s_suppkey % 25)::INT AS parent FROM supplier), w AS (SELECT 0 AS node, 0 AS depth UNION SELECT e.parent, depth + 1 FROM w JOIN e ON e.child = w.node WHERE depth < 3) SELECT DISTINCT node FROM w")
def gra3(t):
    """Three rounds of a frontier from one node."""
    edges = t.supplier.select(F.col("s_nationkey").alias("child"), (F.col("s_suppkey") % 25).cast("int").alias("parent")).distinct()
    return walk(edges, t.spark.range(1).select(F.lit(0).alias("root"))).select("node")


@query("gra4_graph", "SELECT n_regionkey AS region, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS nations FROM nation GROUP BY 1")
def gra4(t):
    return t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("nations"))
