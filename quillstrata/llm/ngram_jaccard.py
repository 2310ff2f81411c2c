"""N-gram Jaccard join by token-combination prefixes: documents whose shingle sets have a Jaccard similarity of LINK or more.

1. Each document's set of hashed shingles; equal sets are one class, and all that follows is done for classes.
2. How many documents each shingle is in, counted over all of them in packed arrays. The most frequent shingles, at most
   FREQUENT_MOST of them, make the frequent token class, a bounded broadcast; they come last in the order of tokens.
   Which shingles are in it changes how much is compared, never what is found.
3. A set of n tokens misses at most d = n // 10 tokens of one that it links with, so that the d + 1 first tokens of both
   share one. If these are all rare, each is a key. Else the rare ones are keys, and the prefix is extended: with at most
   a tokens of x missing in y and b of y in x, k of the first (k - 1)(a + b) + k common tokens are side by side in both;
   so all combinations of k = COMBINED tokens side by side in the first ka + (k - 1)b + k tokens are keys (b is taken
   one higher, as a may be less than d). Sets so small that this promises nothing (fewer than 20 tokens at 80 %) have
   their first d + 1 tokens as keys, whatever their class: the condition is the same for both sets of a pair.
4. Classes that share a key of at most BUCKET classes are compared with each other. Of larger buckets, each class is
   first compared with the leader of those with the same least key. In a bucket that is not yet in one component, all are
   compared with its leader; only what isn't yet in one component goes on to further leaders, of which each round
   takes sixteen times as many, so that every pair not yet connected is compared at last. In its last round those outside
   the bucket's main component lead: a group of near copies is compared with what is not in it, not with itself. A pair
   is made only where the parities of counts in BINS bins allow a link: tokens that one set has and the other has not are
   as many as the parities that differ, at least.
5. A pair is dropped if the sizes, the rare tokens that they don't share, or counts of tokens in BINS bins, rule it out; the rest is verified on the whole sets.
6. Components of the links (components.py).

Defined cases: null and empty texts, and those without words, have no shingles and are linked with nothing; texts with
fewer words than a shingle have one. Repeated rows are copies of each other. Rows with a null doc_id take part and have
the component of their class. Very long texts have all their shingles. Pairs at the threshold itself link. An empty table
gives an empty one. Other columns are left aside. Shingles are 64-bit hashes, classes 64-bit sums of them: of n classes,
n * n / 2^65 pairs are expected to share a name by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard, short_lived_shuffles, stored
from ._batches import bounded_batches, encoded, give_back, map_texts, slices, texts_of
from .components import components

FREQUENT_FROM, FREQUENT_MOST, BUCKET, COMBINED = 32, 1_000_000, 32, 4
#: Keys of large buckets that may be broadcast; parts that a task deals to.
FEW_KEYS, WIDE = 100_000, 512
BINS, COUNT_TOKENS, BLOOM_LEAST, BLOOM_MOST, SLICE = 256, 1_000_000, 26, 30, 2 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_L, _B = T.LongType(), T.BinaryType()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted sets of hashed shingles."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.lower().split() for t in texts]
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*split)}
        n = [len(ws) for ws in split]
        h = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.uint64, sum(n))
        k, out, at = self.size, [], 0
        rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for j in range(k):
            rolled = mix(rolled * _M1 + h[j : j + len(rolled)])
        for m in n:
            if m >= k:
                s = np.sort(rolled[at : at + m - k + 1])
                out.append(s if len(s) < 2 or (new := s[1:] != s[:-1]).all() else s[np.r_[True, new]])
            elif m:
                x = np.array([m], np.uint64)
                for j in range(m):
                    x = mix(x * _M1 + h[at + j])
                out.append(x)
            else:
                out.append(np.zeros(0, np.uint64))
            at += m
        return out


def classes_of(found: list[np.ndarray]) -> np.ndarray:
    """The 64-bit names of sets that aren't empty, signed."""
    if not found:
        return np.zeros(0, np.int64)
    size = np.array([len(s) for s in found])
    total = np.add.reduceat(mix(np.concatenate(found) * _M2), np.cumsum(size) - size)
    return mix(total + size.astype(np.uint64)).view(np.int64)


def bins_of(tokens: np.ndarray) -> bytes:
    return np.minimum(np.bincount((tokens & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


class Frequent:
    """Membership in the frequent token class, which knows tokens by their upper 32 bits."""

    def __init__(self, names: np.ndarray):
        self.names = np.sort(names.astype(np.uint32))
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.names & np.uint32((1 << 22) - 1)] = True

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        names = (tokens >> np.uint64(32)).astype(np.uint32)
        out = self.seen[names & np.uint32((1 << 22) - 1)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.names, names[at]), len(self.names) - 1)
            out[at] = self.names[place] == names[at]
        return out


def keys_of(tokens: np.ndarray, frequent: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of a set; with each combination the number of rare tokens and the combination one place before, else 0 and 0.

    share: percents of similarity that link. tokens ascend, frequent tells the class of each.
    """
    n = len(tokens)
    d = n - -(-share * n // 100)
    rare = tokens[~frequent]
    single = mix(rare[: d + 1])
    if len(rare) > d:
        return single, np.zeros(len(single), np.int64), np.zeros(len(single), np.uint64)
    b = max(0, 100 * (n - d) // share - n)
    k = min(COMBINED, n)
    order = np.concatenate([rare, tokens[frequent]])[: k * d + (k - 1) * (b + 1) + k]
    if (k - 1) * (d + b) + k > n - d:  # too few common tokens for k of them to be side by side in both
        single = mix(order[: d + 1])
    key = order[: len(order) - k + 1]
    for j in range(1, k):
        key = mix(key * _M1 + mix(order[j : len(order) - k + 1 + j] + _M2))
    return np.concatenate([single, key]), np.repeat([0, len(rare)], [len(single), len(key)]), np.concatenate([np.zeros(len(single) + 1, np.uint64), key[:-1]])


def sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, n, v (the class; null if the set is empty) and bins of every document. docs: doc_id, text and text_key."""
    schema = T.StructType([T.StructField("doc_id", _L), T.StructField("text_key", _L), T.StructField("n", _L), T.StructField("v", _L), T.StructField("bins", _B)])

    def build():
        shingler = Shingler(size)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = shingler(encoded(batch, "text"))
            names = iter(classes_of([s for s in found if len(s)]).tolist())
            columns = [pa.array([len(s) for s in found], pa.int64()), pa.array([next(names) if len(s) else None for s in found], pa.int64()), pa.array([bins_of(s) for s in found], pa.binary())]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *columns], names=schema.names)

        return apply

    return map_texts(docs, "text", schema, build, SLICE)


def _summed(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each name once, with the sum of its counts."""
    order = np.argsort(names, kind="stable")
    names, counts = names[order], counts[order]
    first = np.flatnonzero(np.r_[len(names) > 0, names[1:] != names[:-1]])
    return names[first], np.add.reduceat(counts, first) if len(first) else counts


def _dealt(names: np.ndarray, counts: np.ndarray, part: np.ndarray) -> tuple[list[int], list[bytes], list[bytes]]:
    """part, names and counts in packed arrays, a row for each part."""
    order = np.argsort(part, kind="stable")
    names, counts, part = names[order], np.minimum(counts[order], 2**32 - 1).astype(np.uint32), part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    split = zip(np.split(part, cuts), np.split(names, cuts), np.split(counts, cuts), strict=True) if len(names) else ()
    rows = [(int(p[0]), a.tobytes(), c.tobytes()) for p, a, c in split]
    return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [])


def _unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    names, counts = (np.concatenate([np.frombuffer(x, np.uint32) for x in group[c]]) for c in ("names", "counts"))
    return _summed(names, counts.astype(np.int64))


def frequent_names(docs: DataFrame, size: int, tokens: int) -> np.ndarray:
    """Names of the tokens in more than FREQUENT_FROM documents, the most frequent FREQUENT_MOST at most.

    Tasks count the tokens of COUNT_TOKENS at a time and deal names and counts out in packed arrays, so that a token in a
    third of all rows is one entry of each. The number of parts grows with the number of tokens, but a task deals to WIDE
    parts at most: groups of its rows, of bounded size, are summed and dealt on to the parts within each of these.
    """
    parts = max(8, -(-tokens // (2 * COUNT_TOKENS)))
    wide = min(parts, WIDE)
    inner = -(-parts // wide)
    schema = T.StructType([T.StructField("part", _L), T.StructField("names", _B), T.StructField("counts", _B)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, n = Shingler(size), [], 0

        def deal() -> pa.RecordBatch:
            names, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint32), return_counts=True)
            columns = _dealt(names, counts, names % np.uint32(wide))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=schema.names)

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                for s in shingler(encoded(piece, "text")):
                    held.append((s >> np.uint64(32)).astype(np.uint32))
                    n += len(s)
                if n > COUNT_TOKENS:
                    yield deal()
                    held, n = [], 0
        yield deal()
        held = []
        give_back()

    def deal_on(group: pd.DataFrame) -> pd.DataFrame:
        names, counts = _unpacked(group)
        columns = _dealt(names, counts, group["part"].iloc[0] + wide * (names // np.uint32(wide) % np.uint32(inner)).astype(np.int64))
        return pd.DataFrame(dict(zip(schema.names, columns, strict=True)))

    def add(group: pd.DataFrame) -> pd.DataFrame:
        names, counts = _unpacked(group)
        return pd.DataFrame({"name": names[counts > FREQUENT_FROM].astype(np.int64), "n": counts[counts > FREQUENT_FROM]})

    dealt = docs.mapInArrow(count, schema)
    if inner > 1:
        salts = max(1, tokens // (wide * 8 * COUNT_TOKENS))
        dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64("names"), F.lit(salts))).groupBy("part", "_salt").applyInPandas(deal_on, schema)
    counted = stored(dealt.groupBy("part").applyInPandas(add, "name long, n long"))
    # powers of two, from above, as long as all tokens of them fit
    levels = counted.groupBy(F.floor(F.log2("n") * 4).alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, held = None, 0
    for r in levels:
        held += r["n"]
        if held > FREQUENT_MOST:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.uint32)
    return counted.where(F.floor(F.log2("n") * 4) >= least).select("name").toPandas()["name"].to_numpy().astype(np.uint32)


def _entries(docs: DataFrame, size: int, share: int, names: np.ndarray) -> DataFrame:
    """key, v, m (n in the upper, r in the lower half) and p (see keys_of): the keys of every document's class."""
    schema = T.StructType([T.StructField(c, _L) for c in ("key", "v", "m", "p")])
    held = docs.sparkSession.sparkContext.broadcast(names)

    def build():
        shingler, frequent = Shingler(size), Frequent(held.value)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [s for s in shingler(encoded(batch, "text")) if len(s)]
            flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
            marks = np.split(frequent(flat), np.cumsum([len(s) for s in found])[:-1]) if found else []
            keys = [keys_of(s, m, share) for s, m in zip(found, marks, strict=True)]
            sizes = [len(k[0]) for k in keys]
            key, rare, before = (np.concatenate(x) for x in zip(*keys, strict=True)) if keys else [np.zeros(0, np.int64)] * 3
            columns = [key.view(np.int64), np.repeat(classes_of(found), sizes), np.repeat(np.array([len(s) for s in found], np.int64), sizes) << 32 | rare, before.view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.names)

        return apply

    return map_texts(docs, "text", schema, build, SLICE)


def _near(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """The pairs a, b that sizes and bins do not rule out."""
    bins = classes.select("v", "bins", "n")
    both = pairs.join(bins.select(F.col("v").alias("a"), F.col("bins").alias("x"), F.col("n").alias("na")), "a").join(bins.select(F.col("v").alias("b"), F.col("bins").alias("y"), F.col("n").alias("nb")), "b")

    def rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int32) for c in ("x", "y"))
            sizes = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            common = -(-share * sizes // (100 + share))
            keep = np.abs(x - y).sum(1) <= sizes - 2 * common
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return stored(both.select("a", "b", "x", "y", "na", "nb").mapInArrow(rule_out, "a long, b long"))


def _parities(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (v and others) with the parities of its classes' bins, 64 in each of the longs s0, s1 and so on.

    Two parities differ only where the counts do, full ones (255) included.
    """
    kept = wanted.columns
    schema = T.StructType([*wanted.schema.fields, *[T.StructField(f"s{i}", _L) for i in range(BINS // 64)]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
            packed = np.packbits(bins & 1, axis=1).view(np.int64)
            columns = [*[batch.column(c) for c in kept], *[pa.array(np.ascontiguousarray(c), pa.int64()) for c in packed.T]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return wanted.join(classes.select("v", "bins"), "v").select(*kept, "bins").mapInArrow(build, schema)


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """v and tokens of the classes in wanted (v), and of a few others, by one pass over the texts: the first row of a class stands for it.

    A few bits for each row that is wanted, up to 2^BLOOM_MOST of them, make a bounded filter, whose false hits do no harm.
    docs: text and row; classes: v and row.
    """
    rows = stored(wanted.join(classes, "v").select("row").distinct())
    bits_of_filter = min(BLOOM_MOST, max(BLOOM_LEAST, rows.count().bit_length() + 6))
    place = F.expr(f"shiftrightunsigned(row, {64 - bits_of_filter})")
    words = rows.groupBy(F.shiftright(place, 5).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(shiftrightunsigned(row, {64 - bits_of_filter}) & 31 as int))")).alias("bits")).toPandas()
    mask = np.zeros(1 << (bits_of_filter - 5), np.uint32)
    if len(words):
        mask[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    held = docs.sparkSession.sparkContext.broadcast(mask)
    schema = T.StructType([T.StructField("v", _L), T.StructField("tokens", _B)])

    def build():
        shingler = Shingler(size)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.column("row").to_numpy().view(np.uint64) >> np.uint64(64 - bits_of_filter)
            hit = (held.value[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
            found = [s for s in shingler(encoded(batch.filter(pa.array(hit.astype(bool))), "text")) if len(s)]
            sets_ = dict(zip(classes_of(found).tolist(), found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(sets_, pa.int64()), pa.array([s.tobytes() for s in sets_.values()], pa.binary())], names=schema.names)

        return apply

    out = stored(map_texts(docs.select("text", "row"), "text", schema, build, SLICE))
    discard(rows)
    again = stored(out.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v"))
    if again.isEmpty():
        return out
    few = F.broadcast(again) if again.limit(FEW_KEYS + 1).count() <= FEW_KEYS else again
    once = stored(out.join(few, "v", "left_anti").union(out.join(few, "v", "left_semi").groupBy("v").agg(F.first("tokens").alias("tokens"))))
    discard(out, again)
    return once


def _verified(near: DataFrame, tokens: DataFrame, share: int) -> DataFrame:
    """The pairs a, b whose whole sets link."""
    joined = near.join(tokens.select(F.col("v").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("v").alias("b"), F.col("tokens").alias("y")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= share * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        batch = x = y = None
        give_back()

    return stored(joined.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"))


def linked_classes(docs: DataFrame, classes: DataFrame, size: int, share: int) -> DataFrame:
    """v and c, the least class of its component, for each linked class. docs: text and row; classes: v, n, bins and row, a row that stands for it."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    entries = stored(_entries(docs, size, share, frequent_names(docs, size, total)))
    shared = stored(entries.groupBy("key").agg(F.min("v").alias("_a"), F.max("v").alias("_b")).where("_a <> _b").select("key"))
    # the keys of two classes or more; copies of a document have one row
    multi = stored(entries.select("key", "v", "m").join(shared, "key").groupBy("key", "v").agg(F.min("m").alias("m")))
    large = stored(multi.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > BUCKET))
    few = F.broadcast(large) if large.limit(FEW_KEYS + 1).count() <= FEW_KEYS else large
    cold = multi.join(few.select("key"), "key", "left_anti")
    hot = stored(entries.join(few, "key").groupBy("key", "v").agg(F.min("m").alias("m"), F.min("p").alias("p"), F.min("held").alias("held")))
    discard(entries, shared)
    # a class with combinations has all its rare tokens among its keys: two that link either share one, and are compared for that, or have all others in common at most
    n, r = (lambda m: F.shiftright(m, 32)), (lambda m: F.col(m).bitwiseAND(F.lit(0xFFFFFFFF)))
    common = F.least(n("ma") - r("ma"), n("mb") - r("mb"))
    fits = 100 * common >= share * (n("ma") + n("mb") - common)
    left = lambda d, *more: d.select("key", F.col("v").alias("a"), *[F.col(c).alias(f"{c}a") for c in ("m", *more)])
    right = lambda d, *more: d.select("key", F.col("v").alias("b"), *[F.col(c).alias(f"{c}b") for c in ("m", *more)])
    near = _near(left(cold).join(right(cold), "key").where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct(), classes, share)
    discard(multi)
    if near.isEmpty() and hot.isEmpty():
        return components(near)
    wanted = near.select(F.col("a").alias("v")).union(near.select(F.col("b").alias("v"))).union(hot.select("v")).distinct()
    tokens = _sets_of(docs, classes, wanted, size)
    linked = components(_verified(near, tokens, share))
    if hot.isEmpty():
        return linked
    # the class that is in the most large buckets is nearest to all in them: it leads first
    degree = hot.groupBy("v").agg(F.count("*").alias("_degree"))
    entries, hot = hot, stored(hot.join(_parities(classes, degree), "v"))
    discard(entries)
    # each class by its least key alone: near copies mostly share it, and a row for each class is enough to connect them
    one = hot.groupBy("v").agg(F.min(F.struct("key", "m")).alias("_k"), F.max("_degree").alias("_degree")).select("v", "_degree", "_k.*")
    heads = one.groupBy("key").agg(F.max_by(F.struct("v", "m"), F.struct("_degree", "v")).alias("_h")).select("key", F.col("_h.v").alias("a"), F.col("_h.m").alias("ma"))
    to = one.select("key", F.col("v").alias("b"), F.col("m").alias("mb")).join(heads, "key").where((F.col("a") != F.col("b")) & fits)
    tested = stored(to.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    new = _verified(_near(tested, classes, share), tokens, share)
    if not new.isEmpty():
        linked = components(linked.select(F.col("v").alias("a"), F.col("c").alias("b")).union(new))
    leaders = hot.groupBy("key").agg(F.max_by("v", F.struct("_degree", "v")).alias("a"))
    first, taken = True, 1
    largest = hot.agg(F.max("held")).first()[0]
    parts = [f"s{i}" for i in range(BINS // 64)]
    differ = sum((F.bit_count(F.col(f"{s}a").bitwiseXOR(F.col(f"{s}b"))) for s in parts), F.lit(0))
    fits &= (100 + share) * differ <= (100 - share) * (n("ma") + n("mb"))
    while True:
        # buckets of which all pairs were compared in the round before are done, even if they stay apart
        marked = hot.where(F.col("held") > taken // 16).join(linked, "v", "left").withColumn("c", F.coalesce("c", "v"))
        within = marked.groupBy("key", "c").agg(F.count("*").alias("_n")).groupBy("key").agg(F.max_by("c", F.struct("_n", "c")).alias("main"), F.count("*").alias("_n"))
        entries = marked.join(within.where("_n > 1").drop("_n"), "key")
        if first:
            entries = entries.join(leaders, "key").withColumn("leads", F.expr("v = a")).drop("a")
        else:  # where all would lead, of two components one at least is not the main one
            chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) * F.col("held") < F.lit(taken * (1 << 30)).cast("long")
            entries = entries.withColumn("leads", chosen & ((F.col("held") > taken) | (F.col("c") != F.col("main"))))
        entries = stored(entries.drop("main"))
        if entries.isEmpty():
            discard(entries)
            break
        # of the keys that a pair shares side by side, the first one stands for all; of two leaders, one is compared with the other
        once = ((F.col("pa") != F.col("pb")) | (F.col("pa") == 0)) & (~F.col("leadsb") | (F.col("a") < F.col("b")))
        to = left(entries.where("leads"), "p", "c", *parts).join(right(entries, "p", "c", "leads", *parts), "key").where((F.col("ca") != F.col("cb")) & once & fits)
        pairs = to.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"))
        tested, first = tested.union(pairs), False
        new = _verified(_near(pairs, classes, share), tokens, share)
        if not new.isEmpty():
            linked = components(linked.select(F.col("v").alias("a"), F.col("c").alias("b")).union(new))
        discard(entries)
        if taken >= largest:
            break
        taken *= 16
    discard(hot, tokens)
    return linked


def _classified(docs: DataFrame, size: int, share: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and of each class v its component_id, the `first` row of its component and the component's rows.

    first: whether doc_id is null, doc_id and text_key; the least of them.
    """
    bounded_batches(docs.sparkSession)
    with short_lived_shuffles(docs.sparkSession):
        return _classified_now(texts_of(docs).withColumn("text_key", text_key()), size, share)


def _classified_now(keyed: DataFrame, size: int, share: int) -> tuple[DataFrame, DataFrame]:
    all_ = stored(sets(keyed, size))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = stored(all_.where("v is not null").groupBy("v").agg(F.min("n").alias("n"), F.min("bins").alias("bins"), F.min("doc_id").alias("least"), F.min(first).alias("first"), F.count("*").alias("rows")))
    row = lambda of: F.xxhash64(f"{of}doc_id", f"{of}text_key")
    linked = linked_classes(keyed.select("text", row("").alias("row")), classes.select("v", "n", "bins", row("first.").alias("row")), size, share)
    named = classes.select("v", "least", "first", "rows").join(linked, "v", "left").withColumn("c", F.coalesce("c", "v"))
    of = named.groupBy("c").agg(F.min("least").alias("component_id"), F.min("first").alias("first"), F.sum("rows").alias("rows"))
    out = stored(named.select("v", "c").join(of, "c").select("v", "component_id", "first", "rows"))
    discard(classes)
    return all_, out


def text_key(column: str = "text") -> F.Column:
    """Tells the texts of rows with one doc_id apart."""
    return F.xxhash64(F.col(column).cast("string"))


def near_duplicates(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row. size: words of a shingle; share: percents of similarity that link."""
    all_, of = _classified(docs, size, share)
    found = all_.where("v is not null").join(of.select("v", "component_id"), "v").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.union(all_.where("v is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, share: int = 80) -> DataFrame:
    """docs without all rows but the first of each component, with all columns: that of the least doc_id (rows without one come last).

    Rows whose text has no word are in no component and stay. Only the ids and text keys of rows that go are joined with docs.
    """
    all_, of = _classified(docs, size, share)
    members = stored(all_.where("v is not null").join(of.where("rows > 1"), "v").select("doc_id", "text_key", (~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))).alias("goes")).groupBy("doc_id", "text_key").agg(F.max("goes").alias("goes"), F.count("*").alias("rows")))
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("m.doc_id")) & (text_key("d.text") == F.col("m.text_key"))
    join = lambda d, keys, how: d.alias("d").join(keys.select("doc_id", "text_key").alias("m"), same, how).select(*[F.col(f"d.`{c}`") for c in docs.columns])
    out = join(docs, members.where("goes"), "left_anti")
    again = members.where("not goes and rows > 1")
    if again.isEmpty():
        return out
    once = join(out, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return join(out, again, "left_anti").unionByName(once)
