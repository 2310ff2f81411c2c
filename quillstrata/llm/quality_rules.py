"""Distribution divergence: histograms of a text against those of its language, by Jensen-Shannon distance.

References are pooled over all documents of each lang: shares of character classes, and of the COMMON_WORDS most frequent
words with all others as one. A text's distance is that to the nearest language, so that a wrong or missing lang does no
harm. Fixed counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) make the base rule.

Minimum-length guards: below MIN_WORDS words the base rule fails; the word histogram counts from WORD_GUARD words on;
both limits give way by a SLACK / sqrt(words), as short texts stray by chance alone.

Defined cases: null and empty texts have zero counts and fail the base rule; with no language to compare with (no row has
a lang) the base rule alone decides. Very long texts are counted piece by piece, whole. Common words that tie go by their
bytes; a text at a limit is kept. Repeated rows get equal results, one row each. An empty table gives an empty one. Other
columns are left aside.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..sources.shared import discard, stored
from ._batches import bounded_batches, encoded, give_back, map_texts, slices, texts_of

MIN_WORDS, WORD_GUARD, COMMON_WORDS = 50, 80, 48
CLASS_LIMIT, CLASS_SLACK, WORD_LIMIT, WORD_SLACK = 0.20, 0.5, 0.30, 1.0
#: Words that a task counts before it hands the counts on.
FLUSH_WORDS = 150_000
#: Bytes of texts judged at once, and code points counted at once: each core has a worker, whose memory they bound.
SLICE, PIECE = 1 << 20, 1 << 20
#: Places that the words of one language are dealt to when the most frequent ones are looked for.
SALTS = 64

_SEPARATORS, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
CLASSES = ("lower", "upper", "letter", "digit", "space", "line", "stop", "symbol", "other")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("class_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType())])


def _class_of(ch: str) -> int:
    kind = unicodedata.category(ch)
    if ch == "\n":
        return CLASSES.index("line")
    if ch.isspace():
        return CLASSES.index("space")
    if ch in ".,;:!?'\"()-":
        return CLASSES.index("stop")
    named = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Lo": "letter", "Lm": "letter", "Mn": "letter", "Mc": "letter", "Nd": "digit"}
    return CLASSES.index(named.get(kind, "symbol" if kind[0] in "PS" else "other"))


_table: list[np.ndarray] = []


def kinds_of(text: bytes) -> np.ndarray:
    """How many code points of the text are of each class (rows) and are separators or symbols (columns 1 and 2), by pieces of bounded size."""
    if not _table:
        mark = {ord(c): 1 for c in _SEPARATORS} | {ord(c): 2 for c in _SYMBOLS}
        _table.append(np.array([3 * _class_of(chr(i)) + mark.get(i, 0) for i in range(0x110000)], np.uint8))
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(3 * len(CLASSES), np.int64)
    for at in range(0, len(points), PIECE):
        out += np.bincount(_table[0][points[at : at + PIECE]], minlength=len(out))
    return out.reshape(-1, 3)


def _sums(owner: np.ndarray, kind: np.ndarray, owners: int, kinds: int) -> np.ndarray:
    return np.bincount(owner * kinds + kind, minlength=owners * kinds).reshape(owners, kinds)


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(ids: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Of each text, the words that lie in a window of three words found twice or more in it. ids: of words, ascending by owner."""
    out = np.zeros(owners, np.int64)
    at = np.flatnonzero(owner[2:] == owner[:-2]) if len(ids) > 2 else np.zeros(0, np.int64)
    if not len(at):
        return out
    key = ids[at]
    for nxt in (ids[at + 1], ids[at + 2], owner[at]):
        key = np.unique(key * (int(nxt.max()) + 1) + nxt, return_inverse=True)[1]
    twice = at[np.bincount(key)[key] > 1]
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[twice + k] = True
    return np.bincount(owner[covered], minlength=owners)


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p, histograms, to the histogram q, 0 to 1."""
    p, q = p / np.maximum(p.sum(1, keepdims=True), 1e-300), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.maximum(0.0, d / 2))


@dataclass(frozen=True)
class Reference:
    """classes: counts by CLASSES; words: the common words and their counts; total: all words."""

    lang: str
    classes: tuple[int, ...]
    words: tuple[tuple[bytes, int], ...]
    total: int


class Judge:
    """Counts and verdicts of many texts at once."""

    def __init__(self, references: list[Reference]):
        self.classes = [np.array(r.classes, float) for r in references if sum(r.classes)]
        self.words = [([w for w, _ in r.words], np.array([n for _, n in r.words] + [r.total - sum(n for _, n in r.words)], float)) for r in references if r.total]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """COUNTS, base_failed, kept, class_distance and word_distance; the distances of a text without words are nan."""
        n, split = len(texts), [t.split() for t in texts]
        n_words = np.array([len(w) for w in split], np.int64)
        places = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
        ids = np.fromiter((places[w] for ws in split for w in ws), np.int64, int(n_words.sum()))
        owner = np.repeat(np.arange(n), n_words)
        kinds = np.array([kinds_of(t) for t in texts]).reshape(n, len(CLASSES), 3)
        have, marks = kinds.sum(2), kinds.sum(1)
        again = np.array([duplicate_lines(t) for t in texts], np.int64)
        repeated = repeated_words(ids, owner, n)
        failed = (n_words < MIN_WORDS) | (100 * repeated > 50 * n_words)
        by_class = np.full(n, np.inf) if self.classes else np.zeros(n)
        for q in self.classes:
            np.minimum(by_class, distances(have, q), out=by_class)
        by_word = np.full(n, np.inf) if self.words else np.zeros(n)
        for words, q in self.words:
            column = np.full(len(places) + 1, len(words), np.int64)
            for i, w in enumerate(words):
                column[places.get(w, -1)] = i if w in places else column[-1]
            np.minimum(by_word, distances(_sums(owner, column[ids], n, len(words) + 1), q), out=by_word)
        by_class[n_words == 0] = by_word[n_words == 0] = np.nan
        root = np.sqrt(np.maximum(n_words, 1))
        strays = (by_class > CLASS_LIMIT + CLASS_SLACK / root) | (n_words >= WORD_GUARD) & (by_word > WORD_LIMIT + WORD_SLACK / root)
        return [n_words, marks[:, 0] + marks[:, 2], marks[:, 2], again, repeated, failed, ~failed & ~strays, by_class, by_word]


_COUNTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.BinaryType()), T.StructField("class", T.IntegerType()), T.StructField("n", T.LongType())])


def fit(docs: DataFrame) -> list[Reference]:
    """References from all documents with a lang. Tasks hand on sums, added up by key with map-side combine; COMMON_WORDS + len(CLASSES) + 1 rows a language reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def hand_on() -> pa.RecordBatch:
            of = [(lang, c, len(c)) for lang, c in words.items()] + [(lang, None, len(CLASSES)) for lang in classes]
            columns = [
                pa.array([lang for lang, _, size in of for _ in range(size)], pa.string()),
                pa.array([w for _, c, size in of for w in (c or [None] * size)], pa.binary()),
                pa.array([k for _, c, size in of for k in ([None] * size if c else range(size))], pa.int32()),
                pa.array([*chain.from_iterable(c.values() for c in words.values()), *chain.from_iterable(c.tolist() for c in classes.values())], pa.int64()),
            ]
            words.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays(columns, names=_COUNTED.names)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                together: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), encoded(part, "text"), strict=True):
                    together.setdefault(lang, []).append(text)
                for lang, texts in together.items():
                    if split := b"\n".join(texts).split():
                        words.setdefault(lang, Counter()).update(split)
                    classes[lang] = classes.get(lang, 0) + sum(kinds_of(t).sum(1) for t in texts)
                if sum(map(len, words.values())) > FLUSH_WORDS:
                    yield hand_on()
        yield hand_on()
        give_back()

    bounded_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = known.mapInArrow(count, _COUNTED)
    sums = stored(counted.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")))
    words, most = sums.where("word is not null"), [F.desc("n"), F.col("word")]
    of_place = words.withColumn("_rank", F.row_number().over(W.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(SALTS))).orderBy(*most))).where(F.col("_rank") <= COMMON_WORDS)
    top = of_place.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy(*most))).where(F.col("_rank") <= COMMON_WORDS)
    totals = {r[0]: r[1] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    common: dict[str, list[tuple[bytes, int]]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["_rank"])):
        common.setdefault(r["lang"], []).append((bytes(r["word"]), r["n"]))
    classes: dict[str, dict[int, int]] = {}
    for r in sums.where("word is null").collect():
        classes.setdefault(r["lang"], {})[r["class"]] = r["n"]
    discard(sums)
    return [Reference(lang, tuple(classes.get(lang, {}).get(k, 0) for k in range(len(CLASSES))), tuple(common[lang]), totals[lang]) for lang in sorted(totals)]


def judge(docs: DataFrame, references: list[Reference]) -> DataFrame:
    """doc_id, the counts, base_failed, kept and both distances, for every row's whole text."""

    def build():
        judged = Judge(references)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = judged(encoded(batch, "text"))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, from_pandas=True) for c in columns)], names=_SCHEMA.names)

        return apply

    return map_texts(texts_of(docs), "text", _SCHEMA, build, SLICE)


def keep_judged(docs: DataFrame, references: list[Reference]) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns, in one narrow step."""

    def build():
        judged = Judge(references)
        return lambda b: b.filter(pa.array(judged(encoded(b, "text"))[6]))

    return map_texts(docs, "text", docs.schema, build, SLICE)
