"""Compression classifier: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks, so that a dictionary counts for as much in a long text as in a short one. Each block is
compressed with the dictionary of good text and with that of bad text. The normalised difference of the sums of sizes,
(bad - good) / (bad + good), is the only input of the score: a logistic curve of it, fitted on labelled texts that went
into no dictionary. Dictionaries are raw stretches of the labelled texts, as long for one label as for the other.

Defined cases: null and empty texts get the share of label 1 among the sampled texts; so does every text if fewer than
LEAST_TEXTS texts of a label can be learned from (0.5 without labels). Equal texts have equal scores, ties with the
threshold are kept. Very long texts are compressed block by block, whole. Repeated rows get a row each. Rows with a null
doc_id are scored and never learned from. An empty table gives an empty one. Other columns are left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._batches import crc_of_id, map_texts, strings, texts_of
from .sample import sample_texts

#: Bounds of the training sample: documents of each label, and characters taken of each, at a place that depends on its id.
SAMPLE_DOCS, SAMPLE_CHARS = 1536, 8192
DICTIONARY_BYTES, SNIPPET_BYTES, BLOCK_BYTES, LEVEL, LEAST_TEXTS = 262_144, 16, 256, 12, 4
_SCORE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def build_dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """Stretches of all texts in turn: the first of each, then the second of each, until size is reached. They are as long as lets every text take part."""
    encoded, out, held, turn = [t.encode("utf-8", "replace") for t in texts], [], 0, 0
    snippet = max(SNIPPET_BYTES, size // max(1, len(texts)))
    while held < size and any(len(t) > turn * snippet for t in encoded):
        for t in encoded:
            if part := t[turn * snippet : (turn + 1) * snippet]:
                out.append(part)
                held += len(part)
        turn += 1
    return b"\n".join(out)[:size]


def dictionaries(good: list[str], bad: list[str]) -> tuple[bytes, bytes]:
    """That of good and that of bad text, of one length."""
    size = min(DICTIONARY_BYTES, *(sum(len(t.encode("utf-8", "replace")) for t in texts) for texts in (good, bad)))
    return build_dictionary(good, size), build_dictionary(bad, size)


class Difference:
    """The normalised difference of a text's compressed sizes: above 0 if the dictionary of good text serves it better."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL, block: int = BLOCK_BYTES):
        plain = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
        self.block, self.compressors = block, []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=held, **plain))

    def __call__(self, text: str) -> float:
        data = text.encode("utf-8", "replace")
        good, bad = (sum(len(c.compress(data[i : i + self.block])) for i in range(0, len(data), self.block)) for c in self.compressors)
        return (bad - good) / (bad + good)


@dataclass(frozen=True)
class Model:
    """The dictionaries, and the logistic curve: score = 1 / (1 + exp(-(offset + slope * difference)))."""

    good: bytes
    bad: bytes
    offset: float
    slope: float
    prior: float

    def scorer(self):
        if not self.good or not self.bad:
            return lambda texts: np.full(len(texts), self.prior)
        difference = Difference(self.good, self.bad)

        def score(texts: list[str]) -> np.ndarray:
            out, at = np.full(len(texts), self.prior), [i for i, t in enumerate(texts) if t]
            d = np.array([difference(texts[i]) for i in at])
            out[at] = 1 / (1 + np.exp(-np.clip(self.offset + self.slope * d, -30, 30)))
            return out

        return score


def calibrated(d: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 60) -> tuple[float, float]:
    """Offset and slope of the logistic curve, by Newton's method on the differences in units of their spread."""
    mean, spread = d.mean(), d.std() + 1e-9
    z, w = np.column_stack([np.ones(len(d)), (d - mean) / spread]), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + ridge * len(d) * np.eye(2), z.T @ (p - y) + ridge * len(d) * w)
    return float(w[0] - w[1] * mean / spread), float(w[1] / spread)


def fit_texts(good: list[str], bad: list[str]) -> Model:
    """Every other text of each label makes its dictionary, the rest calibrate."""
    good, bad = [t for t in good if t], [t for t in bad if t]
    prior = len(good) / (len(good) + len(bad)) if good or bad else 0.5
    if len(good) < LEAST_TEXTS or len(bad) < LEAST_TEXTS:
        return Model(b"", b"", 0.0, 0.0, prior)
    of_good, of_bad = dictionaries(good[::2], bad[::2])
    difference = Difference(of_good, of_bad)
    d, y = np.array([difference(t) for t in good[1::2] + bad[1::2]]), np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    return Model(of_good, of_bad, *calibrated(d, y), prior)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from a bounded sample of the labelled documents; labels: doc_id and quality (1 good, 0 bad)."""
    keys = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("_quality"))
    found = sample_texts(keys, docs, "_quality", SAMPLE_DOCS, SAMPLE_CHARS)
    return fit_texts([t for q, _, t in found if q == 1], [t for q, _, t in found if q == 0])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row, from the whole text alone."""

    def build():
        scorer = model.scorer()
        return lambda b: pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scorer(strings(b, "text")), pa.float64())], names=["doc_id", "score"])

    return map_texts(texts_of(docs), "text", _SCORE, build)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs with a score of threshold or more, with all their columns, in one narrow step."""

    def build():
        scorer = model.scorer()
        return lambda b: b.filter(pa.array(scorer(strings(b, "text")) >= threshold))

    return map_texts(docs, "text", docs.schema, build)


def learnable(labels: DataFrame) -> DataFrame:
    """The labels outside the held-out third."""
    return labels.where(crc_of_id() % 3 != 1)
