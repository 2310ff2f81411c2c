"""Packing by Karmarkar-Karp multiway differencing.

Documents become ids and an end id. Whole windows are cut off the front; the rests are dealt at random into groups of
about GROUP_WINDOWS windows' worth. In a group every piece starts as a partial partition of its own; the two with the
largest imbalance are merged again and again, the largest parts of one on the smallest of the other, until one partition
into near-equal windows is left. If a window of it exceeds the capacity, the number of windows rises by one and the
group is partitioned anew. Every FILLER_EVERYth rest gives its last FILLERS to the differencing as pieces of their own,
which even out what whole documents cannot.

Defined cases: null and empty texts are the end id alone; repeated rows are packed once each; an empty table gives no
pieces; texts longer than a window span several; pieces that tie go by doc_id and start. Other columns are left aside. Words are kept for reuse up to KEPT_WORDS
a worker, then forgotten: a bound on memory, not on what is packed.
"""

from __future__ import annotations

import gc
import heapq
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import cut
from ._batches import encoded, map_texts, texts_of

CAPACITY, END_ID = 4096, 2
GROUP_WINDOWS, FILLER_EVERY, FILLERS, LEAST_FILLED = 512, 8, (64, 48, 32, 24, 16), 256
#: Words kept in a worker, and bytes of texts encoded at once.
KEPT_WORDS, SLICE = 1_200_000, 2 << 20
_MARKS = b".,;:!?*$%&#"
#: A last letter that stays one letter under the model's normal form and lower case: A-Z, and U+00C0 to U+00FF without two signs.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_LETTER_LAST = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")
_PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())])
_PACKED = T.StructType([*_PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def partition(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the windows, largest first, and the window of each piece."""
    n, pairs = len(sizes), []
    parts = {i: (np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    name = n
    while len(heap) > 1:
        a, b = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        (sums, nodes), (less, fewer) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
        if len(less) == 1 and len(sums) == windows:  # the smallest part grows and moves up
            at = int(np.searchsorted(-sums[:-1], -(grown := sums[-1] + less[0]), side="right"))
            pairs.append((int(nodes[-1]), int(fewer[0])))
            sums[at + 1 :], nodes[at + 1 :] = sums[at:-1].copy(), nodes[at:-1].copy()
            sums[at], nodes[at] = grown, n + len(pairs) - 1
            parts[name] = (sums, nodes)
            heapq.heappush(heap, (-int(sums[0] - sums[-1]), name))
            name += 1
            continue
        if len(sums) + len(less) <= windows:
            sums, nodes = np.concatenate([sums, less]), np.concatenate([nodes, fewer])
        else:
            sums, nodes = np.pad(sums, (0, windows - len(sums))), np.pad(nodes, (0, windows - len(nodes)), constant_values=-1)
            opposite = np.arange(windows - 1, windows - 1 - len(less), -1)
            both = nodes[opposite] >= 0
            joined = fewer.copy()
            joined[both] = n + len(pairs) + np.arange(both.sum())
            pairs += zip(nodes[opposite][both].tolist(), fewer[both].tolist(), strict=True)
            sums[opposite] += less
            nodes[opposite] = joined
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        parts[name] = (sums, nodes)
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == windows else 0)), name))
        name += 1
    sums, nodes = parts[heap[0][1]]
    window = np.empty(n + len(pairs), np.int64)
    window[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for k in range(len(pairs) - 1, -1, -1):
        window[list(pairs[k])] = window[n + k]
    return sums, window[:n]


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, none of them above the capacity."""
    if not sizes:
        return np.zeros(0, np.int64)
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, window = partition(sizes, count)
        if sums[0] <= capacity:
            return window
        count += 1


def cuts_of(n: int, filler: bool, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n ids."""
    rest = n % capacity
    out = [capacity] * (n // capacity)
    if filler and rest >= LEAST_FILLED:
        return [*out, rest - sum(FILLERS), *FILLERS]
    return [*out, rest] if rest else out


class Tokenizer:
    """Ids of texts as little-endian unsigned 32-bit integers. White space parts words, each encoded once by the library.

    The model lower-cases and never joins letters with marks: A-Z is folded first (unless a special token could be in the
    text), and the marks at a word's end are encoded apart from it.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library, self.kept = Library.from_file(path), kept
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[bytes]) -> None:
        """Words of letters alone go in one text each thousand: the model marks where a word ends. The others go one by one."""
        letters = [w for w in words if _LETTERS.fullmatch(w)]
        others = [w for w in words if not _LETTERS.fullmatch(w)]
        for at in range(0, len(letters), 1000):
            part = letters[at : at + 1000]
            ids = np.array(self.library.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(part):
                others += part
                continue
            flat, start = ids.tobytes(), 0
            for w, end in zip(part, ends, strict=True):
                self.known[w] = flat[start:end]
                start = end
        for at in range(0, len(others), 20_000):
            part = others[at : at + 20_000]
            for w, found in zip(part, self.library.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False), strict=True):
                self.known[w] = np.array(found.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        known, ends, whole = self.known, [], set()
        for w in words:
            stem = w.rstrip(_MARKS)
            if stem and len(stem) < len(w) and _LETTER_LAST.search(stem):
                ends.append((w, stem))
                whole.add(stem)
                whole.add(w[len(stem) :])
            else:
                whole.add(w)
        self._encode([w for w in whole if w not in known])
        for w, stem in ends:
            known[w] = known[stem] + known[w[len(stem) :]]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if len(self.known) > self.kept:
            self.known.clear()
        gc.disable()  # nothing here is cyclic, and a collection would walk all words
        try:
            if missing := set().union(*split).difference(self.known):
                self._learn(missing)
            return [b"".join(map(self.known.__getitem__, ws)) for ws in split]
        finally:
            gc.enable()


_tokenizers: dict[str, Tokenizer] = {}


def pieces(docs: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """The pieces of every document, in a narrow step. keep: whether a worker keeps the tokenizer and its words between its tasks, or has its memory back after each."""
    end = np.array([END_ID], "<u4").tobytes()

    def build():
        tokenizer = _tokenizers.get(path) or Tokenizer(path)
        if keep:
            _tokenizers[path] = tokenizer
        else:
            _tokenizers.pop(path, None)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer(encoded(batch, "text")), strict=True):
                ids, at = memoryview(ids + end), 0
                n = len(ids) // 4
                for length in cuts_of(n, zlib.crc32(b"%d" % (doc_id or 0)) % FILLER_EVERY == 0):
                    rows.append((doc_id, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n))
                    at += length
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_PIECES.names)

        return apply

    return map_texts(texts_of(docs), "text", _PIECES, build, SLICE)


def pack(docs: DataFrame, path: str, keep: bool = True) -> DataFrame:
    """Pieces with sequence_id and offset. Groups are of bounded size, dealt by a hash of document, start and place in the table."""
    found = cut(pieces(docs, path, keep))
    total = found.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (GROUP_WINDOWS * CAPACITY)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable", ignore_index=True)
        whole = int((group["length"] == CAPACITY).sum())
        window = np.concatenate([np.arange(whole), whole + windows_of(group["length"].tolist()[whole:])])
        group["sequence_id"] = group["_group"].astype("int64") * (1 << 32) + window
        group = group.iloc[np.argsort(window, kind="stable")]
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group[_PACKED.names]

    # the place in the table parts rows that have one id, or none
    group = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups))
    return found.withColumn("_group", group).groupBy("_group").applyInPandas(place, _PACKED)
