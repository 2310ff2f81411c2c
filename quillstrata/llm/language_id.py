"""Cross-parsing entropy: a text belongs to the language whose labelled text parses it into the fewest phrases.

For each language a suffix automaton of labelled text yields, at every place of a new text, the longest match that
starts there. Parsing takes one longest match after another; phrases * log2(length of the labelled text) / characters
estimates the cross entropy in bits, and the least wins. Many stretches of text walk through all automata at once, one
numpy step a character. Every character of the training texts has a code: the moves of an automaton by the most frequent
characters of its language are a dense table, those by its other characters (of Chinese, say) are sorted keys.

Defined cases: `und` with score 0 if text is null, has no letter, or nothing could be learned; ties go to the first
language in code-point order. A text longer than STRETCH characters is parsed in stretches of that many, all of them,
and a phrase ends where a stretch ends, in all languages alike. Upper case is folded. Repeated rows get equal results; an
empty table gives an empty one; other columns are left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._batches import crc_of_id, map_texts, strings, texts_of
from .sample import sample_texts

#: Bounds of the training sample: documents of each language, characters taken of each, characters in each automaton.
SAMPLE_DOCS, SAMPLE_CHARS, TRAIN_CHARS = 256, 2048, 24_000
#: Columns of the dense tables: characters that the language's text lacks, and its most frequent ones; fewer where languages are so many that the tables would have more than DENSE_CELLS cells.
DENSE, DENSE_CELLS, STRETCH, SHARPNESS = 64, 32_000_000, 2048, 8.0
_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the states; state 0 is the start, and a walk from it spells exactly the substrings of codes."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def _dense(step: list[dict[int, int]], base: int, columns: dict[int, int], dense: int) -> np.ndarray:
    """Row per state: 4 * (place of the next state's row) + phrases that end. A failed match starts anew with the same character. columns: of the codes that have one; column 0 matches nothing."""
    table = np.empty((len(step), dense), np.int64)
    table[:] = 4 * base + 2
    for code, c in columns.items():
        table[:, c] = 4 * (base + step[0][code] * dense) + 1
    table[0, [c for c in range(dense) if c not in columns.values()]] = 4 * base + 1
    for s, moves in enumerate(step):
        for code, to in moves.items():
            if code in columns:
                table[s, columns[code]] = 4 * (base + to * dense)
    return table.ravel()


@dataclass(frozen=True)
class Model:
    """Training text of each language; the tables are built from it on the executors."""

    texts: tuple[tuple[str, str], ...]


class Parser:
    def __init__(self, model: Model):
        self.langs = [lang for lang, _ in model.texts]
        dense = self.dense = max(4, min(DENSE, DENSE_CELLS // max(1, 2 * sum(len(text) for _, text in model.texts))))
        known = sorted({ch for _, text in model.texts for ch in text} - {"\0"})
        self.codes = np.zeros(0x110000, np.int32)  # 0: in no training text
        for i, ch in enumerate(known):
            self.codes[ord(ch)] = i + 1
        between = self.width = len(known) + 1
        # by language and code: the dense column, and where a match that begins with a character outside the table leads
        self.column = np.zeros((len(model.texts), self.width), np.intp)
        self.first = np.zeros((len(model.texts), self.width), np.int64)
        tables, self.starts, base, keys, targets = [], [], 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (_, text) in enumerate(model.texts):
            points = self._points(text)
            walk = self.codes[points]
            walk[points == 0] = between  # two training texts meet
            counts = np.bincount(walk[points != 0], minlength=self.width)
            order = [int(c) for c in np.argsort(-counts, kind="stable") if counts[c]]
            columns = {c: i + 1 for i, c in enumerate(order[: dense - 1])}
            self.column[k, list(columns)] = list(columns.values())
            step = suffix_automaton(walk.tolist())
            tables.append(_dense(step, base, columns, dense))
            for c in order[dense - 1 :]:
                self.first[k, c] = 4 * (base + step[0][c] * dense)
            rare = [((base // dense + s) * self.width + c, 4 * (base + to * dense)) for s, moves in enumerate(step) for c, to in moves.items() if c != between and c not in columns]
            keys.append(np.array([x for x, _ in rare], np.int64))
            targets.append(np.array([x for _, x in rare], np.int64))
            self.starts.append(base)
            base += tables[-1].size
        self.table = np.concatenate([np.zeros(0, np.int64), *tables]).astype(np.int32 if 4 * base < 2**31 else np.int64)
        keys, targets = np.concatenate(keys), np.concatenate(targets)
        order = np.argsort(keys)
        self.keys, self.targets, self.rare = keys[order], targets[order], self.first.any(0)
        self.bits = np.array([np.log2(max(2, len(text))) for _, text in model.texts])

    def _moved(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The cells of table that states (a row for each language) come to by codes."""
        now = self.table[(state >> 2) + self.column[:, codes]]
        at = np.flatnonzero(self.rare[codes])
        if len(at):
            first, key = self.first[:, codes[at]], (state[:, at] >> 2).astype(np.int64) // self.dense * self.width + codes[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            own = np.where(self.keys[place] == key, self.targets[place], first + 1)
            now[:, at] = np.where(first > 0, own, now[:, at])
        return now

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits a character, for each text and language."""
        sizes = np.array([len(t) for t in texts])
        codes = self.codes[self._points("".join(texts))]
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, pieces) + turn * STRETCH
        length = np.minimum(STRETCH, sizes[owner] - turn * STRETCH)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        n, home = len(self.langs), np.array(self.starts)[:, None]
        state = np.repeat(4 * home, len(owner), 1).astype(self.table.dtype)
        phrases = np.zeros((n, len(owner)), np.int32)
        active = len(owner) - np.searchsorted(length[::-1], np.arange(1, (length[0] if len(length) else 0) + 1))
        for t, k in enumerate(active):
            now = self._moved(state[:, :k], codes[start[:k] + t])
            phrases[:, :k] += now & 3
            state[:, :k] = now
        phrases += (state >> 2) != home
        total = np.zeros((len(texts), n))
        np.add.at(total, owner, phrases.T)
        return total * self.bits / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.langs else []
        if at:
            h = self.entropies([texts[i].lower() for i in at])
            best = h.argmin(1)
            p = np.exp(-SHARPNESS * (h - h.min(1, keepdims=True)))
            scores[at] = 1 / p.sum(1)
            for i, b in zip(at, best.tolist(), strict=True):
                names[i] = self.langs[b]
        return names, scores


_parsers: dict[Model, Parser] = {}


def parser_of(model: Model) -> Parser:
    """One parser a worker process: the tables are built once, not in each task."""
    if model not in _parsers:
        _parsers.clear()
        _parsers[model] = Parser(model)
    return _parsers[model]


def fit_texts(samples: dict[str, list[str]]) -> Model:
    """As many characters of each text as makes TRAIN_CHARS together."""
    out = []
    for lang in sorted(samples):
        share = -(-TRAIN_CHARS // max(1, len(samples[lang])))
        text = "\0".join(t.lower()[:share] for t in samples[lang])
        if rest := TRAIN_CHARS - len(text):
            text += "".join("\0" + t.lower()[share : share + rest] for t in samples[lang][: 1 + rest // SAMPLE_CHARS] if rest > 0)
        out.append((lang, text[:TRAIN_CHARS]))
    return Model(tuple(x for x in out if has_letter(x[1])))


def fit(docs: DataFrame) -> Model:
    """Learns from a bounded sample of the documents with a lang, outside the held-out fifth."""
    keys = docs.where(F.col("lang").isNotNull() & (crc_of_id() % 5 != 0)).select("doc_id", F.col("lang").alias("_lang"))
    samples: dict[str, list[str]] = {}
    for lang, _, text in sample_texts(keys, docs, "_lang", SAMPLE_DOCS, SAMPLE_CHARS):
        samples.setdefault(lang, []).append(text)
    return fit_texts(samples)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row, from the whole text alone."""

    def build():
        parser = parser_of(model)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = parser.predict(strings(batch, "text"))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=_SCHEMA.names)

        return apply

    return map_texts(texts_of(docs), "text", _SCHEMA, build)
