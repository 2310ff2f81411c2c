"""SentencePiece encoding and decoding by vectorised merge rounds (see bpe.py).

The model file is read by its own wire format; the sentencepiece library takes no part (tests compare with it). Blanks
become U+2581, one more is put in front, and no piece crosses into a run of them, so that the text falls into words that
are encoded each on its own and kept for reuse. Characters without a piece become the byte pieces of their UTF-8 form.
Pieces of blanks alone share one rank, below all others: what is left of a run of blanks is joined from the left.

Defined cases: null and empty texts have no ids and decode to the empty text. Repeated rows get equal results; other
columns are left aside. Words are kept up to KEPT_WORDS a worker, then forgotten: a bound on memory, not on what is encoded.
Of pairs of one rank the leftmost is merged first. A very long word has rounds of its own (bpe.py). An empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._batches import encoded, map_texts, texts_of
from .bpe import MergeTable

KEPT_WORDS, AT_ONCE = 500_000, 8192
_BLANK, _WORD = "▁", re.compile(rb" +[^ ]*")
_NORMAL, _BYTE = 1, 6
_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message: bytes for nested values, an integer or four raw bytes else."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        if (kind := tag & 7) == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        scores, kinds = [], []
        trainer: dict = {}
        normal_form: dict = {}
        for number, value in _fields(data):
            if number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal_form = dict(_fields(value))
            elif number == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                scores.append(float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(own.get(3, _NORMAL))
        # what this encoder does not do is refused: other kinds of model, character maps, pieces of users, blanks at the end
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or normal_form.get(2) or not normal_form.get(3, 1) or normal_form.get(4, 1) or not normal_form.get(5, 1) or not {1, 2, 3, _BYTE} >= set(kinds):
            raise ValueError("only BPE models that leave the text as it is, put a blank in front, and have no pieces of users")
        size = len(self.pieces)
        normal = [i for i in range(size) if kinds[i] == _NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if kinds[i] == _BYTE}
        if len(self.bytes) != 256 or any("\n" in p or _BLANK in p.lstrip(_BLANK) for p in self.ids):
            raise ValueError("the model needs byte pieces, and pieces with blanks at their start alone")
        self.blanks = {len(p) for p in self.ids if not p.strip(_BLANK)}
        order = {s: k for k, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        pairs = []
        for p, i in self.ids.items():
            if len(p) > 1 and p.strip(_BLANK):
                pairs += [(left, right, order[scores[i]], i) for k in range(1, len(p)) if (left := self.ids.get(p[:k])) is not None and (right := self.ids.get(p[k:])) is not None]
        self.table = MergeTable(size, pairs)
        self.raw = [bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k != _NORMAL else p.replace(_BLANK, " ").encode() for p, k in zip(self.pieces, kinds, strict=True)]
        self.decimal = [b"%d," % i for i in range(size)]
        self._flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self._size = np.array([len(x) for x in self.raw])
        self._start = np.cumsum(self._size) - self._size
        self._runs: dict[int, list[int]] = {}

    def _run(self, n: int) -> list[int]:
        """Lengths of the pieces of n blanks: again and again the leftmost pair that makes a piece is joined."""
        if n not in self._runs:
            # never more than a bounded stretch is open: what is as long as the longest piece stays as it is
            out: list[int] = []
            open_, left, top = [], n, max(self.blanks | {1})
            while left or open_:
                while left and len(open_) < 4 * top:
                    open_.append(1)
                    left -= 1
                while (k := next((k for k in range(len(open_) - 1) if open_[k] + open_[k + 1] in self.blanks), None)) is not None:
                    open_[k : k + 2] = [open_[k] + open_[k + 1]]
                    if open_[0] == top:
                        break
                if open_[0] == top or not left:
                    out.append(open_.pop(0))
                    if not left and not any(open_[k] + open_[k + 1] in self.blanks for k in range(len(open_) - 1)):
                        out += open_
                        open_ = []
            self._runs[n] = out
        return self._runs[n]

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has. A word: a run of blanks (U+2581) and what follows up to the next."""
        size, other = len(self.pieces), {}
        flat = "".join(words)
        chars = {c: self.ids.get(c, -1) for c in set(flat)}
        for c, i in chars.items():
            if i < 0 and ord(c) < 128:
                chars[c] = self.bytes[ord(c)]
            elif i < 0:
                chars[c] = size + len(other)
                other[chars[c]] = [self.bytes[b] for b in c.encode()]
        symbols = np.fromiter(map(chars.__getitem__, flat), np.int32, len(flat))
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbols, word = self.table.merge(symbols, word)
        blank = symbols == self.ids[_BLANK]
        if other or (blank[1:] & blank[:-1] & (word[1:] == word[:-1])).any():
            symbols, word = self._finish(symbols, word, other)
        return symbols, np.bincount(word, minlength=len(words))

    def _finish(self, symbols: np.ndarray, word: np.ndarray, other: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of unknown characters, and pieces of runs of blanks."""
        blank, out, of = self.ids[_BLANK], [], []
        runs = np.flatnonzero(np.r_[True, (symbols[1:] != symbols[:-1]) | (symbols[1:] != blank) | (word[1:] != word[:-1])])
        for at, end in zip(runs.tolist(), np.r_[runs[1:], len(symbols)].tolist(), strict=True):
            s = int(symbols[at])
            new = other[s] if s in other else [self.ids[_BLANK * k] for k in self._run(end - at)] if end - at > 1 else [s]
            out += new
            of += [int(word[at])] * len(new)
        return np.array(out, np.int32), np.array(of)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8: the pieces' bytes by gather; the blank in front is taken off, broken bytes become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        size = self._size[ids]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self._start[ids], size)
        out = self._flat[place].tobytes()
        if len(ids) and self.pieces[int(ids[0])].startswith(_BLANK):
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:
            out = b"".join("�".encode() if 0xDC80 <= ord(c) <= 0xDCFF else c.encode() for c in out.decode("utf-8", "surrogateescape"))
        return out


class Encoder:
    """Texts to ids, with the words seen so far."""

    def __init__(self, model: Model, kept: int = KEPT_WORDS):
        self.model, self.kept = model, kept
        self.known: dict[bytes, tuple[bytes, bytes]] = {}  # ids in decimal with a comma after each, and as 32-bit integers

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        """Words without their blank. One that starts with a line break has none, one that starts with a blank is given whole."""
        text = b" " + text.replace(_BLANK.encode(), b" ")
        cut = text.replace(b"\n", b" \n")
        if b"  " in cut:
            return [w if w[1:2] in (b" ", b"\n") else w[1:] for w in _WORD.findall(text)]
        return cut.split(b" ")[1:]

    def _learn(self, words: list[bytes]) -> None:
        if len(self.known) + len(words) > self.kept:
            self.known.clear()
        for at in range(0, len(words), AT_ONCE):
            part = words[at : at + AT_ONCE]
            full = b"\0".join([w if w[:1] in (b"\n", b" ") else b" " + w for w in part]).decode().replace(" ", _BLANK).split("\0")
            ids, size = self.model.encode_flat(full if len(full) == len(part) else [(w if w[:1] in (b"\n", b" ") else b" " + w).decode().replace(" ", _BLANK) for w in part])
            decimal, flat, at_id = [self.model.decimal[i] for i in ids.tolist()], ids.astype(np.int32).tobytes(), 0
            for w, n in zip(part, size.tolist(), strict=True):
                self.known[w] = (b"".join(decimal[at_id : at_id + n]), flat[4 * at_id : 4 * (at_id + n)])
                at_id += n

    def __call__(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Of each text its ids, in decimal with commas between them, and the text that decode() makes of them."""
        split = [self.words(t) if t else [] for t in texts]
        missing = [w for w in dict.fromkeys(w for ws in split for w in ws) if w not in self.known]
        if len(self.known) + len(missing) > self.kept:
            self.known.clear()
            missing = list(dict.fromkeys(w for ws in split for w in ws))
        self._learn(missing)
        out = []
        for ws in split:
            found = [self.known[w] for w in ws]
            out.append((b"".join([f[0] for f in found])[:-1], self.model.decode(np.frombuffer(b"".join([f[1] for f in found]), np.int32))))
        return out


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder a worker process and model file."""
    if path not in _encoders:
        _encoders[path] = Encoder(Model(path))
    return _encoders[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, digest of the ids, and digest of the text that they decode to, of every whole text."""

    def build():
        encoder = encoder_of(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = encoder(encoded(batch, "text"))
            columns = [
                pa.array([ids.count(b",") + 1 if ids else 0 for ids, _ in found], pa.int64()),
                pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in found], pa.string()),
                pa.array([hashlib.sha256(text).hexdigest() for _, text in found], pa.string()),
            ]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=_SCHEMA.names)

        return apply

    return map_texts(texts_of(docs), "text", _SCHEMA, build)


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, the real output, for use by other jobs."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def build():
        encoder = encoder_of(path)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [list(map(int, x.split(b","))) if x else [] for x, _ in encoder(encoded(batch, "text"))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

        return apply

    return map_texts(texts_of(docs), "text", schema, build)


def decode_ids(encoded_ids: DataFrame, path: str) -> DataFrame:
    """doc_id and text of doc_id and ids."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def build(batches):
        model = encoder_of(path).model
        for batch in batches:
            texts = [model.decode(np.array(ids or [], np.int64)).decode() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=schema.names)

    return encoded_ids.select("doc_id", "ids").mapInArrow(build, schema)
