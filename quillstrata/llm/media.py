"""Media columns: Netpbm and BMP images as numpy arrays, area-resized by integral images, stored as NPY tiles with difference hashes.

decode() reads PBM, PGM and PPM, plain and raw, with 8- or 16-bit samples, and uncompressed 24- and 32-bit BMP.
tiles() decodes a binary column, stores each image as an NPY tile, reads the tile back and hashes what it read.
text_tiles() does the same with texts: their UTF-8 bytes, padded with blanks to a multiple of 192, are the samples of an
image 8 pixels wide (8 * 8 * 3 = 192), stored without loss.

Defined cases: a null text is an empty one, of 192 blanks; a null or unreadable image has null columns and its reason in
`error`. Samples of another largest value than 255 or 65535 are scaled to the whole range. Equal inputs give equal rows;
repeated rows stay; neighbours of equal brightness have the bit 0. A very long text is one tall image. An empty table
gives an empty one. Other columns are left aside.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._batches import encoded, map_texts, texts_of

UNIT, WIDTH = 192, 8
#: Side of the grid behind a difference hash: HASH x HASH bits from HASH x (HASH + 1) means.
HASH = 8
_HEADER = re.compile(rb"P([1-6])(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)")
_TEXT_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("tile", T.BinaryType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType())])
_TILE_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("channels", T.IntegerType()), T.StructField("tile", T.BinaryType()), T.StructField("dhash", T.StringType()), T.StructField("error", T.StringType())])


class MediaError(ValueError):
    """An image that can't be read."""


def _netpbm(data: bytes) -> np.ndarray:
    head = _HEADER.match(data)
    if not head:
        raise MediaError("no netpbm header")
    kind, width, height, at, top = int(head[1]), int(head[2]), int(head[3]), head.end(), 1
    if kind not in (1, 4):
        more = re.compile(rb"(?:\s|#[^\n]*\n)+(\d+)").match(data, at)
        if not more:
            raise MediaError("no largest value")
        top, at = int(more[1]), more.end()
    channels = 3 if kind in (3, 6) else 1
    n = width * height * channels
    if not n or not 0 < top < 65536:
        raise MediaError("empty image or bad largest value")
    if kind == 1:
        values = np.array([x == 49 for x in re.sub(rb"#[^\n]*\n|\s", b"", data[at:])], np.uint8)
    elif kind in (2, 3):
        values = np.array([min(int(x), 1 << 32) for x in re.sub(rb"#[^\n]*\n", b"", data[at:]).split()[:n]], np.int64)
    elif kind == 4:
        row = -(-width // 8)
        values = np.unpackbits(np.frombuffer(data, np.uint8, -1, at + 1)[: row * height])
        if len(values) < row * 8 * height:
            raise MediaError("too few samples")
        values = values.reshape(height, row * 8)[:, :width].ravel()
    else:
        values = np.frombuffer(data, np.uint8, -1, at + 1) if top < 256 else np.frombuffer(data[at + 1 : at + 1 + 2 * n], ">u2").astype(np.uint16)
    if len(values) < n:
        raise MediaError("too few samples")
    values = values[:n].reshape((height, width, channels))
    if kind in (1, 4):
        return (1 - values) * np.uint8(255)
    full, sample = (255, np.uint8) if top < 256 else (65535, np.uint16)
    if top == full and kind in (5, 6):
        return values
    if not 0 <= values.min() <= values.max() <= top:
        raise MediaError("a sample above the largest value")
    return ((values.astype(np.int64) * full * 2 + top) // (2 * top)).astype(sample)  # the whole range, rounded


def _bmp(data: bytes) -> np.ndarray:
    number = lambda at, size, signed=False: int.from_bytes(data[at : at + size], "little", signed=signed)
    if len(data) < 54 or number(30, 4) not in (0, 3) or number(28, 2) not in (24, 32):
        raise MediaError("only uncompressed 24- and 32-bit BMP")
    if number(30, 4) == 3 and [number(54 + 4 * k, 4) for k in range(3)] != [0xFF0000, 0xFF00, 0xFF]:
        raise MediaError("unusual bit fields")
    start, width, height, channels = number(10, 4), number(18, 4, True), number(22, 4, True), number(28, 2) // 8
    row = (width * channels + 3) // 4 * 4
    if width <= 0 or not height or len(data) < start + row * abs(height):
        raise MediaError("too few samples")
    rows = np.frombuffer(data, np.uint8, row * abs(height), start).reshape(abs(height), row)[:, : width * channels].reshape(abs(height), width, channels)
    return (rows[::-1] if height > 0 else rows)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    """Height x width x channels."""
    return _bmp(data) if data[:2] == b"BM" else _netpbm(data)


def encode_ppm(image: np.ndarray) -> bytes:
    return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def write_npy(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(image), (1, 0), allow_pickle=False)
    return out.getvalue()


def read_npy(tile: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(tile), allow_pickle=False)


def _rows_at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows of an integral image at fractional places, between two rows by their shares."""
    low = np.minimum(places.astype(np.int64), table.shape[0] - 1)
    high = np.minimum(low + 1, table.shape[0] - 1)
    share = (places - low).reshape(-1, *[1] * (table.ndim - 1))
    return table[low] * (1 - share) + table[high] * share


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each target pixel covers, by four corners of the integral image."""
    high, wide = image.shape[:2]
    table = np.zeros((high + 1, wide + 1, image.shape[2]), np.int64)
    np.cumsum(image, 0, dtype=np.int64, out=table[1:, 1:])
    np.cumsum(table, 1, out=table)
    rows = _rows_at(table, np.arange(height + 1) * (high / height))
    corners = _rows_at(rows.swapaxes(0, 1), np.arange(width + 1) * (wide / width)).swapaxes(0, 1)
    return np.diff(np.diff(corners, axis=0), axis=1) / (high / height * wide / width)


def difference_hash(image: np.ndarray) -> str:
    """Whether each mean brightness is above its left neighbour's, as hexadecimal digits."""
    grey = area_resize(image, HASH, HASH + 1).mean(2)
    return np.packbits(np.round(np.diff(grey, axis=1), 6) > 0).tobytes().hex()


def payload_of(data: bytes) -> bytes:
    return data + b" " * (-len(data) % UNIT or (0 if data else UNIT))


def store_text(data: bytes) -> bytes:
    """The payload as a PPM image, decoded and written as an NPY tile."""
    payload = payload_of(data)
    source = b"P6\n%d %d\n255\n" % (WIDTH, len(payload) // (3 * WIDTH)) + payload
    return write_npy(decode(source))


def text_tiles(docs: DataFrame, keep_tile: bool = True) -> DataFrame:
    """A tile of each whole text, and digests of what is read back from it. Without keep_tile the tile itself is left out."""
    fields = [f for f in _TEXT_SCHEMA.fields if keep_tile or f.name != "tile"]

    def build():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for data in encoded(batch, "text"):
                tile = store_text(data)
                image = read_npy(tile)
                payload = image.tobytes()
                row = (len(data), tile, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(tile), hashlib.sha256(tile).hexdigest(), difference_hash(image))
                rows.append(row if keep_tile else row[:1] + row[2:])
            columns = list(zip(*rows, strict=True)) or [[] for _ in fields[1:]]
            kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, fields[1:], strict=True))], names=[f.name for f in fields])

        return apply

    return map_texts(texts_of(docs), "text", T.StructType(fields), build)


def tiles(images: DataFrame, id_column: str, data_column: str, height: int | None = None, width: int | None = None) -> DataFrame:
    """id, size, NPY tile and difference hash of each image; with height and width the tile holds the image resized to them."""

    def one(data: bytes) -> tuple:
        try:
            image = decode(data)
            if height and width:
                image = np.clip(np.round(area_resize(image, height, width)), 0, 65535).astype(image.dtype)
            tile = write_npy(image)
            return (*map(int, image.shape), tile, difference_hash(read_npy(tile)), None)
        except (ValueError, OverflowError, MemoryError) as e:
            return (None, None, None, None, None, str(e)[:200])

    def build():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = list(zip(*map(one, encoded(batch, "data")), strict=True)) or [[] for _ in range(6)]
            kinds = [pa.int32()] * 3 + [pa.binary(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=_TILE_SCHEMA.names)

        return apply

    return map_texts(images.select(F.col(id_column).cast("long").alias("id"), F.col(data_column).cast("binary").alias("data")), "data", _TILE_SCHEMA, build)
