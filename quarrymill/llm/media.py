"""Media columns: Netpbm and BMP images in binary columns, area-resized through integral images, cut to NPY tiles.

An image is decoded to a numpy array of 8-bit samples. A reduction to a few cells takes each cell's mean, fractions of
pixels included, from the integral image; that is summed block of rows by block of rows, and only the rows that cell
edges touch are kept, so that a long image needs little memory. Tiles are strips of the image, reduced to a square and
stored as NPY files, each with a difference hash.

Nulls count as empty content. Truncated or foreign bytes raise ValueError in the decoders, whatever they hold; `tiles`
leaves such media out, so that one bad file does not end a job.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, to_batch

UNIT = 576  # payload bytes come in multiples of this: rows of 24 samples, 24 rows
WIDTH = 24
STEP = 240  # rows of a tile


def encode_netpbm(image: np.ndarray) -> bytes:
    """P5 for a 2-D uint8 array, P6 for one with three channels."""
    height, width = image.shape[:2]
    kind = "P5" if image.ndim == 2 else "P6"
    return f"{kind}\n{width} {height}\n255\n".encode() + np.ascontiguousarray(image, np.uint8).tobytes()


def decode_netpbm(blob: bytes) -> np.ndarray:
    """P1 to P6, eight or sixteen bits; samples are scaled to 0..255 unless the maximum is 255 already."""
    head = re.match(rb"P([1-6])((?:\s+|#[^\n]*\n)*)", blob)
    if not head:
        raise ValueError("not Netpbm")
    kind, at, numbers = int(head[1]), head.end(), []
    need = 2 if kind in (1, 4) else 3
    token = re.compile(rb"(?:\s|#[^\n]*\n)*(\d{1,9})(?!\d)")
    while len(numbers) < need:
        found = token.match(blob, at)
        if not found:
            raise ValueError("bad Netpbm header")
        numbers.append(int(found[1]))
        at = found.end()
    width, height, top = numbers[0], numbers[1], numbers[2] if need == 3 else 1
    channels = 3 if kind in (3, 6) else 1
    count = width * height * channels
    stored = {1: count, 2: count, 3: count, 4: (width + 7) // 8 * height}.get(kind, count * (1 if top < 256 else 2))
    if not 0 < top < 65536 or not count or stored > len(blob) - at:
        raise ValueError("bad Netpbm sizes")
    if kind == 1:
        plain = re.sub(rb"#[^\n]*\n?|\s", b"", blob[at:])[:count]
        data = np.frombuffer(plain, np.uint8).astype(np.int64) - 48
    elif kind in (2, 3):
        words = re.sub(rb"#[^\n]*\n?", b" ", blob[at:]).split()[:count]
        if not all(len(w) < 10 and w.isdigit() for w in words):
            raise ValueError("bad Netpbm sample")
        data = np.array(words, np.int64)
    elif kind == 4:
        row = (width + 7) // 8
        packed = np.frombuffer(blob, np.uint8, row * height, at + 1).reshape(height, row)
        data = np.unpackbits(packed, axis=1)[:, :width].ravel().astype(np.int64)
    elif top < 256:
        data = np.frombuffer(blob, np.uint8, count, at + 1)
    else:
        data = np.frombuffer(blob, ">u2", count, at + 1).astype(np.int64)
    if len(data) < count:
        raise ValueError("short Netpbm data")
    if top != 255 and (data.min() < 0 or data.max() > top) or data.max() > 65535:
        raise ValueError("Netpbm sample beyond the maximum")
    if kind in (1, 4):
        data = (1 - data) * 255
    elif top != 255:
        data = data.astype(np.int64) * 255 // top
    elif data.max() > 255:
        raise ValueError("Netpbm sample beyond the maximum")
    return data.astype(np.uint8).reshape((height, width, 3) if channels == 3 else (height, width))


def encode_bmp(image: np.ndarray) -> bytes:
    """8-bit grey palette or 24-bit BMP, bottom-up rows padded to four bytes."""
    height, width = image.shape[:2]
    grey = image.ndim == 2
    pixels = image if grey else image[:, :, ::-1].reshape(height, width * 3)
    stride = -(-pixels.shape[1] // 4) * 4
    body = np.zeros((height, stride), np.uint8)
    body[:, : pixels.shape[1]] = pixels[::-1]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if grey else b""
    offset = 54 + len(palette)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if grey else 24, 0, body.size, 2835, 2835, 256 if grey else 0, 0)
    return struct.pack("<2sIHHI", b"BM", offset + body.size, 0, 0, offset) + info + palette + body.tobytes()


def decode_bmp(blob: bytes) -> np.ndarray:
    """Uncompressed 8-, 24- and 32-bit BMP, bottom-up or top-down; a grey palette gives a 2-D array."""
    if blob[:2] != b"BM" or len(blob) < 54:
        raise ValueError("not BMP")
    offset, head, width, height, _, depth, packing = struct.unpack_from("<I", blob, 10) + struct.unpack_from("<IiiHHI", blob, 14)
    if packing not in (0, 3) or depth not in (8, 24, 32):
        raise ValueError("unsupported BMP")
    rows, stride = abs(height), (width * depth + 31) // 32 * 4
    if width <= 0 or not rows or stride * rows > len(blob) - offset:
        raise ValueError("bad BMP sizes")
    body = np.frombuffer(blob, np.uint8, stride * rows, offset).reshape(rows, stride)
    body = body if height < 0 else body[::-1]
    if depth > 8:
        return np.ascontiguousarray(body[:, : width * depth // 8].reshape(rows, width, depth // 8)[:, :, 2::-1])
    colours = struct.unpack_from("<I", blob, 46)[0] or 256
    if colours > 256 or 14 + head + 4 * colours > len(blob):
        raise ValueError("bad BMP palette")
    palette = np.frombuffer(blob, np.uint8, 4 * colours, 14 + head).reshape(-1, 4)[:, 2::-1]
    full = np.zeros((256, 3), np.uint8)
    full[: len(palette)] = palette
    index = body[:, :width]
    if (full == full[:, :1]).all():
        return np.ascontiguousarray(full[:, 0][index])
    return full[index]


def decode(blob: bytes) -> np.ndarray:
    return decode_bmp(blob) if blob[:2] == b"BM" else decode_netpbm(blob)


def area_resizes(image: np.ndarray, sizes: list[tuple[int, int]], block: int = 1 << 14) -> list[np.ndarray]:
    """For each (height, width) the mean over each target cell, fractions of pixels included, from one pass of the
    integral image by blocks of rows; float64."""
    rows, columns = image.shape[:2]
    if not rows or not columns:
        return [np.zeros(size) for size in sizes]
    edges = [np.linspace(0, rows, height + 1) for height, _ in sizes]
    lows = [np.minimum(y.astype(np.int64), rows - 1) for y in edges]
    wanted = np.unique(np.concatenate([*lows, *(low + 1 for low in lows)]))  # rows of the integral image that are looked at
    integral, carry = np.zeros((len(wanted), columns)), np.zeros(columns)
    for at in range(0, rows, block):
        part = image[at : at + block]
        summed = np.cumsum(part if part.ndim == 2 else part.mean(axis=2), axis=0, dtype=np.float64) + carry
        here = (wanted > at) & (wanted <= at + len(part))
        integral[here] = summed[wanted[here] - at - 1]
        carry = summed[-1]
    out = []
    for (height, width), y, low in zip(sizes, edges, lows, strict=True):
        above, below = integral[np.searchsorted(wanted, low)], integral[np.searchsorted(wanted, low + 1)]
        part = np.cumsum(above + (below - above) * (y - low)[:, None], axis=1)
        part = np.hstack([np.zeros((height + 1, 1)), part])
        x = np.linspace(0, columns, width + 1)
        left = np.minimum(x.astype(np.int64), columns - 1)
        corner = part[:, left] + (part[:, left + 1] - part[:, left]) * (x - left)
        out.append(np.diff(np.diff(corner, axis=0), axis=1) * (height * width / (rows * columns)))
    return out


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    return area_resizes(image, [(height, width)])[0]


def hash_of(small: np.ndarray) -> int:
    """64 bits of a 9 x 8 reduction: is each cell brighter than its right neighbour?"""
    small = np.round(small, 6)
    return int.from_bytes(np.packbits(small[:, :-1] > small[:, 1:]).tobytes(), "big")


def npy_of(small: np.ndarray) -> bytes:
    """A reduction as the bytes of an NPY file of 8-bit samples."""
    out = io.BytesIO()
    np.save(out, np.clip(np.floor(np.round(small, 6) + 0.5), 0, 255).astype(np.uint8))
    return out.getvalue()


def tile_of(image: np.ndarray, side: int = 16) -> tuple[bytes, int]:
    """The NPY tile of an image, side x side samples, and its difference hash."""
    small, square = area_resizes(image, [(8, 9), (side, side)])
    return npy_of(square), hash_of(small)


def text_image(raw: bytes) -> np.ndarray:
    """Bytes as 8-bit samples, 24 to a row, filled up with 255 to a positive multiple of 576."""
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    return np.frombuffer(raw.ljust(size, b"\xff"), np.uint8).reshape(-1, WIDTH)


def media_features(docs: DataFrame, kind: str = "netpbm", side: int = 16, step: int = STEP) -> DataFrame:
    """Each text stored as an image (netpbm or bmp), decoded from the stored bytes, with checksums and features: doc_id,
    n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature (difference hash and checksum
    of the NPY tile of the whole image), and of its tiles, one for each `step` rows: n_tiles, tiles_sha256 (over the NPY
    files one after the other) and tile_hashes (their difference hashes, comma-joined).

    Null text counts as empty: one unit of filling. A null doc_id stays null; other columns of docs are left aside, so
    none can clash. Rows that repeat give equal results; an empty table gives an empty result. Texts of any length are
    stored whole. One pass over the rows, no shuffle; a task holds one document.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_tiles", pa.int64()), ("tiles_sha256", pa.string()), ("tile_hashes", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_bmp if kind == "bmp" else encode_netpbm
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True):
                media = encode(text_image(raw))
                image = decode(media)
                payload = image.tobytes()
                npy, dhash = tile_of(image, side)
                cut = [(npy, dhash)] if len(image) <= step else [tile_of(strip, side) for strip in strips(image, step)]
                feature = f"{dhash:016x}{hashlib.sha256(npy).hexdigest()[:16]}"
                rows.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(cut), hashlib.sha256(b"".join(t for t, _ in cut)).hexdigest(), ",".join(f"{h:016x}" for _, h in cut)))
            if rows:
                yield to_batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_tiles long, tiles_sha256 string, tile_hashes string")


def strips(image: np.ndarray, step: int = STEP) -> Iterator[np.ndarray]:
    for top in range(0, len(image), step):
        yield image[top : top + step]


def tiles(media: DataFrame, key: str, column: str, side: int = 16, step: int = STEP) -> DataFrame:
    """NPY tiles of images: key, tile (number), npy (bytes) and dhash for each strip of `step` rows.

    Undecodable, empty or null media give no tile; a null key stays null, and rows that repeat give equal tiles. The caller
    writes the rows wherever it likes (e.g. as Parquet), and `np.load` reads each of them.
    """
    schema = pa.schema([("key", pa.string()), ("tile", pa.int64()), ("npy", pa.binary()), ("dhash", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, blob in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True):
                try:
                    image = decode(blob)
                except ValueError:
                    continue
                for number, strip in enumerate(strips(image, step)):
                    npy, dhash = tile_of(strip, side)
                    rows.append((name, number, npy, f"{dhash:016x}"))
                if len(rows) > 5000:
                    yield to_batch(rows, schema)
                    rows = []
            if rows:
                yield to_batch(rows, schema)

    return media.select(F.col(key).cast("string").alias("key"), F.col(column).alias("media")).mapInArrow(run, "key string, tile long, npy binary, dhash string")


def media_column(docs: DataFrame, kind: str = "netpbm") -> DataFrame:
    """doc_id and media, the stored form of each text as netpbm or bmp, for writers and for `tiles`."""
    schema = pa.schema([("doc_id", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_bmp if kind == "bmp" else encode_netpbm
        for batch in batches:
            rows = [(i, encode(text_image(raw))) for i, raw in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True)]
            if rows:
                yield to_batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, media binary")
