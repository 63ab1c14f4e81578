"""Substring dedup by suffix order: each byte of a 200-byte string that also starts elsewhere is removed.

1. Winnowing deals the work, once: of the 32-byte grams in a 200-byte window, the one with the smallest hash (the first of
   equal ones) is the window's anchor. Equal windows have equal anchors at equal places, so windows only need to meet
   others of their anchor. Consecutive windows with one anchor form a run; runs of an anchor that occurs once have no
   partner and go.
2. Runs with equal anchor and equal bytes as a whole repeat in full, which a count tells. What is left are runs that
   share an anchor but differ somewhere, such as the borders of repeated passages, one representative per different run.
3. Around the anchor, each of these is trimmed to what it can share with any other: the longest common extensions to
   either side, found by sorting. Equal remainders repeat in full. The other remainders meet in a collection
   Burrows-Wheeler transform built column by column: every round inserts one symbol of each string, from the last to the
   first, and updates the transform and the table of common prefixes. Suffixes of 200 bytes or more whose common prefix
   with a neighbour has 200 bytes or more start repeated windows.
4. An anchor with more than `HOT` different runs is not brought to one task; its windows are counted by digest instead,
   which partial aggregation spreads. Results are the same either way; a test forces both.

The transform's columns are arrays that each round reads and writes front to back, held in memory for one batch of
strings: a task may not keep files of its own on an executor, and over the shared folder each round would be a job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, drop, materialise, row_key, to_batch

LENGTH = 200
GRAM = 32
HOT = 4096  # different runs of an anchor that still meet in one task; their transform takes about 100 MB
BATCH = 384  # strings in one transform; whole anchors only, so it may be exceeded by one anchor's runs
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the `gram` bytes that start at each position; gram is a power of two."""
    value, span = (data.astype(np.uint64) + np.uint64(1)) * MULTIPLIER, 1
    while span < gram:
        value = value[: len(value) - span] * np.uint64(0xD6E8FEB86659FD93) + (value[span:] ^ (value[span:] >> np.uint64(29)))
        span *= 2
    value ^= value >> np.uint64(32)
    value *= MULTIPLIER
    return value ^ (value >> np.uint64(29))


def runs(raw: bytes, length: int = LENGTH, gram: int = GRAM, block: int = 1 << 19) -> tuple[np.ndarray, ...]:
    """Anchor hash, first and last window start, and anchor start of each run of windows of raw, by blocks of windows."""
    windows = len(raw) - length + 1
    out: list[tuple[np.ndarray, ...]] = []
    for low in range(0, max(0, windows), block):
        many = min(block, windows - low)
        data = np.frombuffer(raw, np.uint8, many + length - 1, low)
        hashes = gram_hashes(data, gram)
        least = (hashes >> np.uint64(20) << np.uint64(20)) | np.arange(len(hashes), dtype=np.uint64)
        span, most = 1, length - gram + 1
        while span < most:
            step = min(span, most - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(first[1:], many) - 1
        out.append((hashes[anchor[first]].view(np.int64), first + low, last + low, anchor[first] + low))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Collection BWT of texts with common prefixes: symbols, common prefix with the suffix before, text, start.

    Symbols are 1 + byte, and 0 where a suffix is a whole text. Equal suffixes of different texts are in the order of
    the texts, and each text ends in an end mark of its own that is smaller than any byte and never counts as common.
    Round j inserts the suffixes of length j: a suffix c + s follows all smaller symbols and the suffixes with c before
    s, whose number is a rank in the transform so far; its common prefixes are one more than the least common prefix
    between s and the nearest suffixes before and after it that c precedes. Each round reads and writes the columns
    front to back once.
    """
    size = np.array([len(t) for t in texts], np.int64)
    m, flat = len(texts), np.frombuffer(b"".join(texts), np.uint8)
    alphabet = np.unique(flat)
    code = np.zeros(256, np.uint16 if len(alphabet) > 255 else np.uint8)
    code[alphabet] = np.arange(1, len(alphabet) + 1)
    flat, base = code[flat], np.cumsum(size + 1) - size - 1  # a suffix's number is base + start
    first = np.cumsum(size) - size
    symbol, has = np.zeros(m, code.dtype), size > 0
    symbol[has] = flat[first[has] + size[has] - 1]  # before the empty suffix of each text stands its last symbol
    common, number = np.zeros(m, np.int32), (base + size).astype(np.int64)
    new, owner = np.arange(m), np.arange(m)  # places and texts of the suffixes inserted last
    for j in range(1, int(size.max(initial=0)) + 1):
        going = size[owner] >= j
        new, owner = new[going], owner[going]
        by_symbol = np.argsort(symbol, kind="stable")
        mapped = by_symbol[len(symbol) - np.count_nonzero(symbol) :]  # suffixes in the order of their extensions
        flag = np.zeros(len(symbol), bool)
        flag[new] = True
        fresh = flag[mapped]
        old, places = ~fresh, np.flatnonzero(fresh)
        who = np.zeros(len(symbol), np.int64)
        who[new] = owner
        owner = who[mapped[places]]
        # common prefixes with the suffix before, for the inserted and for those right after them
        touched = np.zeros(len(mapped) + 1, bool)
        touched[places] = touched[places + 1] = True
        touched = np.flatnonzero(touched[:-1])
        here, before = mapped[touched], mapped[touched - 1]
        same = (symbol[here] == symbol[before]) & (touched > 0)
        value = np.zeros(len(touched), np.int32)
        if same.any():
            cuts = np.stack([before[same] + 1, here[same] + 1], axis=1).ravel()
            value[same] = 1 + np.minimum.reduceat(np.append(common, np.int32(0)), cuts)[::2]

        def wider(column: np.ndarray, inserted: np.ndarray) -> np.ndarray:
            out = np.empty(m + len(mapped), column.dtype)
            out[:m] = column[:m]
            tail = out[m:]
            tail[old] = column[m:]
            tail[places] = inserted
            return out

        left = size[owner] - j
        common = wider(common, 0)
        common[touched + m] = value
        number = wider(number, base[owner] + left)
        symbol = wider(symbol, np.where(left > 0, flat[np.maximum(first[owner] + left - 1, 0)], 0))
        new = places + m
    text = np.searchsorted(base, number, side="right") - 1
    return np.where(symbol > 0, np.append(alphabet, 0)[symbol.astype(np.int64) - 1].astype(np.int16) + 1, 0), common, text, number - base[text]


def repeated_starts(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text the sorted starts of substrings of `length` bytes that start at another place as well."""
    size = np.array([len(t) for t in texts], np.int64)
    _, common, text, start = transform(texts)
    long = common >= length
    hit = long.copy()
    hit[:-1] |= long[1:]
    hit &= size[text] - start >= length
    out = [np.zeros(0, np.int64)] * len(texts)
    places = np.flatnonzero(hit)
    places = places[np.lexsort((start[places], text[places]))]
    for piece in np.split(places, np.flatnonzero(np.diff(text[places])) + 1):
        if len(piece):
            out[text[piece[0]]] = start[piece]
    return out


def common_length(a: bytes, b: bytes) -> int:
    """How many bytes a and b have in common from their start, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def shared_extent(pieces: list[bytes], anchors: list[int]) -> list[tuple[int, int]]:
    """For pieces that all hold the same gram at their anchors: how far each agrees with any other, to left and right."""
    extent = []
    for sides in ([p[:a][::-1] for p, a in zip(pieces, anchors, strict=True)], [p[a:] for p, a in zip(pieces, anchors, strict=True)]):
        order = sorted(range(len(sides)), key=sides.__getitem__)
        most = [0] * len(sides)
        for i, j in zip(order, order[1:]):
            most[i] = max(most[i], n := common_length(sides[i], sides[j]))
            most[j] = max(most[j], n)
        extent.append(most)
    return list(zip(*extent, strict=True))


def trimmed(pieces: list[bytes], anchors: list[int], length: int = LENGTH) -> list[tuple[int, bytes]]:
    """Start and bytes of the part of each piece that can hold a repeated window; empty where it has under `length`."""
    parts = []
    for piece, anchor, (left, right) in zip(pieces, anchors, shared_extent(pieces, anchors), strict=True):
        parts.append((anchor - left, piece[anchor - left : anchor + right]) if left + right >= length else (0, b""))
    return parts


def digest64(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Consecutive window starts as (first, last) pairs."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True))


def dedup_substrings(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    Null text counts as empty; shorter texts than `length` never lose a byte. Rows that repeat are documents like any
    other, so equal rows remove each other. doc_id may be null or repeat. Other columns are left aside.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", *row_key())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "h", "g")] + [("lo", pa.int32()), ("hi", pa.int32()), ("at", pa.int32())])
        for batch in batches:
            parts = []
            for k1, k2, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), arrow_blobs(batch.column(2)), strict=True):
                h, lo, hi, at = runs(raw, length)
                if len(h):
                    g = np.fromiter((digest64(raw[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)), np.int64, len(lo))
                    parts.append((np.full(len(h), k1), np.full(len(h), k2), h, g, lo.astype(np.int32), hi.astype(np.int32), (at - lo).astype(np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], schema=schema)

    dealt = materialise(keyed.select("k1", "k2", "text").mapInArrow(deal, "k1 long, k2 long, h long, g long, lo int, hi int, at int"), "suffix-dealt")
    # counts by anchor are tables of their own: a join reads both sides from a shuffle then, and can split a hot anchor
    repeated = materialise(dealt.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "suffix-anchors")
    shared = materialise(dealt.join(repeated, "h", "left_semi"), "suffix-shared")
    drop(dealt, repeated)
    # one row per different run: how often it occurs, and which row of docs stands for it
    different = shared.groupBy("h", "g").agg(F.count("*").alias("n"), F.min("k1").alias("stands"))
    kinds = materialise(shared.select("h", "g").distinct().groupBy("h").agg(F.count("*").alias("kinds")), "suffix-kinds")
    verdicts = different.join(kinds, "h").select("h", "g", (F.col("n") > 1).alias("settled"), F.when(F.col("kinds") == 1, 0).when(F.col("kinds") <= hot, 1).otherwise(2).alias("how"), "stands")
    wanted = shared.join(verdicts, ["h", "g"]).select("k1", "k2", F.struct("lo", "hi", "at", "h", "settled", F.when(F.col("k1") == F.col("stands"), F.col("how")).otherwise(0).alias("how")).alias("r"))
    wanted = materialise(wanted.where("r.settled OR r.how > 0").groupBy("k1", "k2").agg(F.collect_list("r").alias("r")), "suffix-runs")
    drop(shared, kinds)

    # texts travel as zstd frames, a third of their size; both joins below bring them together with verdicts

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            frames = pa.array([compress(raw) for raw in arrow_blobs(batch.column(3))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], frames], names=["doc_id", "k1", "k2", "text"])

    packed = keyed.select("doc_id", "k1", "k2", "text").mapInArrow(pack, "doc_id long, k1 long, k2 long, text binary")
    pieces = packed.select("k1", "k2", "text").join(wanted.select("k1", "k2", F.filter("r", lambda r: r["how"] > 0).alias("r")).where("size(r) > 0"), ["k1", "k2"])
    pieces = pieces.select("k1", "k2", "text", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"), F.col("r.at").alias("at"), F.col("r.h").alias("h"), F.col("r.how").alias("how"), F.col("r.settled").alias("settled"))

    def snip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "h")] + [("how", pa.int32()), ("lo", pa.int32()), ("at", pa.int32()), ("settled", pa.bool_()), ("piece", pa.binary())])
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for k1, k2, lo, hi, at, h, how, settled, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6, 7, 8)), map(unpack, arrow_blobs(batch.column(2))), strict=True):
                seen = set()
                for a, b, place, anchor, kind, done in zip(lo, hi, at, h, how, settled, strict=True):
                    piece = raw[a : b + length]
                    if not done or (anchor, piece) not in seen:  # a settled run stands for its likes once
                        rows.append((k1, k2, anchor, kind, a, place, done, piece))
                        seen.add((anchor, piece))
                if len(rows) > 20_000:
                    yield to_batch(rows, schema)
                    rows = []
            if rows:
                yield to_batch(rows, schema)

    snipped = pieces.mapInArrow(snip, "k1 long, k2 long, h long, how int, lo int, at int, settled boolean, piece binary")
    snipped = materialise(snipped, "suffix-pieces")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            out, texts, owners, at = [], [], [], 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][2] == rows[at][2]:
                    end += 1
                group, at = rows[at:end], end
                likes: dict[bytes, list[tuple]] = {}
                for row, (start, part) in zip(group, trimmed([r[6] for r in group], [r[4] for r in group], length), strict=True):
                    if part:
                        likes.setdefault(part, []).append((row, start))
                single = any(len(x) == 1 and not x[0][0][5] for x in likes.values())
                for part, rows_of in likes.items():
                    if len(rows_of) > 1:
                        out += [(r[0], r[1], r[3] + a, r[3] + a + len(part) - length) for r, a in rows_of if not r[5]]
                    if single:
                        texts.append(part)
                        owners.append(rows_of[0] if len(rows_of) == 1 and not rows_of[0][0][5] else None)
            for owner, starts in zip(owners, repeated_starts(texts, length) if texts else (), strict=True):
                if owner:
                    row, shift = owner
                    out += [(row[0], row[1], row[3] + shift + a, row[3] + shift + b) for a, b in spans(starts, length)]
            return to_batch(out, schema)

        rest: list[tuple] = []
        for batch in batches:
            rest += zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True)
            while len(rest) > 4 * BATCH:
                cut = 4 * BATCH
                while cut < len(rest) and rest[cut][2] == rest[cut - 1][2]:
                    cut += 1
                if cut == len(rest):
                    break
                yield solve(rest[:cut])
                rest = rest[cut:]
        if rest:
            yield solve(rest)

    met = snipped.where("how = 1").select("k1", "k2", "h", "lo", "at", "settled", "piece").repartition(F.col("h")).sortWithinPartitions("h", "k1", "lo")
    solved = met.mapInArrow(suffixes, "k1 long, k2 long, lo int, hi int")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "h", "w1", "w2")] + [("lo", pa.int32()), ("settled", pa.bool_())])
        for batch in batches:
            rows = []
            for k1, k2, h, lo, settled, piece in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                for at in range(len(piece) - length + 1):
                    pair = hashlib.blake2b(piece[at : at + length], digest_size=16).digest()
                    rows.append((k1, k2, h, int.from_bytes(pair[:8], "little", signed=True), int.from_bytes(pair[8:], "little", signed=True), lo + at, settled))
                if len(rows) > 20_000:
                    yield to_batch(rows, schema)
                    rows = []
            if rows:
                yield to_batch(rows, schema)

    single = snipped.where("how = 2").select("k1", "k2", "h", "lo", "settled", "piece").mapInArrow(windows, "k1 long, k2 long, h long, w1 long, w2 long, lo int, settled boolean")
    often = single.groupBy("h", "w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    counted = single.where("NOT settled").join(often, ["h", "w1", "w2"]).select("k1", "k2", "lo", F.col("lo").alias("hi"))

    found = materialise(solved.unionByName(counted).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("more")), "suffix-found")
    drop(snipped)
    known = wanted.select("k1", "k2", F.filter("r", lambda r: r["settled"]).alias("r"))
    marks = known.join(found, ["k1", "k2"], "full_outer").select("k1", "k2", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"), F.col("more.lo").alias("lo2"), F.col("more.hi").alias("hi2"))
    joined = packed.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "lo", "hi", "lo2", "hi2")
    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc_id, lo, hi, lo2, hi2, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), map(unpack, arrow_blobs(batch.column(1))), strict=True):
                removed, count, kept, at = 0, 0, hashlib.sha256(), 0
                end = -1
                for a, b in sorted(zip((lo or []) + (lo2 or []), (hi or []) + (hi2 or []), strict=True)):
                    a, b = max(a, end), b + length
                    if b <= end:
                        continue
                    count += a > end
                    kept.update(raw[at:a] if a > at else b"")
                    removed += b - a
                    at = end = b
                kept.update(raw[at:])
                rows.append((doc_id, len(raw), removed, count, kept.hexdigest()))
            if rows:
                yield to_batch(rows, result)

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
