"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a position adds a random number per byte, shifted by the byte's distance, and so depends on the last 16
bytes only. A chunk ends where the hash is the largest within `reach` bytes on either side (the first of equal ones).
Ends thus depend on nearby bytes alone: an insertion moves the ends around it and no others, chunks have at least
reach + 1 bytes, and most have about twice that. Only where there is no such end for `MOST` bytes, as in text that
repeats a few letters, chunks are cut at that size.

Chunks are compared by a 128-bit BLAKE2 digest; of equal chunks the first stays: that of the document with the smallest
doc_id, and within it the first. Two results are given. `plain` deduplicates every chunk by its digest. As a single
repeated chunk is often a common phrase, the main result only takes passages: runs of neighbouring repeated chunks of
together `RUN` bytes. A repeated passage of over 50 words of usual length holds one in more than 99 of 100 cases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, row_key, to_batch

REACH = 24
MOST = 192
RUN = 80
GEAR = np.random.default_rng(20260501).integers(0, 2**32, 256, np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte over the last 16 bytes (fewer at the start), modulo 2^32, by doubling."""
    out, reach = GEAR[data], 1
    while reach < 16:
        out[reach:] = out[reach:] + (out[:-reach] << np.uint32(reach))
        reach *= 2
    return out


def chunk_ends(raw: bytes, reach: int = REACH, block: int = 1 << 20) -> np.ndarray:
    """End offsets of the chunks of raw, the last being len(raw); long texts go through in overlapping blocks."""
    size, found, margin = len(raw), [], reach + 16
    for at in range(0, size, block):
        low, high = max(0, at - margin), min(size, at + block + margin)
        data = np.frombuffer(raw, np.uint8, high - low, low)
        value = (gear_hashes(data).astype(np.uint64) << np.uint64(31)) - np.arange(len(data), dtype=np.uint64)  # the first of equal ones is largest
        top, span = value.copy(), 1
        while span < 2 * reach + 1:  # largest of value[i : i + span]
            step = min(span, 2 * reach + 1 - span)
            top = np.maximum(top[: len(top) - step], top[step:]) if len(top) > step else top[:0]
            span += step
        centre = np.flatnonzero(value[reach : reach + len(top)] == top) + reach + low
        found.append(centre[(centre >= at) & (centre < at + block)] + 1)
    if not size:
        return np.zeros(0, np.int64)
    ends = np.concatenate(found)
    ends = np.append(ends[ends < size], size)
    starts = np.concatenate([[0], ends[:-1]])
    pieces = (ends - starts + MOST - 1) // MOST  # cuts of long chunks are counted from their start
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces) + 1
    return np.minimum(np.repeat(starts, pieces) + within * MOST, np.repeat(ends, pieces))


def chunks(raw: bytes, reach: int = REACH) -> list[tuple[int, int, bytes]]:
    """Start, end and digest of each chunk."""
    ends = chunk_ends(raw, reach).tolist()
    return [(a, b, hashlib.blake2b(raw[a:b], digest_size=16).digest()) for a, b in zip([0, *ends], ends, strict=False)]


def in_runs(repeated: list[tuple[int, int]], run: int) -> set[int]:
    """The starts of those chunks (start, end; in order) that lie in runs of neighbours of together `run` bytes."""
    out, own = set(), []
    for start, end in [*repeated, (-1, -1)]:
        if own and own[-1][1] != start:
            if own[-1][1] - own[0][0] >= run:
                out.update(s for s, _ in own)
            own = []
        own.append((start, end))
    return out


def dedup_chunks(docs: DataFrame, reach: int = REACH, run: int = RUN) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_chunks, n_repeated (bytes in passages of repeated chunks), n_removed (bytes
    taken out), n_spans (spans taken out), kept_sha256, kept (the remaining bytes), and for digests alone plain_repeated
    (bytes of chunks that occur again anywhere), plain_removed and plain_sha256.

    Null text counts as empty and has no chunk. Which chunk is the first goes by doc_id, null last, then by a hash of
    doc_id and text; of rows equal in both one keeps the first chunks and the others lose them. `run` 0 makes both results
    the same. Columns other than doc_id and text are left aside. An empty table gives an empty result. Counts are summed
    before the shuffle for each document and digest, and a digest that occurs everywhere is one row on the side it
    joins, so skew joins can split the other; equal rows become one before they are shuffled.
    """
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("owner", pa.int64()), ("n", pa.int64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys1, keys2, owners, digests, counts = [], [], [], [], []
            for k1, k2, owner, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), arrow_blobs(batch.column(3)), strict=True):
                own: dict[bytes, int] = {}
                for _, _, digest in chunks(raw, reach):
                    own[digest] = own.get(digest, 0) + 1
                keys1 += [k1] * len(own)
                keys2 += [k2] * len(own)
                owners += [owner] * len(own)
                digests += own
                counts += own.values()
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            if len(pair):
                yield pa.RecordBatch.from_arrays([pa.array(keys1, pa.int64()), pa.array(keys2, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(owners, pa.int64()), pa.array(counts, pa.int64())], schema=schema)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = source.select("doc_id", "text", *row_key())
    last = F.lit(2**63 - 1)
    dealt = keyed.select("k1", "k2", F.coalesce("doc_id", last).alias("owner"), "text").mapInArrow(deal, "k1 long, k2 long, d1 long, d2 long, owner long, n long")
    first = F.min(F.struct("owner", "k1", "k2")).alias("first")
    again = dealt.groupBy("d1", "d2").agg(F.sum("n").alias("total"), first).where("total > 1").select("d1", "d2", "first.owner", "first.k1", "first.k2").toDF("d1", "d2", "f0", "f1", "f2")
    own = (F.col("owner") == F.col("f0")) & (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2"))
    marked = dealt.select("k1", "k2", "d1", "d2", "owner").join(again, ["d1", "d2"]).select("k1", "k2", F.struct("d1", "d2", own.alias("first")).alias("m"))
    marked = marked.groupBy("k1", "k2").agg(F.collect_set("m").alias("marks"))
    rows = keyed.groupBy("k1", "k2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    joined = rows.join(marked, ["k1", "k2"], "left").select("doc_id", "copies", "text", F.col("marks.d1").alias("d1"), F.col("marks.d2").alias("d2"), F.col("marks.first").alias("firsts"))

    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("n_repeated", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()), ("plain_repeated", pa.int64()), ("plain_removed", pa.int64()), ("plain_sha256", pa.string())])

    def judged(doc_id: int | None, raw: bytes, own: list[tuple[int, int, bytes]], stays: dict[bytes, bool]) -> tuple:
        long = in_runs([(a, b) for a, b, digest in own if digest in stays], run)
        kept, plain, seen, repeated, again, spans, before = [], [], set(), 0, 0, 0, -1
        for a, b, digest in own:
            there = digest in stays
            again += (b - a) * there
            repeated += (b - a) * (a in long)
            out = there and (not stays[digest] or digest in seen)
            if not out:
                plain.append(raw[a:b])
            if out and a in long:
                spans += before != a
                before = b
            else:
                kept.append(raw[a:b])
            seen.add(digest)
        rest, bare = b"".join(kept), b"".join(plain)
        return (doc_id, len(raw), len(own), repeated, len(raw) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest, again, len(raw) - len(bare), hashlib.sha256(bare).hexdigest())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for doc_id, copies, d1, d2, firsts, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), arrow_blobs(batch.column(2)), strict=True):
                stays = {np.array(pair, np.int64).tobytes(): first for *pair, first in zip(d1 or (), d2 or (), firsts or (), strict=True)}
                own = chunks(raw, reach)
                out.append(judged(doc_id, raw, own, stays))
                later = judged(doc_id, raw, own, dict.fromkeys(stays, False)) if copies > 1 else None
                for _ in range(copies - 1):
                    out.append(later)
                    size += len(later[7])
                    if size > 1 << 24 or len(out) > 20_000:
                        yield to_batch(out, result)
                        out, size = [], 0
            if out:
                yield to_batch(out, result)

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, n_spans long, kept_sha256 string, kept binary, plain_repeated long, plain_removed long, plain_sha256 string")
