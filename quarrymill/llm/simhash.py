"""SimHash near-duplicates: segment popcounts, a grid join under Manhattan distance, exact verification, components.

A fingerprint's 64 bits are cut into segments; the bit counts of the segments are its embedding. The Manhattan distance
of two embeddings never exceeds the Hamming distance of the fingerprints. The segments are dealt to `groups` groups;
with at most `radius` differing bits, at least `groups - radius` groups agree in every count, that is, lie in one cell
of the grid of side 1, so joining on every choice of groups - radius groups finds every link. There are the more groups, and
so the finer cells, the more fingerprints there are (`grid`). The bound on the whole embedding and the exact Hamming
distance follow.

Copies never multiply: the join runs on distinct fingerprints only. A crowded cell is not paired out either: it is cut
to blocks, each pair of blocks is a group of bounded size in one task, and a task returns only a minimum spanning
forest of the links it finds, which keeps the components at every radius and has fewer edges than fingerprints.

`near_groups` links by Hamming distance alone. `keep_one` goes further: it also links all texts whose sets of word shingles
have a Jaccard similarity of at least `least`. In any one order of all shingles, the first n - ceil(least * n) + 1 of two
such sets have one in common, so lists of the texts by each of these shingles hold every pair. Shingles that a sample
shows to be common come last in the order, which keeps common lines out of most lists. Each list's texts are first
compared with one of them; once the components of what passed are known, all pairs that still lie in different ones are
compared. A pair that fails never counts as linked, and every verdict is exact, on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import arrow_blobs, carried, drop, drop_since, mark, materialise, restored, row_key
from quarrymill.llm.components import components

BLOCK = 2048  # fingerprints of one cell that meet in one task
SMALL = 32  # cells up to this size are compared all at once; larger ones by growing trees, with the same components
SAMPLE = 16  # one text of so many is looked at for common shingles
COMMON = 8  # texts of the sample that make a shingle common
BUCKETS = 256  # counts in a text's sketch
MOST = 1 << 18  # common shingles that the driver keeps, the most frequent ones


def fingerprint(raw: bytes, width: int = 3) -> int:
    """SimHash of the bytes: A-Z lower-cased, words between ASCII white space, shingles of `width` words by XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    span = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def digest() -> Column:
    """Equal texts have equal digests; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, row keys, t (the text's digest) and fp (a signed long with the fingerprint's bits) of every row; null, empty
    and blank texts have fp 0."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "k1", "k2", "t", "fp")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(raw, width) for raw in arrow_blobs(batch.column(4))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(fps, pa.int64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", *row_key(), digest(), "text").mapInArrow(run, "doc_id long, k1 long, k2 long, t long, fp long")


def embedding(fps: np.ndarray, segment: int = 2) -> np.ndarray:
    """Bit counts of the segments of `segment` bits of each fingerprint, lowest segment first."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), 64 // segment, segment).sum(axis=2, dtype=np.uint8)


def cells(fps: np.ndarray, groups: int, agree: int, segment: int = 2) -> np.ndarray:
    """The grid cell of each fingerprint for every choice of `agree` groups: one column of cell numbers per choice."""
    counts = embedding(fps, segment).astype(np.uint64)
    choices = list(combinations(range(groups), agree))
    parts = np.array_split(np.arange(64 // segment), groups)
    out = np.empty((len(fps), len(choices)), np.uint64)
    for n, choice in enumerate(choices):
        cell = np.full(len(fps), n, np.uint64)
        for place in np.concatenate([parts[g] for g in choice]):
            cell = cell * np.uint64(segment + 1) + counts[:, place]
        out[:, n] = cell
    return out.view(np.int64)


def grid(count: int, radius: int, segment: int = 2) -> int:
    """How many groups to deal the segments to for so many fingerprints: the number that makes the least work of copies
    into cells and comparisons in them. A cell of random fingerprints holds count * chance of them, where chance is that
    of equal counts in all segments of a choice; so cells get finer as the table grows. Every number finds all links."""
    halves = 64 // segment
    each = sum(math.comb(segment, i) ** 2 for i in range(segment + 1)) / 4**segment  # equal counts in one segment
    work = lambda groups: math.comb(groups, radius) * (1 + count * each ** (halves * (groups - radius) // groups))
    return min(range(radius + 2, min(halves, radius + 14) + 1), key=work)


def near(left: np.ndarray, right: np.ndarray, radius: int, segment: int) -> np.ndarray:
    """Which pairs link: the embeddings' distance is a lower bound and goes first, the exact distance decides."""
    bound = np.abs(embedding(left, segment).astype(np.int8) - embedding(right, segment).astype(np.int8)).sum(axis=1, dtype=np.int16) <= radius
    out = np.zeros(len(left), bool)
    out[bound] = np.bitwise_count(left[bound].view(np.uint64) ^ right[bound].view(np.uint64)) <= radius
    return out


def forest(fps: np.ndarray, radius: int) -> np.ndarray:
    """Edges (positions) of a minimum spanning forest of the links among fps, grown from one tree to the next."""
    bits, far = fps.view(np.uint64), 65
    distance, parent = np.full(len(fps), far), np.zeros(len(fps), np.int64)
    waiting, edges = np.ones(len(fps), bool), []
    for _ in range(len(fps)):
        i = int(np.argmin(np.where(waiting, distance, far + 1)))
        if distance[i] <= radius:
            edges.append((int(parent[i]), i))
        waiting[i] = False
        to = np.bitwise_count(bits ^ bits[i])
        closer = waiting & (to < distance) & (to <= radius)
        distance[closer], parent[closer] = to[closer], i
    return np.array(edges, np.int64).reshape(-1, 2)


def links(distinct: DataFrame, radius: int = 2, groups: int | None = None, segment: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that keep the components at every radius up to `radius`.

    distinct: one row per fingerprint, column fp. groups: `grid` of their number, if it is not given. Cells with up to `block` fingerprints are one group; fuller ones are
    cut by a hash of the fingerprint and every pair of parts is a group, so that no group holds over about two blocks.
    """
    groups = groups or grid(distinct.count(), radius, segment)
    agree = groups - radius
    choices = math.comb(groups, agree)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                found = cells(fps[at : at + 4096], groups, agree, segment)
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(np.repeat(fps[at : at + 4096], choices))], names=["cell", "fp"])

    placed = distinct.select("fp").mapInArrow(deal, "cell long, fp long")
    full = placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    grouped = placed.join(full, "cell").select("cell", "fp", mine.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    grouped = grouped.select("cell", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 4), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)])
            last = int((rest[:, :3] == rest[-1, :3]).all(axis=1).argmax())
            if last:
                yield solve(rest[:last])
                rest = rest[last:]
        if len(rest):
            yield solve(rest)

    def solve(rows: np.ndarray) -> pa.RecordBatch:
        """All groups of some sorted rows: small ones by comparing rows at every offset, others by forests."""
        fps = np.ascontiguousarray(rows[:, 3])
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(rows)]])
        sizes = ends - starts
        end = np.repeat(np.where(sizes <= SMALL, ends, 0), sizes)
        found, offset = [], 1
        here = np.flatnonzero(np.arange(len(rows)) + offset < end)
        while len(here):
            ok = near(fps[here], fps[here + offset], radius, segment)
            found.append((fps[here[ok]], fps[here[ok] + offset]))
            offset += 1
            here = here[here + offset < end[here]]
        for s, e in zip(starts[sizes > SMALL], ends[sizes > SMALL], strict=True):
            edges = forest(fps[s:e], radius)
            found.append((fps[s + edges[:, 0]], fps[s + edges[:, 1]]))
        a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    dealt = grouped.repartition(F.col("cell"), F.col("p"), F.col("q")).sortWithinPartitions("cell", "p", "q", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def shingles(raw: bytes, width: int) -> frozenset[bytes]:
    """The different word shingles of lower-cased text; the whole word sequence if it is shorter."""
    words = raw.lower().split()
    return frozenset(b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def shingle_hashes(raw: bytes, width: int) -> np.ndarray:
    """Hashes of the different shingles, sorted."""
    words = raw.lower().split()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words] or [0], np.uint64)
    span = min(width, len(hashes))
    out = hashes[: len(hashes) - span + 1].copy()
    for k in range(1, span):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - span + 1 + k]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique((out ^ (out >> np.uint64(29))).view(np.int64))


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and ranks (from 1, rarest first) of shingles that are common in a sample. They only change the
    order of shingles, so what is linked does not depend on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in arrow_blobs(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(raw, width))], names=["h"])

    sample = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), digest()).where(F.pmod("t", F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    top = counts.orderBy(F.desc("n"), "h").limit(MOST).toArrow().column("h").to_numpy()
    order = np.argsort(top)
    return top[order], (len(top) - order).astype(np.int64)


def postings(docs: DataFrame, width: int, least: float, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """h, t, n, pos: the first shingles of each text, as many as two texts with a similarity of `least` can't both have
    without one in common; n is the number of the text's shingles, pos the place in the order. Only shingles that
    several texts share."""
    schema = pa.schema([(c, pa.int64()) for c in ("h", "t", "n", "pos")])
    known, ranks = common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            found = []
            for t, raw in zip(batch.column(0).to_pylist(), arrow_blobs(batch.column(1)), strict=True):
                if t in seen:
                    continue
                seen.add(t)
                h = shingle_hashes(raw, width)
                n = len(h)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    h = h[np.argsort(np.where(known[at] == h, ranks[at], 0), kind="stable")]
                h = h[: n - int(np.ceil(least * n - 1e-9)) + 1]
                found.append((h, np.full(len(h), t), np.full(len(h), n), np.arange(len(h))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)], schema=schema)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, before = np.zeros((0, 4), np.int64), False
        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            if not len(rows):
                continue
            rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
            after = rows[1:, 0] == rows[:-1, 0]
            joined = np.concatenate([[before], after])
            keep = rows[:-1][joined[:-1] | after]
            rest, before = rows[-1:], bool(joined[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in keep.T], schema=schema)
        if before:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rest.T], schema=schema)

    columns = "h long, t long, n long, pos long"
    dealt = docs.select(digest(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, columns)
    return dealt.repartition("h").sortWithinPartitions("h", "t").mapInArrow(shared, columns)


def can_reach(n: np.ndarray | Column, pos: np.ndarray | Column, m: np.ndarray | Column, at: np.ndarray | Column, least: float) -> np.ndarray | Column:
    """Whether texts of n and m shingles can be similar if their first common shingle is at these places."""
    need = (n + m) * (least / (1 + least)) - 1e-6
    return (n - pos >= need) & (m - at >= need) & (n >= m * least - 1e-6) & (m >= n * least - 1e-6)


def crossing(lists: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of texts of one list that lie in different components and can be similar; lists: h, t, n, pos,
    component. Lists of over `block` texts are cut to parts, and every pair of parts is a group."""
    full = lists.groupBy("h").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("t"), "parts").cast("int")
    dealt = lists.join(full, "h").select("h", mine.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"), "component", "t", "n", "pos")
    dealt = dealt.select("h", F.least("part", "other").cast("long").alias("p"), F.greatest("part", "other").cast("long").alias("q"), "component", "t", "n", "pos", F.col("part").cast("long").alias("part"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 8), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            if not len(rest):
                continue
            last = int((rest[:, :3] == rest[-1, :3]).all(axis=1).argmax())
            if last:
                yield from solve(rest[:last])
                rest = rest[last:]
        if len(rest):
            yield from solve(rest)

    def ends(rows: np.ndarray) -> np.ndarray:
        """For each row, where its run of equal rows ends."""
        cuts = np.concatenate([np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1, [len(rows)]])
        return np.repeat(cuts, np.diff(cuts, prepend=0))

    def solve(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        stop, to = ends(rows[:, :3]), ends(rows[:, :4])
        p, q, t, n, pos, part = (rows[:, i] for i in (1, 2, 4, 5, 6, 7))
        here, found, many = np.flatnonzero(to < stop), [], 0
        to = to[here]
        while len(here):
            ok = can_reach(n[here], pos[here], n[to], pos[to], least) & ((p[here] == q[here]) | (part[here] != part[to]))
            found.append(np.stack([t[here[ok]], t[to[ok]]]))
            many += len(found[-1][0])
            to = to + 1
            more = to < stop[here]
            here, to = here[more], to[more]
            if many > 100_000 or not len(here):
                a, b = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)
                found, many = [], 0

    order = ["h", "p", "q", "component", "t"]
    return dealt.repartition("h", "p", "q").sortWithinPartitions(*order).mapInArrow(run, "a long, b long").distinct()


def sketches(texts: DataFrame, width: int) -> DataFrame:
    """t, fp, sketch: how many of the text's shingles fall in each of BUCKETS buckets, a byte each; null if one has more
    than a byte holds."""
    schema = pa.schema([("t", pa.int64()), ("fp", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (np.bincount([xxhash.xxh64_intdigest(s) % BUCKETS for s in shingles(raw, width)], minlength=BUCKETS) for raw in arrow_blobs(batch.column(2)))
            found = [c.astype(np.uint8).tobytes() if c.max() < 256 else None for c in counts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], schema=schema)

    return texts.select("t", "fp", "text").mapInArrow(run, "t long, fp long, sketch binary")


def possible(edges: DataFrame, sketched: DataFrame, least: float) -> DataFrame:
    """The edges (a, b: digests) between different fingerprints without those that can't be similar: two texts share at
    most the smaller count of each bucket, an upper bound that never loses a similar pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if left is None or right is None:
                    keep.append(True)
                    continue
                x, y = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
                both = int(np.minimum(x, y).sum(dtype=np.int64))
                keep.append(both >= least * (int(x.sum(dtype=np.int64)) + int(y.sum(dtype=np.int64)) - both))
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(keep, pa.bool_())).columns[:2]), schema=schema)

    left = edges.join(sketched.select(F.col("t").alias("a"), F.col("fp").alias("fp_a"), F.col("sketch").alias("s_a")), "a")
    both = left.join(sketched.select(F.col("t").alias("b"), F.col("fp").alias("fp_b"), F.col("sketch").alias("s_b")), "b")
    return both.where("fp_a <> fp_b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def alike(edges: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The fingerprints (a, b) of the edges (a, b: digests) whose texts (t, fp, text; one per digest) have a Jaccard
    similarity of at least `least` on shingles of `width` words."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(arrow_blobs(batch.column(2)), arrow_blobs(batch.column(3)), strict=True):
                x, y = shingles(left, width), shingles(right, width)
                both = len(x & y)
                keep.append(both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(keep, pa.bool_())).columns[:2]), schema=schema)

    left = edges.join(texts.select(F.col("t").alias("a"), F.col("fp").alias("fp_a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("t").alias("b"), F.col("fp").alias("fp_b"), F.col("text").alias("text_b")), "b")
    return both.where("fp_a <> fp_b").select("fp_a", "fp_b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def with_component(marked: DataFrame, edges: DataFrame) -> DataFrame:
    """fp and component (a fingerprint that stands for all those it is linked to) of every fingerprint of marked."""
    labels = components(edges)
    distinct = marked.select("fp").distinct()
    return distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_groups(docs: DataFrame, width: int = 3, radius: int = 2, groups: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row of docs.

    Null and blank texts share the fingerprint 0 and are linked like any other. Rows that repeat a doc_id each get a
    row; a null doc_id counts as absent when the smallest is sought, and a component of such rows only has a null id.
    Columns of docs other than doc_id and text are left aside. An empty table gives an empty result.
    """
    start = mark()
    marked = materialise(fingerprints(docs, width), "simhash")
    edges = materialise(links(marked.select("fp").distinct(), radius, groups, 2, block), "simhash-links")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    merged = with_component(marked, edges).join(least, "fp")
    smallest = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = materialise(merged.select("fp", "component").join(smallest, "component").select("fp", "component_id"), "simhash-ids")
    drop_since(start, marked, ids)
    return marked.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def similar(docs: DataFrame, marked: DataFrame, close: DataFrame, shingle: int, least: float) -> DataFrame:
    """Edges (a, b) between fingerprints that, with those of close, keep the components of all pairs of texts with a
    similarity of at least `least`."""
    lists = materialise(postings(docs, shingle, least, common_shingles(docs, shingle)), "dedup-lists")
    nodes = marked.groupBy("t").agg(F.min("fp").alias("fp"), F.min(F.struct("k1", "k2")).alias("k"))
    nodes = materialise(nodes.join(lists.select("t").distinct(), "t", "left_semi").select("t", "fp", "k.k1", "k.k2"), "dedup-nodes")
    keyed = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *row_key())
    texts = materialise(nodes.join(keyed, ["k1", "k2"]).select("t", "fp", "text").dropDuplicates(["t"]), "dedup-texts")
    sketched = materialise(sketches(texts, shingle), "dedup-sketches")
    center = lists.groupBy("h").agg(F.min(F.struct("pos", "t", "n")).alias("c"))
    fits = can_reach(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos"), least)
    stars = lists.join(center, "h").where(F.col("t") != F.col("c.t")).where(fits)
    tried = materialise(stars.select(F.least("t", "c.t").alias("a"), F.greatest("t", "c.t").alias("b")).distinct(), "dedup-tried")
    maybe = materialise(possible(tried, sketched, least), "dedup-possible")
    passed = materialise(alike(maybe, texts, shingle, least), "dedup-passed")
    drop(maybe)
    labels = with_component(marked, close.unionByName(passed))
    labelled = lists.join(nodes.join(labels, "fp").select("t", "component"), "t")
    mixed = labelled.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("h")
    left = materialise(labelled.join(mixed, "h"), "dedup-open")
    drop(lists)
    rest = materialise(possible(crossing(left, least).join(tried, ["a", "b"], "left_anti"), sketched, least), "dedup-rest")
    drop(left, tried, sketched)
    more = materialise(alike(rest, texts, shingle, least), "dedup-more")
    drop(rest, texts)
    return passed.unionByName(more)


def keep_one(docs: DataFrame, width: int = 3, radius: int = 2, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one document of each group of near-duplicates: that of the smallest doc_id; all columns are kept.

    Texts link if their fingerprints (of `width` words) differ in at most `radius` bits, or if they share at least
    `similarity` of their shingles of `shingle` words; no such pair is left out, however crowded a list of candidates is.
    A null text counts as an empty one, and blank texts are all alike: one of them stays. Rows without a doc_id come last
    when the one to stay is chosen; of rows equal in doc_id and text one stays (the least by a hash of all its columns).
    Other columns never matter and are carried apart, so no name can clash. An empty table stays empty. Texts of any
    length are compared whole; a task holds a pair of them.
    """
    start = mark()
    marked = materialise(fingerprints(docs, width), "dedup")
    close = materialise(links(marked.select("fp").distinct(), radius), "dedup-links")
    kept = close.unionByName(similar(docs, marked, close, shingle, similarity))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")
    best = marked.groupBy("fp").agg(F.min(rank).alias("f"))  # copies meet here, in part before the shuffle
    first = best.join(with_component(marked, kept), "fp").groupBy("component").agg(F.min("f").alias("f"))
    first = materialise(first.select("f.k1", "f.k2"), "dedup-first")
    drop_since(start, first)
    rows = carried(docs, *row_key()).join(first, ["k1", "k2"], "left_semi")
    equal = Window.partitionBy("k1", "k2").orderBy(F.xxhash64("carried"))
    return restored(rows.withColumn("nth", F.row_number().over(equal)).where("nth = 1"), docs)
