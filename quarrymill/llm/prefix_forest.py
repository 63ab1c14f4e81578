"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives a vector a long string of hash bits (signs of projections on random directions, orthogonal ones in
groups); a tree is the sorted array of the strings. A query descends to the longest prefix that any tree shares with it,
and then all trees are ascended together, one bit at a time: each step widens the ranges of the sorted arrays that share
the prefix, and the new candidates are scored exactly. The ascent ends when a vector as near as the k-th best so far
would have been met by now with probability `target`: one that shares a bit with probability p shares a prefix of depth d
in one of the trees with 1 - (1 - p^d)^trees. So the share that is scored follows from the data: it falls as the table
grows and neighbours get nearer, and no number of candidates is fixed.

For the largest inner product, vectors are first brought to one length by an added coordinate, which makes the order of
inner products that of angles. Equal vectors are one class, indexed once, with its smallest ids (ties go to those).
Vectors of different lengths are searched each among their like.

A table too large for one task is cut by a tree of its own: leaves are prefixes of variable length, as long as it takes
for at most `block` classes, and every class goes to its one leaf. A query goes to those leaves that together hold a
k-th neighbour with probability `route`, the likeliest first; how likely a leaf is follows from how far the query lies
from each of its planes and from the angle of a k-th neighbour, which a bounded sample gives (`SAMPLE`). Each leaf builds
its forest once for up to `QUERIES` queries and hands on at most k candidates for each. Leaves whose vectors no prefix
tells apart are cut to parts by hash, which are all searched.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import drop_since, mark, materialise

TREES = 72
BITS = 24
TARGET = 0.9  # for the k-th neighbour; nearer ones are found more surely
ROUTE = 0.995
BLOCK = 16_384  # classes of a leaf
QUERIES = 65_536  # queries that meet a leaf in one task
BATCH = 256  # queries that ascend side by side
CELLS = 1 << 22  # queries of a batch x classes of a leaf, at most
STEP = 1 << 20  # entries of sorted arrays that are read at once
SAMPLE = 2_048  # classes that the angle of a k-th neighbour is estimated from


@cache
def planes(dimension: int, count: int, seed: int) -> np.ndarray:
    """Directions as columns, orthogonal in groups of `dimension`, each as long as a standard normal one is on average."""
    rng = np.random.default_rng([seed, dimension])
    groups = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(-(-count // dimension))]
    return np.hstack(groups)[:, :count] * math.sqrt(dimension) if count else np.zeros((dimension, 0))


def augmented(base: np.ndarray, top: float) -> np.ndarray:
    """Rows scaled by the largest length (its square is `top`), with a coordinate that makes each of length 1."""
    squares = (base**2).sum(axis=1)
    return np.hstack([base / math.sqrt(top), np.sqrt(np.maximum(0, 1 - squares / top))[:, None]])


def probes_of(queries: np.ndarray) -> np.ndarray:
    return np.hstack([queries / np.sqrt((queries**2).sum(axis=1))[:, None], np.zeros((len(queries), 1))])


def met(cosine: float, depth: int, trees: int) -> float:
    """The probability that a vector at this cosine shares a prefix of `depth` bits in one of the trees."""
    p = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return 1 - (1 - p**depth) ** trees


class Forest:
    """Sorted arrays of hash strings over unit vectors."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 20260701):
        self.trees, self.bits, self.count = trees, bits, len(vectors)
        self.planes = planes(vectors.shape[1], trees * bits, seed)
        strings = self.strings(vectors)
        order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, order, axis=1)
        self.order = order.astype(np.int32).ravel()
        self.short = min(bits, self.count.bit_length() + 2)
        self.starts = np.zeros((trees, (1 << self.short) + 1), np.int32)  # where each prefix of that many bits starts
        for t in range(trees):
            np.cumsum(np.bincount(self.sorted[t] >> (bits - self.short), minlength=1 << self.short), out=self.starts[t, 1:])

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """trees x vectors hash strings, first bit highest."""
        out = np.zeros((self.trees, len(vectors)), np.int32)
        for at in range(0, len(vectors), 4096):
            signs = (vectors[at : at + 4096] @ self.planes > 0).reshape(-1, self.bits, self.trees)  # trees of a group differ most
            own = np.zeros((len(signs), self.trees), np.int32)
            for bit in range(self.bits):
                own |= signs[:, bit].astype(np.int32) << (self.bits - 1 - bit)
            out[:, at : at + 4096] = own.T
        return out

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """queries x trees: the range of the sorted array that shares a prefix of `depth` bits."""
        shift = self.bits - depth
        if depth <= self.short:
            prefixes, rest = (strings.T >> shift).astype(np.int64), self.short - depth
            places = (prefixes << rest) + np.arange(self.trees) * self.starts.shape[1]
            flat = self.starts.ravel()
            return flat[places].astype(np.int64), flat[places + (1 << rest)].astype(np.int64)
        low = np.empty(strings.T.shape, np.int64)
        high = np.empty_like(low)
        first = strings >> shift << shift
        for t in range(self.trees):
            low[:, t] = self.sorted[t].searchsorted(first[t], side="left")
            high[:, t] = self.sorted[t].searchsorted(first[t] + ((1 << shift) - 1), side="right")
        return low, high

    def ascend(self, strings: np.ndarray, least: int, take: Callable[[int, int, np.ndarray], bool]) -> None:
        """Ascents of a batch of queries side by side, from the longest prefix up to the root.

        `take` gets a depth, a query and the rows that the depth adds to it, and tells whether that query is done. Depths
        at which a query has less than `least` entries may be left out; what they add then comes with the next one."""
        many, n = strings.shape[1], self.count
        seen, stamp = np.zeros(many * n, bool), np.empty(many * n, np.int32)
        low, high = self.ranges(strings, self.short)
        crowded = (high - low).sum(axis=1) >= least  # these may end at longer prefixes
        inner, outer = low.copy(), low  # the ranges that have been met: none so far
        if crowded.any():
            inner[crowded] = outer[crowded] = self.ranges(strings[:, crowded], self.bits)[0]
        left = np.ones(many, bool)
        for depth in range(self.bits, 0, -1):
            at = np.flatnonzero(left & crowded if depth > self.short else left)
            if not len(at):
                continue
            low, high = self.ranges(strings[:, at], depth)
            # ranges are nested: what is new lies before and behind the range that has been met
            starts = (np.stack([low, outer[at]], axis=1) + np.arange(self.trees) * n).reshape(len(at), -1)
            sizes = np.stack([inner[at] - low, high - outer[at]], axis=1).reshape(len(at), -1)
            inner[at], outer[at] = low, high
            upto = np.cumsum(sizes.sum(axis=1))
            begin = 0
            while begin < len(at):
                end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + STEP, side="right")))
                own, size = at[begin:end], sizes[begin:end].ravel()
                entries = np.repeat(starts[begin:end].ravel() - (np.cumsum(size) - size), size)
                entries += np.arange(len(entries))
                keys = np.repeat(own * n, sizes[begin:end].sum(axis=1)) + self.order[entries]
                keys = keys[~seen[keys]]
                places = np.arange(len(keys), dtype=np.int32)
                stamp[keys] = places
                keys = keys[stamp[keys] == places]  # once each
                seen[keys] = True
                for q, rows in zip(own.tolist(), np.split(keys % n, np.searchsorted(keys // n, own[1:])), strict=True):
                    left[q] = not take(depth, q, rows)
                begin = end
        for q in np.flatnonzero(left).tolist():
            take(0, q, np.flatnonzero(~seen[q * n : (q + 1) * n]))


class Best:
    """The rows met by one query that may be among its k + 1 best, with their scores."""

    def __init__(self, base: np.ndarray, query: np.ndarray, k: int, slack: float):
        self.base, self.query, self.k, self.slack = base, query, k, slack
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0)
        self.met, self.kth = 0, -math.inf

    def add(self, rows: np.ndarray) -> None:
        scores = self.base.take(rows, axis=0) @ self.query
        near = np.flatnonzero(~(scores < self.kth - self.slack))
        self.met += len(rows)
        self.rows, self.scores = np.concatenate([self.rows, rows[near]]), np.concatenate([self.scores, scores[near]])
        if len(self.rows) > self.k:  # one of them may be the query itself
            place = len(self.rows) - self.k - 1
            self.kth = float(np.partition(self.scores, place)[place])
            near = ~(self.scores < self.kth - self.slack)
            self.rows, self.scores = self.rows[near], self.scores[near]


def search_block(base: np.ndarray, ids: list[list[int]], queries: np.ndarray, query_ids: np.ndarray, k: int, top: float, hope: float = -1.0, target: float = TARGET) -> tuple[list[tuple], int]:
    """(query_id, vec_id, score) of up to k best candidates of each query in one block, and how many rows were scored.

    top: the square of the longest vector of the whole table; hope: a cosine that a k-th neighbour in the whole table
    has at least, so that one block need not look for worse ones. Queries ascend in batches, so that what is done for
    each of them and each tree is array work; the rows that they meet and score are those of ascents one by one."""
    forest = Forest(augmented(base, top))
    first = np.array([own[0] for own in ids])
    lengths = np.sqrt((queries**2).sum(axis=1)) * math.sqrt(top)
    slack = 8 * base.shape[1] * np.finfo(float).eps * lengths  # more than rounding, in whatever order a product is summed
    out, scored, step = [], 0, max(1, min(BATCH, CELLS // len(base)))
    for at in range(0, len(queries), step):
        batch, length = queries[at : at + step], lengths[at : at + step].tolist()
        bests = [Best(base, query, k, s) for query, s in zip(batch, slack[at : at + step].tolist(), strict=True)]

        def take(depth: int, q: int, rows: np.ndarray, bests: list[Best] = bests, length: list[float] = length) -> bool:
            own = bests[q]
            if len(rows):
                own.add(rows)
            return own.met > k and met(max(own.kth / length[q], hope), depth, forest.trees) >= target

        forest.ascend(forest.strings(probes_of(batch)), k + 1, take)
        for q, found in enumerate(bests):
            own, rows = int(query_ids[at + q]), found.rows
            scored += found.met
            scores = (base[rows] * batch[q]).sum(axis=1)
            best: list[tuple] = []
            for i in np.lexsort((first[rows], -scores)):
                if len(best) > k and scores[i] < best[k][0]:
                    break
                best += [(scores[i], v) for v in ids[rows[i]] if v != own]
            best.sort(key=lambda x: (-x[0], x[1]))
            out += [(own, v, float(s)) for s, v in best[:k]]
    return out, scored


class Router:
    """Leaves of the routing tree of one vector length, and which of them a query visits."""

    def __init__(self, dimension: int, classes: int, top: float, block: int, seed: int = 20260702):
        self.top, self.block = top, block
        self.bits = 0 if classes <= block else min(30, math.ceil(math.log2(classes / block)) + 3)
        self.planes = planes(dimension + 1, self.bits, seed)
        self.leaves: list[tuple[int, int, int]] = [(0, 0, 1)]  # prefix, its bits, parts
        self.cosine, self.mean, self.spread = 0.0, np.zeros(dimension + 1), np.ones(self.bits)

    def learn(self, sample: np.ndarray, k: int, classes: int) -> None:
        """The angle of a k-th neighbour, and where vectors lie along the planes, from a sample of the table."""
        unit = augmented(sample, self.top)
        self.cosine = expected_cosine(unit, probes_of(sample), k, classes)
        self.mean, self.spread = unit.mean(axis=0), (unit @ self.planes).std(axis=0)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit @ self.planes > 0).astype(np.int64)
        return (signs << np.arange(self.bits - 1, -1, -1)).sum(axis=1) if self.bits else np.zeros(len(unit), np.int64)

    def grow(self, counts: dict[int, int]) -> None:
        """Leaves from the number of classes of each full code: a prefix is cut while it holds too many classes."""
        codes = np.array(sorted(counts), np.int64)
        upto = np.concatenate([[0], np.cumsum([counts[c] for c in codes.tolist()])])
        self.leaves, waiting = [], [(0, 0)]
        while waiting:
            prefix, depth = waiting.pop()
            shift = self.bits - depth
            a, b = np.searchsorted(codes, [prefix << shift, (prefix + 1) << shift])
            many = int(upto[b] - upto[a])
            if many > self.block and depth < self.bits:
                waiting += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
            elif many:
                self.leaves.append((prefix, depth, -(-many // self.block)))
        self.leaves.sort(key=lambda leaf: leaf[0] << (self.bits - leaf[1]))

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        starts = np.array([prefix << (self.bits - depth) for prefix, depth, _ in self.leaves], np.int64)
        return np.searchsorted(starts, codes, side="right") - 1

    def visits(self, unit: np.ndarray, route: float) -> Iterator[np.ndarray]:
        """For each query the leaves to visit."""
        if len(self.leaves) == 1:
            yield from np.zeros((len(unit), 1), np.int64)
            return
        depth = np.array([d for _, d, _ in self.leaves])
        places = np.arange(self.bits)
        inside = places[None, :] < depth[:, None]
        full = np.array([p << (self.bits - d) for p, d, _ in self.leaves], np.int64)
        ones = (full[:, None] >> (self.bits - 1 - places)[None, :] & 1).astype(bool)
        across = self.spread * math.sqrt(max(1e-9, 1 - self.cosine**2))
        for at in range(0, len(unit), 256):
            own = unit[at : at + 256]
            margin = own @ self.planes
            # a neighbour is a part of the query and a rest, which is like that of any vector of the table
            rest = self.mean @ self.planes - (own @ self.mean)[:, None] * margin
            high = np.vectorize(NormalDist().cdf, otypes=[float])((self.cosine * margin + rest) / np.maximum(across, 1e-9))  # that its bit is 1
            one, zero = np.log(np.maximum(high, 1e-12)), np.log(np.maximum(1 - high, 1e-12))
            chance = np.exp(one @ (inside & ones).T + zero @ (inside & ~ones).T)
            chance /= np.maximum(chance.sum(axis=1, keepdims=True), 1e-300)  # empty leaves hold none
            order = np.argsort(-chance, axis=1, kind="stable")
            upto = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
            for row, sums in zip(order, upto, strict=True):
                yield row[: int(np.searchsorted(sums, route)) + 1]


def expected_cosine(unit: np.ndarray, probes: np.ndarray, k: int, classes: int) -> float:
    """A cosine that the k-th neighbour among so many classes has at least, for nine queries in ten.

    The sample's own cosines tell it as far as they reach; beyond, their upper tail is carried on by a little less than
    its slope over the normal deviate, which bends down where lengths or dimensions bound it."""
    n = len(unit)
    if n < 100 or classes <= k:
        return -1.0
    cosines = probes @ unit.T
    np.fill_diagonal(cosines, -np.inf)
    at = lambda share: np.partition(cosines, n - 1 - int(share * n), axis=1)[:, n - 1 - int(share * n)]
    share = max(k / classes, 4 / n)
    low = at(share)
    if k / classes < share:
        deviate = lambda x: NormalDist().inv_cdf(1 - x)
        slope = (low - at(32 / n)) / (deviate(4 / n) - deviate(32 / n))
        low = low + 0.8 * slope * (deviate(k / classes) - deviate(share))
    return float(min(1.0, np.quantile(low, 0.1)))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, target: float = TARGET, route: float = ROUTE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by `every`.

    vectors: vec_id and embedding (array of numbers). Rows with a null id or vector, a null or non-finite component, or no
    component but zeros take no part; vectors of other lengths than a query's are no candidates of it. Rows that repeat a
    vec_id are that vector once for each different embedding. Other columns are left aside. An empty table gives an empty
    result. The driver gets a row for each vector length, at most 16 counts for each leaf, and the sample.
    """
    start = mark()
    item = F.col("embedding").cast("array<double>")
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(item, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    clean = clean.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)).distinct()
    # the k + 1 smallest ids of each class: ranked in parts first, so a class of any size is spread
    part = Window.partitionBy("v", F.pmod("vec_id", F.lit(64))).orderBy("vec_id")
    whole = Window.partitionBy("v").orderBy("vec_id")
    few = clean.withColumn("n", F.row_number().over(part)).where(F.col("n") <= k + 1).withColumn("n", F.row_number().over(whole)).where(F.col("n") <= k + 1)
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    classes = materialise(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumns({"d": F.size("v"), "squares": length}), "forest-classes")
    routers = {r["d"]: Router(r["d"], r["n"], r["top"], block) for r in classes.groupBy("d").agg(F.count("*").alias("n"), F.max("squares").alias("top")).collect()}
    sizes = {r["d"]: r["count"] for r in classes.groupBy("d").count().collect()}
    for d, router in routers.items():
        sample = classes.where(F.col("d") == d).orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
        router.learn(np.array(sample.flatten()).reshape(len(sample), d), k, sizes[d])

    def unit_rows(batch: pa.RecordBatch, column: int, probe: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Vector length, rows of the batch that have it, and their unit vectors."""
        values = batch.column(column)
        lengths = np.diff(values.offsets.to_numpy())
        for d in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == d)
            own = np.array(values.take(pa.array(rows)).flatten()).reshape(len(rows), d)
            yield d, rows, probes_of(own) if probe else augmented(own, routers[d].top)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, unit in unit_rows(batch, 0, False):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d)), pa.array(routers[d].codes(unit))], names=["d", "code"])

    grown: dict[int, dict[int, int]] = {}
    if any(r.bits for r in routers.values()):
        for r in classes.select("v").mapInArrow(coded, "d long, code long").groupBy("d", "code").count().collect():
            grown.setdefault(r["d"], {})[r["code"]] = r["count"]
    for d, counts in grown.items():
        routers[d].grow(counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, unit in unit_rows(batch, 1, False):
                own = batch.take(pa.array(rows))
                leaf = routers[d].leaf_of(routers[d].codes(unit))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d)), pa.array(leaf), *own.columns], names=["d", "leaf", "ids", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, unit in unit_rows(batch, 1, True):
                leaves = list(routers[d].visits(unit, route))
                at = np.repeat(rows, [len(x) for x in leaves])
                leaf = np.concatenate(leaves)
                parts = np.array([p for *_, p in routers[d].leaves])[leaf]
                within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                own = batch.take(pa.array(np.repeat(at, parts)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(within), d)), pa.array(np.repeat(leaf, parts)), pa.array(within), *own.columns], names=["d", "leaf", "part", "query_id", "v"])

    split = {(d, leaf): parts for d, r in routers.items() for leaf, (*_, parts) in enumerate(r.leaves) if parts > 1}
    base = classes.select("ids", "v").mapInArrow(place, "d long, leaf long, ids array<long>, v array<double>")
    parts = F.lit(1).cast("long")
    if split:
        known = F.create_map(*(x for (d, leaf), n in split.items() for x in (F.lit(f"{d}:{leaf}"), F.lit(n).cast("long"))))
        parts = F.coalesce(known[F.concat_ws(":", "d", "leaf")], parts)
    base = base.withColumn("part", F.pmod(F.xxhash64(F.element_at("ids", 1)), parts))
    asked = clean.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v")
    asked = materialise(asked.mapInArrow(visit, "d long, leaf long, part long, query_id long, v array<double>"), "forest-visits")
    crowds = asked.groupBy("d", "leaf", "part").agg(F.ceil(F.count("*") / QUERIES).alias("crowds"))
    keys = ["d", "leaf", "part", "crowd"]
    queries = asked.join(crowds, ["d", "leaf", "part"]).withColumn("crowd", F.pmod(F.xxhash64("query_id", F.lit(3)), F.col("crowds"))).select(*keys, "query_id", "v")
    base = base.join(crowds, ["d", "leaf", "part"]).withColumn("crowd", F.explode(F.sequence(F.lit(0).cast("long"), F.col("crowds") - 1))).select(*keys, "ids", "v")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            left, right = left.assign(_first=[own[0] for own in left["ids"]]).sort_values("_first"), right.sort_values("query_id")
            router = routers[int(left["d"].iloc[0])]
            rows, _ = search_block(np.stack(left["v"].to_list()).astype(np.float64), left["ids"].to_list(), np.stack(right["v"].to_list()).astype(np.float64), right["query_id"].to_numpy(), k, router.top, router.cosine, target)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = base.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = materialise(found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "forest-found")
    drop_since(start, best)
    return best
