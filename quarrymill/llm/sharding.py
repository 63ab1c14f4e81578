"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, and groups of equal texts stay whole.

A group is placed as one item, into the shard where the dot product of its demand with the residual capacity is highest.
Only a group that exceeds a shard in one of the three measures is cut, by a hash, into pieces of a quarter of a shard
(`PIECES`) at most, about. Groups that are heavy (over a `HEAVY`-th part of a shard in some measure, so at most
3 * shards * HEAVY of them) are placed on the driver, largest first; then single items move from the fullest shard to the
emptiest while that evens out the bytes. All other groups are dealt to lots by hash; each lot gets its share of every
shard's residual capacity and places its own groups in the same way, all lots at once. A lot holds at least `LOT` groups,
all small against its share, so each comes out even, and so does the sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import materialise

HEAVY = 64  # groups above one part in so many of a shard are placed on the driver
PIECES = 4  # pieces per shard of a group that exceeds a shard
LOT = 16_384  # groups of a lot at least; up to 16 times as many once there are 4096 lots
SLOT_ROWS = 500_000  # rows that are numbered in one task at most, about
WORD = r"[^\x20\x09-\x0D]+"


def place(demand: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """The shard of each item. demand: items x measures (bytes first); capacity: shards x measures, what each shard is to
    get. Ties go to the first item, and to the first shard."""
    scale = np.where(capacity.mean(axis=0) > 0, capacity.mean(axis=0), 1)
    scaled, residual = demand / scale, capacity / scale
    out = np.zeros(len(demand), np.int64)
    for i in np.argsort(-scaled.max(axis=1, initial=0), kind="stable"):
        item = scaled[i]
        score = residual @ item
        fits = residual[:, 0] >= item[0]
        out[i] = shard = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmax(residual[:, 0]))
        residual[shard] -= item
    even_out(out, demand[:, 0], capacity[:, 0])
    return out


def even_out(out: np.ndarray, sizes: np.ndarray, capacity: np.ndarray) -> None:
    """Moves an item of at most half the gap, or lets two change places, between the shard that is furthest above its
    capacity and the one furthest below, as long as that helps."""
    shards = len(capacity)
    load = np.bincount(out, weights=sizes, minlength=shards) - capacity
    for _ in range(8 * shards + 512):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        above, below = np.flatnonzero(out == high), np.flatnonzero(out == low)
        moves = above[(sizes[above] > 0) & (sizes[above] < gap)]
        best, swap = (None, 0.0), None
        if len(moves):
            i = moves[np.argmin(np.abs(sizes[moves] - gap / 2))]
            best = (i, min(sizes[i], gap - sizes[i]))
        if len(below) and len(above):
            ranked = below[np.argsort(sizes[below], kind="stable")]
            at = np.minimum(np.searchsorted(sizes[ranked], sizes[above] - gap / 2), len(ranked) - 1)
            change = sizes[above] - sizes[ranked[at]]
            gain = np.minimum(change, gap - change)
            j = int(np.argmax(gain))
            if gain[j] > best[1]:
                swap, best = ranked[at[j]], (above[j], gain[j])
        if best[0] is None or best[1] <= 0:
            break
        i = best[0]
        out[i] = low
        load[high] -= sizes[i]
        load[low] += sizes[i]
        if swap is not None:
            out[swap] = high
            load[low] -= sizes[swap]
            load[high] += sizes[swap]


def place_light(groups: DataFrame, capacity: np.ndarray, lots: int) -> DataFrame:
    """g1, g2 and shard of each group of groups (g1, g2, size, tokens, n); capacity: what the shards are still to get."""
    schema = pa.schema([("g1", pa.int64()), ("g2", pa.int64()), ("shard", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) for batch in batches]
        rows = np.concatenate(parts) if parts else np.zeros((0, 5), np.int64)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        if len(rows):
            demand = rows[:, 2:].astype(np.float64)
            share = np.maximum(capacity, 0)
            share = share * (demand.sum(axis=0) / np.maximum(share.sum(axis=0), 1))
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(place(demand, share).astype(np.int32))], schema=schema)

    return groups.select("g1", "g2", "size", "tokens", "n").repartition(lots, "g1").mapInArrow(run, "g1 long, g2 long, shard int")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, law (`bytes`), shard, slot and grown_shard (null under this law).

    size is the text's UTF-8 bytes plus 8; null text has no bytes and is a group of its own, apart from empty text, and
    its checksum is that of no bytes, 0. Equal texts share a shard unless their group exceeds a shard. Rows that repeat or
    have a null doc_id are rows like any other. Texts of any length count whole. Other columns are left aside. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    bare = F.coalesce(text, F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(bare) + 8).cast("long").alias("size"), F.crc32(bare).alias("text_crc32"), F.regexp_count(bare, F.lit(WORD)).cast("long").alias("tokens"), F.xxhash64(text.isNull(), text).alias("g1"), F.xxhash64(text, F.lit(7), text.isNull()).alias("g2"))
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "shard-rows")  # written once: rid stays
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    groups = materialise(groups, "shard-groups")
    total = groups.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.sum("n").alias("n"), F.count("*").alias("groups")).first()
    if not total["n"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    weight = F.greatest(*(F.col(c) * shards / F.lit(max(1, total[c])) for c in ("size", "tokens", "n")))
    heavy = groups.select("g1", "g2", weight.alias("weight"), "n").where(F.col("weight") > 1 / HEAVY)  # at most 3 * shards * HEAVY
    heavy = heavy.select("g1", "g2", F.when(F.col("weight") > 1, F.least(F.ceil(F.col("weight") * PIECES), F.col("n"))).otherwise(1).cast("long").alias("pieces"))
    heavy = spark.createDataFrame(heavy.collect(), "g1 long, g2 long, pieces long")
    piece = F.pmod(F.xxhash64(F.lit(11), "doc_id", "rid"), F.col("pieces"))
    own = rows.join(F.broadcast(heavy), ["g1", "g2"]).select("doc_id", "size", "text_crc32", "tokens", "g1", "g2", piece.alias("piece"))
    demand = own.groupBy("g1", "g2", "piece").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).orderBy("g1", "g2", "piece").collect()
    capacity = np.tile(np.array([total["size"], total["tokens"], total["n"]], np.float64) / shards, (shards, 1))
    items = np.array([(d["size"], d["tokens"], d["n"]) for d in demand], np.float64).reshape(-1, 3)
    found = place(items, capacity)
    for measure in range(3):
        capacity[:, measure] -= np.bincount(found, weights=items[:, measure], minlength=shards)
    placed = spark.createDataFrame([(d["g1"], d["g2"], d["piece"], int(s)) for d, s in zip(demand, found, strict=True)], "g1 long, g2 long, piece long, shard int")
    first = own.join(F.broadcast(placed), ["g1", "g2", "piece"]).select("doc_id", "size", "text_crc32", "g1", "shard")

    light = groups.join(F.broadcast(heavy), ["g1", "g2"], "left_anti")
    parts = place_light(light, capacity, max(1, min(total["groups"] // LOT, max(4096, total["groups"] // (16 * LOT)))))
    rest = rows.join(parts, ["g1", "g2"]).select("doc_id", "size", "text_crc32", "g1", "shard")  # heavy groups aren't here

    lots = max(16, -(-total["n"] // (shards * SLOT_ROWS)))
    lot = F.pmod(F.xxhash64(F.lit(13), "doc_id", "g1"), F.lit(lots))
    sharded = materialise(first.unionByName(rest).withColumn("lot", lot), "shard-places")
    sizes = sharded.groupBy("shard", "lot").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "lot", (F.sum("n").over(Window.partitionBy("shard").orderBy("lot")) - F.col("n")).alias("before"))
    order = Window.partitionBy("shard", "lot").orderBy("doc_id", "g1")
    numbered = sharded.withColumn("nth", F.row_number().over(order) - 1)
    return numbered.join(before, ["shard", "lot"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
