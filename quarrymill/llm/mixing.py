"""Mixing sources to target weights, with DataFrame functions only.

Targets: sources in order (code point, null last) weigh 5, 2, 1, repeating, and share 150 % of all words; no target
passes twice its source, and what is above is shared again by weight. In order of cap to weight, the level at which
the rest is shared is (total - caps before) / (weights from here), and the true level is the largest of these.

Blocks: a hash deals each source's documents to blocks, as many as it takes for about `BLOCK_ROWS` of them at most in
each, and at least `BLOCKS`; a source's blocks are taken in a permuted order. A target is so many full passes over all
blocks and a rest; the rest takes whole blocks in order and part of one, the border block, document by document in hash
order, the last one by words. So each source is met to the word.

Shards: every draw of a block is a unit of its source's quota. From the root on, a node ranks its units by a hash and
hands the first half to its left child, which makes the source counts of both a multivariate hypergeometric draw that
keeps all quotas exactly. The leaves' counts say how many blocks of each source a shard gets: it draws the next ones
of the source's permuted list, so no two shards share a draw. What a document gives is the sum over the draws of its
block. A shard then orders its documents by a hash of its own: `mixed` brings them together, `SLICES` ranges of that
order to a shard, and sorts each, so that the written rows are the shards one by one, each shuffled. There are as many
shards as it takes for `SHARD_WORDS` words each, and at least 2 ** `LEVELS`.

What windows of one partition see is small: a row per source for the targets, and for the tree's root a row per draw of
a block, at most 2 * (rows / BLOCK_ROWS + BLOCKS * sources + 1). Only documents of border blocks are sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import carried, drop, materialise, restored

WEIGHTS = (5, 2, 1)
BLOCKS = 128  # blocks of a source at least
BLOCK_ROWS = 65_536  # documents of a block at most, about
SHARE = 1.5
CAP = 2
LEVELS = 4  # 16 shards at least
SHARD_WORDS = 1 << 26
SLICES = 16  # tasks that sort a shard
SEED = 20260601
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """docs with _size (words), _known (source is not null), _name (source or empty), _block and _order (hashes)."""
    chance = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))
    return docs.withColumns({"_size": words(), "_known": F.col("source").isNotNull(), "_name": F.coalesce(F.col("source").cast("string"), F.lit("")), "_block": F.pmod(chance, F.lit(blocks)), "_order": F.xxhash64(chance, F.lit("order"))})


def targets(sizes: DataFrame) -> DataFrame:
    """sizes (_known, _name, source_size; a row per source) with nth, cap, target and quota (whole words)."""
    every = Window.partitionBy()
    nth = F.row_number().over(Window.orderBy(F.desc("_known"), "_name")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("nth") % len(WEIGHTS) + 1).cast("int")).cast("double")
    out = sizes.withColumn("nth", nth).withColumn("weight", weight).withColumn("cap", F.col("source_size") * CAP)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("total", F.sum("source_size").over(every) * SHARE).withColumn("caps", F.sum("cap").over(by_level) - F.col("cap")).withColumn("left", F.sum("weight").over(every) - F.sum("weight").over(by_level) + F.col("weight"))
    level = F.max((F.col("total") - F.col("caps")) / F.col("left")).over(every)
    out = out.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))
    return out.select("_known", "_name", "nth", "source_size", "target", F.least(F.round("target").cast("long"), "cap").alias("quota"))


def block_plan(rows: DataFrame) -> DataFrame:
    """For each block of each source (rows: _known, _name, _block, _size): its place in the permuted list, the full
    passes that take it, and for the rest of the quota `whole` or, for the border block, the words it gives."""
    blocks = rows.groupBy("_known", "_name", "_block").agg(F.sum("_size").alias("block_size"))
    plan = targets(blocks.groupBy("_known", "_name").agg(F.sum("block_size").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    plan = plan.withColumn("passes", passes).withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
    permuted = Window.partitionBy("_known", "_name").orderBy(F.xxhash64(F.lit(SEED), "_known", "_name", "_block"), "_block")
    plan = blocks.join(plan, ["_known", "_name"]).withColumn("place", F.row_number().over(permuted)).withColumn("so_far", F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    before = F.col("so_far") - F.col("block_size")
    return plan.withColumn("whole", (F.col("so_far") <= F.col("rest")) & (F.col("block_size") > 0)).withColumn("border", F.when((before < F.col("rest")) & (F.col("so_far") > F.col("rest")), F.col("rest") - before))


def shard_draws(plan: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Each draw of a block (nth source, _block, lap: 0, 1, ... for the passes; whether it is cut at the border) with the
    shard that draws it."""
    laps = F.col("passes") + F.when(F.col("whole") | F.col("border").isNotNull(), 1).otherwise(0)
    draws = plan.where(laps > 0).select("nth", "_block", "place", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), laps - 1), lambda lap: F.struct(lap.alias("lap"), (F.col("border").isNotNull() & (lap == laps - 1)).alias("cut")))).alias("d")).select("nth", "_block", "place", "d.lap", "d.cut")
    draws = draws.withColumn("unit", F.row_number().over(Window.partitionBy("nth").orderBy("lap", "place")))
    nodes = draws.select("nth", "unit", F.lit(0).alias("node"))
    for level in range(levels):  # the tree: counts of each source in a node's half are drawn without replacement
        chance = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(SEED + level), "nth", "unit"), "nth", "unit")
        half = F.row_number().over(chance) * 2 <= F.count("*").over(Window.partitionBy("node"))
        nodes = nodes.select("nth", "unit", (F.col("node") * 2 + F.when(half, 0).otherwise(1)).alias("node"))
    counts = nodes.groupBy("nth", "node").agg(F.count("*").alias("quota"))
    upto = F.sum("quota").over(Window.partitionBy("nth").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumn("upto", upto)
    counts = counts.select("nth", F.explode(F.sequence(F.col("upto") - F.col("quota") + 1, F.col("upto"))).alias("unit"), F.col("node").alias("shard"))  # the next ones of the list
    return draws.join(counts, ["nth", "unit"]).select("nth", "_block", "lap", "cut", "shard")


def mix(docs: DataFrame) -> DataFrame:
    """docs with _size, _source_size, _target, _taken (words, repeats counted) and _draws: for each draw that takes the
    document its lap, shard, the words it gives, and a hash for its place in the shard.

    Null text and text without words have size 0 and are never taken. Null sources are one source, the last. Rows that
    repeat are documents of their own; which of two equal rows is cut at a border makes no difference to the result. An
    empty table gives an empty result. Texts of any length count whole.
    """
    blocks = max(BLOCKS, -(-docs.count() // BLOCK_ROWS))
    rows = dealt(docs, blocks)
    plan = materialise(block_plan(rows.select("_known", "_name", "_block", "_size")), "mix-blocks")
    quota = plan.agg(F.sum(F.col("passes") * F.col("block_size") + F.when(F.col("whole"), F.col("block_size")).otherwise(F.coalesce("border", F.lit(0))))).first()[0] or 1
    levels = max(LEVELS, math.ceil(math.log2(max(1, quota / SHARD_WORDS))))
    draws = shard_draws(plan, levels).groupBy("nth", "_block").agg(F.array_sort(F.collect_list(F.struct("lap", "shard", "cut"))).alias("_drawn"))
    joint = materialise(plan.join(draws, ["nth", "_block"], "left").select("_known", "_name", "_block", "source_size", "target", "border", F.coalesce("_drawn", F.array().cast("array<struct<lap:long,shard:int,cut:boolean>>")).alias("_drawn")), "mix-plan")
    drop(plan)
    joined = rows.join(joint, ["_known", "_name", "_block"])
    full = joined.where("border IS NULL").withColumn("_rest", F.lit(0).cast("long"))
    upto = F.sum("_size").over(Window.partitionBy("_known", "_name", "_block").orderBy("_order", "doc_id", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    border = joined.where("border IS NOT NULL").withColumn("_rest", F.greatest(F.lit(0).cast("long"), F.least(F.col("_size"), F.col("border") - upto + F.col("_size"))))
    given = F.transform("_drawn", lambda d: F.struct(d["lap"].alias("lap"), d["shard"].alias("shard"), F.when(d["cut"], F.col("_rest")).otherwise(F.col("_size")).alias("words"), F.xxhash64(F.col("_order"), d["lap"], d["shard"]).alias("order")))
    out = full.unionByName(border).withColumn("_draws", F.filter(given, lambda d: d["words"] > 0))
    taken = F.aggregate("_draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return out.select(*docs.columns, "_size", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), taken.alias("_taken"), "_draws")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, and for the draws of each document, in order of the laps and
    comma-joined: shards, words given, and places (hashes that order a shard)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    out = mix(narrow)
    listed = lambda field: F.concat_ws(",", F.transform("_draws", lambda d: d[field].cast("string")))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), listed("shard").alias("shards"), listed("words").alias("words"), listed("order").alias("places"))


def mixed(docs: DataFrame, places: bool = False) -> DataFrame:
    """The mix itself: docs' columns, a row per draw that takes a document, cut after the words given where a border runs
    through it (n_chars, if there is such a column, follows). Documents that are not taken are left out.

    Rows come shard by shard, each in the order of its hashes; `places` adds both as mix_shard and mix_order.
    """
    out = mix(carried(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")))
    rows = out.select("carried", "text", "_size", F.explode("_draws").alias("_draw")).withColumn("_cut", F.when(F.col("_draw.words") < F.col("_size"), F.col("_draw.words")).otherwise(0).cast("int"))
    head = F.expr(r"regexp_extract(text, concat('^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){', _cut, '}+'), 0)")
    rows = rows.select("carried", F.when(F.col("_cut") > 0, head).alias("_head"), "_cut", F.col("_draw.shard").alias("_shard"), F.col("_draw.order").alias("_order"))
    slices = F.shiftright("_order", 64 - SLICES.bit_length() + 1)  # the order's top bits, so a slice is a range of it
    shuffled = rows.repartition(F.col("_shard"), slices).sortWithinPartitions("_shard", "_order")
    kept = restored(shuffled, docs, F.col("_head"), F.col("_cut") > 0, {"mix_shard": F.col("_shard"), "mix_order": F.col("_order")} if places else {})
    return kept
