"""Dedup, sampling, splitting and dealing, all in hash order: results don't depend on partitions or reruns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.tags import MOTION_RICH
from quarrymill.functions.text import hash_order
from quarrymill.sources.store import materialise


def half_even(x: float) -> int:
    return round(x)


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first by order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def top_of_each(df: DataFrame, bucket: str, limit: int, seed: int, key: str) -> DataFrame:
    """At most `limit` rows of each bucket, a uniform sample; rank counts from 1."""
    order = Window.partitionBy(bucket).orderBy(hash_order(seed, key), key)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def bucket_limit(target: int) -> int:
    """How many candidates of a bucket are kept in reserve."""
    return max(6 * target, target + 100)


def split_train_val(df: DataFrame, train: int, val: int, ratio: float, seed: int, key: str, bucket: str = "source_bucket") -> DataFrame:
    """Disjoint train and val rows with the motion share `ratio` in both, numbered from 0 within a split (index)."""
    counts = {"train": train, "val": val}
    motion = {s: half_even(n * ratio) for s, n in counts.items()}
    rich = F.col(bucket) == MOTION_RICH
    first, both = F.when(rich, motion["train"]).otherwise(train - motion["train"]), F.when(rich, motion["train"] + motion["val"]).otherwise(train + val - motion["train"] - motion["val"])
    ranked = top_of_each(df, bucket, train + val, seed, key)
    chosen = ranked.where(F.col("rank") <= both).withColumn("split", F.when(F.col("rank") <= first, "train").otherwise("val"))
    order = Window.partitionBy("split").orderBy(hash_order(seed + 1, key), key)
    return chosen.drop("rank").withColumn("index", F.row_number().over(order) - 1)


def shortage(df: DataFrame, train: int, val: int, ratio: float, bucket: str = "source_bucket") -> str | None:
    """Why a split cannot be made, if so."""
    need_motion = half_even(train * ratio) + half_even(val * ratio)
    have = df.agg(F.count_if(F.col(bucket) == MOTION_RICH).alias("m"), F.count("*").alias("n")).first()
    if have["n"] - have["m"] < train + val - need_motion:
        return f"not enough natural candidates: need {train + val - need_motion}, got {have['n'] - have['m']}"
    if have["m"] < need_motion:
        return f"not enough motion-rich candidates: need {need_motion}, got {have['m']}"
    return None


def select_quota(df: DataFrame, target: int, ratio: float, seed: int, key: str, bucket: str = "source_bucket") -> DataFrame:
    """`target` rows with a motion quota of round(target * ratio), as far as there are so many; leftovers fill up.

    Adds in_quota and index. The window over all rows only sees 2 * target of them: those that rank in a bucket.
    """
    rich, chance = F.col(bucket) == MOTION_RICH, hash_order(seed, key)
    marked = df.withColumn("_rich", F.coalesce(rich, F.lit(False))).withColumn("_chance", chance)
    ranked = marked.withColumn("_rank", F.row_number().over(Window.partitionBy("_rich").orderBy("_chance", key))).where(F.col("_rank") <= target)
    every = Window.partitionBy()
    quota = F.least(F.lit(half_even(target * ratio)), F.count_if(F.col("_rich")).over(every))
    ranked = ranked.withColumn("in_quota", F.when(F.col("_rich"), F.col("_rank") <= quota).otherwise(F.col("_rank") <= target - quota))
    placed = ranked.withColumn("_place", F.row_number().over(Window.orderBy(~F.col("in_quota"), "_chance", key))).where(F.col("_place") <= target)
    last = Window.orderBy(hash_order(seed + 1, key), key)
    return placed.withColumn("index", F.row_number().over(last) - 1).drop("_rich", "_chance", "_rank", "_place")


def numbered(df: DataFrame, order: list[str | Column], ranges: int | None = None) -> DataFrame:
    """df with n, the row's place from 0 in the given order, without bringing all rows to one task: rows are dealt to
    ranges, numbered there, and shifted by the sizes of the ranges before.

    The dealt rows are a table in the shared folder, which both the rows and the sizes are read from: a second reading of
    df would draw other range bounds. Rows equal in the order are numbered in any order."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(ranges or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    placed = materialise(dealt.withColumn("_id", F.monotonically_increasing_id()), "numbered")  # range << 33 | place
    within = F.lit((1 << 33) - 1)
    sizes = placed.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count("*").alias("_size"))
    before = sizes.select("_part", F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    local = placed.withColumn("_part", F.shiftright("_id", 33))
    return local.join(F.broadcast(before), "_part").withColumn("n", F.col("_id").bitwiseAND(within) + F.coalesce("_before", F.lit(0))).drop("_part", "_id", "_before")


def stride(n: Column | str, world: int) -> Column:
    return F.pmod(F.col(n) if isinstance(n, str) else n, F.lit(world))


def batch(n: Column | str, size: int) -> Column:
    return F.floor((F.col(n) if isinstance(n, str) else n) / max(1, size))

