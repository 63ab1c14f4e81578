"""Leased work from an event log, in batch: who holds an item, whether the lease is stale, and how the queue stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import col

LEASE_SECONDS = 1800


def is_stale(now: Column, expires_at: Column | str, updated_at: Column | str, modified_at: Column | str | None = None, lease: int = LEASE_SECONDS) -> Column:
    """Epoch seconds. Without a readable lease (expiry and update null) the lock's own age decides."""
    expires, updated = col(expires_at), col(updated_at)
    age = now - col(modified_at) > lease if modified_at is not None else F.lit(False)
    return F.when(expires.isNull() & updated.isNull(), F.coalesce(age, F.lit(False))).otherwise(now > F.greatest(F.coalesce(expires, F.lit(0.0)), F.coalesce(updated, F.lit(0.0)) + lease))


def heartbeat_gaps(events: DataFrame, key: str = "user_id", ts: str = "ts", lease: int = LEASE_SECONDS) -> DataFrame:
    """events with next_ts, gap_seconds and lapsed: whether the lease ran out before the holder's next heartbeat."""
    order = Window.partitionBy(key).orderBy(ts, "event_id")
    gap = F.unix_micros(F.lead(F.col(ts).cast("timestamp")).over(order)) - F.unix_micros(F.col(ts).cast("timestamp"))
    return events.withColumn("gap_us", gap).withColumn("lapsed", F.coalesce(F.col("gap_us") > lease * 1_000_000, F.lit(False)))


def lease_sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", lease: int = LEASE_SECONDS) -> DataFrame:
    """Runs of heartbeats whose gaps stay within the lease: key, start, heartbeats."""
    held = events.select(key, F.col(ts).cast("timestamp").alias("ts"))
    return held.groupBy(key, F.session_window("ts", f"{lease} seconds").alias("w")).agg(F.count("*").alias("heartbeats")).select(key, F.col("w.start").alias("start"), "heartbeats")


def queue_status(records: DataFrame, done: DataFrame, locks: DataFrame, now: Column, key: str, lease: int = LEASE_SECONDS, examples: int = 10) -> DataFrame:
    """One row: target_count, complete, incomplete, active_locks, stale_locks, done and the first lock names."""
    marked = records.join(done.select(key).distinct().withColumn("_done", F.lit(True)), key, "left")
    counts = marked.agg(F.count("*").alias("target_count"), F.count("_done").alias("complete"))
    stale = is_stale(now, "expires_at", "updated_at", None, lease)
    held = locks.agg(F.count_if(~stale).alias("active_locks"), F.count_if(stale).alias("stale_locks"))
    first = locks.select("lock").orderBy("lock").limit(examples).agg(F.array_sort(F.collect_list("lock")).alias("lock_examples"))
    out = counts.crossJoin(held).crossJoin(first)
    return out.select("target_count", "complete", (F.col("target_count") - F.col("complete")).alias("incomplete"), "active_locks", "stale_locks", (F.col("complete") >= F.col("target_count")).alias("done"), "lock_examples")


def worker_order(df: DataFrame, key: str, worker: str, lap: int) -> DataFrame:
    """df with order_key: each worker and lap visits the records in another order."""
    return df.withColumn("order_key", F.sha1(F.concat(F.lit(f"{worker}:{lap}:"), F.col(key).cast("string"))))


def claim(records: DataFrame, done: DataFrame, held: DataFrame, key: str, worker: str, lap: int, size: int) -> DataFrame:
    """The next `size` records for a worker: neither done nor held by a fresh lease, first in its own order."""
    free = records.join(done.select(key).distinct(), key, "left_anti").join(held.select(key).distinct(), key, "left_anti")
    return worker_order(free, key, worker, lap).orderBy("order_key", key).limit(max(1, size))


def commit(results: DataFrame, leases: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """results (key, worker_id, token) with outcome: lost_lock_after_render, completed_elsewhere or ok. Fenced by token."""
    owners = leases.select(key, F.col("worker_id").alias("_worker"), F.col("token").alias("_token"))
    joined = results.join(owners, key, "left").join(done.select(key).distinct().withColumn("_done", F.lit(True)), key, "left")
    owns = F.coalesce((F.col("_worker") == F.col("worker_id")) & (F.col("_token") == F.col("token")), F.lit(False))
    return joined.withColumn("outcome", F.when(~owns, "lost_lock_after_render").when(F.col("_done"), "completed_elsewhere").otherwise("ok")).drop("_worker", "_token", "_done")


def worker_events(events: DataFrame) -> DataFrame:
    """Counts, failures and total runtime by worker and event type of a log with a type column `event`."""
    return events.groupBy("worker_id", "event").agg(F.count("*").alias("n"), F.round(F.sum("runtime_s"), 4).alias("runtime_s"))
