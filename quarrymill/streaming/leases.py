"""Leases as a stream of events: sessions under a watermark, the full claim, heartbeat, release and expiry machine, the
status of the queue after each batch, and commits fenced by ownership."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarrymill.operators.leases import LEASE_SECONDS, commit, worker_events
from quarrymill.sources.store import new_path

STATES = "prompt_id string, worker_id string, token string, action string, outcome string, updated_at double, expires_at double"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_sessions(events: DataFrame, key: str = "user_id", lease: int = LEASE_SECONDS, late: str = "30 minutes") -> DataFrame:
    """lease_sessions of a stream: a session is handed on once the watermark has passed its end."""
    held = events.select(key, F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    return held.groupBy(key, F.session_window("ts", f"{lease} seconds").alias("w")).agg(F.count("*").alias("heartbeats")).select(key, F.col("w.start").alias("start"), "heartbeats")


class LeaseMachine(StatefulProcessor):
    """One lease per item. Events: claim, heartbeat, release, commit, each with worker and token; those of a batch are
    taken in order of time, then of event_id.

    A claim succeeds if nobody holds the item or the holder's lease ran out; heartbeats and releases count only from
    the holder; a commit by anyone else is lost, and after the first one the item is complete for good. A lease that ran
    out gives a row of its own, `expire` and `stale`, at its expiry: before the item's next event, or by a timer once the
    watermark has passed it. So the rows don't depend on how events are cut into batches, as long as none is late.
    """

    def __init__(self, lease: int = LEASE_SECONDS):
        self.lease = lease

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "worker_id string, token string, expires_at double, complete boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        worker, token, expires, complete = self.held.get() if self.held.exists() else ("", "", 0.0, False)
        out = []
        events = sorted((e for frame in rows for e in frame[["at", "event_id", "worker_id", "token", "action"]].itertuples(index=False)), key=lambda e: (e.at, e.event_id))
        for e in events:
            if token and e.at > expires:
                out.append((key[0], worker, token, "expire", "stale", float(expires), 0.0))
                worker, token, expires = "", "", 0.0
            owner = bool(token) and e.token == token and e.worker_id == worker
            if e.action == "claim":
                outcome = "completed_elsewhere" if complete else "held" if token else "claimed"
                if outcome == "claimed":
                    worker, token, expires = e.worker_id, e.token, e.at + self.lease
            elif not owner:
                outcome = "completed_elsewhere" if complete and e.action == "commit" else "lost_lock"
            elif e.action == "heartbeat":
                outcome, expires = "refreshed", max(expires, e.at + self.lease)
            else:
                outcome = "ok" if e.action == "commit" else "released"
                complete = complete or e.action == "commit"
                worker, token, expires = "", "", 0.0
            out.append((key[0], e.worker_id, e.token, e.action, outcome, float(e.at), float(expires)))
        self.held.update((worker, token, float(expires), complete))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if token:
            self.handle.registerTimer(int(expires * 1000) + 1)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STATES.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        worker, token, expires, complete = self.held.get()
        self.held.update(("", "", 0.0, complete))
        row = (key[0], worker, token, "expire", "stale", float(expires), 0.0)
        yield pd.DataFrame([row] if token else [], columns=[c.split()[0] for c in STATES.split(", ")])

    def close(self) -> None:
        pass


def stream_leases(events: DataFrame, lease: int = LEASE_SECONDS, late: str = "30 minutes") -> DataFrame:
    """events (event_id, ts, prompt_id, worker_id, token, action) to one row per event with its outcome, and one per
    lease that ran out. Needs the RocksDB state store (`run_once` sets it for its query)."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).withColumn("at", F.unix_micros("ts") / 1e6)
    return timed.groupBy("prompt_id").transformWithStateInPandas(statefulProcessor=LeaseMachine(lease), outputStructType=T.StructType.fromDDL(STATES), outputMode="Append", timeMode="EventTime")


def event_stream(spark, path: str, schema: str | T.StructType) -> DataFrame:
    """A folder of JSON lines as a stream of events; lines that don't parse are rows of nulls."""
    return spark.readStream.schema(schema).option("mode", "PERMISSIVE").json(path)


def run_once(stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """All that is available, appended to a Parquet table in the shared folder and read back: no row passes the driver,
    and a rerun with the same checkpoint goes on where the last one ended. For reports and tests."""
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    path = new_path(spark, "stream")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint or new_path(spark, "stream-log"))
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema(stream.schema).parquet(path)


def status_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Counts, failures and run times by worker and event, rewritten in full after each batch (complete mode): a reader
    of path always finds the state after the last batch."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = worker_events(stream).writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def commit_once(results: DataFrame, leases: str, path: str, checkpoint: str, key: str = "prompt_id", order: str = "event_id") -> None:
    """A stream of results (key, worker_id, token, order) committed to path: every row with its outcome.

    Ownership is read again from the table of leases for each batch, just before it commits; what earlier batches
    committed is complete. Of several good results for an item in one batch the first by order is `ok`, so outcomes don't
    depend on how results are cut into batches. A batch's number names its folder, so a repeated batch replaces itself.
    """
    spark = results.sparkSession

    def save(batch: DataFrame, number: int) -> None:
        there = [path] if number and _exists(spark, path) else []
        done = spark.read.schema(committed).parquet(*there).where((F.col("outcome") == "ok") & (F.col("batch") != number)).select(key) if there else spark.createDataFrame([], T.StructType([batch.schema[key]]))
        judged = commit(batch, spark.read.parquet(leases), done, key)
        first = F.row_number().over(Window.partitionBy(key, "outcome").orderBy(order))
        judged = judged.withColumn("outcome", F.when((F.col("outcome") == "ok") & (first > 1), "completed_elsewhere").otherwise(F.col("outcome")))
        judged.write.mode("overwrite").parquet(f"{path}/batch={number}")

    committed = T.StructType([*results.schema.fields, T.StructField("outcome", T.StringType()), T.StructField("batch", T.IntegerType())])
    results.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def sink_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """All that is available, committed exactly once to Parquet: a batch's number names its folder, so a repeated batch
    replaces itself."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
