"""The registered stream queries over the event log, each with its SQL: a stream that has ended must equal the batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.leases import LEASE_SECONDS
from quarrymill.sources.io import parquet_table as table
from quarrymill.sources.store import new_path
from quarrymill.streaming import leases as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MICROS = "epoch_us(ts)"


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of events as a stream; the pattern lets a single file be read like a folder."""
    path = f"{sf_dir}/events.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


@query(f"""WITH b AS (SELECT user_id, {MICROS} AS t, CASE WHEN {MICROS} - lag({MICROS}) OVER (PARTITION BY user_id ORDER BY ts) < 1800000000 THEN 0 ELSE 1 END AS s FROM events),
  g AS (SELECT user_id, t, sum(s) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM b) SELECT user_id, min(t) AS start_us, COUNT(*) AS heartbeats FROM g GROUP BY user_id, g""")
def stream_lease_sessions(spark, sf_dir):
    """All sessions of the log: a last event of nobody, far behind the others, lets the watermark close every session."""
    path = new_path(spark, "end-of-log")
    ends = table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("ts"))
    ends.select(F.lit(None).cast("long").alias("user_id"), (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")).write.parquet(path)
    log = event_log(spark, sf_dir).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    both = log.unionByName(spark.readStream.schema(log.schema).parquet(path))
    out = stream.run_once(stream.stream_sessions(both))
    return out.where("user_id IS NOT NULL").select("user_id", F.unix_micros("start").alias("start_us"), "heartbeats")


ACTIONS = ["claim", "heartbeat", "release"]
MACHINE = f"""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS item, 'w' || event_id % 2 AS w, 't' || event_id % 2 AS t, CASE WHEN event_id % 40 = 0 THEN 'commit' ELSE ['claim', 'heartbeat', 'release'][(event_id // 2) % 3 + 1] END AS action,
    {MICROS} / 1e6 AS tm, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
  r AS (SELECT DISTINCT item, 0::BIGINT AS n, '' AS w, '' AS t, '' AS action, '' AS outcome, 0::DOUBLE AS tm, '' AS hw, '' AS ht, 0::DOUBLE AS ex, false AS complete, '' AS xw, '' AS xt, 0::DOUBLE AS xe FROM e
  UNION ALL SELECT item, n, w, t, action, outcome, tm,
      CASE outcome WHEN 'claimed' THEN w WHEN 'ok' THEN '' WHEN 'released' THEN '' ELSE hw END, CASE outcome WHEN 'claimed' THEN t WHEN 'ok' THEN '' WHEN 'released' THEN '' ELSE ht END,
      CASE outcome WHEN 'claimed' THEN tm + {LEASE_SECONDS} WHEN 'refreshed' THEN greatest(ex, tm + {LEASE_SECONDS}) WHEN 'ok' THEN 0 WHEN 'released' THEN 0 ELSE ex END, complete OR outcome = 'ok', xw, xt, xe
    FROM (SELECT *, CASE WHEN action = 'claim' THEN CASE WHEN complete THEN 'completed_elsewhere' WHEN ht <> '' THEN 'held' ELSE 'claimed' END
        WHEN ht = '' OR ht <> t OR hw <> w THEN CASE WHEN complete AND action = 'commit' THEN 'completed_elsewhere' ELSE 'lost_lock' END
        WHEN action = 'heartbeat' THEN 'refreshed' WHEN action = 'commit' THEN 'ok' ELSE 'released' END AS outcome
      FROM (SELECT e.item, e.n, e.w, e.t, e.action, e.tm, r.complete, CASE WHEN late THEN '' ELSE r.hw END AS hw, CASE WHEN late THEN '' ELSE r.ht END AS ht, CASE WHEN late THEN 0 ELSE r.ex END AS ex,
          CASE WHEN late THEN r.hw ELSE '' END AS xw, CASE WHEN late THEN r.ht ELSE '' END AS xt, CASE WHEN late THEN r.ex ELSE 0 END AS xe
        FROM (SELECT r.*, e.tm AS now, r.ht <> '' AND e.tm > r.ex AS late FROM r JOIN e ON e.item = r.item AND e.n = r.n + 1) r JOIN e ON e.item = r.item AND e.n = r.n + 1))),
  mark AS (SELECT max({MICROS}) / 1e6 - 1800 AS m FROM events)
  SELECT item AS prompt_id, w AS worker_id, t AS token, action, outcome, tm AS updated_at, ex AS expires_at FROM r WHERE n > 0
  UNION ALL SELECT item, xw, xt, 'expire', 'stale', xe, 0 FROM r WHERE xt <> ''
  UNION ALL SELECT item, hw, ht, 'expire', 'stale', ex, 0 FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY item ORDER BY n DESC) = 1), mark WHERE ht <> '' AND ex < m"""


@query(MACHINE)
def stream_lease_state(spark, sf_dir):
    """The lease machine over the event log: items are users, the event's number says who does what."""
    action = F.when(F.col("event_id") % 40 == 0, "commit").otherwise(F.element_at(F.array(*map(F.lit, ACTIONS)), (F.floor(F.col("event_id") / 2) % 3 + 1).cast("int")))
    events = event_log(spark, sf_dir).select("event_id", "ts", F.col("user_id").cast("string").alias("prompt_id"), F.concat(F.lit("w"), F.col("event_id") % 2).alias("worker_id"), F.concat(F.lit("t"), F.col("event_id") % 2).alias("token"), action.alias("action"))
    return stream.run_once(stream.stream_leases(events))


@query("SELECT user_id AS worker_id, event_type AS event, COUNT(*) AS n, CAST(sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS runtime_s FROM events GROUP BY 1, 2")
def stream_worker_status(spark, sf_dir):
    """A log of JSON lines, in three files that arrive one by one, and the status after the last of them."""
    log, status, mark = (new_path(spark, x) for x in ("worker-log", "worker-status", "worker-mark"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("worker_id"), F.col("event_type").alias("event"), F.round("value", 2).cast("decimal(18,2)").alias("runtime_s"))
    events.repartition(3).write.json(log)
    source = spark.readStream.schema("worker_id long, event string, runtime_s decimal(18,2)").option("maxFilesPerTrigger", 1).json(log)
    stream.status_stream(source, status, mark)
    return spark.read.parquet(status).withColumn("runtime_s", F.col("runtime_s").cast("double"))


COMMITTED = """WITH o AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1),
  v AS (SELECT v.event_id, v.user_id, v.event_id % 4 = o.e % 4 AND v.event_id % 3 = o.e % 3 AS own FROM events v JOIN o ON o.user_id = v.user_id)
  SELECT event_id, CASE WHEN NOT own THEN 'lost_lock_after_render' WHEN row_number() OVER (PARTITION BY user_id, own ORDER BY event_id) > 1 THEN 'completed_elsewhere' ELSE 'ok' END AS outcome FROM v"""


@query(COMMITTED)
def stream_commits(spark, sf_dir):
    """Results of all events, in order of their numbers in four files, committed against the table of owners."""
    log, owners, out, mark = (new_path(spark, x) for x in ("results", "owners", "commits", "commits-mark"))
    events = table(spark, sf_dir, "events")
    named = lambda e: (F.concat(F.lit("w"), F.col(e) % 4).alias("worker_id"), F.concat(F.lit("t"), F.col(e) % 3).alias("token"))
    events.groupBy(F.col("user_id").alias("prompt_id")).agg(F.max("event_id").alias("e")).select("prompt_id", *named("e")).write.parquet(owners)
    rows = events.select("event_id", F.col("user_id").alias("prompt_id"), *named("event_id"))
    bounds = [0.25, 0.5, 0.75]
    cuts = rows.agg(F.percentile_approx("event_id", bounds).alias("c")).first()["c"] or [0, 0, 0]
    part = sum(((F.col("event_id") > cut).cast("int") for cut in cuts), F.lit(0))
    for n in range(4):  # one file after the other, so that they arrive in this order
        rows.where(part == n).coalesce(1).write.mode("append").parquet(log)
        stream.commit_once(spark.readStream.schema(rows.schema).parquet(log), owners, out, mark)
    return spark.read.parquet(out).select("event_id", "outcome")
