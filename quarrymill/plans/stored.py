"""The registered queries of sources and sinks, each with its SQL: tables are written through a sink to the shared
folder, read back through a source, and must be what SQL says of the table itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions import text
from quarrymill.operators import compose, manifests, qc, render, rewrite, summaries
from quarrymill.operators.leases import is_stale
from quarrymill.plans import oracle, queries
from quarrymill.sources import io
from quarrymill.sources.io import parquet_table as table
from quarrymill.sources.store import materialise, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'long'}" for k, v in values.items()))


def small_files(spark: SparkSession, df: DataFrame, value: str, label: str, glob: bool = True) -> str:
    """A text file for each row of a small table."""
    path = new_path(spark, label)
    n = F.monotonically_increasing_id().alias("n")
    df.select(n, F.col(value).alias("value")).write.partitionBy("n").text(path)
    return f"{path}/*/*.txt" if glob else path


# --- sources


@query("SELECT CAST(d.doc_id AS VARCHAR) AS uuid, md5(COALESCE(d.text, '')) AS prompt_md5, COALESCE(CAST(l.toxic AS VARCHAR), '') AS toxicity FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def source_csv_prompts(spark, sf_dir):
    """A CSV of quoted texts, some columns of the schema missing."""
    path = new_path(spark, "prompts-csv")
    rows = queries.scored(spark, sf_dir).select(F.col("doc_id").alias("uuid"), F.col("text").alias("prompt"), F.col("toxic").alias("toxicity"))
    io.write_csv(rows, path, ["uuid", "prompt", "toxicity"])
    return io.raw_prompts(spark, path).select("uuid", F.md5("prompt").alias("prompt_md5"), "toxicity")


@query("SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def source_jsonl(spark, sf_dir):
    path = new_path(spark, "turns")
    turns = table(spark, sf_dir, "conversations")
    io.write_jsonl(turns, path)
    return io.jsonl(spark, path, turns.schema).select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query("SELECT COUNT(*) AS rows, least(COUNT(*), 10) AS limited, 0::BIGINT AS missing FROM labels")
def source_jsonl_limit(spark, sf_dir):
    """A limit that the scan stops at, and a missing file that counts as empty."""
    path, schema = new_path(spark, "labels"), "doc_id long, quality int, toxic int"
    io.write_jsonl(table(spark, sf_dir, "labels"), path)
    return one_row(spark, rows=io.jsonl(spark, path, schema).count(), limited=io.jsonl(spark, path, schema, limit=10).count(), missing=io.jsonl(spark, path + "-none", schema, missing_ok=True).count())


@query(f"WITH {oracle.COMPOSED} SELECT printf('bank_train_%08d', doc_id) AS prompt_id, prompt, subject_group, style, mood FROM composed")
def source_prompt_bank(spark, sf_dir):
    """A bank of prompts with nested tags."""
    path = new_path(spark, "bank")
    made = queries.composed(spark, sf_dir)
    rows = made.select(text.row_id("bank", "train", "doc_id").alias("prompt_id"), "prompt", F.struct("subject_group", "subject_type", "style", "camera", "lighting", "mood", "scene").alias("tags"))
    io.write_jsonl(rows, path)
    return io.jsonl(spark, path, rows.schema).select("prompt_id", "prompt", "tags.subject_group", "tags.style", "tags.mood")


BROKEN = "SELECT NULL::INT AS n_nationkey, NULL::VARCHAR AS n_name, true AS sidecar_error FROM region"


@query(f"SELECT n_nationkey, n_name, false AS sidecar_error FROM nation UNION ALL {BROKEN}")
def source_sidecars(spark, sf_dir):
    """A folder of indented JSON documents, some of them broken."""
    good = table(spark, sf_dir, "nation").select(F.to_json(F.struct("n_nationkey", "n_name"), {"pretty": "true"}).alias("value"))
    bad = table(spark, sf_dir, "region").select(F.concat(F.lit('{"n_name": "'), "r_name").alias("value"))
    path = small_files(spark, good.unionByName(bad).coalesce(1), "value", "sidecars")
    return io.sidecars(spark, path, T.StructType.fromDDL("n_nationkey int, n_name string"), ordered=True).select("n_nationkey", "n_name", "sidecar_error")


@query("SELECT n_name AS prompt_id, 'w' || n_regionkey AS worker_id, 1000.0::DOUBLE + n_nationkey * 100 + 1800 < 4000 AS stale FROM nation UNION ALL SELECT NULL, NULL, true FROM region")
def source_lease_files(spark, sf_dir):
    """Lock files, some unreadable; those are stale by their own age."""
    n = table(spark, sf_dir, "nation")
    good = n.select(F.to_json(F.struct(F.col("n_name").alias("prompt_id"), F.concat(F.lit("w"), "n_regionkey").alias("worker_id"), (F.lit(1000.0) + F.col("n_nationkey") * 100).alias("updated_at"))).alias("value"))
    bad = table(spark, sf_dir, "region").select(F.lit("{").alias("value"))
    path = small_files(spark, good.unionByName(bad).coalesce(1), "value", "leases")
    return io.lease_files(spark, path).select("prompt_id", "worker_id", is_stale(F.lit(4000.0), "expires_at", "updated_at", F.lit(0.0)).alias("stale"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS prompt_id, 'v' || l_linenumber AS video, CAST(l_partkey AS VARCHAR) AS prompt FROM lineitem
  WHERE l_orderkey % 10 > 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1""")
def source_metadata_last_row(spark, sf_dir):
    """A metadata CSV with several rows for an id, in the order of their numbers, and rows without an id."""
    path = new_path(spark, "metadata")
    key = F.when(F.col("l_orderkey") % 10 > 0, F.col("l_orderkey").cast("string")).otherwise("")
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("v"), "l_linenumber").alias("video"), F.col("l_partkey").alias("prompt"), key.alias("prompt_id"), "l_linenumber", "l_partkey")
    io.write_csv(rows.repartition("prompt_id").sortWithinPartitions("prompt_id", "l_linenumber", "l_partkey"), path)
    return io.metadata_csv(spark, path).select("prompt_id", "video", "prompt")


@query("SELECT COUNT(*) AS files, CAST(sum(len(n_name) + 1) AS BIGINT) AS bytes FROM nation")
def source_listing(spark, sf_dir):
    path = small_files(spark, table(spark, sf_dir, "nation").coalesce(1), "n_name", "listing", glob=False)
    return io.listing(spark, path, "*.txt").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("SELECT COUNT(*) FILTER (WHERE doc_id % 3 > 0) AS lines, 0::BIGINT AS missing FROM documents")
def source_line_count(spark, sf_dir):
    """Lines of which every third is blank; a missing file has none."""
    path = new_path(spark, "lines")
    table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 > 0, F.to_json(F.struct("doc_id"))).otherwise("  ").alias("value")).write.text(path)
    return one_row(spark, lines=io.count_lines(spark, path), missing=io.count_lines(spark, path + "-none"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'a' || c_custkey WHEN 1 THEN 'b' || c_custkey WHEN 2 THEN 'c' || c_custkey ELSE '' END AS base_url, CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS workers FROM customer")
def source_config_aliases(spark, sf_dir):
    """Configuration documents that name a value by one of several keys; empty and zero values don't count."""
    c = table(spark, sf_dir, "customer")
    value = lambda n, letter: F.when(F.col("c_custkey") % 4 == n, F.concat(F.lit(letter), "c_custkey")).otherwise("")
    config = F.to_json(F.struct(value(0, "a").alias("base_url"), value(1, "b").alias("LLM_BASE_URL"), value(2, "c").alias("api_url"), F.col("c_nationkey").alias("workers")))
    return c.select("c_custkey", text.config_value(config, "base_url", "LLM_BASE_URL", "api_url", "LLM_API_URL").alias("base_url"), text.config_value(config, "workers").alias("workers"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{g['name']}', '{g['subject_type']}', {len(g['subjects'])}::BIGINT, '{g['actions'][0]}')" for g in compose.TAXONOMY["subject_groups"]) + ") t(name, subject_type, subjects, first_action)")
def source_taxonomy(spark, sf_dir):
    path = new_path(spark, "taxonomy")
    io.write_document(spark, compose.TAXONOMY, path)
    groups = io.taxonomy(spark, path)["subject_groups"]
    return spark.createDataFrame([(g["name"], g["subject_type"], len(g["subjects"]), g["actions"][0]) for g in groups], "name string, subject_type string, subjects long, first_action string")


@query("SELECT DISTINCT printf('doc_%08d', doc_id) AS prompt_id FROM labels WHERE doc_id % 7 > 0")
def source_existing_ids(spark, sf_dir):
    """Ids of finished records; lines that break off in the middle, and repeated ones."""
    path = new_path(spark, "finished")
    ids = table(spark, sf_dir, "labels").select("doc_id", F.format_string("doc_%08d", "doc_id").alias("prompt_id"))
    line = F.to_json(F.struct("prompt_id"))
    ids.unionByName(ids).select(F.when(F.col("doc_id") % 7 > 0, line).otherwise(F.substring(line, 1, 12)).alias("value")).write.text(path)
    return io.existing_ids(spark, path)


def decode_text(content: bytes) -> dict | None:
    """A stand-in for a video decoder: a frame for each byte, whose luma is the byte. Foreign contents raise."""
    frames = [float(b) for b in content.rstrip(b"\n")]
    if frames[0] == 73.0:
        return None
    if frames[0] == 85.0:
        raise OSError("broken container")
    return {"width": 8, "height": 8, "fps": 16.0, "frame_count": len(frames), "luma_means": frames, "luma_stds": frames, "lap_vars": frames, "diffs": [abs(b - a) for a, b in zip(frames, frames[1:], strict=False)]}


@query("""SELECT len(n_name) + 1 AS video_bytes, left(n_name, 1) IN ('I', 'U') AS open_failed, CASE WHEN left(n_name, 1) NOT IN ('I', 'U') THEN len(n_name)::BIGINT END AS frame_count,
  CASE WHEN left(n_name, 1) NOT IN ('I', 'U') THEN round(list_avg(list_transform(string_split(n_name, ''), lambda c: ascii(c)::DOUBLE)), 4) END AS luma_mean FROM nation""")
def source_video_probe(spark, sf_dir):
    """Media files through the decoder seam; a decoder that gives up, and one that raises, are files that don't open."""
    path = small_files(spark, table(spark, sf_dir, "nation").coalesce(1), "n_name", "videos", glob=False)
    found = io.frames(spark, f"{path}/*", decode_text, "*.txt")
    return qc.with_metrics(found).select("video_bytes", "open_failed", "frame_count", "luma_mean")


# --- sinks


@query("SELECT (SELECT COUNT(*) FROM region) AS replaced, (SELECT COUNT(*) FROM region) + (SELECT COUNT(*) FROM nation) AS appended, true AS protected")
def sink_jsonl_modes(spark, sf_dir):
    """Overwrite replaces a whole table, append adds to it, and the default refuses to touch what is there."""
    path, schema = new_path(spark, "modes"), "k int, name string"
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    io.write_jsonl(n, path)
    io.write_jsonl(r, path, "overwrite")
    replaced = io.jsonl(spark, path, schema).count()
    io.write_jsonl(n, path, "append")
    try:
        io.write_jsonl(n, path)
        protected = False
    except AnalysisException:
        protected = True
    return one_row(spark, replaced=replaced, appended=io.jsonl(spark, path, schema).count(), protected=protected)


@query("SELECT printf('doc_%08d', doc_id) AS prompt_id, COALESCE(source, '') AS source, lang FROM documents")
def sink_jsonl_text(spark, sf_dir):
    """Records as lines of UTF-8 with null fields left out, read back as plain text."""
    path = new_path(spark, "records")
    io.write_jsonl(table(spark, sf_dir, "documents").select(F.format_string("doc_%08d", "doc_id").alias("prompt_id"), F.coalesce("source", F.lit("")).alias("source"), "lang"), path)
    return spark.read.text(path).select(*(F.get_json_object("value", f"$.{c}").alias(c) for c in ("prompt_id", "source", "lang")))


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS prompt_id, 'videos/' || o_orderkey || '.mp4' AS video, o_orderpriority AS prompt, CAST(o_custkey AS VARCHAR) AS seed, o_orderstatus AS subject_type, '{','.join(manifests.FIELDS)}' AS header FROM orders")
def sink_manifest_csv(spark, sf_dir):
    """A manifest of 14 columns from sidecar records, read back by its header."""
    path = new_path(spark, "manifest")
    io.write_csv(manifests.metadata_rows(queries.order_records(spark, sf_dir)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("prompt_id", "video", "prompt", "seed", "subject_type", F.lit(",".join(back.columns)).alias("header"))


@query("SELECT 'video,prompt' AS header, 0::BIGINT AS rows")
def sink_empty_metadata(spark, sf_dir):
    path = new_path(spark, "empty")
    io.write_metadata(table(spark, sf_dir, "nation").where("false").select(F.col("n_name").alias("video")), path)
    back = spark.read.option("header", True).csv(path)
    return spark.createDataFrame([(",".join(back.columns), back.count())], "header string, rows long")


@query(f"{oracle.REWRITTEN}, r AS (SELECT doc_id, len({oracle.judged(True)}) = 0 AS good FROM judged) SELECT doc_id, good AS kept FROM r")
def sink_kept_rejected(spark, sf_dir):
    kept, rejected = new_path(spark, "kept"), new_path(spark, "rejected")
    judged = queries.filters.post_filter(queries.rewritten(spark, sf_dir)).select("doc_id", "usable_for_teacher_generation")
    io.write_split(judged, F.col("usable_for_teacher_generation"), kept, rejected)
    read = lambda path, good: io.jsonl(spark, path, "doc_id long").withColumn("kept", F.lit(good))
    return read(kept, True).unionByName(read(rejected, False))


@query(f"{oracle.RULES} SELECT CAST(vec_id AS VARCHAR) AS prompt_id, status, 'v' || vec_id AS video FROM judged")
def sink_by_status(spark, sf_dir):
    """Manifests and id lists of each status in folders of their own; an id must be in both."""
    path = new_path(spark, "by-status")
    results = qc.with_status(queries.frame_metrics(spark, sf_dir), queries.QC).select(F.col("vec_id").cast("string").alias("prompt_id"), "status")
    rows = manifests.metadata_rows(results.select("prompt_id", F.concat(F.lit("v"), "prompt_id").alias("video_path")))
    io.write_by_status(results, rows, path)
    listed = spark.read.text(f"{path}/ids").select(F.col("value").alias("prompt_id"), "status")
    return spark.read.option("header", True).csv(f"{path}/manifests").join(listed, ["prompt_id", "status"]).select("prompt_id", "status", "video")


@query(f"""{oracle.RULES}, p AS (SELECT 'status' AS kind, status AS value FROM judged UNION ALL SELECT 'reject', unnest(rejects) FROM judged UNION ALL SELECT 'warning', unnest(warnings) FROM judged),
  l AS (SELECT '| ' || value || ' | ' || COUNT(*) || ' |' AS line FROM p GROUP BY kind, value UNION ALL SELECT '- ' || vec_id FROM (SELECT vec_id, status FROM judged QUALIFY row_number() OVER (PARTITION BY status ORDER BY vec_id) <= 20)) SELECT line FROM l""")
def sink_report(spark, sf_dir):
    """The Markdown report: the counts by status and reason, and the first 20 ids of each status."""
    path = new_path(spark, "report")
    results = qc.with_status(queries.frame_metrics(spark, sf_dir), queries.QC).withColumn("prompt_id", F.col("vec_id"))
    results = materialise(results.select("prompt_id", "status", "reject_reasons", "warning_reasons", *queries.METRIC_COLUMNS), "results")  # read eight times
    report = io.qc_report(results, qc.reason_counts(results), qc.metric_summary(results, queries.METRIC_COLUMNS))
    spark.createDataFrame([(line,) for line in report.splitlines()], "value string").coalesce(1).write.text(path)
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where(r"line RLIKE '^- ' OR line RLIKE '^[|] [a-z_]+ [|] [0-9]+ [|]$'")


STATS = oracle.summary("SELECT doc_id, brief AS t FROM composed")


@query(f"""SELECT path, n FROM (SELECT 'tags.' || dimension || '.' || value AS path, n FROM ({STATS})) UNION ALL
  SELECT 'records', COUNT(*) FROM documents UNION ALL (WITH {oracle.CHECKED} SELECT 'reasons.' || COALESCE(reason, 'accepted'), COUNT(*) FROM checked GROUP BY 1)""")
def sink_stats_document(spark, sf_dir):
    """The statistics of a bank, written as one document, read back and laid out."""
    path = new_path(spark, "stats")
    tagged, reasons = queries.tagged(spark, sf_dir), summaries.reason_counts(queries.checked(spark, sf_dir))
    io.write_document(spark, summaries.stats_document(tagged, reasons, "brief"), path)
    found = io.taxonomy(spark, path)
    rows = [("records", found["records"])] + [(f"tags.{d}.{v}", n) for d, values in found["tags"].items() for v, n in values.items()] + [(f"reasons.{r}", n) for r, n in found["reasons"].items()]
    return spark.createDataFrame(rows, "path string, n long")


@query(f"WITH s AS ({STATS}) SELECT dimension, value, n, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS place FROM s")
def tags_most_common(spark, sf_dir):
    return summaries.most_common(summaries.tag_counts(queries.tagged(spark, sf_dir)), ["dimension"])


@query("""WITH c AS (SELECT *, CASE WHEN len(t) = 0 THEN 'missing_prompt' WHEN w < 25 THEN 'extended_prompt_too_short' WHEN w > 110 THEN 'extended_prompt_too_long' END AS e
    FROM (SELECT conv_id % 5 = 0 AS broken, trim(text) AS t, len(regexp_extract_all(text, '\\S+')) AS w FROM conversations WHERE text IS NOT NULL)),
  m AS (SELECT 'records' AS metric FROM c UNION ALL SELECT CASE WHEN broken OR e IS NOT NULL THEN 'fallback' ELSE 'extended' END FROM c
    UNION ALL SELECT 'reason_' || CASE WHEN broken THEN 'result_not_object' ELSE e END FROM c WHERE broken OR e IS NOT NULL) SELECT metric, COUNT(*) AS n FROM m GROUP BY 1""")
def llm_outcome_counts(spark, sf_dir):
    """Turns as a model's replies, every fifth conversation's broken: what became of them."""
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    reply = F.when(F.col("conv_id") % 5 > 0, F.to_json(F.struct(F.col("text").alias("prompt"), F.lit(False).alias("reject")))).otherwise("none")
    none = F.create_map().cast("map<string,string>")
    out = rewrite.apply_replies(turns.select(F.col("text").alias("prompt"), F.col("text").alias("clean_prompt"), none.alias("tags"), rewrite.parse_reply(reply).alias("reply")))
    return rewrite.outcome_counts(out)


@query("SELECT vec_id, md5(array_to_string(list_transform(embedding, lambda x: CAST(round_even((greatest(least(x::DOUBLE * 3, 1), -1) + 1) * 127.5, 0) AS INTEGER)), ',')) AS frame_md5 FROM embeddings")
def tensor_frames(spark, sf_dir):
    """Embeddings as samples of a decoded tensor, some beyond the range, to 8-bit frames."""
    frame = text.to_frame(F.transform("embedding", lambda x: x.cast("double") * 3))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.md5(F.array_join(F.transform(frame, lambda x: x.cast("string")), ",")).alias("frame_md5"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / COUNT(*) OVER (PARTITION BY l_orderkey), 6) AS runtime_s FROM lineitem")
def runtime_per_item(spark, sf_dir):
    """Orders as batches: a batch's time shared among its items."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    sizes = items.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return items.join(sizes, "l_orderkey").select("l_orderkey", "l_linenumber", F.round(render.item_runtime("l_extendedprice", "n"), 6).alias("runtime_s"))
