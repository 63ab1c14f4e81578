"""The registered queries of the prompt-bank operators, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import tags, text
from quarrymill.operators import compose, filters, leases, manifests, qc, render, rewrite, sampling, summaries
from quarrymill.plans import pipeline
from quarrymill.sources.io import parquet_table as table

SEED = 20260503
MAX_WORDS = 1000  # documents are longer than prompts
#: Endings put to composed prompts so that every rule has something to find.
PLANTS = ["", "", "", " seen on https://x.example/a", " with a Logo", " wearing nike shoes", " poorly drawn", " in 16:9", " --ar 16:9", " -motion 3 fast, once more", " -neg blur, haze", " with no visible text or logos.", ", and no watermark", " on a skull", " like Spider-Man", " by a president"]
QC = qc.QcRules(width=8, height=8, num_frames=64, fps=16.0, hard_min_luma=120.0, hard_max_luma=136.0, warn_min_luma=126.0, warn_max_luma=130.0, hard_min_std=10.0, warn_min_std=11.5, low_motion_mean=14.5, low_motion_max=50.0, flicker_std=13.5, min_bytes=20, warn_min_bytes=100)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A composed prompt for each document id, a brief of it, and the prompt with a planted ending."""
    out = compose.compose(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SEED)
    brief = F.concat_ws(" ", "subject", F.lit("that"), "action", "scene")
    plant = F.element_at(F.array(*map(F.lit, PLANTS)), (text.hash_pick(SEED, "doc_id", "plant", len(PLANTS)) + 1).cast("int"))
    return out.withColumn("brief", brief).withColumn("planted", F.concat("prompt", plant))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.with_tags(composed(spark, sf_dir), "brief")


def joined(values: Column | str) -> Column:
    return F.array_join(values, ",")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the label's toxicity as their only safety score."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_clean(scored(spark, sf_dir), "text", F.coalesce(F.col("toxic").cast("double"), F.lit(0.0)), filters.CleanRules(max_words=MAX_WORDS))


@query
def clean_text(spark, sf_dir):
    out = table(spark, sf_dir, "documents").select("doc_id", text.clean_prompt("text").alias("clean"))
    return out.select("doc_id", F.md5("clean").alias("clean_md5"), text.word_count("clean").alias("n_words"))


@query
def html_unescape_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.unescape("html").alias("html"))


@query
def prompt_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.prompt_hash("text").alias("prompt_hash"))


@query
def tolerant_scores(spark, sf_dir):
    score = text.tolerant_double(F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select("event_id", score.alias("score"), F.greatest(score, text.tolerant_double("event_type"), F.coalesce("value", F.lit(0.0))).alias("top_score"))


@query
def reject_reason_counts(spark, sf_dir):
    return summaries.reason_counts(checked(spark, sf_dir))


@query
def accepted_prompts(spark, sf_dir):
    return checked(spark, sf_dir).where("reason IS NULL").select("doc_id", "n_words")


@query
def planted_reject_reasons(spark, sf_dir):
    out = filters.with_clean(composed(spark, sf_dir), "planted", F.lit(0.0), filters.CleanRules(max_words=60))
    return out.select("doc_id", F.coalesce("reason", F.lit("accepted")).alias("reason"), F.md5("clean").alias("clean_md5"))


@query
def length_buckets(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(text.length_bucket("text").alias("length_bucket")).agg(F.count("*").alias("n"))


@query
def compose_prompts(spark, sf_dir):
    return composed(spark, sf_dir).select("doc_id", "prompt", "subject_group", "subject_type", "style", "camera", "lighting", "mood", "scene")


@query
def compose_dedup(spark, sf_dir):
    return sampling.keep_first(composed(spark, sf_dir), "brief", "doc_id").select("doc_id", "brief")


@query
def classify_subject(spark, sf_dir):
    return composed(spark, sf_dir).select("doc_id", tags.classify_subject("brief").alias("subject_type"))


@query
def classify_scene(spark, sf_dir):
    return composed(spark, sf_dir).select("doc_id", tags.classify_scene("brief").alias("scene_type"))


@query
def classify_motion(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", "motion_type")


@query
def motion_intensity(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", "motion_intensity")


@query
def challenge_tags(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", joined("challenge_tags").alias("challenge_tags"))


@query
def source_bucket(spark, sf_dir):
    return tagged(spark, sf_dir).select("doc_id", "source_bucket", "camera_motion")


@query
def tag_summary(spark, sf_dir):
    return summaries.tag_counts(tagged(spark, sf_dir))


@query
def document_tag_summary(spark, sf_dir):
    return summaries.tag_counts(tags.with_tags(table(spark, sf_dir, "documents").select("text"), "text"))


@query
def word_length_summary(spark, sf_dir):
    return summaries.word_lengths(table(spark, sf_dir, "documents"), "text")


@query
def dedup_keep_first(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select("doc_id", text.prompt_hash("text").alias("prompt_hash"))
    return sampling.keep_first(hashed, "prompt_hash", "doc_id")


@query
def bucket_topk_sample(spark, sf_dir):
    """A top-k report: 20 of each source."""
    return sampling.top_of_each(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", 20, SEED, "doc_id").select("doc_id", "source", F.col("rank").cast("long").alias("rank"))


@query
def train_val_split(spark, sf_dir):
    out = sampling.split_train_val(tagged(spark, sf_dir), 60, 20, 0.4, SEED, "doc_id")
    return out.select("doc_id", "split", "source_bucket", text.row_id("pb", F.col("split"), "index").alias("prompt_id"))


@query
def quota_final_select(spark, sf_dir):
    out = sampling.select_quota(tagged(spark, sf_dir), 100, 0.3, SEED, "doc_id")
    return out.select("doc_id", "source_bucket", "in_quota", F.col("index").cast("long").alias("index"))


@query
def quota_shortage(spark, sf_dir):
    """More motion-rich rows are asked for than there are: all of them are taken and others fill up."""
    rare = tagged(spark, sf_dir).withColumn("source_bucket", F.when(F.col("doc_id") % 50 == 0, tags.MOTION_RICH).otherwise(tags.NATURAL))
    out = sampling.select_quota(rare, 80, 0.9, SEED, "doc_id")
    return out.groupBy("source_bucket", "in_quota").agg(F.count("*").alias("n"))


@query
def render_plan(spark, sf_dir):
    """Documents to render, those with a label being finished: seeds, paths, ranks and batches."""
    records = table(spark, sf_dir, "documents").select(F.format_string("doc_%08d", "doc_id").alias("prompt_id"), F.when(F.col("doc_id") % 5 > 0, F.col("doc_id")).alias("seed_hint"), F.when(F.col("doc_id") % 3 == 0, "fog").otherwise("").alias("negative_prompt"))
    done = table(spark, sf_dir, "labels").select(F.format_string("doc_%08d", "doc_id").alias("prompt_id"))
    out = render.plan(records, done, render.RenderOptions(batch_size=4, seed_offset=100), world=8)
    return out.select("prompt_id", "seed", "negative_prompt", "video_path", "rank", "batch", "height", "cfg_scale")


@query
def render_outcomes(spark, sf_dir):
    """A dry run of the plan: finished items by rank."""
    records = table(spark, sf_dir, "documents").select(F.format_string("doc_%08d", "doc_id").alias("prompt_id"), F.col("doc_id").alias("seed_hint"), F.lit("").alias("negative_prompt"))
    done = table(spark, sf_dir, "labels").select(F.format_string("doc_%08d", "doc_id").alias("prompt_id"))
    options = render.RenderOptions(batch_size=4)
    planned = render.plan(records, done, options, world=8)
    finished = render.sidecars(planned, render.render(planned, options=options))
    return finished.groupBy("rank").agg(F.count("*").alias("items"), F.sum(F.col("batch_size").cast("long")).alias("batch_sizes"))


@query
def subject_groups(spark, sf_dir):
    return summaries.distinct_sorted(composed(spark, sf_dir), "subject_group")


@query
def stride_shard(spark, sf_dir):
    placed = sampling.numbered(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    return placed.select("doc_id", sampling.stride("n", 8).alias("shard"))


@query
def batch_chunk(spark, sf_dir):
    placed = sampling.numbered(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    return placed.groupBy(sampling.batch("n", 16).alias("batch")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query
def worker_permutation(spark, sf_dir):
    """A top-k report: the first 100 orders that a worker visits."""
    out = leases.worker_order(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "worker-3", 2)
    return out.orderBy("order_key", "o_orderkey").limit(100).select("o_orderkey", text.stable_int("order_key").alias("stable_int"))


@query
def dry_run_extend(spark, sf_dir):
    return composed(spark, sf_dir).select("doc_id", rewrite.dry_run("prompt", "doc_id", SEED).alias("prompt"))


@query
def validate_rewrite(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("asked"), F.col("text").alias("request"))
    given = turns.where("role = 'assistant'").select("conv_id", "turn", "text")
    pairs = asked.join(given, (asked["conv_id"] == given["conv_id"]) & (given["turn"] == asked["asked"] + 1), "left").select(asked["conv_id"], "asked", "text")
    error = filters.rewrite_error(F.col("text").isNotNull(), F.lit(False), "text")
    return pairs.select("conv_id", "asked", F.coalesce(error, F.lit("ok")).alias("outcome"))


@query
def extract_llm_json(spark, sf_dir):
    """Turns wrapped as a model would: fenced, with words around, or broken."""
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", "text")
    body = F.concat(F.lit('{"prompt": "'), F.regexp_replace("text", r"[^A-Za-z0-9 ]", " "), F.lit('", "reject": false, "tags": {"scene_type": "city"}}'))
    style = (F.col("conv_id") + F.col("turn")) % 4
    reply = F.when(style == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(style == 1, F.concat(F.lit("Sure: "), body, F.lit(" Done."))).when(style == 2, body).otherwise(F.concat(F.lit("no object: "), F.substring(body, 2, 40)))
    out = turns.withColumn("reply", rewrite.parse_reply(reply))
    tags_after = rewrite.merge_tags(F.create_map(F.lit("scene_type"), F.lit("unknown"), F.lit("subject_type"), F.lit("human")), "reply.tags")
    return out.select("conv_id", "turn", F.coalesce(F.md5("reply.prompt"), F.lit("")).alias("prompt_md5"), F.col("reply").isNotNull().alias("is_object"), tags_after["scene_type"].alias("scene_type"), tags_after["subject_type"].alias("subject_type"))


def rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrites that came from planted prompts: the prompt itself is planted for every third row, its origin for all."""
    base = composed(spark, sf_dir)
    prompt = F.when(F.col("doc_id") % 3 == 0, F.col("planted")).otherwise(F.col("prompt"))
    return base.select("doc_id", prompt.alias("prompt"), (F.col("doc_id") % 7 == 0).alias("used_fallback_prompt"), F.col("planted").alias("raw_prompt"), F.col("brief").alias("clean_prompt"), F.lit("").alias("pre_llm_prompt"), prompt.alias("extended_prompt"))


@query
def post_filter_reasons(spark, sf_dir):
    out = filters.post_filter(rewritten(spark, sf_dir))
    return out.select("doc_id", "usable_for_teacher_generation", joined("post_filter_reject_reasons").alias("reasons"), "prompt", F.coalesce(joined("postprocess_notes"), F.lit("")).alias("notes"))


@query
def post_filter_counts(spark, sf_dir):
    return summaries.exploded_counts(filters.post_filter(rewritten(spark, sf_dir), check_lineage=False))


@query
def scrub_no_text(spark, sf_dir):
    return composed(spark, sf_dir).select("doc_id", text.scrub_no_text("planted").alias("prompt"))


@query
def resume_pending(spark, sf_dir):
    return rewrite.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query
def require_artifact(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").where("l_returnflag = 'R'")
    return manifests.with_artifact(orders, parts, "o_orderkey")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sidecar records."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("prompt_id"), F.concat(F.lit("videos/"), F.col("o_orderkey"), F.lit(".mp4")).alias("video_path"), F.col("o_orderpriority").alias("prompt"), F.col("o_custkey").alias("seed"), F.create_map(F.lit("subject_type"), F.col("o_orderstatus")).alias("tags"))


@query
def metadata_manifest(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'")
    rows = items.select(F.col("l_orderkey").alias("prompt_id"), F.col("l_linenumber").alias("n"), F.concat(F.lit("meta/"), F.col("l_partkey")).alias("video"), F.col("l_linestatus").alias("prompt"), *(F.lit("").alias(f) for f in manifests.FIELDS if f not in ("prompt_id", "video", "prompt")))
    return manifests.prefer_metadata(order_records(spark, sf_dir), manifests.last_of_each(rows, "prompt_id", ["n", "video", "prompt"]))


@query
def verify_artifacts(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select("o_orderkey")
    found = table(spark, sf_dir, "lineitem").where("l_shipdate < '1998-01-01'").select(F.col("l_orderkey").alias("o_orderkey"))
    out = manifests.verify(records, found, "o_orderkey")
    return out.withColumn("missing", joined(F.transform("missing", lambda x: x.cast("string"))))


def frame_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as luma series: 128 + 100 times the component is a frame's mean."""
    luma = F.transform("embedding", lambda x: F.round(F.lit(128.0) + F.lit(100.0) * x.cast("double"), 6))
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", luma.alias("luma_means"))
    v = v.withColumns({"luma_stds": F.transform("luma_means", lambda x: F.abs(x - 128.0)), "lap_vars": F.transform("luma_means", lambda x: x / 2), "diffs": qc.consecutive_diffs("luma_means"), "fps": F.when(F.col("vec_id") % 11 == 0, 0.0).otherwise(F.lit(16.0) + (F.col("vec_id") % 5) * 0.02), "frame_count": F.lit(64).cast("long") + F.col("vec_id") % 3, "width": F.when(F.col("vec_id") % 13 == 0, 9).otherwise(8), "height": F.lit(8), "video_bytes": F.col("vec_id") % 200})
    return qc.with_metrics(v)


METRIC_COLUMNS = ["duration_s", "luma_mean", "luma_mean_std_over_time", "frame_luma_std_mean", "laplacian_var_mean", "sample_diff_mean", "sample_diff_max"]


@query
def qc_metrics(spark, sf_dir):
    return frame_metrics(spark, sf_dir).select("vec_id", *METRIC_COLUMNS)


@query
def qc_rules_status(spark, sf_dir):
    out = qc.with_status(frame_metrics(spark, sf_dir), QC)
    return out.select("vec_id", "status", joined("reject_reasons").alias("reject_reasons"), joined("warning_reasons").alias("warning_reasons"))


@query
def qc_sample_positions(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", qc.sample_positions(F.col("p_size").cast("long") - 2, 9).alias("p"))
    return parts.select("p_partkey", joined(F.transform("p", lambda x: x.cast("string"))).alias("positions"))


@query
def qc_metric_summary(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return qc.metric_summary(items, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def qc_reason_counts(spark, sf_dir):
    return qc.reason_counts(qc.with_status(frame_metrics(spark, sf_dir), QC))


@query
def qc_manifest_split(spark, sf_dir):
    out = qc.with_status(frame_metrics(spark, sf_dir), QC)
    return out.groupBy("status", "label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))


@query
def lease_staleness(spark, sf_dir):
    return leases.heartbeat_gaps(table(spark, sf_dir, "events")).select("event_id", "user_id", "gap_us", "lapsed")


@query
def lease_expiry(spark, sf_dir):
    held = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("updated_at"))
    last = held.agg(F.max("updated_at").alias("now"))
    return held.crossJoin(last).select("user_id", leases.is_stale(F.col("now"), F.col("updated_at") + 600, "updated_at").alias("stale"))


@query
def lease_sessions(spark, sf_dir):
    return leases.lease_sessions(table(spark, sf_dir, "events")).select("user_id", F.unix_micros("start").alias("start_us"), "heartbeats")


@query
def queue_status(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    locks = events.groupBy("user_id").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("updated_at")).select(F.format_string("%08d.lock", "user_id").alias("lock"), "updated_at", (F.col("updated_at") + 1800).alias("expires_at"))
    end = events.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).first()[0]
    out = leases.queue_status(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), locks, F.lit(end), "doc_id")
    return out.withColumn("lock_examples", joined("lock_examples"))


@query
def claim_batch(spark, sf_dir):
    """A top-k report: the next 25 documents for a worker."""
    docs, done = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").where("quality = 1")
    held = table(spark, sf_dir, "labels").where("toxic = 1")
    return leases.claim(docs, done, held, "doc_id", "worker-7", 1, 25).select("doc_id")


@query
def commit_outcomes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    results = events.select("event_id", F.col("user_id").alias("item"), F.concat(F.lit("w"), F.col("event_id") % 4).alias("worker_id"), F.concat(F.lit("t"), F.col("event_id") % 3).alias("token"))
    owners = events.groupBy(F.col("user_id").alias("item")).agg(F.max("event_id").alias("e")).select("item", F.concat(F.lit("w"), F.col("e") % 4).alias("worker_id"), F.concat(F.lit("t"), F.col("e") % 3).alias("token"))
    done = events.where("event_type = 'purchase'").select(F.col("user_id").alias("item"))
    return leases.commit(results, owners, done.where("item % 2 = 0"), "item").groupBy("outcome").agg(F.count("*").alias("n"))


@query
def worker_event_log(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("worker_id"), F.col("event_type").alias("event"), F.round("value", 2).cast("decimal(18,2)").alias("runtime_s"))
    return leases.worker_events(events).withColumn("runtime_s", F.col("runtime_s").cast("double"))


@query
def sanitize_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), F.concat(F.lit("_"), F.col("c_name"), F.lit(" é/x.")).alias("name"))
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"))
    return c.unionByName(p).select("id", text.sanitize_name("name").alias("name"))


@query
def iso_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.iso_time(F.col("ts").cast("timestamp")).alias("time"))


@query
def prompt_pipeline(spark, sf_dir):
    """The whole prompt pipeline over composed prompts: the final records."""
    base = composed(spark, sf_dir).select("doc_id", "planted")
    raw = base.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    options = pipeline.PipelineOptions(train=20, val=5, seed=SEED, motion_ratio=1.0, factor=2.5, extra=2)
    final = pipeline.run(raw, "planted", "doc_id", F.coalesce(F.col("toxic").cast("double"), F.lit(0.0)), options)["final"]
    return final.select("doc_id", "split", "prompt_id", "source_prompt_id", "prompt", F.col("index").cast("long").alias("index"))
