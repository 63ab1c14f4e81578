"""Sampling, manifests, leases, sources, sinks, streams: properties and small cases."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrymill.functions import tags, text
from quarrymill.operators import compose, filters, leases, manifests, qc, render, rewrite, sampling, summaries
from quarrymill.plans import pipeline
from quarrymill.sources import io, store
from quarrymill.streaming import leases as stream


def bank(spark, rich, other):
    return spark.range(rich + other).withColumn("source_bucket", F.when(F.col("id") < rich, tags.MOTION_RICH).otherwise(tags.NATURAL))


def test_split_is_disjoint_exact_and_independent_of_partitions(spark):
    df = bank(spark, 60, 200)
    got = sampling.split_train_val(df, 50, 10, 0.2, 7, "id")
    rows = {(r.id, r.split, r["index"]) for r in got.collect()}
    assert rows == {(r.id, r.split, r["index"]) for r in sampling.split_train_val(df.repartition(13), 50, 10, 0.2, 7, "id").collect()}
    assert len({r[0] for r in rows}) == 60 and sorted(r[2] for r in rows if r[1] == "val") == list(range(10))
    assert got.where("split = 'train' AND source_bucket = 'motion_rich'").count() == 10 and got.where("split = 'val' AND source_bucket = 'motion_rich'").count() == 2
    assert sampling.shortage(df, 50, 10, 0.2) is None and "motion" in sampling.shortage(df, 250, 60, 0.9) and "natural" in sampling.shortage(df, 400, 10, 0.1)


@pytest.mark.parametrize(("rich", "other", "target", "ratio", "want"), [(50, 50, 40, 0.25, 10), (3, 50, 40, 0.25, 3), (50, 5, 40, 0.25, 35), (5, 5, 40, 0.5, 5), (0, 9, 4, 0.5, 0)])
def test_quota_with_top_up(spark, rich, other, target, ratio, want):
    got = sampling.select_quota(bank(spark, rich, other), target, ratio, 3, "id").collect()
    assert len(got) == min(target, rich + other) and sum(r.source_bucket == tags.MOTION_RICH for r in got) == want
    assert sorted(r["index"] for r in got) == list(range(len(got)))


def test_numbering_without_one_partition(spark):
    df = spark.range(1000).repartition(7)
    got = sampling.numbered(df, ["id"], 5).collect()
    assert all(r.id == r.n for r in got) and len(got) == 1000
    assert sampling.numbered(spark.range(0), ["id"]).count() == 0


def test_numbering_of_many_rows_with_other_columns(spark):
    """Range bounds come from a sample here; two samples of one table would differ."""
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("k"), F.md5(F.col("id").cast("string")).alias("payload")).repartition(7, "payload")
    got = sampling.numbered(df, ["k"], 8)
    assert got.columns == ["k", "payload", "n"]
    checked = got.select("n", "k", F.lag("k").over(Window.orderBy("n")).alias("before"))
    assert tuple(checked.agg(F.count_distinct("n"), F.min("n"), F.max("n"), F.count_if(F.col("before") >= F.col("k"))).first()) == (1_000_000, 0, 999_999, 0)


def test_keep_first_and_limits(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, None), (4, None)], "id long, h string")
    assert sorted(r.id for r in sampling.keep_first(df, "h", "id").collect()) == [1, 2, 4]
    assert sampling.bucket_limit(10) == 110 and sampling.bucket_limit(100) == 600 and sampling.half_even(2.5) == 2


def test_compose_bank(spark):
    got = compose.compose_bank(spark, 30, "train", 5).collect()
    assert len({r.prompt for r in got}) == 30 and sorted(r.prompt_id for r in got)[0] == "bank_train_00000000" and all(len(set(r.quality)) == 3 for r in got)
    with pytest.raises(ValueError):
        tiny = {**compose.TAXONOMY, "styles": ["s"], "camera_setups": ["c"], "lighting": ["l"], "moods": ["m"], "quality_tags": ["a", "b", "c"], "subject_groups": [{"name": "g", "subject_type": "t", "subjects": ["x"], "actions": ["y"], "scenes": ["z"], "details": ["d"]}]}
        compose.compose_bank(spark, 30, "train", 5, taxonomy=tiny)


def test_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], "prompt string")
    assert tuple(summaries.word_lengths(empty).first()) == (0, 0, 0, 0.0)
    assert summaries.tag_counts(tags.with_tags(empty)).count() == 0


def test_metadata_last_row_and_fallback(spark):
    rows = spark.createDataFrame([("a", 1, "v1"), ("a", 2, "v2"), ("", 3, "x"), (None, 4, "y")], "prompt_id string, n int, video string")
    last = manifests.last_of_each(rows, "prompt_id", ["n"])
    assert [(r.prompt_id, r.video) for r in last.collect()] == [("a", "v2")]
    records = spark.createDataFrame([("a", "ra", {"subject_type": "human"}), ("b", "rb", None)], "prompt_id string, video_path string, tags map<string,string>")
    full = last.select("prompt_id", "video", *(F.lit("m").alias(f) for f in manifests.FIELDS if f not in ("prompt_id", "video")))
    got = {r.prompt_id: r.asDict() for r in manifests.prefer_metadata(records, full).collect()}
    assert got["a"]["video"] == "v2" and got["a"]["seed"] == "m" and got["b"]["video"] == "rb" and got["b"]["subject_group"] == "" and list(got["b"]) == manifests.FIELDS


def test_verify_and_complete(spark):
    records, files = spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), spark.createDataFrame([("a", 5000), ("b", 10), ("z", 9999)], "k string, length long")
    got = manifests.verify(records, files, "k").first()
    assert (got.record_count, got.artifact_count, got.missing_count, got.missing, got.ok) == (3, 3, 1, ["c"], False)
    assert [r.k for r in manifests.complete(records, files, "k").collect()] == ["a"]


def test_lease_predicate_at_its_boundaries(spark):
    df = spark.createDataFrame([(1800.0, None, None, None), (1801.0, 0.0, None, None), (1800.0, 0.0, 0.0, None), (5000.0, 6000.0, 0.0, None), (2000.0, None, None, 100.0), (2000.0, None, None, 300.0)], "now double, e double, u double, m double")
    assert [r[0] for r in df.select(leases.is_stale(F.col("now"), "e", "u", "m")).collect()] == [False, True, False, False, True, False]


def test_claims_and_commits(spark):
    records, done, held = spark.range(10).select(F.col("id")), spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(3,)], "id long")
    first = [r.id for r in leases.claim(records, done, held, "id", "w", 1, 4).collect()]
    assert len(first) == 4 and not {1, 2, 3} & set(first) and first != [r.id for r in leases.claim(records, done, held, "id", "w", 2, 4).collect()]
    results = spark.createDataFrame([("a", "w", "t"), ("b", "w", "old"), ("c", "w", "t")], "k string, worker_id string, token string")
    owners = spark.createDataFrame([("a", "w", "t"), ("b", "w", "t"), ("c", "w", "t")], "k string, worker_id string, token string")
    got = {r.k: r.outcome for r in leases.commit(results, owners, spark.createDataFrame([("c",)], "k string"), "k").collect()}
    assert got == {"a": "ok", "b": "lost_lock_after_render", "c": "completed_elsewhere"}


def test_render_gives_each_item_a_status(spark):
    records = spark.createDataFrame([(f"p{i}", i, None) for i in range(10)], "prompt_id string, seed_hint long, negative_prompt string")
    options = render.RenderOptions(batch_size=4, max_items=9, max_attempts=2)
    planned = render.plan(records, spark.createDataFrame([("p1",)], "prompt_id string"), options, world=2)
    assert planned.count() == 8 and {r["rank"] for r in planned.collect()} == {0, 1}

    def renderer(items):
        if any(i["prompt_id"] == "p3" for i in items):
            raise OSError("no memory")
        return render.dry_run(items)

    got = {r.prompt_id: r for r in render.render(planned, renderer, options).collect()}
    assert len(got) == 8 and got["p3"].status == "failed" and "no memory" in got["p3"].error and got["p3"].content is None
    assert all(r.status == "ok" and bytes(r.content).startswith(b"dry run p") for k, r in got.items() if k != "p3")
    done = render.sidecars(planned, render.render(planned, renderer, options))
    assert done.count() == 7 and "content" not in done.columns
    again = render.plan(records, done, options, world=2)
    assert sorted(r.prompt_id for r in again.collect()) == ["p1", "p3"]


def test_cleaning_is_planned_once_under_a_filter(spark):
    df = spark.createDataFrame([("a fine day at the sea with two dogs",)], "prompt string")
    kept = filters.with_clean(df, "prompt", F.lit(0.0)).where("reason IS NULL").select("n_words")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.collect()[0][0] == 9 and plan.count("Message:") <= 2, plan


def test_render_keeps_batches_whole_that_arrow_cuts(spark):
    records = spark.range(10).select(F.format_string("p%d", "id").alias("prompt_id"), F.col("id").alias("seed_hint"), F.lit("").alias("negative_prompt"))
    options = render.RenderOptions(batch_size=4)
    planned = render.plan(records, spark.createDataFrame([], "prompt_id string"), options)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        got = render.render(planned, options=options).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(r.batch_size for r in got) == [2] * 2 + [4] * 8


def test_renderer_may_use_the_package_when_tables_were_written(spark):
    import quarrymill.llm.common  # noqa: F401  functions carry the package's code along from here on

    written = store.materialise(spark.range(1), "written")
    planned = render.plan(spark.createDataFrame([("p", 1, None)], "prompt_id string, seed_hint long, negative_prompt string"), spark.createDataFrame([], "prompt_id string"))
    assert [r.status for r in render.render(planned, lambda items: render.dry_run(items)).collect()] == ["ok"]
    assert any(path.rsplit("/", 1)[-1] in written.inputFiles()[0] for _, path in store._written)
    store.drop(written)


def test_csv_source(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('uuid,prompt,toxicity,extra\n1,"two\nlines ""q""",0.5,x\n2,,nan,y\n3,short\n')
    got = {r.uuid: r for r in io.raw_prompts(spark, str(tmp_path / "raw.csv")).collect()}
    assert got["1"].prompt == 'two\nlines "q"' and got["2"].prompt == "" and got["3"].toxicity == "" and got["1"].threat == ""


def test_csv_sink_keeps_white_space(spark, tmp_path):
    texts = [" a ", "\tb\n", "\n\rc\r", "  ", "\n", 'd" ', " ,\r\n"]
    io.write_csv(spark.createDataFrame(list(enumerate(texts)), "uuid long, prompt string"), str(tmp_path / "raw"), ["uuid", "prompt"])
    assert {int(r.uuid): r.prompt for r in io.raw_prompts(spark, str(tmp_path / "raw")).collect()} == dict(enumerate(texts))


def test_status_manifests_keep_white_space(spark, tmp_path):
    results = spark.createDataFrame([("a", "pass")], "prompt_id string, status string")
    io.write_by_status(results, manifests.metadata_rows(results.select("prompt_id", F.lit(" v ").alias("video_path"))), str(tmp_path / "s"))
    assert [r.video for r in spark.read.option("header", True).csv(str(tmp_path / "s/manifests")).collect()] == [" v "]


def test_json_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"prompt_id": "x"}\n\n{"prompt_id": "y"}\nbroken\n')
    path = str(tmp_path / "a.jsonl")
    assert sorted(r[0] for r in io.existing_ids(spark, path).collect()) == ["x", "y"] and io.existing_ids(spark, path + "no").count() == 0
    assert io.count_lines(spark, path) == 3 and io.count_lines(spark, path + "no") == 0
    assert io.jsonl(spark, path, "prompt_id string", limit=1).count() == 1
    io.write_jsonl(spark.createDataFrame([("é", None)], "a string, b string").coalesce(1), str(tmp_path / "out"))
    assert (next((tmp_path / "out").glob("part*"))).read_text() == '{"a":"é"}\n'
    with pytest.raises(Exception, match="already exists"):
        io.write_jsonl(spark.range(1), str(tmp_path / "out"))
    io.write_split(spark.range(10), F.when(F.col("id") > 0, F.col("id") < 4), str(tmp_path / "kept"), str(tmp_path / "rejected"))
    assert spark.read.json(str(tmp_path / "kept")).count() == 3 and spark.read.json(str(tmp_path / "rejected")).count() == 7
    io.write_document(spark, {"a": 1}, str(tmp_path / "doc"))
    assert io.taxonomy(spark, str(tmp_path / "doc")) == {"a": 1}


def test_sidecars_tolerate_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"prompt_id": "a"}, indent=2))
    (tmp_path / "b.json").write_text("{broken")
    from pyspark.sql.types import StructType

    got = {r.file_name: (r.prompt_id, r.sidecar_error) for r in io.sidecars(spark, str(tmp_path), StructType.fromDDL("prompt_id string")).collect()}
    assert got == {"a.json": ("a", False), "b.json": (None, True)}
    assert {(r.name, r.length) for r in io.listing(spark, str(tmp_path), "b.*").collect()} == {("b.json", 7)}


def test_csv_sinks_and_last_row(spark, tmp_path):
    io.write_csv(spark.createDataFrame([("v", "p, q", "a")], "video string, prompt string, prompt_id string").coalesce(1), str(tmp_path / "m"))
    part = next((tmp_path / "m").glob("part*"))
    assert part.read_text().splitlines() == [",".join(manifests.FIELDS), 'v,"p, q",,a,,,,,,,,,,']
    part.write_text(part.read_text() + "v2,new,,a,,,,,,,,,,\n")
    (tmp_path / "m" / f".{part.name}.crc").unlink()
    assert [(r.video, r.prompt) for r in io.metadata_csv(spark, str(tmp_path / "m")).collect()] == [("v2", "new")]
    results = spark.createDataFrame([("a", "pass")], "prompt_id string, status string")
    io.write_by_status(results, io.metadata_csv(spark, str(tmp_path / "m")), str(tmp_path / "by"))
    assert spark.read.text(str(tmp_path / "by/ids/status=pass")).first()[0] == "a"


def test_decoder_seam(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"ok")
    (tmp_path / "b.mp4").write_bytes(b"no!")
    (tmp_path / "c.mp4").write_bytes(b"raises")
    good = lambda content: {"width": 8, "height": 8, "fps": 16.0, "frame_count": 2, "luma_means": [1.0], "luma_stds": [1.0], "lap_vars": [1.0], "diffs": []} if content == b"ok" else None

    def decode(content):
        if content == b"raises":
            raise RuntimeError("foreign code")
        return good(content)

    got = {r.path[-5:]: (r.open_failed, r.video_bytes, r.width) for r in io.frames(spark, str(tmp_path), decode).collect()}
    assert got == {"a.mp4": (False, 2, 8), "b.mp4": (True, 3, None), "c.mp4": (True, 6, None)}


def events(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp, prompt_id string, worker_id string, token string, action string").coalesce(1).write.mode("append").parquet(str(path))


def test_lease_machine(spark, tmp_path):
    from datetime import datetime, timedelta

    t = lambda s: datetime(2026, 1, 1) + timedelta(seconds=s)
    script = [("claim", "w1", "t1", 0, "claimed"), ("claim", "w2", "t2", 10, "held"), ("heartbeat", "w1", "t1", 60, "refreshed"), ("heartbeat", "w2", "t2", 61, "lost_lock"), ("claim", "w2", "t2", 300, "claimed"), ("commit", "w1", "t1", 301, "lost_lock"), ("commit", "w2", "t2", 302, "ok"), ("commit", "w2", "t2", 303, "completed_elsewhere"), ("claim", "w3", "t3", 304, "completed_elsewhere")]
    events(spark, tmp_path / "in", [(i, t(s), "item", w, k, a) for i, (a, w, k, s, _) in enumerate(script)])
    source = spark.readStream.schema("event_id long, ts timestamp, prompt_id string, worker_id string, token string, action string").parquet(str(tmp_path / "in"))
    got = stream.run_once(stream.stream_leases(source, lease=120))
    outcomes = [x[4] for x in script]
    outcomes.insert(4, "stale")  # w1 fell silent: its lease runs out at 180, before the claim of w2
    assert [r.outcome for r in got.orderBy("updated_at").collect()] == outcomes


def test_stream_sessions_equal_batch_once_closed(spark, tmp_path):
    from datetime import datetime, timedelta

    t = lambda s: datetime(2026, 1, 1) + timedelta(seconds=s)
    rows = [(1, t(0), 7), (2, t(1799), 7), (3, t(3600), 7), (4, t(9000), 8)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long")
    df.write.parquet(str(tmp_path / "e"))
    batch = {(r.user_id, r.heartbeats) for r in leases.lease_sessions(df).collect()}
    assert batch == {(7, 2), (7, 1), (8, 1)}  # a gap of exactly the lease starts a new session
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    assert {(r.user_id, r.heartbeats) for r in stream.run_once(stream.stream_sessions(source)).collect()} == {(7, 2), (7, 1)}
    stream.sink_once(source, str(tmp_path / "out"), str(tmp_path / "cp2"))
    stream.sink_once(source, str(tmp_path / "out"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_pipeline_accounts_for_every_record(spark):
    made = compose.compose(spark.range(400), "id", 1).withColumn("planted", F.col("prompt"))
    options = pipeline.PipelineOptions(train=20, val=5, motion_ratio=1.0, factor=1.5, extra=5)
    out = pipeline.run(made.select("id", "planted"), "planted", "id", F.lit(0.0), options)
    assert out["clean"].count() == out["extended"].count() == out["safe"].count() + out["rejected"].count() == 30 + 10
    final = out["final"].collect()
    assert len(final) == 25 and len({r.prompt_id for r in final}) == 25 and all(r.prompt_selection.target_count in (20, 5) for r in final)
    with pytest.raises(ValueError):
        pipeline.run(made.select("id", "planted"), "planted", "id", F.lit(0.0), pipeline.PipelineOptions(train=5000))
    asked = pipeline.extend(out["clean"].withColumn("raw_prompt", F.col("planted")), options, lambda prompt: "not json").first()
    assert asked.used_fallback_prompt


def test_model_calls_run_side_by_side_and_never_end_the_job(spark):
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "id long, prompt string").coalesce(1)

    def client(prompt):
        if prompt == "p7":
            raise RuntimeError("foreign code")
        if prompt == "p8":
            raise TypeError("foreign code")
        return prompt.upper()

    got = {r.id: r.reply_text for r in rewrite.call_model(prompts, client, retries=1, workers=8).collect()}
    assert got == {i: None if i in (7, 8) else f"P{i}" for i in range(40)}


def test_metric_summary_of_values_close_together(spark):
    """All values within a thousandth: ranges follow them."""
    values = [1 + i * 1e-7 for i in range(4001)]
    df = spark.createDataFrame([(v, None) for v in values], "a double, b double").repartition(5)
    got = qc.metric_summary(df, ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [("a", 1.0, 1.0002, 1.0002, 1.0004)]


def test_intermediate_tables_are_removed(spark):
    start = store.mark()
    kept, gone = store.materialise(spark.range(3), "t"), store.materialise(spark.range(4), "t")
    path = gone.inputFiles()[0]
    assert kept.count() == 3 and os.path.exists(path.removeprefix("file://"))
    store.drop(gone)
    assert not os.path.exists(path.removeprefix("file://")) and kept.count() == 3
    store.drop_since(start)
    assert store.mark() == start


def test_stats_and_config(spark):
    assert text.first_value({"a": "", "b": 0, "c": "x"}, "a", "b", "c") == "x"
    rows = spark.createDataFrame([('{"a": "", "b": 0, "c": "x"}',), ("{}",), (None,), ('{"a": false, "c": 5}',)], "j string")
    assert [r[0] for r in rows.select(text.config_value("j", "a", "b", "c")).collect()] == ["x", "", "", "5"]
    frame = spark.createDataFrame([([-2.0, -1.0, 0.0, 1.0, 9.0, None],), (None,)], "t array<double>")
    assert [r[0] for r in frame.select(text.to_frame("t")).collect()] == [[0, 0, 128, 255, 255, None], None]


def test_report_reads_written_results(spark, sf_dir, monkeypatch):
    from quarrymill.plans import stored

    seen = []
    monkeypatch.setattr(stored.io, "qc_report", lambda results, *_: seen.extend(results.inputFiles()) or "")
    stored.sink_report(spark, sf_dir)
    assert seen and all("/results-" in path for path in seen)
