"""Golden rows for each rule, and the traps of text, numbers and rounding."""

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import tags, text, vocab
from quarrymill.operators import filters, qc, rewrite


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.select("i", f("x").alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (None, ""), ("", ""), ("  a   b \t\n c ,.;", "a b c"), ("Tom &amp; Jerry &eacute;", "Tom & Jerry é"), ("see https://x.y/z now", "see x.y/z now"), ("Message: 3 Attachment here", "here"),
        ("a cat --ar 16:9 sits", "a cat sits"), ("a cat 4:3", "a cat"), ("cat -motion 2 fast, then", "cat , then"), ("cat -neg blur and more", "cat"), ("cat -neg blur\nmore. end", "cat . end"), ("cat --seed 5, dog", "cat , dog"), ("wide landscape view", "wide view"), ("café -gs 3 x; tea", "café ; tea"), ("a b", "a b"),
    ],
)
def test_clean(spark, raw, clean):
    assert column(spark, [raw], text.clean_prompt) == [clean]


def test_clean_without_python_in_the_plan(spark):
    plan = spark.createDataFrame([("a",)], "x string").select(text.clean_prompt("x", entities=False))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_word_boundaries_are_unicode(spark):
    assert column(spark, ["écar", "a CAR.", "cars", "caré", None], lambda x: tags.has(x, ["car"])) == [False, True, False, False, None]


def test_tolerant_double(spark):
    got = column(spark, [None, "", "abc", "0.5", " 1e2 ", "0.1d", "0x1p3", "-3", ".5", "1_000"], text.tolerant_double)
    assert got == [0, 0, 0, 0.5, 100, 0, 0, -3, 0.5, 0]


def test_names_and_hashes(spark):
    assert column(spark, [None, "", "..", "a b/c", "_x.y-z_", "é" * 130], text.sanitize_name) == ["worker", "worker", "worker", "a_b_c", "x.y-z", "é" * 120]
    assert column(spark, ["A Cat"], text.prompt_hash) == column(spark, ["a cat"], text.prompt_hash)
    assert text.split_seed(20260503, "train") == 21879948 and text.split_seed(20260503, "val") == 20902227
    assert text.pool_count(2000, 1.3) == 2600 and text.pool_count(200, 1.3) == 260 and text.pool_count(0) == 0 and text.pool_count(10) == 60
    assert [text.normalize_url(u) for u in ("http://a/", "http://a/v1", "http://a/chat/completions")] == ["http://a/v1/chat/completions", "http://a/v1/chat/completions", "http://a/chat/completions"]
    assert text.first_value({"a": "", "b": 0, "c": 3}, "a", "b", "c") == "3"


BASE = "a quiet old stone wall stands near low hills"


@pytest.mark.parametrize(
    ("raw", "score", "reason"),
    [
        (BASE, 0.0, None), ("", 0.0, "empty_after_cleaning"), ("one two", 0.0, "too_short"), ("word " * 81, 0.0, "too_long"), (BASE, 0.06, "unsafe_score"), (BASE, float("nan"), "unsafe_score"), (BASE, 0.05, None),
        (BASE + " <img src", 0.0, "attachment_or_url"), (BASE + " with a caption", 0.0, "text_or_logo_request"), (BASE + " with Words", 0.0, "text_or_logo_request"), (BASE + " Star Wars", 0.0, "sensitive_or_ip_term"), (BASE + " cocacola", 0.0, "sensitive_or_ip_term"),
        (BASE + " poorly drawn", 0.0, "negative_prompt_fragment"), (BASE + " -neg fog", 0.0, "negative_prompt_fragment"), (BASE + " in portrait", 0.0, "aspect_or_size_hint"), (BASE + " --ar 16:9", 0.0, "aspect_or_size_hint"), ("one https://x", 1.0, "too_short"),
    ],
)
def test_reject_reason(spark, raw, score, reason):
    df = filters.with_clean(spark.createDataFrame([(raw, score)], "raw string, s double"), "raw", F.col("s"))
    assert df.first()["reason"] == reason


def test_aspect_can_be_kept(spark):
    df = spark.createDataFrame([(BASE + " in portrait",)], "raw string")
    assert filters.with_clean(df, "raw", F.lit(0.0), filters.CleanRules(keep_aspect=True)).first()["reason"] is None


@pytest.mark.parametrize(
    ("prompt", "subject", "scene", "motion", "intensity", "bucket", "challenge"),
    [
        ("a man in a room", "human", "indoor", "static_low_motion", "low", "natural", ["static_low_motion"]),
        ("a dog runs by the car", "animal", "unknown", "static_low_motion", "low", "natural", ["static_low_motion"]),
        ("rain on the street", "environment", "city", "environment_dynamics", "medium", "motion_rich", ["basic_motion", "cyclic_motion", "environment_dynamics"]),
        ("hands hold two cups", "human", "unknown", "fine_interaction", "low", "natural", ["fine_interaction", "multi_entity"]),
        ("wide view of a bus", "vehicle", "unknown", "camera_motion", "low", "motion_rich", ["camera_parallax"]),
        ("the same robot is running again", "object", "unknown", "subject_translation", "high", "motion_rich", ["basic_motion", "identity_persistence"]),
        ("it waits hidden in a dream", "scene", "fantasy", "static_low_motion", "low", "natural", ["occlusion_reentry"]),
        (None, "scene", "unknown", "static_low_motion", "low", "natural", ["static_low_motion"]),
    ],
)
def test_tags(spark, prompt, subject, scene, motion, intensity, bucket, challenge):
    row = tags.with_tags(spark.createDataFrame([(prompt,)], "prompt string")).first()
    assert (row.subject_type, row.scene_type, row.motion_type, row.motion_intensity, row.source_bucket, row.challenge_tags) == (subject, scene, motion, intensity, bucket, challenge)


def test_length_buckets(spark):
    assert column(spark, ["w " * n for n in (0, 15, 16, 40, 41)], text.length_bucket) == ["short", "short", "medium", "medium", "long"]


def test_post_filter(spark):
    rows = [("a calm sea. Ensure no visible text, ever. Done", False, "x"), ("a calm sea and no logos, ever", False, "x"), ("Nike on a skull", True, "tupac"), (None, False, None)]
    df = spark.createDataFrame([(*r, "", "", "e") for r in rows], "prompt string, used_fallback_prompt boolean, raw_prompt string, clean_prompt string, pre_llm_prompt string, extended_prompt string")
    got = filters.post_filter(df).collect()
    assert [r.prompt for r in got] == ["a calm sea. Done", "a calm sea, ever", "Nike on a skull", None]
    assert got[2].post_filter_reject_reasons == ["fallback_or_rejected", "public_ip_or_brand", "public_ip_or_brand_lineage", "sensitive_or_violent"]
    assert [r.usable_for_teacher_generation for r in got] == [True, True, False, True] and got[0].postprocess_notes and got[3].postprocess_notes is None


@pytest.mark.parametrize(("n", "error"), [(24, "extended_prompt_too_short"), (25, None), (110, None), (111, "extended_prompt_too_long"), (0, "missing_prompt")])
def test_rewrite_lengths(spark, n, error):
    assert spark.range(1).select(filters.rewrite_error(F.lit(True), F.lit(None).cast("boolean"), F.lit("w " * n))).first()[0] == error


def test_dry_run_adds_42_words_or_43(spark):
    out = spark.createDataFrame([(1, BASE), (2, "a cartoon")], "id long, p string").select("p", rewrite.dry_run("p", "id", 7).alias("r")).collect()
    assert [len(r.r.split()) - len(r.p.split()) for r in out] == [42, 43]


@pytest.mark.parametrize(
    ("reply", "prompt"),
    [('{"prompt": "p"}', "p"), ('```json\n{"prompt": "p", "tags": {"a": "b"}}\n```', "p"), ('Here: {"prompt": "p"} bye', "p"), ("no object", None), ("[1]", None), ('{"prompt": ', None), (None, None), ("", None)],
)
def test_reply_parsing(spark, reply, prompt):
    got = spark.createDataFrame([(reply,)], "r string").select(rewrite.parse_reply("r").alias("x")).first().x
    assert (got.prompt if got else None) == prompt


def test_replies_fall_back(spark):
    long = "word " * 30
    df = spark.createDataFrame([("p1", "p1", {"a": "1"}, '{"prompt": "%s", "tags": {"a": null, "b": "2"}}' % long), ("p2", "p2", None, "junk"), ("p3", "p3", {}, '{"reject": true, "reject_reason": "bad"}')], "prompt string, clean_prompt string, tags map<string,string>, t string")
    got = rewrite.apply_replies(df.withColumn("reply", rewrite.parse_reply("t"))).collect()
    assert [r.used_fallback_prompt for r in got] == [False, True, True] and got[0].prompt == long.strip() and got[0].tags == {"a": "1", "b": "2"}
    assert [r.llm_extension.reject_reason for r in got] == ["", "result_not_object", "bad"] and got[1].prompt == "p2"
    assert {r.metric: r.n for r in rewrite.outcome_counts(rewrite.apply_replies(df.withColumn("reply", rewrite.parse_reply("t")))).collect()} == {"records": 3, "extended": 1, "fallback": 2, "reason_result_not_object": 1, "reason_bad": 1}


def test_client_seam_retries_and_gives_up(spark):
    def client(prompt):
        if prompt == "bad":
            raise OSError
        return prompt.upper()

    got = rewrite.call_model(spark.createDataFrame([("a",), ("bad",)], "prompt string"), client, retries=1).collect()
    assert {r.prompt: r.reply_text for r in got} == {"a": "A", "bad": None}


def test_sample_positions(spark):
    df = spark.createDataFrame([(n,) for n in (0, -1, 1, 2, 9, 81)], "n long")
    got = [r[0] for r in df.select(qc.sample_positions("n", 9)).collect()]
    assert got == [[], [], [0], [0, 1], list(range(9)), [0, 10, 20, 30, 40, 50, 60, 70, 80]]
    assert [r[0] for r in df.select(qc.sample_positions("n", 1)).collect()] == [[], [], [0], [0], [0], [0]]


GOOD = {"video_bytes": 200_000, "width": 832, "height": 480, "fps": 16.0, "frame_count": 81, "luma_means": [100.0] * 9, "luma_stds": [20.0] * 9, "lap_vars": [1.0] * 9, "diffs": [5.0] * 8}
SCHEMA = "video_bytes long, width int, height int, fps double, frame_count long, luma_means array<double>, luma_stds array<double>, lap_vars array<double>, diffs array<double>"


@pytest.mark.parametrize(
    ("change", "status", "rejects", "warnings"),
    [
        ({}, "pass", [], []), ({"video_bytes": 1023}, "reject", ["video_too_small"], []), ({"video_bytes": 1024}, "review", [], ["small_video_file"]), ({"video_bytes": 149_999}, "review", [], ["small_video_file"]), ({"video_bytes": 150_000}, "pass", [], []),
        ({"width": 831}, "reject", ["dimension_mismatch"], []), ({"fps": 16.04}, "pass", [], []), ({"fps": 16.06}, "reject", ["fps_mismatch"], []), ({"fps": 0.0}, "reject", ["duration_mismatch", "fps_mismatch"], []), ({"frame_count": 82}, "pass", [], []), ({"frame_count": 83}, "reject", ["frame_count_mismatch"], []),
        ({"frame_count": 90}, "reject", ["duration_mismatch", "frame_count_mismatch"], []), ({"luma_means": [100.0] * 2}, "reject", ["too_few_decodable_frames"], []), ({"luma_means": [2.0] * 9}, "reject", ["black_or_white_video"], []), ({"luma_means": [3.0] * 9}, "review", [], ["very_dark_video"]), ({"luma_means": [241.0] * 9}, "review", [], ["very_bright_video"]),
        ({"luma_stds": [1.0] * 9}, "reject", ["blank_low_detail_video"], []), ({"luma_stds": [2.0] * 9}, "review", [], ["low_detail_video"]), ({"diffs": [1.0] * 8}, "review", [], ["low_motion_or_freeze"]), ({"diffs": [1.0] * 7 + [4.5]}, "pass", [], []), ({"diffs": []}, "pass", [], []), ({"luma_means": [50.0, 150.0] * 4}, "review", [], ["high_global_flicker"]),
    ],
)
def test_qc_rules(spark, change, status, rejects, warnings):
    row = tuple((GOOD | change).values())
    got = qc.with_status(qc.with_metrics(spark.createDataFrame([row], SCHEMA))).first()
    assert (got.status, got.reject_reasons, got.warning_reasons) == (status, rejects, warnings)


@pytest.mark.parametrize(("flag", "reason"), [("decoder_missing", "missing_video_decode_dependency"), ("sidecar_error", "sidecar_json_error"), ("video_missing", "missing_video"), ("open_failed", "open_failed")])
def test_qc_early_exits(spark, flag, reason):
    df = qc.with_metrics(spark.createDataFrame([tuple((GOOD | {"width": 1}).values())], SCHEMA)).withColumn(flag, F.lit(True))
    got = qc.with_status(df).first()
    assert got.reject_reasons == [reason] and got.status == "reject" and got.warning_reasons == []


def test_upper_median_and_empty_metrics(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "a double, b double")
    got = {r.metric: (r.min, r.mean, r.median, r.max) for r in qc.metric_summary(df, ["a", "b"]).collect()}
    assert got == {"a": (1.0, 2.5, 3.0, 4.0)}


def test_word_lookup_equals_the_patterns(spark):
    terms = ["close-up", "walk", "coca-cola", "cocacola", "nike", "spider man", "clouds", "words", "through the crowd"]
    odd = ["ſnow", "nıKe nİke", "walk-ing", "close up", "coca cola", "cloud?", "wálk", "walk\u200d", "水walk", "spider\nman", "", None]
    rows = [(f"{a}{t.upper()}{b}",) for t in terms for a, b in (("", ""), ("é", ""), ("-", "."), ("", "_"))] + [(t,) for t in odd]
    df = spark.createDataFrame(rows, "t string").withColumn("w", text.words_of("t"))
    lists = [vocab.TEXT_OR_LOGO, vocab.SENSITIVE_OR_IP, vocab.MOTION, vocab.CAMERA, vocab.DYNAMICS, vocab.OCCLUSION, vocab.PUBLIC_IP]
    differs = F.array(*(~tags.has("t", every).eqNullSafe(tags.has("t", every, "w")) for every in lists))
    assert df.where(F.exists(differs, lambda x: x)).collect() == []


def test_unescape_batches_are_small(spark):
    texts = ["a &amp; b", "&lt;p&gt; &#x41;&notit;", "plain", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.unescape("t").alias("u"))
    assert [r.u for r in df.collect()] == ["a & b", "<p> A¬it;", "plain", None]
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
