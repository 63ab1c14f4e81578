"""DuckDB SQL for the queries of `queries`, written from the rules and the vocabulary, not from Spark's plans.

RE2 knows no look-behind and its \\b is ASCII, so whole words are matched by the characters around them.
"""

from __future__ import annotations

from quarrymill.functions import vocab
from quarrymill.functions.text import pool_count, split_seed
from quarrymill.operators.compose import PARTS, TAXONOMY
from quarrymill.operators.manifests import FIELDS
from quarrymill.operators.rewrite import CAMERAS, LIGHTS
from quarrymill.plans.queries import MAX_WORDS, METRIC_COLUMNS, PLANTS, QC, SEED


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


def pick(key: str, slot: str, n: int, seed: int = SEED) -> str:
    return f"(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR) || ':{slot}'), 1, 8))::BIGINT % {n})"


def chosen(key: str, slot: str, values: list[str]) -> str:
    return f"{listed(values)}[{pick(key, slot, len(values))} + 1]"


def has(text: str, terms: list[str]) -> str:
    return f"regexp_matches({text}, {q('(^|[^\\p{L}\\p{N}_])(' + '|'.join(terms) + ')([^\\p{L}\\p{N}_]|$)')}, 'i')"


def rough(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(pattern)}, 'i')"


def clean(text: str) -> str:
    out = text
    for pattern in (vocab.ATTACHMENT, vocab.ASPECT, vocab.OPTION, vocab.NEGATED, vocab.COMMAND, r"\s+"):
        out = f"regexp_replace({out}, {q(pattern)}, ' ', 'gi')"
    return f"trim({out}, ' ,.;' || chr(9) || chr(13) || chr(10))"


def n_words(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '\\S+')) AS BIGINT)"


def text_hash(text: str) -> str:
    return f"substr(sha1(lower({text})), 1, 16)"


def order(key: str, seed: int = SEED) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def label(text: str, labels: dict[str, list[str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(text, terms)} THEN '{name}'" for name, terms in labels.items()) + f" ELSE '{default}' END"


def reason(raw: str, cleaned: str, words: str, score: str, most: int) -> str:
    return f"""CASE WHEN {cleaned} = '' THEN 'empty_after_cleaning' WHEN {words} < 8 THEN 'too_short' WHEN {words} > {most} THEN 'too_long'
    WHEN {score} > 0.05 THEN 'unsafe_score' WHEN {rough(raw, vocab.ATTACHMENT)} THEN 'attachment_or_url' WHEN {has(cleaned, vocab.TEXT_OR_LOGO)} THEN 'text_or_logo_request'
    WHEN {has(cleaned, vocab.SENSITIVE_OR_IP)} THEN 'sensitive_or_ip_term' WHEN {rough(raw, vocab.NEGATIVE)} THEN 'negative_prompt_fragment'
    WHEN {rough(raw, vocab.ASPECT)} THEN 'aspect_or_size_hint' END"""


GROUPS = TAXONOMY["subject_groups"]
GROUP = pick("doc_id", "group", len(GROUPS))


def part(name: str) -> str:
    return "CASE g " + " ".join(f"WHEN {i} THEN {chosen('doc_id', name, group[name])}" for i, group in enumerate(GROUPS)) + " END"


COMPOSED = f"""picked AS (SELECT doc_id, {GROUP} AS g FROM documents),
parts AS (SELECT doc_id, {listed([g['name'] for g in GROUPS])}[g + 1] AS subject_group, {listed([g['subject_type'] for g in GROUPS])}[g + 1] AS subject_type,
  {chosen('doc_id', 'styles', TAXONOMY['styles'])} AS style, {chosen('doc_id', 'camera_setups', TAXONOMY['camera_setups'])} AS camera,
  {chosen('doc_id', 'lighting', TAXONOMY['lighting'])} AS lighting, {chosen('doc_id', 'moods', TAXONOMY['moods'])} AS mood,
  {', '.join(f'{part(p)} AS {p[:-1]}' for p in PARTS)},
  list_sort(list_transform({listed(TAXONOMY['quality_tags'])}, lambda x: md5('{SEED}:' || CAST(doc_id AS VARCHAR) || ':quality:' || x) || x)) AS ql FROM picked),
composed AS (SELECT *, subject || ' that ' || "action" || ' ' || scene AS brief,
  style || ': ' || subject || ' ' || "action" || ' ' || scene || '. ' || detail || '. Seen in ' || camera || ', lit by ' || lighting || '; the mood is ' || mood
  || '. Wanted: ' || substr(ql[1], 33) || ', ' || substr(ql[2], 33) || ', ' || substr(ql[3], 33) || '.' AS prompt FROM parts),
planted AS (SELECT *, prompt || {chosen('doc_id', 'plant', PLANTS)} AS planted FROM composed)"""

MOTION_TYPE = "CASE WHEN dyn THEN 'environment_dynamics' WHEN fine THEN 'fine_interaction' WHEN cam THEN 'camera_motion' WHEN mot THEN 'subject_translation' ELSE 'static_low_motion' END"


def tag_columns(text: str) -> str:
    return f"""tagged AS (SELECT f.*, {label('t', vocab.SUBJECTS, 'scene')} AS subject, {label('t', vocab.SCENES, 'unknown')} AS scene_type, {MOTION_TYPE} AS motion_type,
  CASE WHEN cam THEN 'explicit' ELSE 'unknown' END AS camera_motion, CASE WHEN mot OR cam THEN 'motion_rich' ELSE 'natural' END AS source_bucket,
  CASE WHEN {has('t', vocab.HIGH_INTENSITY)} THEN 'high' WHEN mot THEN 'medium' ELSE 'low' END AS motion_intensity,
  CASE WHEN {n_words('t')} < 16 THEN 'short' WHEN {n_words('t')} <= 40 THEN 'medium' ELSE 'long' END AS length_bucket,
  list_sort(list_filter([CASE WHEN mot THEN 'basic_motion' END, CASE WHEN cam THEN 'camera_parallax' END, CASE WHEN cyc THEN 'cyclic_motion' END, CASE WHEN occ THEN 'occlusion_reentry' END,
    CASE WHEN ide THEN 'identity_persistence' END, CASE WHEN ent THEN 'multi_entity' END, CASE WHEN fine AND NOT dyn THEN 'fine_interaction' END, CASE WHEN dyn THEN 'environment_dynamics' END,
    CASE WHEN NOT (mot OR cam OR cyc OR occ OR ide OR ent OR fine OR dyn) THEN 'static_low_motion' END], lambda x: x IS NOT NULL)) AS challenge
  FROM (SELECT *, {has('t', vocab.MOTION)} AS mot, {has('t', vocab.CAMERA)} AS cam, {has('t', vocab.DYNAMICS)} AS dyn, {has('t', vocab.FINE)} AS fine, {has('t', vocab.CYCLIC)} AS cyc,
    {has('t', vocab.OCCLUSION)} AS occ, {has('t', vocab.IDENTITY)} AS ide, {has('t', vocab.ENTITIES)} AS ent FROM ({text})) f)"""


TAGGED = f"WITH {COMPOSED}, {tag_columns('SELECT doc_id, brief AS t FROM composed')}"


def summary(text: str, with_parts: bool = True) -> str:
    dims = {"source_bucket": "source_bucket", "subject_type": "subject", "scene_type": "scene_type", "motion_type": "motion_type", "motion_intensity": "motion_intensity", "length_bucket": "length_bucket"}
    rows = " UNION ALL ".join([f"SELECT '{d}' AS dimension, {c} AS value FROM tagged" for d, c in dims.items()] + ["SELECT 'challenge_tags', unnest(challenge) FROM tagged"])
    return f"WITH {COMPOSED + ', ' if with_parts else ''}{tag_columns(text)} SELECT dimension, value, COUNT(*) AS n FROM ({rows}) GROUP BY ALL"


CHECKED = f"""checked AS (SELECT doc_id, w AS n_words, {reason('raw', 'c', 'w', 's', MAX_WORDS)} AS reason FROM
  (SELECT doc_id, raw, c, s, {n_words('c')} AS w FROM (SELECT d.doc_id, d.text AS raw, {clean('d.text')} AS c, COALESCE(CAST(l.toxic AS DOUBLE), 0) AS s FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)))"""

NUMBER = "^[+-]?([0-9]+\\.?[0-9]*(e[+-]?[0-9]+)?|\\.[0-9]+(e[+-]?[0-9]+)?)$"


def tolerant(text: str) -> str:
    return f"CASE WHEN regexp_matches(trim({text}), '{NUMBER}', 'i') THEN CAST(trim({text}) AS DOUBLE) ELSE 0 END"


def scrub(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace({text}, {q(vocab.NO_TEXT_SENTENCE)}, '', 'gi'), {q(vocab.NO_TEXT_INLINE)}, '', 'gi'))"


REWRITTEN = f"""WITH {COMPOSED}, rewritten AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN planted ELSE prompt END AS prompt, doc_id % 7 = 0 AS fallback, planted AS raw_prompt, brief FROM planted),
judged AS (SELECT *, raw_prompt || chr(10) || brief || chr(10) || prompt AS origin FROM rewritten)"""


def judged(lineage: bool) -> str:
    checks = ["CASE WHEN fallback THEN 'fallback_or_rejected' END"]
    for name, terms in (("public_ip_or_brand", vocab.PUBLIC_IP), ("sensitive_or_violent", vocab.VIOLENT)):
        checks.append(f"CASE WHEN {has('prompt', terms)} THEN '{name}' END")
        if lineage:
            checks.append(f"CASE WHEN {has('origin', terms)} THEN '{name}_lineage' END")
    return f"list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL)"


EMBED = "list_transform(embedding, lambda x: round(128.0::DOUBLE + 100.0::DOUBLE * x::DOUBLE, 6))"
FRAMES = f"""WITH v AS (SELECT vec_id, label, {EMBED} AS m, CASE WHEN vec_id % 11 = 0 THEN 0.0::DOUBLE ELSE 16.0::DOUBLE + (vec_id % 5) * 0.02::DOUBLE END AS fps, 64 + vec_id % 3 AS frame_count,
  CASE WHEN vec_id % 13 = 0 THEN 9 ELSE 8 END AS width, vec_id % 200 AS video_bytes FROM embeddings),
s AS (SELECT *, list_transform(m, lambda x: abs(x - 128.0::DOUBLE)) AS sd, list_transform(m, lambda x: x / 2) AS lap, list_transform(range(2, len(m) + 1), lambda i: abs(m[i] - m[i - 1])) AS df FROM v),
metrics AS (SELECT vec_id, label, fps, frame_count, width, video_bytes, CASE WHEN fps > 0 THEN round(frame_count / fps, 4) END AS duration_s, round(list_avg(m), 4) AS luma_mean, round(list_stddev_pop(m), 4) AS luma_mean_std_over_time,
  round(list_avg(sd), 4) AS frame_luma_std_mean, round(list_avg(lap), 4) AS laplacian_var_mean, round(list_avg(df), 4) AS sample_diff_mean, round(list_max(df), 4) AS sample_diff_max, len(m) AS decoded FROM s)"""

RULES = f"""{FRAMES}, ruled AS (SELECT vec_id, label, list_sort(list_filter([
  CASE WHEN video_bytes < {QC.min_bytes} THEN 'video_too_small' END, CASE WHEN width <> {QC.width} THEN 'dimension_mismatch' END,
  CASE WHEN fps <= 0 OR abs(fps - {QC.fps}) > {QC.fps_tolerance} THEN 'fps_mismatch' END, CASE WHEN abs(frame_count - {QC.num_frames}) > {QC.frame_tolerance} THEN 'frame_count_mismatch' END,
  CASE WHEN fps <= 0 OR abs(frame_count / fps - {QC.num_frames} / {QC.fps}) > {QC.duration_tolerance} THEN 'duration_mismatch' END, CASE WHEN decoded < 3 THEN 'too_few_decodable_frames' END,
  CASE WHEN luma_mean < {QC.hard_min_luma} OR luma_mean > {QC.hard_max_luma} THEN 'black_or_white_video' END, CASE WHEN frame_luma_std_mean < {QC.hard_min_std} THEN 'blank_low_detail_video' END], lambda x: x IS NOT NULL)) AS rejects,
  list_sort(list_filter([CASE WHEN video_bytes >= {QC.min_bytes} AND video_bytes < {QC.warn_min_bytes} THEN 'small_video_file' END,
  CASE WHEN luma_mean >= {QC.hard_min_luma} AND luma_mean < {QC.warn_min_luma} THEN 'very_dark_video' END, CASE WHEN luma_mean <= {QC.hard_max_luma} AND luma_mean > {QC.warn_max_luma} THEN 'very_bright_video' END,
  CASE WHEN frame_luma_std_mean >= {QC.hard_min_std} AND frame_luma_std_mean < {QC.warn_min_std} THEN 'low_detail_video' END,
  CASE WHEN sample_diff_mean < {QC.low_motion_mean} AND sample_diff_max < {QC.low_motion_max} THEN 'low_motion_or_freeze' END, CASE WHEN luma_mean_std_over_time > {QC.flicker_std} THEN 'high_global_flicker' END], lambda x: x IS NOT NULL)) AS warnings FROM metrics),
judged AS (SELECT *, CASE WHEN len(rejects) > 0 THEN 'reject' WHEN len(warnings) > 0 THEN 'review' ELSE 'pass' END AS status FROM ruled)"""

MICROS = "epoch_us(ts)"


def quota(source: str, target: int, ratio: float) -> str:
    most = round(target * ratio)
    return f"""ranked AS (SELECT *, source_bucket = 'motion_rich' AS rich, {order('doc_id')} AS h FROM {source}),
  placed AS (SELECT *, row_number() OVER (PARTITION BY rich ORDER BY h, doc_id) AS rn, count(*) FILTER (WHERE rich) OVER () AS nm FROM ranked),
  quotad AS (SELECT *, CASE WHEN rich THEN rn <= least({most}, nm) ELSE rn <= {target} - least({most}, nm) END AS in_quota FROM placed),
  final AS (SELECT *, row_number() OVER (ORDER BY NOT in_quota, h, doc_id) AS place FROM quotad)"""


METADATA = ", ".join(f"CASE WHEN m.k IS NOT NULL THEN {m} ELSE {b} END AS {f}" for f, m, b in ((f, {"video": "m.video", "prompt": "m.prompt"}.get(f, "''"), {"video": "'videos/' || o.o_orderkey || '.mp4'", "prompt": "o.o_orderpriority", "seed": "CAST(o.o_custkey AS VARCHAR)", "subject_type": "o.o_orderstatus"}.get(f, "''")) for f in FIELDS if f != "prompt_id"))

def pipeline_sql(train: int, val: int, factor: float, extra: int) -> str:
    """The whole prompt pipeline over planted prompts, which are all motion-rich."""
    pools = {n: pool_count(n, factor, extra) for n in (train, val)}
    final = " UNION ALL ".join(
        f"""SELECT doc_id, split, printf('pb_{split}_%08d', i) AS prompt_id, prompt_id AS source_prompt_id, sc AS prompt, i AS index FROM
        (SELECT *, row_number() OVER (ORDER BY {order('prompt_id', split_seed(SEED, split) + 1)}, prompt_id) - 1 AS i FROM
        (SELECT * FROM safe WHERE split = '{split}' QUALIFY row_number() OVER (ORDER BY {order('prompt_id', split_seed(SEED, split))}, prompt_id) <= {target}))"""
        for split, target in (("train", train), ("val", val))
    )
    return f"""WITH {COMPOSED}, c AS (SELECT p.doc_id, planted, COALESCE(CAST(l.toxic AS DOUBLE), 0) AS s, {clean('planted')} AS c FROM planted p LEFT JOIN labels l ON l.doc_id = p.doc_id),
    ok AS (SELECT * FROM c WHERE {reason('planted', 'c', n_words('c'), 's', 80)} IS NULL QUALIFY row_number() OVER (PARTITION BY {text_hash('c')} ORDER BY doc_id) = 1),
    r AS (SELECT *, row_number() OVER (ORDER BY {order('doc_id')}, doc_id) AS rn FROM ok),
    s AS (SELECT *, CASE WHEN rn <= {pools[train]} THEN 'train' ELSE 'val' END AS split FROM r WHERE rn <= {pools[train] + pools[val]}),
    n AS (SELECT *, printf('pb_%s_%08d', split, row_number() OVER (PARTITION BY split ORDER BY {order('doc_id', SEED + 1)}, doc_id) - 1) AS prompt_id FROM s),
    x AS (SELECT *, {extended('c', 'prompt_id')} AS e FROM n), y AS (SELECT *, {n_words('e')} BETWEEN 25 AND 110 AS good FROM x),
    z AS (SELECT *, NOT good AS fallback, CASE WHEN good THEN e ELSE c END AS prompt, planted || chr(10) || c || chr(10) || c || CASE WHEN good THEN chr(10) || e ELSE '' END AS origin FROM y),
    safe AS (SELECT *, {scrub('prompt')} AS sc FROM z WHERE len({judged(True)}) = 0) {final}"""


def extended(text: str, key: str) -> str:
    return f"""CASE WHEN regexp_matches(lower({text}), '{'|'.join(vocab.ANIMATED)}') THEN 'Stylized animation video' ELSE 'Realistic video' END || '. ' || {text}
      || '. Over five seconds, the main subject performs one clear, continuous action while the background remains coherent. The camera uses ' || {chosen(key, 'camera', CAMERAS)} || ' with ' || {chosen(key, 'light', LIGHTS)}
      || '. Keep the subject appearance, scene layout, and motion direction consistent across the clip.'"""


SQL: dict[str, str] = {
    "clean_text": f"SELECT doc_id, md5(c) AS clean_md5, {n_words('c')} AS n_words FROM (SELECT doc_id, {clean('text')} AS c FROM documents)",
    "prompt_hash": f"SELECT doc_id, {text_hash('text')} AS prompt_hash FROM documents",
    "tolerant_scores": f"SELECT event_id, score, greatest(score, {tolerant('event_type')}, COALESCE(value, 0)) AS top_score FROM (SELECT *, {tolerant("COALESCE(json_extract_string(props, '$.k'), '')")} AS score FROM events)",
    "reject_reason_counts": f"WITH {CHECKED} SELECT COALESCE(reason, 'accepted') AS reason, COUNT(*) AS n FROM checked GROUP BY 1",
    "accepted_prompts": f"WITH {CHECKED} SELECT doc_id, n_words FROM checked WHERE reason IS NULL",
    "planted_reject_reasons": f"WITH {COMPOSED}, c AS (SELECT doc_id, planted, {clean('planted')} AS c FROM planted) SELECT doc_id, COALESCE({reason('planted', 'c', n_words('c'), '0', 60)}, 'accepted') AS reason, md5(c) AS clean_md5 FROM c",
    "length_buckets": f"SELECT CASE WHEN w < 16 THEN 'short' WHEN w <= 40 THEN 'medium' ELSE 'long' END AS length_bucket, COUNT(*) AS n FROM (SELECT {n_words('text')} AS w FROM documents) GROUP BY 1",
    "compose_prompts": f"WITH {COMPOSED} SELECT doc_id, prompt, subject_group, subject_type, style, camera, lighting, mood, scene FROM composed",
    "compose_dedup": f"WITH {COMPOSED} SELECT min(doc_id) AS doc_id, brief FROM composed GROUP BY brief",
    "classify_subject": f"{TAGGED} SELECT doc_id, subject AS subject_type FROM tagged",
    "classify_scene": f"{TAGGED} SELECT doc_id, scene_type FROM tagged",
    "classify_motion": f"{TAGGED} SELECT doc_id, motion_type FROM tagged",
    "motion_intensity": f"{TAGGED} SELECT doc_id, motion_intensity FROM tagged",
    "challenge_tags": f"{TAGGED} SELECT doc_id, array_to_string(challenge, ',') AS challenge_tags FROM tagged",
    "source_bucket": f"{TAGGED} SELECT doc_id, source_bucket, camera_motion FROM tagged",
    "tag_summary": summary("SELECT doc_id, brief AS t FROM composed"),
    "document_tag_summary": summary("SELECT doc_id, text AS t FROM documents", False),
    "word_length_summary": f"SELECT COUNT(*) AS records, COALESCE(min(w), 0) AS min_words, COALESCE(max(w), 0) AS max_words, COALESCE(round(avg(w), 2), 0) AS avg_words FROM (SELECT {n_words('text')} AS w FROM documents)",
    "dedup_keep_first": f"SELECT min(doc_id) AS doc_id, h AS prompt_hash FROM (SELECT doc_id, {text_hash('text')} AS h FROM documents) GROUP BY h",
    "bucket_topk_sample": f"SELECT * FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {order('doc_id')}, doc_id) AS rank FROM documents) WHERE rank <= 20",
    "train_val_split": f"""{TAGGED}, r AS (SELECT doc_id, source_bucket, row_number() OVER (PARTITION BY source_bucket ORDER BY {order('doc_id')}, doc_id) AS rn FROM tagged),
      s AS (SELECT doc_id, source_bucket, CASE WHEN rn <= CASE WHEN source_bucket = 'motion_rich' THEN 24 ELSE 36 END THEN 'train' ELSE 'val' END AS split FROM r WHERE rn <= CASE WHEN source_bucket = 'motion_rich' THEN 32 ELSE 48 END)
      SELECT doc_id, split, source_bucket, printf('pb_%s_%08d', split, row_number() OVER (PARTITION BY split ORDER BY {order('doc_id', SEED + 1)}, doc_id) - 1) AS prompt_id FROM s""",
    "quota_final_select": f"{TAGGED}, {quota('tagged', 100, 0.3)} SELECT doc_id, source_bucket, in_quota, row_number() OVER (ORDER BY {order('doc_id', SEED + 1)}, doc_id) - 1 AS index FROM final WHERE place <= 100",
    "quota_shortage": f"WITH rare AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 'motion_rich' ELSE 'natural' END AS source_bucket FROM documents), {quota('rare', 80, 0.9)} SELECT source_bucket, in_quota, COUNT(*) AS n FROM final WHERE place <= 80 GROUP BY 1, 2",
    "render_plan": f"""SELECT printf('doc_%08d', doc_id) AS prompt_id, CASE WHEN doc_id % 5 > 0 THEN doc_id ELSE 0 END + 100 AS seed, CASE WHEN doc_id % 3 = 0 THEN 'fog' ELSE {q(vocab.NEGATIVE_PROMPT)} END AS negative_prompt,
      printf('videos/doc_%08d.mp4', doc_id) AS video_path, n % 8 AS rank, (n // 8) // 4 AS batch, 480 AS height, 6.0::DOUBLE AS cfg_scale FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))""",
    "render_outcomes": """SELECT rank, COUNT(*) AS items, CAST(sum(c) AS BIGINT) AS batch_sizes FROM (SELECT n % 8 AS rank, COUNT(*) OVER (PARTITION BY n % 8, (n // 8) // 4) AS c FROM
      (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))) GROUP BY rank""",
    "subject_groups": f"WITH {COMPOSED} SELECT string_agg(DISTINCT subject_group, ',' ORDER BY subject_group) AS subject_groups FROM composed",
    "stride_shard": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 8 AS shard FROM documents",
    "batch_chunk": "SELECT (n // 16)::BIGINT AS batch, COUNT(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents) GROUP BY 1",
    "worker_permutation": "SELECT o_orderkey, ('0x' || substr(sha1(k), 1, 12))::BIGINT AS stable_int FROM (SELECT o_orderkey, sha1('worker-3:2:' || o_orderkey) AS k FROM orders) ORDER BY k, o_orderkey LIMIT 100",
    "dry_run_extend": f"WITH {COMPOSED} SELECT doc_id, {extended('prompt', 'doc_id')} AS prompt FROM composed",
    "prompt_pipeline": pipeline_sql(20, 5, 2.5, 2),
    "validate_rewrite": f"""SELECT u.conv_id, u.turn AS asked, CASE WHEN a.text IS NULL THEN 'result_not_object' WHEN trim(a.text) = '' THEN 'missing_prompt' WHEN {n_words('a.text')} < 25 THEN 'extended_prompt_too_short' WHEN {n_words('a.text')} > 110 THEN 'extended_prompt_too_long' ELSE 'ok' END AS outcome
      FROM (SELECT * FROM conversations WHERE role = 'user') u LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1""",
    "extract_llm_json": "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 4 = 3 THEN '' ELSE md5(regexp_replace(text, '[^A-Za-z0-9 ]', ' ', 'g')) END AS prompt_md5, (conv_id + turn) % 4 <> 3 AS is_object, CASE WHEN (conv_id + turn) % 4 = 3 THEN 'unknown' ELSE 'city' END AS scene_type, 'human' AS subject_type FROM conversations WHERE text IS NOT NULL",
    "post_filter_reasons": f"""{REWRITTEN}, r AS (SELECT *, {judged(True)} AS rs, {scrub('prompt')} AS sc FROM judged) SELECT doc_id, len(rs) = 0 AS usable_for_teacher_generation, array_to_string(rs, ',') AS reasons,
      CASE WHEN len(rs) = 0 THEN sc ELSE prompt END AS prompt, CASE WHEN len(rs) = 0 AND sc <> prompt THEN 'removed_positive_no_text_clause' ELSE '' END AS notes FROM r""",
    "post_filter_counts": f"{REWRITTEN}, r AS (SELECT {judged(False)} AS rs FROM judged), m AS (SELECT 'input' AS metric FROM r UNION ALL SELECT CASE WHEN len(rs) = 0 THEN 'kept' ELSE 'rejected' END FROM r UNION ALL SELECT 'reject_' || unnest(rs) FROM r) SELECT metric, COUNT(*) AS n FROM m GROUP BY 1",
    "scrub_no_text": f"WITH {COMPOSED} SELECT doc_id, {scrub('planted')} AS prompt FROM planted",
    "resume_pending": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "require_artifact": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "metadata_manifest": f"""WITH m AS (SELECT l_orderkey AS k, 'meta/' || l_partkey AS video, l_linestatus AS prompt FROM lineitem WHERE l_returnflag = 'A' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, 'meta/' || l_partkey DESC, l_linestatus DESC) = 1)
      SELECT CAST(o.o_orderkey AS VARCHAR) AS prompt_id, {METADATA} FROM orders o LEFT JOIN m ON m.k = o.o_orderkey""",
    "verify_artifacts": """WITH a AS (SELECT l_orderkey FROM lineitem WHERE l_shipdate < '1998-01-01'), miss AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM a))
      SELECT (SELECT COUNT(*) FROM orders) AS record_count, (SELECT COUNT(*) FROM a) AS artifact_count, (SELECT COUNT(*) FROM miss) AS missing_count, COALESCE((SELECT string_agg(o_orderkey, ',' ORDER BY o_orderkey) FROM (SELECT * FROM miss ORDER BY 1 LIMIT 20)), '') AS missing, (SELECT COUNT(*) FROM miss) = 0 AS ok""",
    "qc_metrics": f"{FRAMES} SELECT vec_id, {', '.join(METRIC_COLUMNS)} FROM metrics",
    "qc_rules_status": f"{RULES} SELECT vec_id, status, array_to_string(rejects, ',') AS reject_reasons, array_to_string(warnings, ',') AS warning_reasons FROM judged",
    "qc_sample_positions": "SELECT p_partkey, CASE WHEN f <= 0 THEN '' ELSE array_to_string(list_sort(list_distinct(list_transform(range(0, 9), lambda i: round_even(i * (f - 1) / 8.0::DOUBLE, 0)::BIGINT))), ',') END AS positions FROM (SELECT p_partkey, p_size::BIGINT - 2 AS f FROM part)",
    "qc_metric_summary": "WITH m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS v FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + "), r AS (SELECT metric, v, row_number() OVER (PARTITION BY metric ORDER BY v) AS rn, COUNT(*) OVER (PARTITION BY metric) AS n FROM m WHERE v IS NOT NULL) SELECT metric, round(min(v), 4) AS min, round(avg(v), 4) AS mean, round(max(v) FILTER (WHERE rn = n // 2 + 1), 4) AS median, round(max(v), 4) AS max FROM r GROUP BY metric",
    "qc_reason_counts": f"{RULES}, p AS (SELECT 'status' AS kind, status AS value FROM judged UNION ALL SELECT 'reject', unnest(rejects) FROM judged UNION ALL SELECT 'warning', unnest(warnings) FROM judged) SELECT kind, value, COUNT(*) AS n FROM p GROUP BY 1, 2",
    "qc_manifest_split": f"{RULES} SELECT status, label, COUNT(*) AS n, min(vec_id) AS first_id FROM judged GROUP BY 1, 2",
    "lease_staleness": f"SELECT event_id, user_id, g AS gap_us, COALESCE(g > 1800000000, false) AS lapsed FROM (SELECT event_id, user_id, lead({MICROS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) - {MICROS} AS g FROM events)",
    "lease_expiry": f"WITH h AS (SELECT user_id, max({MICROS}) / 1e6 AS u FROM events GROUP BY 1) SELECT user_id, (SELECT max(u) FROM h) > greatest(u + 600, u + 1800) AS stale FROM h",
    "lease_sessions": f"""WITH b AS (SELECT user_id, {MICROS} AS t, CASE WHEN {MICROS} - lag({MICROS}) OVER (PARTITION BY user_id ORDER BY ts) < 1800000000 THEN 0 ELSE 1 END AS s FROM events),
      g AS (SELECT user_id, t, sum(s) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM b) SELECT user_id, min(t) AS start_us, COUNT(*) AS heartbeats FROM g GROUP BY user_id, g""",
    "queue_status": f"""WITH l AS (SELECT printf('%08d.lock', user_id) AS lock, max({MICROS}) / 1e6 AS u FROM events GROUP BY user_id), n AS (SELECT max(u) AS now FROM l), d AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS c FROM documents)
      SELECT t AS target_count, c AS complete, t - c AS incomplete, (SELECT COUNT(*) FROM l, n WHERE NOT now > u + 1800) AS active_locks, (SELECT COUNT(*) FROM l, n WHERE now > u + 1800) AS stale_locks, c >= t AS done, (SELECT string_agg(lock, ',' ORDER BY lock) FROM (SELECT lock FROM l ORDER BY lock LIMIT 10)) AS lock_examples FROM d""",
    "claim_batch": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 OR toxic = 1) ORDER BY sha1('worker-7:1:' || doc_id), doc_id LIMIT 25",
    "commit_outcomes": """WITH o AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1), d AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND user_id % 2 = 0)
      SELECT CASE WHEN v.event_id % 4 <> o.e % 4 OR v.event_id % 3 <> o.e % 3 THEN 'lost_lock_after_render' WHEN v.user_id IN (SELECT user_id FROM d) THEN 'completed_elsewhere' ELSE 'ok' END AS outcome, COUNT(*) AS n FROM events v JOIN o ON o.user_id = v.user_id GROUP BY 1""",
    "worker_event_log": "SELECT user_id AS worker_id, event_type AS event, COUNT(*) AS n, CAST(sum(CAST(round(value, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS runtime_s FROM events GROUP BY 1, 2",
    "sanitize_names": "SELECT id, COALESCE(NULLIF(substr(trim(regexp_replace(name, '[^\\p{L}\\p{N}._-]', '_', 'g'), '._'), 1, 120), ''), 'worker') AS name FROM (SELECT 'c' || c_custkey AS id, '_' || c_name || ' é/x.' AS name FROM customer UNION ALL SELECT 'p' || p_partkey, p_name FROM part)",
    "iso_times": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time FROM events",
}
