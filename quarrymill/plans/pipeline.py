"""The prompt pipeline as one lazy chain: clean, reject, dedup, sample, split, tag, rewrite, filter, select."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import tags, text, vocab
from quarrymill.operators import filters, rewrite, sampling
from quarrymill.sources.store import materialise

VERSION = "prompt_pipeline_v1"


@dataclass(frozen=True)
class PipelineOptions:
    train: int = 2000
    val: int = 200
    seed: int = 20260503
    prefix: str = "pb"
    motion_ratio: float = 0.2
    factor: float = 1.25
    extra: int = 50
    check_lineage: bool = True
    allow_short: bool = False
    rules: filters.CleanRules = field(default_factory=filters.CleanRules)

    def pool(self, split: str) -> int:
        return text.pool_count(self.train if split == "train" else self.val, self.factor, self.extra)


def candidates(raw: DataFrame, prompt: str, key: str, unsafe: Column, rules: filters.CleanRules) -> DataFrame:
    """Accepted prompts, the first of each hash by key, with source_bucket; raw needs columns prompt and key."""
    checked = filters.with_clean(raw, prompt, unsafe, rules).where("reason IS NULL")
    hashed = checked.withColumn("prompt_hash", text.prompt_hash("clean"))
    return tags.with_tags(sampling.keep_first(hashed, "prompt_hash", key), "clean")


def clean_pool(found: DataFrame, key: str, options: PipelineOptions) -> DataFrame:
    """Records of the clean stage, split by the pool sizes, a table in the shared folder as all later stages read them;
    raises if there are too few of a kind."""
    train, val = options.pool("train"), options.pool("val")
    chosen = sampling.split_train_val(found, train, val, options.motion_ratio, options.seed, key)
    chosen = materialise(chosen, "clean-pool")
    if not options.allow_short and (why := sampling.shortage(chosen, train, val, options.motion_ratio)):
        raise ValueError(why)
    seed = F.pmod(F.conv(F.substring(text.hash_order(options.seed + 2, key), 1, 12), 16, 10).cast("long"), F.lit(2**31 - 1))
    return chosen.withColumns({"prompt_id": text.row_id(options.prefix, F.col("split"), "index"), "prompt": F.col("clean"), "clean_prompt": F.col("clean"), "lang": F.lit("en"), "negative_prompt": F.lit(vocab.NEGATIVE_PROMPT), "seed_hint": seed, "source": F.lit("filtered_clean_v1")})


def extend(pool: DataFrame, options: PipelineOptions, client: Callable[[str], str] | None = None) -> DataFrame:
    """Rewritten records: by the dry-run sentence, or by the replies of client."""
    old = F.create_map(*(x for t in ("subject_type", "scene_type", "motion_type", "motion_intensity") for x in (F.lit(t), F.col(t))))
    tagged = pool.withColumn("tags", old)
    if client is None:
        reply = F.struct(rewrite.dry_run("prompt", "prompt_id", options.seed).alias("prompt"), F.lit(False).alias("reject"), F.lit("").alias("reject_reason"), F.col("tags").alias("tags"))
        return rewrite.apply_replies(tagged.withColumn("reply", reply), source="dryrun_extended_v1").drop("reply")
    asked = rewrite.call_model(tagged, client)
    return rewrite.apply_replies(asked.withColumn("reply", rewrite.parse_reply("reply_text")), model="client").drop("reply", "reply_text")


def finalize(safe: DataFrame, options: PipelineOptions) -> DataFrame:
    """The final records of both splits with their lineage."""
    out, sizes = None, {r["split"]: r["count"] for r in safe.groupBy("split").count().collect()}
    for split, target in (("train", options.train), ("val", options.val)):
        part = safe.where(F.col("split") == split).drop("index")
        size = sizes.get(split, 0)
        if size < target and not options.allow_short:
            raise ValueError(f"safe pool for {split} is short: need {target}, got {size}")
        target = min(target, size)
        chosen = sampling.select_quota(part, target, options.motion_ratio, text.split_seed(options.seed, split), "prompt_id")
        selection = F.struct(F.lit(options.seed).alias("seed"), F.lit(size).alias("safe_pool_split_size"), F.lit(target).alias("target_count"), F.lit(options.motion_ratio).alias("motion_rich_ratio"))
        named = chosen.withColumns({"source_prompt_id": F.col("prompt_id"), "pre_selection_source": F.col("source"), "prompt_id": text.row_id(options.prefix, split, "index"), "source": F.lit("extended_safe_v1"), "prompt_program_version": F.lit(VERSION), "prompt_selection": selection})
        out = named if out is None else out.unionByName(named)
    return out


def run(raw: DataFrame, prompt: str, key: str, unsafe: Column, options: PipelineOptions = PipelineOptions(), client: Callable[[str], str] | None = None) -> dict[str, DataFrame]:
    """All stages: clean, extended, safe, rejected and final. Callers may write each and hand it back to the next."""
    pool = clean_pool(candidates(raw, prompt, key, unsafe, options.rules), key, options)
    extended = extend(pool.withColumnRenamed(prompt, "raw_prompt") if prompt != "prompt" else pool.withColumn("raw_prompt", F.col("clean")), options, client)
    judged = filters.post_filter(extended, options.check_lineage)
    safe = judged.where("usable_for_teacher_generation")
    return {"clean": pool, "extended": extended, "safe": safe, "rejected": judged.where("NOT usable_for_teacher_generation"), "final": finalize(safe, options)}
