"""Rewriting prompts with a language model: a deterministic stand-in, reply parsing, validation and the client seam."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import vocab
from quarrymill.functions.text import col, hash_pick
from quarrymill.operators.filters import rewrite_error

# Fixed values of the dry run: its choices and the sentence around the prompt.
CAMERAS = ["a locked medium shot", "a gentle forward push-in", "a wide establishing shot"]
LIGHTS = ["soft natural light", "warm afternoon light", "balanced cinematic lighting"]
ACTION = ". Over five seconds, the main subject performs one clear, continuous action while the background remains coherent. The camera uses "
CONSISTENCY = ". Keep the subject appearance, scene layout, and motion direction consistent across the clip."

REPLY = "prompt string, reject boolean, reject_reason string, tags map<string,string>"


def dry_run(prompt: Column | str, key: str, seed: int) -> Column:
    """The rewrite without a model: a fixed sentence around the prompt, with a camera and a light that the id picks."""
    text = F.btrim(col(prompt))
    animated = F.lower(text).rlike("|".join(vocab.ANIMATED))
    pick = lambda slot, values: F.element_at(F.array(*map(F.lit, values)), (hash_pick(seed, key, slot, len(values)) + 1).cast("int"))
    style = F.when(animated, "Stylized animation video").otherwise("Realistic video")
    return F.concat(style, F.lit(". "), text, F.lit(ACTION), pick("camera", CAMERAS), F.lit(" with "), pick("light", LIGHTS), F.lit(CONSISTENCY))


def reply_json(text: Column | str) -> Column:
    """The part of a chatty reply from its first to its last brace, or the whole reply if there is none."""
    text = F.btrim(F.coalesce(col(text), F.lit("")), F.lit(" \t\r\n`"))
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.coalesce(F.nullif(braces, F.lit("")), text)


def parse_reply(text: Column | str) -> Column:
    """A struct of prompt, reject, reject_reason and tags; null where the reply is not a JSON object."""
    body = reply_json(text)
    return F.when(body.startswith("{") & F.try_parse_json(body).isNotNull(), F.from_json(body, REPLY))


def merge_tags(old: Column | str, new: Column | str) -> Column:
    """Both maps as one; where both have a key, the new value stands unless it is null."""
    none = F.create_map().cast("map<string,string>")
    return F.map_zip_with(F.coalesce(col(old), none), F.coalesce(col(new), none), lambda k, a, b: F.coalesce(b, a))


def apply_replies(df: DataFrame, reply: str = "reply", model: str = "dry-run-template", source: str = "llm_extended_v1") -> DataFrame:
    """df (prompt, clean_prompt, tags, and the parsed reply) with the extension columns; a bad reply falls back."""
    error = rewrite_error(F.col(reply).isNotNull(), f"{reply}.reject", f"{reply}.prompt")
    rejected = F.coalesce(F.col(f"{reply}.reject"), F.lit(False)) | error.isNotNull()
    text = F.when(rejected, F.col("prompt")).otherwise(F.btrim(F.col(f"{reply}.prompt")))
    extension = F.struct(F.lit(model).alias("model"), rejected.alias("reject"), F.coalesce(error, F.col(f"{reply}.reject_reason"), F.lit("")).alias("reject_reason"), rejected.alias("used_fallback_prompt"))
    return df.withColumns({"source": F.lit(source), "pre_llm_prompt": F.col("prompt"), "clean_prompt": F.coalesce("clean_prompt", "prompt"), "llm_extension": extension, "used_fallback_prompt": rejected, "extended_prompt": F.when(~rejected, text), "prompt": text, "tags": merge_tags("tags", f"{reply}.tags")})


def call_model(df: DataFrame, client: Callable[[str], str], retries: int = 3, column: str = "reply_text", workers: int = 1) -> DataFrame:
    """df with the model's replies to its prompts, batch by batch on the executors; client is a function of the prompt,
    called by up to `workers` threads of a task at once. Replies stay with their prompts.

    After `retries` failures of any kind, with growing pauses, the reply is null, which validation turns into a
    fallback, so that one request never ends the job.
    """

    def ask(prompt: str) -> str | None:
        for attempt in range(retries):
            try:
                return client(prompt)
            except Exception:  # noqa: BLE001  the client is foreign code
                time.sleep(min(2**attempt, 8) if attempt + 1 < retries else 0)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max(1, workers)) as threads:
            for frame in batches:
                yield frame.assign(**{column: list(threads.map(ask, frame["prompt"]))})

    return df.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", {column} string")


def pending(records: DataFrame, done: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Records that are not done. Done ids may be null or repeat; the optimizer broadcasts them only while small."""
    return records.join(done.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")


def outcome_counts(df: DataFrame) -> DataFrame:
    """rows, extended, fallbacks and each validation reason, as one row per metric."""
    reason = F.col("llm_extension.reject_reason")
    return df.select(F.explode(F.array_compact(F.array(F.lit("records"), F.when(F.col("used_fallback_prompt"), "fallback").otherwise("extended"), F.when(reason != "", F.concat(F.lit("reason_"), reason))))).alias("metric")).groupBy("metric").agg(F.count("*").alias("n"))
