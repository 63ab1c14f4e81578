"""Accept and reject rules with accountable reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import vocab
from quarrymill.functions.tags import has
from quarrymill.functions.text import clean_prompt, col, lineage, once, scrub_no_text, word_count


@dataclass(frozen=True)
class CleanRules:
    min_words: int = 8
    max_words: int = 80
    max_safety: float = 0.05
    keep_aspect: bool = False
    entities: bool = True


def reject_reason(raw: Column | str, clean: Column | str, n_words: Column | str, unsafe: Column | str, rules: CleanRules = CleanRules()) -> Column:
    """The first rule that a prompt breaks, null if none. Raw is the prompt as it came; NaN scores count as unsafe."""
    raw, clean, n, unsafe = F.coalesce(col(raw), F.lit("")), col(clean), col(n_words), col(unsafe)
    rough = lambda pattern: raw.rlike(vocab.FLAGS + pattern)
    out = F.when(clean == "", "empty_after_cleaning").when(n < rules.min_words, "too_short").when(n > rules.max_words, "too_long").when(unsafe > rules.max_safety, "unsafe_score").when(rough(vocab.ATTACHMENT), "attachment_or_url").when(has(clean, vocab.TEXT_OR_LOGO), "text_or_logo_request").when(has(clean, vocab.SENSITIVE_OR_IP), "sensitive_or_ip_term").when(rough(vocab.NEGATIVE), "negative_prompt_fragment")
    return out if rules.keep_aspect else out.when(rough(vocab.ASPECT), "aspect_or_size_hint")


def with_clean(df: DataFrame, raw: str, unsafe: Column, rules: CleanRules = CleanRules()) -> DataFrame:
    """df with clean, n_words, max_score and reason (null: accepted)."""
    out = df.withColumn("clean", once(clean_prompt(raw, rules.entities))).withColumn("n_words", once(word_count("clean"))).withColumn("max_score", unsafe)
    return out.withColumn("reason", once(reject_reason(raw, "clean", "n_words", "max_score", rules)))


def post_filter_reasons(prompt: Column | str, fallback: Column | str, fields: list[Column | str] | None = None) -> Column:
    """All reasons against a rewritten prompt, in rule order; fields: the texts it came from, to be checked as well."""
    prompt, checks = F.coalesce(col(prompt), F.lit("")), [F.when(col(fallback), "fallback_or_rejected")]
    origin = lineage(*fields) if fields else None
    for name, terms in (("public_ip_or_brand", vocab.PUBLIC_IP), ("sensitive_or_violent", vocab.VIOLENT)):
        checks.append(F.when(has(prompt, terms), name))
        if origin is not None:
            checks.append(F.when(has(origin, terms), f"{name}_lineage"))
    return F.array_compact(F.array(*checks))


def post_filter(df: DataFrame, check_lineage: bool = True) -> DataFrame:
    """df (prompt, used_fallback_prompt and the lineage fields) with usable, reasons, scrubbed prompt and notes."""
    fields = ["raw_prompt", "clean_prompt", "pre_llm_prompt", "extended_prompt"] if check_lineage else None
    out = df.withColumn("post_filter_reject_reasons", post_filter_reasons("prompt", "used_fallback_prompt", fields))
    usable = F.size("post_filter_reject_reasons") == 0
    out = out.withColumn("usable_for_teacher_generation", usable).withColumn("_scrubbed", F.when(usable, scrub_no_text("prompt")).otherwise(F.col("prompt")))
    changed = F.col("_scrubbed") != F.col("prompt")
    out = out.withColumns({"prompt_before_postprocess": F.when(changed, F.col("prompt")), "postprocess_notes": F.when(changed, F.array(F.lit("removed_positive_no_text_clause"))), "extended_prompt": F.when(changed, F.col("_scrubbed")).otherwise(F.col("extended_prompt"))})
    return out.withColumn("prompt", F.col("_scrubbed")).drop("_scrubbed")


def rewrite_error(is_object: Column, rejected: Column | str, prompt: Column | str, shortest: int = 25, longest: int = 110) -> Column:
    """What is wrong with a rewrite, null if nothing; a rejection by the model is valid."""
    text = F.btrim(F.coalesce(col(prompt), F.lit("")))
    n = word_count(text)
    return F.when(~is_object, "result_not_object").when(F.coalesce(col(rejected), F.lit(False)), None).when(text == "", "missing_prompt").when(n < shortest, "extended_prompt_too_short").when(n > longest, "extended_prompt_too_long")
