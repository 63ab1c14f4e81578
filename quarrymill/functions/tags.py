"""Heuristic tags of a prompt as Spark columns; the prompt is cut to words once, which all flags read."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import vocab
from quarrymill.functions.text import col, length_bucket, once, words_of

MOTION_RICH, NATURAL = "motion_rich", "natural"


def has(text: Column | str, terms: list[str], words: Column | str | None = None) -> Column:
    """Whether text holds one of terms as whole words. With the text's `words_of`, single words are looked up there, and
    the pattern of the others only runs where the first word of one is."""
    if words is None:
        return col(text).rlike(vocab.words(terms))
    every = vocab.literal(terms)
    several = [t for t in every if not t.isalnum()]
    among = lambda values: F.arrays_overlap(col(words), F.array(*map(F.lit, values)))
    out = among([t for t in every if t.isalnum()])
    return out | (among(sorted({re.match("[a-z0-9]+", t)[0] for t in several})) & col(text).rlike(vocab.words(several))) if several else out


def first_label(text: Column | str, labels: dict[str, list[str]], default: str, words: Column | str | None = None) -> Column:
    """The first label, in order, one of whose words is in text."""
    return F.coalesce(*(F.when(has(text, terms, words), label) for label, terms in labels.items()), F.lit(default))


def classify_subject(text: Column | str, words: Column | str | None = None) -> Column:
    return first_label(text, vocab.SUBJECTS, "scene", words)


def classify_scene(text: Column | str, words: Column | str | None = None) -> Column:
    return first_label(text, vocab.SCENES, "unknown", words)


def with_flags(df: DataFrame, text: str = "prompt") -> DataFrame:
    """Boolean columns that several tags share, so that nothing is looked up twice, and _words."""
    flags = {"motion": vocab.MOTION, "camera": vocab.CAMERA, "dynamics": vocab.DYNAMICS, "fine": vocab.FINE, "high": vocab.HIGH_INTENSITY, "cyclic": vocab.CYCLIC, "occlusion": vocab.OCCLUSION, "identity": vocab.IDENTITY, "entities": vocab.ENTITIES}
    return df.withColumn("_words", once(words_of(text))).withColumns({f"_{name}": has(text, terms, "_words") for name, terms in flags.items()})


def motion_type() -> Column:
    """Needs the columns of with_flags, as do the next three."""
    return F.when(F.col("_dynamics"), "environment_dynamics").when(F.col("_fine"), "fine_interaction").when(F.col("_camera"), "camera_motion").when(F.col("_motion"), "subject_translation").otherwise("static_low_motion")


def motion_intensity() -> Column:
    return F.when(F.col("_high"), "high").when(F.col("_motion"), "medium").otherwise("low")


def source_bucket() -> Column:
    return F.when(F.col("_motion") | F.col("_camera"), MOTION_RICH).otherwise(NATURAL)


def challenge_tags() -> Column:
    """Sorted, without repeats; `static_low_motion` where nothing else holds."""
    flags = {"basic_motion": F.col("_motion"), "camera_parallax": F.col("_camera"), "cyclic_motion": F.col("_cyclic"), "occlusion_reentry": F.col("_occlusion"), "identity_persistence": F.col("_identity"), "multi_entity": F.col("_entities"), "fine_interaction": ~F.col("_dynamics") & F.col("_fine"), "environment_dynamics": F.col("_dynamics")}
    none = ~reduce(lambda a, b: a | b, flags.values())
    return F.array_sort(F.array_compact(F.array(*(F.when(flag, tag) for tag, flag in (flags | {"static_low_motion": none}).items()))))


def with_tags(df: DataFrame, text: str = "prompt") -> DataFrame:
    """df with all tag columns of its prompt; a null prompt counts as empty."""
    out = with_flags(df.withColumn("_prompt", once(F.coalesce(F.col(text), F.lit("")))), "_prompt")
    out = out.withColumns({"source_bucket": source_bucket(), "subject_type": classify_subject("_prompt", "_words"), "scene_type": classify_scene("_prompt", "_words"), "motion_type": motion_type(), "camera_motion": F.when(F.col("_camera"), "explicit").otherwise("unknown"), "motion_intensity": motion_intensity(), "challenge_tags": challenge_tags(), "length_bucket": length_bucket("_prompt")})
    return out.drop(*(c for c in out.columns if c.startswith("_") and c not in df.columns))
