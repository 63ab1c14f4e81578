"""Counts and length statistics of a prompt bank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.text import word_count

TAGS = ["source_bucket", "subject_type", "scene_type", "motion_type", "motion_intensity", "length_bucket"]


def tag_counts(df: DataFrame, tags: list[str] = TAGS) -> DataFrame:
    """dimension, value and n over the single tags and the exploded challenge_tags; null tags count as `unknown`."""
    single = F.array(*(F.struct(F.lit(t).alias("dimension"), F.coalesce(F.col(t), F.lit("unknown")).alias("value")) for t in tags))
    several = F.transform(F.coalesce(F.col("challenge_tags"), F.array().cast("array<string>")), lambda x: F.struct(F.lit("challenge_tags").alias("dimension"), x.alias("value")))
    return df.select(F.explode(F.concat(single, several)).alias("t")).groupBy("t.dimension", "t.value").agg(F.count("*").alias("n"))


def word_lengths(df: DataFrame, text: str = "prompt") -> DataFrame:
    """One row: records, min, max and avg words (two places); zeros for an empty table."""
    n = word_count(text)
    return df.agg(F.count("*").alias("records"), F.coalesce(F.min(n), F.lit(0)).alias("min_words"), F.coalesce(F.max(n), F.lit(0)).alias("max_words"), F.coalesce(F.round(F.avg(n), 2), F.lit(0.0)).alias("avg_words"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """One row: the different values of a column of few values, in order, comma-joined under the column's plural."""
    return df.groupBy(column).count().agg(F.array_join(F.array_sort(F.collect_list(column)), ",").alias(f"{column}s"))


def reason_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(reason), F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def exploded_counts(df: DataFrame, reasons: str = "post_filter_reject_reasons") -> DataFrame:
    """A row per reason and for input, kept and rejected; a row with several reasons counts for each."""
    kept = F.when(F.size(reasons) == 0, "kept").otherwise("rejected")
    named = F.concat(F.array(F.lit("input"), kept), F.transform(reasons, lambda r: F.concat(F.lit("reject_"), r)))
    return df.select(F.explode(named).alias("metric")).groupBy("metric").agg(F.count("*").alias("n"))


def most_common(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts (n) with place, from 1: most frequent first within the columns `by`, ties in the order of value."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), "value")
    return df.withColumn("place", F.row_number().over(order).cast("long"))


def stats_document(tagged: DataFrame, reasons: DataFrame, text: str = "prompt") -> dict:
    """The statistics of a bank as one small document: records, word lengths, counts by dimension and by reason, each
    most frequent first. Only tables of a few rows for each dimension are collected."""
    lengths = word_lengths(tagged, text).first().asDict()
    document: dict = {"records": lengths.pop("records"), "word_lengths": lengths, "tags": {}, "reasons": {}}
    for row in most_common(tag_counts(tagged), ["dimension"]).orderBy("dimension", "place").collect():
        document["tags"].setdefault(row["dimension"], {})[row["value"]] = row["n"]
    for row in reasons.orderBy(F.desc("n"), "reason").collect():
        document["reasons"][row["reason"]] = row["n"]
    return document
