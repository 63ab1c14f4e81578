"""A corpus pipeline of five stages; each stage's result is a Parquet table that the next one reads as its documents.

language drops documents without a known language, near_dedup keeps one document of each near-duplicate group, pii
redacts personal data, mixing draws the sources to their target weights, packing cuts the token ids into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import langid, mixing, packing, pii, simhash
from quarrymill.llm.common import drop, drop_since, mark, new_path, save, table

#: Packing needs a tokenizer, which SQL lacks: tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without texts that are null, have no letter, or are in none of the languages that docs' labels teach."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id; null texts count as empty."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All docs, personal data in their texts replaced by its kind; null texts stay null."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, shard by shard in shuffled order; null sources are a source."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' token ids in sequences; null texts have the end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("pii", personal_data),
    ("mixing", source_mix),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir. A stage's table, and what its operator wrote on the way, go once
    the next stage is written; the last one goes at the end of the process."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        start = mark()
        out = stage(spark, docs, sf_dir)
        path = new_path(spark, f"corpus-{number}-{name}")
        save(out, path)
        before, docs = docs, spark.read.parquet(path)
        drop_since(start, docs)
        if number:
            drop(before)
    return docs
