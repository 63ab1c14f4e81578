"""Metadata manifests and the checks between records and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The manifest's columns, fixed values.
FIELDS = ["video", "prompt", "negative_prompt", "prompt_id", "seed", "height", "width", "num_frames", "fps", "cfg_scale", "num_inference_steps", "sigma_shift", "subject_group", "subject_type"]


def last_of_each(rows: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """The last row of each key; null and empty keys are left out."""
    keyed = rows.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    falling = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    return keyed.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*falling))).where("_n = 1").drop("_n")


def metadata_rows(records: DataFrame) -> DataFrame:
    """The manifest's fields of sidecar records, missing ones empty; tags may be a struct or a map, or not be there."""
    tags = records.columns and "tags" in records.columns
    named = {"video": "video_path"}
    def field(name: str) -> Column:
        source = named.get(name, name)
        if source in records.columns:
            value = F.col(source)
        elif tags and name in ("subject_group", "subject_type"):
            value = F.col("tags").getItem(name) if records.schema["tags"].dataType.typeName() == "map" or name in records.schema["tags"].dataType.names else F.lit(None)
        else:
            value = F.lit(None)
        return F.coalesce(value.cast("string"), F.lit("")).alias(name)
    return records.select(*map(field, FIELDS))


def prefer_metadata(records: DataFrame, metadata: DataFrame, key: str = "prompt_id") -> DataFrame:
    """The manifest row of each record: that of metadata where there is one, else built from the record."""
    built, own = metadata_rows(records), metadata.select(*FIELDS)
    joined = built.alias("b").join(own.alias("m"), key, "left")
    there = F.col("m.video").isNotNull()
    return joined.select(*(F.col(key) if f == key else F.when(there, F.col(f"m.{f}")).otherwise(F.col(f"b.{f}")).alias(f) for f in FIELDS))


def with_artifact(records: DataFrame, artifacts: DataFrame, key: str) -> DataFrame:
    return records.join(artifacts.select(key).distinct(), key, "left_semi")


def complete(records: DataFrame, artifacts: DataFrame, key: str, least_bytes: int = 1024) -> DataFrame:
    """Records with an artifact of at least `least_bytes` (column length)."""
    return with_artifact(records, artifacts.where(F.col("length") >= least_bytes), key)


def verify(records: DataFrame, artifacts: DataFrame, key: str, examples: int = 20) -> DataFrame:
    """One row: record_count, artifact_count, missing_count, missing (the first `examples` keys, in order) and ok."""
    marked = records.join(artifacts.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    counts = marked.agg(F.count("*").alias("record_count"), F.count_if(F.col("_there").isNull()).alias("missing_count"))
    first = marked.where("_there IS NULL").select(key).orderBy(key).limit(examples).agg(F.array_sort(F.collect_list(key)).alias("missing"))
    n = artifacts.agg(F.count("*").alias("artifact_count"))
    return counts.crossJoin(n).crossJoin(first).select("record_count", "artifact_count", "missing_count", "missing", (F.col("missing_count") == 0).alias("ok"))
