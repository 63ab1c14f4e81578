"""Sources and sinks of the engine; paths are only ever opened by Spark, so any file system that Spark reads will do."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.vocab import SAFETY_COLUMNS
from quarrymill.operators.manifests import FIELDS, last_of_each
from quarrymill.sources.store import drop, materialise

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("uuid", "prompt", *SAFETY_COLUMNS)])


def parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores is dealt to all cores; larger ones stay as they are read.

    Only file names are looked at. A small table pays one cheap exchange, a large one none."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df._jdf.inputFiles()) >= cores else df.repartition(cores)


def raw_prompts(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of prompts: columns by the header's names, quoted line breaks and doubled quotes, all strings, '' for null.
    Short rows are filled with '', surplus fields dropped, columns of the file beside the schema left aside."""
    header = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("enforceSchema", False).csv(path)
    return header.select(*(F.coalesce(F.col(f"`{f.name}`") if f.name in header.columns else F.lit(None).cast("string"), F.lit("")).alias(f.name) for f in RAW_SCHEMA))


def jsonl(spark: SparkSession, path: str, schema: T.StructType | str, limit: int | None = None, missing_ok: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped. A missing path is an empty table if `missing_ok`."""
    try:
        out = spark.read.schema(schema).json(path)
        return out if limit is None else out.limit(limit)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def sidecars(spark: SparkSession, path: str, schema: T.StructType, ordered: bool = False) -> DataFrame:
    """A folder of JSON documents with file_name, and sidecar_error where a document does not parse. `ordered` sorts by
    file name, for callers that need the listing's order."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    read = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return read.select(*(f.name for f in schema), F.col("_metadata.file_name").alias("file_name"), F.col("_corrupt_record").isNotNull().alias("sidecar_error")).transform(lambda df: df.orderBy("file_name") if ordered else df)


LEASE = T.StructType([T.StructField(c, t) for t, names in ((T.StringType(), ("prompt_id", "token", "worker_id", "hostname", "state")), (T.DoubleType(), ("updated_at", "expires_at")), (T.IntegerType(), ("pid", "lease_seconds"))) for c in names])


def lease_files(spark: SparkSession, path: str) -> DataFrame:
    """The leases of a folder of lock files, with file_name; a file that does not parse is a lease of nulls, never an
    error, so that only its age can free it (`is_stale`)."""
    read = sidecars(spark, path, LEASE)
    return read.select("file_name", *(F.when(~F.col("sidecar_error"), F.col(f.name)).alias(f.name) for f in LEASE))


def existing_ids(spark: SparkSession, path: str, key: str = "prompt_id") -> DataFrame:
    """The ids in a JSON lines file; lines that don't parse, and a missing file, give none."""
    schema = T.StructType([T.StructField(key, T.StringType())])
    return jsonl(spark, path, schema, missing_ok=True).where(F.col(key).isNotNull()).distinct()


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name and length of the files below path; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank; 0 for a missing path."""
    try:
        return spark.read.text(path).where(F.trim("value") != "").count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """A metadata CSV, last row of each prompt_id. The order within a file is that of its lines."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
    read = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    placed = read.withColumn("_file", F.col("_metadata.file_name")).withColumn("_n", F.monotonically_increasing_id())
    return last_of_each(placed, "prompt_id", ["_file", "_n"]).drop("_file")


def taxonomy(spark: SparkSession, path: str) -> dict:
    """A taxonomy document as Python data; one small file by design."""
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0])


def frames(spark: SparkSession, path: str, decode, pattern: str = "*.mp4") -> DataFrame:
    """Metrics of media files by an injected decoder: bytes -> dict of the fields below, or None where it can't open.
    A decoder that raises counts as one that can't open the file, so no file ends the job."""
    import pandas as pd

    schema = "path string, video_bytes long, open_failed boolean, width int, height int, fps double, frame_count long, luma_means array<double>, luma_stds array<double>, lap_vars array<double>, diffs array<double>"
    names = [part.split()[0] for part in schema.split(", ")][3:]

    def run(batches):
        for batch in batches:
            rows = []
            for path, length, content in zip(batch["path"], batch["length"], batch["content"], strict=True):
                try:
                    found = decode(bytes(content))
                except Exception:  # noqa: BLE001  the decoder is foreign code
                    found = None
                rows.append([path, length, found is None, *((found or {}).get(n) for n in names)])
            yield pd.DataFrame(rows, columns=["path", "video_bytes", "open_failed", *names])

    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content").mapInPandas(run, schema)


#: Values are written as they are: quoted where needed, and no blank, tab or line break is trimmed at their ends.
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in UTF-8, null fields left out. The committer makes a whole write visible at once; mode `errorifexists`
    protects what is there, `overwrite` replaces it, `append` adds to it."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, fields: list[str] = FIELDS, mode: str = "errorifexists") -> None:
    """CSV with a header; missing fields are empty."""
    columns = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in df.columns else F.lit("").alias(f) for f in fields]
    df.select(*columns).write.mode(mode).options(**CSV, emptyValue="").csv(path)


def write_split(df: DataFrame, keep: Column, kept_path: str, rejected_path: str, mode: str = "errorifexists") -> None:
    """Kept and rejected rows to two places; rows for which keep is null are rejected. Both are read from a
    written table, so that the rows are made once."""
    judged = materialise(df.withColumn("_keep", F.coalesce(keep, F.lit(False))), "judged")
    write_jsonl(judged.where("_keep").drop("_keep"), kept_path, mode)
    write_jsonl(judged.where("NOT _keep").drop("_keep"), rejected_path, mode)
    drop(judged)


def write_by_status(results: DataFrame, manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The manifest rows and the ids of each status, in folders status=pass, status=review and status=reject."""
    rows = manifest.join(results.select("prompt_id", "status"), "prompt_id").select(*FIELDS, "status")
    rows.write.mode(mode).partitionBy("status").options(**CSV).csv(f"{path}/manifests")
    results.select(F.col("prompt_id").alias("value"), "status").write.mode(mode).partitionBy("status").text(f"{path}/ids")


def write_metadata(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A metadata CSV by its own columns; without rows it has the header `video,prompt` alone."""
    if not df.take(1):
        df = df.sparkSession.createDataFrame([], "video string, prompt string").coalesce(1)
    write_csv(df, path, df.columns, mode)


def write_document(spark: SparkSession, value: dict, path: str, mode: str = "overwrite") -> None:
    """One small JSON document."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode(mode).text(path)


def qc_report(results: DataFrame, counts: DataFrame, summary: DataFrame, examples: int = 20) -> str:
    """Markdown: counts by kind, the metric summary and the first ids of each status. Only small tables are collected."""
    lines = ["# Quality report", ""]
    for kind in ("status", "reject", "warning"):
        lines += [f"## {kind}", "", "| value | n |", "|-|-|"]
        lines += [f"| {r['value']} | {r['n']} |" for r in counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "value").collect()] + [""]
    lines += ["## metrics", "", "| metric | min | mean | median | max |", "|-|-|-|-|-|"]
    lines += [f"| {r['metric']} | {r['min']} | {r['mean']} | {r['median']} | {r['max']} |" for r in summary.orderBy("metric").collect()] + [""]
    for status in ("reject", "review", "pass"):
        ids = [r[0] for r in results.where(F.col("status") == status).select("prompt_id").orderBy("prompt_id").limit(examples).collect()]
        lines += [f"## {status}: first {len(ids)}", "", *(f"- {i}" for i in ids), ""]
    return "\n".join(lines)
