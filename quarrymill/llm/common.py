"""What the operators of this subpackage share: tables, shared storage, row keys and Arrow plumbing."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.sources.io import parquet_table as table
from quarrymill.sources.store import drop, drop_since, mark, materialise, new_path, save

# Functions sent to executors carry their code along, so workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

__all__ = ["arrow_blobs", "carried", "drop", "drop_since", "mark", "materialise", "new_path", "restored", "row_key", "save", "table", "to_batch", "worker_cache"]


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_quarrymill_cache", types.ModuleType("_quarrymill_cache")).__dict__


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs, k1 and k2, never null: equal rows have equal keys, so a repeated or null doc_id does no harm."""
    return [F.xxhash64(F.lit(1), F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.col(text), F.col(doc_id), F.lit(2)).alias("k2")]


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns beside `carried`, a struct of all columns of docs, so that no name of docs can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carried"), *names)


def restored(df: DataFrame, docs: DataFrame, text: Column | None = None, changed: Column | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """The columns of docs from `carried`, in docs' order and types, then those of `more`; where `changed` holds, text is
    replaced, and n_chars, if docs has it, follows."""
    columns = {c: F.col("carried").getField(c) for c in docs.columns}
    if text is not None:
        columns["text"] = F.when(changed, text).otherwise(columns["text"])
        if "n_chars" in columns:
            columns["n_chars"] = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return df.select(*(column.alias(c) for c, column in [*columns.items(), *(more or {}).items()]))


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_blobs(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each value of a string or binary column; null: empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""
