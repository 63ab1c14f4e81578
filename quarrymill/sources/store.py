"""Intermediate tables in the folder that driver and executors share, and their removal."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class _Written(list):
    """Sessions and paths; empty where a function sent to executors carries this module along, as sessions can't go there."""

    def __reduce__(self) -> tuple:
        return list, ()


#: Paths written by this process and not yet removed.
_written: list[tuple[SparkSession, str]] = _Written()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder serves in
    local mode only; on a cluster the executors could not see one, so that is an error."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="quarrymill-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path for a table; it is removed at the end of the process or by `drop`."""
    path = f"{shared_dir(spark)}/quarrymill/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(drop_all)
    _written.append((spark, path))
    return path


#: Spark removes an execution's shuffle files at its end if this is set; what was written needs them no more.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of whole texts go to Python in batches of this many at most, so that long ones fit on both sides.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def save(df: DataFrame, path: str) -> None:
    """df as a Parquet table; the shuffle files of its plan go at once, not when the driver's garbage is collected."""
    conf = df.sparkSession.conf
    before = {CLEAN: conf.get(CLEAN, "false"), BATCH: conf.get(BATCH)}
    conf.set(CLEAN, "true")
    conf.set(BATCH, str(min(BATCH_ROWS, int(before[BATCH]) if int(before[BATCH]) > 0 else BATCH_ROWS)))
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, label)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Remove tables that `materialise` gave, once nothing will read them again."""
    for path in _paths(tables):
        for spark, own in [x for x in _written if x[1].endswith(path)]:
            _remove(spark, own)


def mark() -> int:
    """How many paths there are now, for `drop_since`."""
    return len(_written)


def drop_since(start: int, *keep: DataFrame) -> None:
    """Remove all tables written since `mark` gave start, but for those that `keep` reads, once nothing else will be read
    again."""
    kept = _paths(keep)
    for spark, path in _written[start:]:
        if not any(path.endswith(x) for x in kept):
            _remove(spark, path)


def _paths(tables: tuple[DataFrame, ...]) -> set[str]:
    """The last parts of the folders that tables read."""
    return {"/" + f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for table in tables for f in table.inputFiles()}


def drop_all() -> None:
    drop_since(0)


def _remove(spark: SparkSession, path: str) -> None:
    _written.remove((spark, path))
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have ended; a table left behind does no harm
        pass
