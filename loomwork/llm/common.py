"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: list[str] = []
_made = threading.local()
#: Bytes of an Arrow batch while a working table is written, for executors with little memory.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table `name` under `sf_dir`, through Spark's reader only (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in a local run, one of our own where that is unset. A cluster must name one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="loomwork-"))
        atexit.register(shutil.rmtree, _OWN_DIR[0], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(_OWN_DIR[0])
    return f"file://{_OWN_DIR[0]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs its running tasks, never the steps before; and whatever was
    not deterministic in `df` (row ids, partition ids) is fixed from here on. While it is written, Arrow batches
    are bounded to BATCH_BYTES; the session's own bound stands again afterwards.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.getAll.get(BATCH_SETTING)  # as it was set, if it was
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)
    _tables().append(path)
    out = spark.read.schema(schema).parquet(path)
    out._own_path = path
    return out


def _tables() -> list[str]:
    """The working tables that this thread has written."""
    if not hasattr(_made, "tables"):
        _made.tables = []
    return _made.tables


def made() -> int:
    """How many working tables this thread has written so far."""
    return len(_tables())


def made_since(number: int) -> list[str]:
    """The working tables that this thread has written after the first `number`."""
    return _tables()[number:]


def forget(*tables: DataFrame) -> None:
    """Deletes working tables (of `written`) that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._own_path)


def release(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Deletes the working tables at `paths` that `reader` does not read; returns those that stay."""
    read = reader.inputFiles() if paths else []
    plain = lambda x: x.removeprefix("file:").lstrip("/")
    kept = [p for p in paths if any(plain(f).startswith(plain(p)) for f in read)]
    for p in set(paths) - set(kept):
        _delete(spark, p)
    return kept


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what a function makes of whole texts stays small; Spark bounds the bytes of a batch itself."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def texts_of(batch: pa.RecordBatch, *path: str) -> list[str]:
    """A column, or a field of a struct, as str; null is the empty text."""
    return [x or "" for x in _at(batch, path).to_pylist()]


def bytes_of(batch: pa.RecordBatch, *path: str) -> list[bytes]:
    """A column, or a field of a struct, as UTF-8 bytes without decoding; null is empty."""
    return [x or b"" for x in _at(batch, path).cast(pa.binary()).to_pylist()]


def _at(batch: pa.RecordBatch, path: tuple[str, ...]) -> pa.Array:
    column = batch.column(path[0])
    return column if len(path) == 1 else column.flatten()[column.type.get_field_index(path[1])]


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1])
    return starts, np.append(starts[1:], len(sorted_keys))
