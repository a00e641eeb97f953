"""Working tables: results that several branches read, written once to a folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local run, where that is unset, a temporary folder of our own. A cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="loomwork-core-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet and read back: later steps read it as often as they like, and a lost executor costs none of the steps before."""
    schema = df.schema
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
