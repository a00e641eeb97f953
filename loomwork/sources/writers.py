"""Sinks: tables replaced whole or in part, appended caches, manifests, reports.

A table is a folder of versions with a pointer file, so readers see the old version or the new one, never a mix,
on any file system that Spark writes to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import relational as R


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Writes `df` as the table's new version and points the table at it; returns the version read back."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/v-{version}")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return read_table(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's current version."""
    version = spark.read.json(f"{path}/current", schema="version string").first()["version"]
    return spark.read.parquet(f"{path}/v-{version}")


def replace_where(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replaces the partitions that `df` has rows of (one kind and label set, say), leaving the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_columns(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """A CSV export with the columns stated: missing ones blank, others left out."""
    df.select(*[(F.col(c) if c in df.columns else F.lit("")).alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def load_rows(df: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, dict[str, int]]:
    """Text columns as their kinds (see scalars.lenient), and how many values of each could not be read. Both come from one pass when the table is written with the observation attached."""
    bad = df.agg(*[S.unreadable(F.col(c), k).alias(c) for c, k in kinds.items()]).first().asDict() if kinds else {}
    return df.select(*[(S.lenient(F.col(c), kinds[c]) if c in kinds else F.nullif(F.col(c), F.lit(""))).alias(c) for c in df.columns]), bad


def append_vectors(cache: DataFrame, new: DataFrame, width: int) -> DataFrame:
    """New vectors (sha, embedding) to append to a content-addressed cache: of the right width, with a norm of 0.9 to 1.1, not there yet, each once."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    good = new.where((F.size("embedding") == width) & norm.between(0.9, 1.1))
    return R.first_per_key(good, ["sha"], [F.col("embedding").asc()]).join(cache.select("sha"), "sha", "left_anti")


def content_hash(df: DataFrame) -> tuple[int, str]:
    """Rows and a hash of a table that does not depend on their order."""
    flat = [F.to_json(F.struct(F.col(f.name))) if isinstance(f.dataType, T.MapType | T.VariantType) else F.col(f.name) for f in df.schema]
    r = df.agg(F.count("*").alias("n"), F.sha2(F.coalesce(F.sum(F.xxhash64(*flat).cast("decimal(38,0)")), F.lit(0)).cast("string"), 256).alias("h")).first()
    return r["n"], r["h"]


def manifest(tables: dict[str, DataFrame]) -> tuple[str, list[tuple[str, int, str]]]:
    """The identity of a release: the hash of its tables' names, rows and hashes; equal data has an equal one."""
    import hashlib

    rows = [(name, *content_hash(df)) for name, df in sorted(tables.items())]
    return hashlib.sha256(repr(rows).encode()).hexdigest()[:12], rows


def latest_load(loads: DataFrame) -> DataFrame:
    """Each table's latest source hash."""
    return loads.groupBy("table").agg(F.max_by("source_sha", "loaded_at").alias("source_sha"))


def report(counters: dict[str, object], title: str) -> str:
    """Counters as a Markdown note."""
    return "\n".join([f"# {title}", "", *[f"- {k}: {v}" for k, v in counters.items()], ""])
