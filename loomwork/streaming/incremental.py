"""Incremental runs by content: what has not changed is not done again.

The engine is batch; there are no streams to keep state of. A stage's inputs have a fingerprint (see
writers.content_hash); a stage whose fingerprint is that of its last run is skipped, and rows are redone by the
hash of their own content.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import content_hash


def fingerprint(inputs: dict[str, DataFrame], settings: dict[str, object]) -> str:
    """One hash of a stage's input tables and settings."""
    parts = [(name, *content_hash(df)) for name, df in sorted(inputs.items())]
    return hashlib.sha256(repr((parts, sorted(settings.items(), key=lambda kv: kv[0]))).encode()).hexdigest()


def due(state: dict[str, str], stage: str, inputs: dict[str, DataFrame], settings: dict[str, object]) -> bool:
    """Whether the stage's inputs or settings differ from its last run's; records the new fingerprint."""
    new = fingerprint(inputs, settings)
    changed = state.get(stage) != new
    state[stage] = new
    return changed


def new_rows(df: DataFrame, done: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose content (the columns' hash, as content_sha) is not among what is done."""
    text = F.to_json(F.struct(*columns))
    return df.withColumn("content_sha", F.sha2(text, 256)).join(done.select("content_sha"), "content_sha", "left_anti")


def records_due(records: DataFrame, today: str, days: int = 7) -> DataFrame:
    """Records to fetch again: fetched `days` or more ago and not closed, or never."""
    old = F.datediff(F.lit(today).cast("date"), F.col("fetched_at").cast("date")) >= days
    return records.where(F.col("fetched_at").isNull() | (old & ~F.col("status").eqNullSafe("Closed")))
