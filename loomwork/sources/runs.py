"""Search runs, fits and scratch sets as stored tables: each appears whole or not at all, and names what it was made from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R
from ..operators.extraction import walk_groups
from . import writers


class Stale(ValueError):
    """A stored run that was made from other data."""


def write_run(queries: DataFrame, scores: DataFrame, units: DataFrame, path: str) -> None:
    """A search run: its queries, its scores, and last the manifest with the fingerprint of the units it scored, without which it is no run."""
    writers.replace_table(queries, f"{path}/queries")
    writers.replace_table(scores, f"{path}/scores")
    n, fingerprint = writers.content_hash(units)
    writers.replace_table(units.sparkSession.createDataFrame([(n, fingerprint)], "units bigint, fingerprint string"), f"{path}/manifest")


def load_run(spark: SparkSession, path: str, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A run's queries and scores; one that scored other units is refused."""
    made = writers.read_table(spark, f"{path}/manifest").first()
    n, fingerprint = writers.content_hash(units)
    if (made["units"], made["fingerprint"]) != (n, fingerprint):
        raise Stale(f"{path}: scored {made['units']} other units")
    return writers.read_table(spark, f"{path}/queries"), writers.read_table(spark, f"{path}/scores")


def write_fits(fits: DataFrame, new: DataFrame, path: str) -> DataFrame:
    """Fits with all of the new ones' kinds and label sets replaced, those that are not there any more included."""
    kept = fits.join(new.select("kind", "label_set").distinct(), ["kind", "label_set"], "left_anti")
    return writers.replace_table(new.unionByName(kept), path)


def scratch_files(spark: SparkSession, folder: str, slug: str, label: dict[str, str], phrases: Sequence[str], patterns: Sequence[str]) -> None:
    """A scratch label set as three CSV tables, replacing earlier ones."""
    tables = {
        "labels": ([(slug, label["name"], label["definition"], "true")], "label_id string, label_name string, definition string, active string"),
        "queries": ([(slug, f"q{i}", p, "true") for i, p in enumerate(phrases, 1)], "label_id string, query_id string, query string, active string"),
        "patterns": ([(slug, f"w{i}", p, "false") for i, p in enumerate(patterns, 1)], "label_id string, pattern_id string, pattern string, case_sensitive string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        writers.write_columns(df, f"{folder}/{slug}_{name}", df.columns)


def ask_batches(items: DataFrame, most_items: int = 50, most_characters: int = 80_000, spread: int = 64) -> DataFrame:
    """Items still to ask (question_sha, state_sha, state) with their batch: of one question set, in the order of their hashes, as many as both bounds allow; a longer state is a batch of its own. A question set is dealt over `spread` walks, so that one with very many items is no single task."""

    def walk(rows: list[dict]) -> list[tuple]:
        out, n, size, batch = [], 0, 0, 0
        for r in rows:
            length = len(r["state"] or "")
            if n and (n == most_items or size + length > most_characters):
                n, size, batch = 0, 0, batch + 1
            n, size = n + 1, size + length
            out.append((r["question_sha"], r["state_sha"], f"{r['question_sha'][:12]}:{r['walk']}:{batch}"))
        return out

    own = items.select("question_sha", "state_sha", "state").distinct().withColumn("walk", F.pmod(F.xxhash64("state_sha"), F.lit(spread)))
    return walk_groups(own, ["question_sha", "walk"], ["state_sha"], walk, "question_sha string, state_sha string, batch string")


def schema_columns(df: DataFrame, names: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """A CSV's columns under the database's names and kinds: names maps old to new; columns that it lacks go."""
    return df.select(*[(S.lenient(F.col(old), kinds[new]) if new in kinds else F.nullif(F.col(old), F.lit(""))).alias(new) for old, new in names.items() if old in df.columns])


def unit_rows(units: DataFrame, texts: DataFrame) -> DataFrame:
    """Units (document_id, char_start, char_end, lead_start, lead_end) with the text that was embedded: their lead-in, if any, and their own, cut out of the document's text."""
    cut = lambda a, b: F.substring(F.col("__text"), F.col(a) + 1, F.col(b) - F.col(a))
    joined = units.join(texts.select("document_id", F.col("text").alias("__text")), "document_id")
    lead = F.when(F.col("lead_start").isNotNull(), F.concat(cut("lead_start", "lead_end"), F.lit("\n"))).otherwise("")
    return joined.withColumn("text", F.concat(lead, cut("char_start", "char_end"))).drop("__text")


def document_owners(documents: DataFrame, parts: DataFrame) -> DataFrame:
    """Documents (project_ids: an array) whose projects are those of their parts, where they have some; else those they are listed under, kept as listed_project_ids."""
    owners = parts.select("document_id", F.explode("project_ids").alias("p")).groupBy("document_id").agg(F.array_sort(F.collect_set("p")).alias("__owners"))
    return documents.withColumn("listed_project_ids", F.col("project_ids")).join(owners, "document_id", "left").withColumn("project_ids", F.coalesce("__owners", "project_ids")).drop("__owners")


def stage_spend(ledger: DataFrame, prefix: Column | None = None) -> DataFrame:
    """stage, calls, cost of a run's ledger (step, cost): steps that share what stands before a colon are one stage."""
    stage = F.substring_index("step", ":", 1) if prefix is None else prefix
    return ledger.groupBy(stage.alias("stage")).agg(F.count("*").alias("calls"), F.sum("cost").alias("cost"))


def earlier_runs(runs: DataFrame, at: str, n: int = 5) -> DataFrame:
    """The n runs before a time, newest first. A report: the cut is its point."""
    return runs.where(F.col("started_at") < F.lit(at).cast("timestamp")).orderBy(F.col("started_at").desc()).limit(n)


def brief(tables: dict[str, DataFrame]) -> list[str]:
    """A line for each stored table: its name and rows."""
    return [f"{name}: {df.count():,} rows" for name, df in sorted(tables.items())]


def current_rows(rows: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The newest row of each key."""
    return R.first_per_key(rows, keys, [F.col(at).desc_nulls_last()])
