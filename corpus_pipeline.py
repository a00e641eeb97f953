"""A corpus from raw documents: language, exact copies, near copies, mixture, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs; all but the last return the columns of documents.

Documents whose language is not told go. Of equal texts the row with the largest id stays. Of documents that
link by a similarity of five-word shingles of 0.8 or more the one with the smallest id stays. The mixture
keeps what it takes of each source: a document that it takes in part counts as taken, and one that it takes
more than once stands as often. The last stage packs what is left into sequences of at most 4096 tokens.
Null ids, repeated rows and further columns pass through; an empty table gives an empty result at each stage.
The pipeline is an application: unless its session has a bound for the bytes of Arrow batches, it sets one.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import langid, mixing, packing, radix, simhash
from loomwork.llm.common import BATCH_BYTES, BATCH_SETTING, made, made_since, read_table, release, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Of each thread, the working tables of its run's stages before, which a stage deletes as soon as its own input does not read them.
_left = threading.local()


def staged(first: bool = False) -> Callable[[Stage], Stage]:
    """A stage that first deletes the working tables of those before it in its run: their results have been written and read again by then. The first stage begins a run: it deletes none, so that the result of a run before stays readable."""

    def wrap(stage: Stage) -> Stage:
        @functools.wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if BATCH_SETTING not in spark.conf.getAll:  # whole documents pass through Python: a bound for executors with little memory
                spark.conf.set(BATCH_SETTING, BATCH_BYTES)
            left = [] if first else release(spark, getattr(_left, "tables", []), docs)
            before = made()
            out = stage(spark, docs, sf_dir)
            _left.tables = [*left, *made_since(before)]
            return out

        return run_stage

    return wrap


@staged(first=True)
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a probability of 0.4 or more. Null, empty and letterless texts go; whole texts are read; rows that repeat are judged alike; all columns pass through; an empty table gives no rows."""
    return langid.keep_known_languages(docs)


@staged()
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (a null one is empty) the row with the largest id; of rows that tie in id one, null ids last of all. Whole texts are compared; all columns pass through; an empty table gives no rows."""
    return radix.drop_exact_duplicates(docs)


@staged()
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, and so on, by a similarity of five-word shingles of 0.8 or more the one with the smallest id; texts without words are one group, null ids larger than all others, of rows that tie one stays. All columns pass through; an empty table gives no rows."""
    return simhash.drop_near_duplicates(docs, similarity=0.8, words=5)


@staged()
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mixture takes words of, as often as it passes over them, the last pass in part counted whole. Texts without words are never taken; a null source is a source; rows that tie in id go by size; all columns pass through; an empty table gives no rows."""
    mixed = mixing.mix_sources(docs, carry=docs.columns).where("taken > 0")
    times = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    return mixed.select("row", times.alias("time")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@staged()
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their sequence and place. Null and empty texts are the end id alone, only texts longer than a sequence are cut, rows that repeat are packed each; an empty table gives no rows."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: The learnt language model and the fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
