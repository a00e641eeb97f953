"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are worked out once, distributed, and written; a bounded sample of the
labelled rows trains the trees on the driver; all rows are scored by traversing the flattened trees in numpy.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gbdt
from .common import bytes_of, col, crc_of_id, slices, written

#: At most so many labelled rows (chosen by a hash) train the trees.
MAX_TRAIN = 40_000
THRESHOLD = 0.3
STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "space", "letter_other", "punctuation", "symbol", "pipe", "exclamation", "hash_dollar",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "lines", "distinct_lines", "top_line", "words_a_line", "sentences", "distinct_sentences", "capital_words", "short_words", "long_words", "symbol_words", "entropy",
)

_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = 0 if 65 <= _c <= 90 else 1 if 97 <= _c <= 122 else 2 if 48 <= _c <= 57 else 3 if _c in b" \t\n\r\x0b\x0c" else 4 if _c >= 128 else 5 if _ch in ".,;:'\"()?-" else 7 if _ch == "|" else 8 if _ch == "!" else 9 if _ch in "#$%&*" else 6


def statistics(text: bytes) -> list[float]:
    """The statistics of a UTF-8 text, in the order of STATISTICS; zeros for an empty one."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, seen, 10) / n
    p = seen[seen > 0] / n
    words = text.split()
    w = len(words) or 1
    count = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split(b"\n") if x.strip()]
    lined = Counter(lines)
    sentences = [x.strip() for x in text.split(b".") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    capital = sum(x[:1].isupper() for x in words)
    odd = sum(not x[-1:].isalnum() and x[-1] < 128 for x in words)
    return [
        math.log1p(n), math.log1p(len(words)), float(lengths.mean()) if len(words) else 0.0, *kinds.tolist(),
        len(count) / w, max(count.values(), default=0) / w, repeated / w, len(pairs) / w, math.log1p(len(lines)), len(lined) / (len(lines) or 1), max(lined.values(), default=0) / (len(lines) or 1), w / (len(lines) or 1),
        math.log1p(len(sentences)), len(set(sentences)) / (len(sentences) or 1), capital / w, float((lengths <= 2).sum()) / w, float((lengths >= 12).sum()) / w, odd / w, float(-(p * np.log2(p)).sum()),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics (array<float>) for each row; null and empty texts have zeros."""
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.record_batch([b.column(0), pa.array([statistics(t) for t in bytes_of(b, "text")], pa.list_(pa.float32()))], ["doc_id", "x"])

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, x array<float>")


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, chosen by the crc32 of the id as text."""
    return crc_of_id(doc_id) % 5 == 0


def train(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> gbdt.Forest:
    """Trees from the labelled rows of `stats` that are not held out. A label is the mean of an id's rows, rounded; nulls and other values don't count. No labels: 0.5 for all."""
    label = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    rows = stats.join(label, "doc_id").select("x", "y", F.xxhash64(F.lit("quality"), "doc_id").alias("h")).orderBy("h", "x", "y").limit(max_train).select("x", "y").toPandas()
    x = np.array(rows["x"].tolist(), dtype=np.float32).reshape(-1, len(STATISTICS)).astype(np.float64)
    return gbdt.fit(x, rows["y"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for each row. Rows that repeat are scored alike; empty tables: empty result."""
    spark = docs.sparkSession
    stats = written(document_statistics(docs, id_col, text_col), "quality")
    forest = spark.sparkContext.broadcast(train(stats, labels, max_train))  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
            yield pa.record_batch([b.column("doc_id"), pa.array(forest.value.score(x))], ["doc_id", "score"])

    scored = stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
