"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes decides where a text is cut, so an insertion moves only the chunks around
it. Chunking is normalised: before the normal size a cut needs more zero bits, after it fewer, so sizes gather
around the normal one. A fingerprint is the set of the chunks' digests with their lengths; the likeness of one
to another is the share of its length whose chunks the other has too (containment).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, slices, texts_of

MIN, NORMAL, MAX = 12, 32, 128
HARD, EASY = np.uint32((1 << 7) - 1 << 24), np.uint32((1 << 3) - 1 << 24)
WINDOW = 32
#: A row's range is sought among every STEP-th bound first.
STEP = 64
_GEAR = np.random.default_rng(20_240_501).integers(0, 1 << 32, 256, dtype=np.uint32)

Chunks = list[tuple[int, int]]


def boundaries(data: bytes, start: int = 0) -> list[int]:
    """Ends of the chunks of data from `start`, where a chunk begins. What stands before counts only through the window, so a text cut at a boundary goes on as the whole does."""
    n = len(data)
    base = max(0, start - WINDOW + 1)
    h = _GEAR[np.frombuffer(data, np.uint8, n - base, base)] if n > base else np.zeros(0, np.uint32)
    width = 1
    while width < WINDOW and width < len(h):  # sums of 2, 4, ... bytes, each shifted by its distance
        step = h.copy()
        step[width:] += h[:-width] << np.uint32(width)
        h, width = step, 2 * width
    hard = (np.flatnonzero(h & HARD == 0) + base).tolist()
    easy = (np.flatnonzero(h & EASY == 0) + base).tolist()
    out, s, i, j = [], start, 0, 0
    while n - s > MIN:
        i = bisect_left(hard, s + MIN - 1, i)
        if i < len(hard) and hard[i] < min(s + NORMAL, n):
            s = hard[i] + 1
        else:
            j, end = bisect_left(easy, s + NORMAL, j), min(s + MAX, n)
            s = easy[j] + 1 if j < len(easy) and easy[j] < end else end
        out.append(s)
    if s < n:
        out.append(n)
    return out


def chunk_set(data: bytes, ends: list[int], start: int = 0) -> dict[int, int]:
    """Digest and length of each distinct chunk."""
    digest = xxhash.xxh3_64_intdigest
    out = {}
    for e in ends:
        out[digest(data[start:e]) >> 24] = e - start
        start = e
    return out


def as_text(chunks: dict[int, int]) -> str:
    """The fingerprint as text: digest-length pairs in order of digest."""
    return ",".join(f"{d:010x}-{n}" for d, n in sorted(chunks.items()))


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's length whose chunks are in b; 1 for two empty ones, 0 if only a is empty."""
    if not a:
        return float(not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def _edited(text: str, data: bytes, ends: list[int], own: dict[int, int], following: str) -> tuple[bytes, dict[int, int]]:
    """The text with its last quarter replaced by the beginning of the following one, and its chunks: those that end before the edit stay as they are."""
    k = len(text) // 4
    if not k:
        return data, own
    head = text[: len(text) - k].encode()
    new = head + following[:k].encode()
    kept = bisect_left(ends, len(head) + 1)
    at = ends[kept - 1] if kept else 0
    chunks = chunk_set(data, ends[:kept])
    return new, chunks | chunk_set(new, boundaries(new, at), at)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row; ids are integers.

    The next document is the next row by id (rows that tie in id go by their text), after the last the first;
    a null id comes first, a null text is empty, texts of any length are read whole. Rows go to ranges of ids; the first row of each range also
    goes to the range before, so that every row meets its next one. One shuffle of the texts.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(col(id_col).cast("bigint").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    ids = own.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []  # n - 1 numbers
    bounds = sorted(set(cuts))
    low = -(2**63)

    def range_of(i: Column) -> Column:
        """How many bounds are not above an id: by every STEP-th bound, then by the bounds between two of those."""
        lits = lambda xs: F.array(*[F.lit(int(x)).cast("bigint") for x in xs]) if xs else F.array().cast("array<bigint>")
        coarse = F.size(F.filter(lits(bounds[STEP - 1 :: STEP]), lambda x: x <= i)) * STEP
        return F.transform(F.array(coarse), lambda c: c + F.size(F.filter(F.slice(lits(bounds), c + 1, STEP), lambda x: x <= i)))[0]

    ids = ids.select(F.coalesce("doc_id", F.lit(low)).alias("id"))
    firsts = sorted((r["part"], r["id"]) for r in ids.withColumn("part", range_of(F.col("id"))).groupBy("part").agg(F.min("id").alias("id")).collect())  # a row for each range
    parts = [p for p, _ in firsts]
    to = spark.createDataFrame([(i, parts[k - 1]) for k, (_, i) in enumerate(firsts)], "id bigint, before int")
    sent = own.withColumn("id", F.coalesce("doc_id", F.lit(low))).withColumn("part", range_of(F.col("id"))).join(F.broadcast(to), "id", "left")  # as many rows as ranges
    here = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")))
    sent = sent.select("doc_id", "id", "text", F.explode(F.when(F.col("before").isNull(), here).otherwise(F.concat(here, F.array(F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))))).alias("to"))
    dealt = sent.select(F.col("to.part").alias("part"), F.col("to.guest").alias("guest"), "id", "text", "doc_id").repartition(n, "part").sortWithinPartitions("part", "guest", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next one
        done = False  # the range's guest has been met
        for b in slices(batches):
            rows: list[tuple] = []
            for part, guest, text, doc_id in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b, "text"), b.column(4).to_pylist(), strict=True):
                if held and held[0] != part:
                    held = None
                if guest and held is None:
                    continue  # a further guest that ties in id
                data = text.encode()
                ends = boundaries(data)
                chunks = chunk_set(data, ends)
                if held:
                    _, of, old, raw, cut, print_ = held
                    new, edited = _edited(old, raw, cut, print_, text)
                    rows.append((of, len(old), hashlib.sha256(new).hexdigest(), as_text(print_), as_text(edited), likeness(print_, edited), likeness(print_, chunks)))
                held = None if guest else (part, doc_id, text, data, ends, chunks)
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
