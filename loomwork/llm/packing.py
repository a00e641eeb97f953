"""Best-fit packing of token sequences by linear grouping.

Only the histogram of piece lengths matters for a packing, and it has at most `capacity` entries however many
documents there are. So the plan is made on the driver from the histogram: large lengths are put into groups
of equal cardinality and rounded up to the largest of their group; configurations of the few sizes are
optimised (column generation for the linear programme, rounded down, the remainder packed best-fit); the
actual lengths take the places of the rounded ones; small lengths go best-fit into the gaps. All of it counts
runs of equal sequences, never single ones, so the plan's size depends on the capacity alone.

The plan gives, for each length, which ranks among its pieces go to which sequences and offsets. Ranks are
distributed: pieces of a length are cut by a hash into ranges, the ranges' counts give offsets, and a rank is
counted within a range, so a length that a third of the pieces have is no hot task.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import bytes_of, col, slices, written

CAPACITY = 4096
EOT = 1
#: Sizes that large lengths are rounded to, and the share of the capacity above which a length is large.
GROUPS = 40
LARGE = 1 / 8
assert sys.byteorder == "little" and array("I").itemsize == 4  # the ids' bytes are those of the machine
#: Distinct words whose ids a task keeps; beyond them and a text's own it starts anew.
WORDS_KEPT = 400_000
RANGE_ROWS = 50_000


class _Known(dict):
    """What `make` gives for a key, worked out once."""

    def __init__(self, make: Callable[[bytes], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: bytes) -> bytes:
        ids = self[key] = self.make(key)
        return ids


class WordIds:
    """Ids of whole texts as little-endian uint32 bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its white-space
    separated words in order, and a word's ids those of its runs of letters, digits and other marks, which the
    tokenizer's model merges. Both are kept once worked out. Words outside the Latin blocks, or with what may
    be a special token or is not printable, are encoded as they are.
    """

    RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.words, self.runs = _Known(self._word), _Known(self._run)
        # The model's bytes as characters: printable Latin-1 ones stand for themselves, the rest from U+0100 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.chars = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _run(self, run: bytes) -> bytes:
        text = run.decode("ascii") if run.isascii() else "".join(map(self.chars.__getitem__, run))
        return array("I", [t.id for t in self.merge(text)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes: A to Z alone
            return self.runs[word.lower()]
        if word[-1] in b".,;:!?" and word[:-1].isalpha():
            return self.runs[word[:-1].lower()] + self.runs[word[-1:]]
        text = word.decode("utf-8")
        if not text.isprintable() or not (text.isascii() or max(text) < "\u0250") or "<|" in text:
            return array("I", self.encode(text, add_special_tokens=False).ids).tobytes()
        low = text.lower()
        if low.isalpha():
            return self.runs[low.encode()]
        if low[-1] in ".,;:!?" and low[:-1].isalpha():
            return self.runs[low[:-1].encode()] + self.runs[low[-1].encode()]
        return b"".join([self.runs[r.encode()] for r in self.RUNS.findall(low)])

    def batch(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        get = self.words.__getitem__
        for text in texts:
            yield b"".join(map(get, text.split()))
            if len(self.words) > WORDS_KEPT:
                self.words.clear()
            if len(self.runs) > WORDS_KEPT:
                self.runs.clear()


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = EOT, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and `row`): each document's ids, then `end_id`, cut only above `capacity`. Null and empty texts are the end id alone."""
    names = carry or []
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), *([F.struct(*[col(c) for c in names]).alias("row")] if names else []))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        for b in slices(batches):
            at, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(words.batch(bytes_of(b, "text"))):
                ids += end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    at.append(i)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            rows = pa.array(at, pa.int32())
            kept = [b.column(0).take(rows), *([b.column(2).take(rows)] if names else [])]
            yield pa.record_batch([*kept, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", *(["row"] if names else []), "piece", "start", "length", "ids_crc32"])

    long = T.LongType()
    schema = T.StructType([*(f for f in own.schema if f.name != "text"), T.StructField("piece", T.IntegerType()), *(T.StructField(n, long) for n in ("start", "length", "ids_crc32"))])
    return own.mapInArrow(run, schema)


def _dearest(sizes: list[int], price: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of the highest price: an unbounded knapsack, an item more in each round until nothing gains."""
    best, paid = np.zeros(capacity + 1), [i for i in range(len(sizes)) if price[i] > 1e-12]
    while True:
        new = best.copy()
        for i in paid:
            np.maximum(new[sizes[i] :], best[: capacity + 1 - sizes[i]] + price[i], out=new[sizes[i] :])
        if (new <= best + 1e-12).all():
            break
        best = new
    column, room = np.zeros(len(sizes)), capacity
    while best[room] > 1e-12:
        i = next((i for i in paid if sizes[i] <= room and best[room - sizes[i]] + price[i] >= best[room] - 1e-9), None)
        if i is None:
            break
        column[i] += 1
        room -= sizes[i]
    return column


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (how many of each size) and how often, that cover the demand: the linear programme by column generation, then best-fit for what rounding leaves."""
    k = len(sizes)
    want = np.array(demand, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(400):
        inverse = np.linalg.inv(basis)
        price = np.ones(k) @ inverse
        column = _dearest(sizes, price, capacity)
        if column @ price <= 1 + 1e-7:
            break
        x, d = inverse @ want, inverse @ column
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        if not np.isfinite(ratio.min()):
            break
        basis[:, int(ratio.argmin())] = column
    x = np.floor(np.linalg.solve(basis, want) + 1e-9).clip(0).astype(int)
    patterns = [(basis[:, j].astype(int).tolist(), int(x[j])) for j in range(k) if x[j]]
    rest = [n - sum(p[i] * m for p, m in patterns) for i, n in enumerate(demand)]
    while any(r > 0 for r in rest):  # one pattern at a time, as often as the rest allows
        room, pattern = capacity, [0] * k
        for i, s in enumerate(sizes):
            pattern[i] = max(0, min(rest[i], room // s))
            room -= pattern[i] * s
        often = min(rest[i] // n for i, n in enumerate(pattern) if n)
        patterns.append((pattern, often))
        rest = [r - n * often for r, n in zip(rest, pattern, strict=True)]
    return patterns


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, count, per sequence, first sequence, offset): `count` pieces of a length from a rank on, `per sequence` in each sequence from an offset on."""
    out: list[tuple[int, int, int, int, int, int]] = []
    used = dict.fromkeys(histogram, 0)
    sequences = 0
    open_: list[tuple[int, int, int]] = []  # runs of sequences with a gap: (gap, first sequence, how many)

    def place(length: int, many: int, each: int, first: int, offset: int) -> None:
        out.append((length, used[length], many * each, each, first, offset))
        used[length] += many * each

    if histogram.get(capacity):
        place(capacity, histogram[capacity], 1, 0, 0)
        sequences = histogram[capacity]
    large = sorted((s for s in histogram if capacity * LARGE < s < capacity), reverse=True)
    total = sum(histogram[s] for s in large)
    if total:
        # Groups of equal cardinality in descending order; a group's largest length is its size.
        left = [[s, histogram[s]] for s in large]
        grouped: list[list[list[int]]] = []
        each = -(-total // groups)
        while left:
            group, room = [], each
            while left and room:
                n = min(room, left[0][1])
                group.append([left[0][0], n])
                left[0][1] -= n
                room -= n
                if not left[0][1]:
                    left.pop(0)
            grouped.append(group)
        sizes, demand = [g[0][0] for g in grouped], [sum(n for _, n in g) for g in grouped]
        for pattern, often in _configurations(sizes, demand, capacity):
            slots = [g for g, n in enumerate(pattern) for _ in range(n)]
            segments = [(often, sequences, 0, [])]  # how many sequences, the first, filled, lengths
            sequences += often
            for g in slots:
                new = []
                for many, first, filled, inside in segments:
                    while many and grouped[g]:
                        length, n = grouped[g][0]
                        take = min(many, n)
                        place(length, take, 1, first, filled)
                        new.append((take, first, filled + length, inside))
                        many, first = many - take, first + take
                        grouped[g][0][1] -= take
                        if not grouped[g][0][1]:
                            grouped[g].pop(0)
                    if many:
                        new.append((many, first, filled, inside))
                segments = new
            open_ += [(capacity - filled, first, many) for many, first, filled, _ in segments if filled < capacity]
    gaps: dict[int, list[tuple[int, int]]] = {}
    for gap, first, many in open_:
        gaps.setdefault(gap, []).append((first, many))
    for s in sorted((s for s in histogram if s <= capacity * LARGE), reverse=True):
        n, gap = histogram[s], s
        while n:
            while gap <= capacity and not gaps.get(gap):  # the tightest gap that holds it
                gap += 1
            if gap > capacity:
                many = max(1, n // (capacity // s))
                gaps[capacity] = [(sequences, many)]
                sequences, gap = sequences + many, capacity
            first, many = gaps[gap].pop()
            each = min(gap // s, n)
            fill = min(many, n // each)
            place(s, fill, each, first, capacity - gap)
            n -= fill * each
            if many > fill:
                gaps[gap].append((first + fill, many - fill))
            if gap > each * s:
                gaps.setdefault(gap - each * s, []).append((first, fill))
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """`cut` (of `pieces`, written) with sequence_id and offset: sequences of at most `capacity`, filled from 0 without gaps.

    Where `cut` has `rid`, a number of the row, it deals the rows over ranges, so that an id (or none) that many
    rows have makes no hot task; it is dropped. Rows that tie in id and piece are interchangeable. Empty table: empty result.
    """
    spark = cut.sparkSession
    names = [c for c in cut.columns if c != "rid"]
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = sorted(plan(counts, capacity, groups))
    table = spark.sparkContext.broadcast(np.array(runs, dtype=np.int64).reshape(-1, 6))  # its size depends on the capacity alone
    ranges = max(1, -(-sum(counts.values()) // range_rows))
    ranged = cut.withColumn("range", F.pmod(F.xxhash64(*(["rid"] if "rid" in cut.columns else ["doc_id", "piece"])), F.lit(ranges)).cast("int"))
    before = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("length", "range").agg(F.count("*").alias("n")).select("length", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "range").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = ranged.withColumn("within", within).join(offsets, ["length", "range"]).select(*names, (F.col("before") + F.col("within") - 1).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, each, sequence, offset = table.value.T
        keys = (length << 44) + first
        for b in batches:
            n, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, (n << 44) + rank, side="right") - 1
            slot = rank - first[at]
            yield pa.record_batch([*b.columns[:-1], pa.array(sequence[at] + slot // each[at]), pa.array(offset[at] + slot % each[at] * n)], [*b.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*(cut.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = EOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each row; see `pieces` and `pack`."""
    return pack(written(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()), "pieces"), capacity)
