"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in few bits agree in some segment up to one
bit, so each fingerprint is filed under its value of every segment (the table) and looked up under the values
one bit away (the small Hamming ball). Of two values one bit apart exactly one has that bit set, so only the
set bits are flipped: half the ball finds every pair once. What meets under a value is verified by the complete
distance and gives a spanning forest of its links, of which a task reports only those that join what it has not
seen joined: a large group costs a row a document, not a pair. A value that very many fingerprints share is met by
pieces of the other segment (64-bit form), and what is still hot is cut into blocks of the table that each meet all
lookups.

The 64-bit form (two segments of 32 bits) is exact for distances up to 3. The wide form is for a similarity of
shingle sets, of which 64 bits say too little. It has 256 bits in 16 segments of 16 bits and two rounds: documents
that agree in a segment, and then, by what the first round has joined, those that agree up to one bit. What hangs
together within the distance allowed is a cluster; each document of a cluster comes once with its set of shingles,
and the sets decide which links there are. Clusters of large sets are cut into blocks, each pair of which is a
group of its own. Bits of few shingles say too little: documents of up to SHORT distinct shingles, and those that
may be similar to one, meet under their rarest shingles, so many that two similar sets share one (a prefix
filter), and there the sets alone decide: every such link is found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, col, forget, runs, slices, written
from .components import connected_components

HASH_SEED = 42
#: Rows of the table under one value that one task takes; more are cut into blocks.
BLOCK = 20_000
#: Ids of near documents up to this number (8 bytes each) go to all executors to fetch the texts; more are joined by a shuffle.
BROADCAST_NODES = 1_000_000
#: Meetings of more rows than this are searched row by row, smaller ones pair by pair.
SMALL = 64
#: Links of documents with up to so many distinct shingles are found without fingerprints (wide form).
SHORT = 64
#: Bytes of shingle sets in one block; a group that is verified at once has two blocks at most.
SETS_BYTES = 32 << 20


@dataclass(frozen=True)
class Plan:
    """words: of a shingle; bits: of the fingerprint; segments: offset and width; distance: largest that links.

    Wide form: near: largest distance of one 64-bit word, looked at before the complete one; similarity: least of the sets of distinct shingles.
    """

    words: int
    bits: int
    segments: tuple[tuple[int, int], ...]
    distance: int
    near: int = 64
    similarity: float | None = None


#: 3-word shingles, repeats included; 3 bits at most. One of two segments differs in one bit at most.
EXACT = Plan(3, 64, ((0, 32), (32, 32)), 3)


def for_similarity(similarity: float, words: int = 5, segments: int = 16, width: int = 16) -> Plan:
    """Sets of shingles with a Jaccard similarity s have a cosine of 2s / (1 + s); bits differ with probability angle / pi.

    A pair at similarity 0.8 differs in 15 % of the bits; it meets in a segment of 16 bits with probability
    0.28, in one of 16 with 0.994 (0.85: 0.999), and is within the complete distance (4 standard deviations) and
    the word's (5) with 0.9999; these hold for large sets, small ones meet by their shingles. Wider segments, and
    more of them, suit corpora of more than about 100 million different documents: fewer strangers meet, each
    document is looked up more often.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    most = lambda bits, sd: math.ceil(bits * p + sd * math.sqrt(bits * p * (1 - p)))
    bits = 64 * -(-segments * width // 64)
    return Plan(words, bits, tuple((i * width, width) for i in range(segments)), most(bits, 4), most(64, 5), similarity)


def _bit_sums(h: np.ndarray, bits: int) -> np.ndarray:
    """How many of the hashes have each bit set; beyond 64 bits, of the hashes mixed anew for each further word."""
    out = np.zeros(bits, np.int64)
    words = bits // 64
    step = max(255, 255 * (2048 // bits))
    with np.errstate(over="ignore"):
        for at in range(0, len(h), step):
            x = h[at : at + step, None]
            if words > 1:
                x = x + np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                z = x[:, 1:]
                z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x[:, 1:] = z ^ (z >> np.uint64(31))
            set_ = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")
            for b in range(0, len(set_), 255):
                out += np.add.reduce(set_[b : b + 255], axis=0, dtype=np.uint8)
    return out


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included: words are runs without \x20 and \x09-\x0d, A-Z lower-cased; a shorter text is one shingle, one without words none."""
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    flat, digest = b" ".join(split), xxhash.xxh64_intdigest
    if len(split) <= words:
        return np.array([digest(flat, HASH_SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([digest(flat[a:b], HASH_SEED) for a, b in zip(starts[: len(split) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)], dtype=np.uint64)


def fingerprint(text: bytes, plan: Plan = EXACT) -> bytes:
    """Little-endian bytes of the fingerprint of a UTF-8 text: bit i is 1 if set in over half of the shingles' hashes (in the wide form of the distinct ones); no words: zero."""
    return _fingerprint(_hashes(text, plan), plan)


def _hashes(text: bytes, plan: Plan) -> np.ndarray:
    hashes = shingle_hashes(text, plan.words)
    return hashes if plan.similarity is None else np.unique(hashes)


def _fingerprint(hashes: np.ndarray, plan: Plan) -> bytes:
    return np.packbits(_bit_sums(hashes, plan.bits) * 2 > len(hashes), bitorder="little").tobytes()


def fingerprints(docs: DataFrame, plan: Plan = EXACT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (binary) for each row; null and empty texts have a fingerprint of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.record_batch([b.column(0), pa.array([fingerprint(t, plan) for t in bytes_of(b, "text")], pa.binary())], ["doc_id", "fp"])

    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    return own.mapInArrow(run, T.StructType([own.schema["doc_id"], T.StructField("fp", T.BinaryType())]))


def _filed(prints: DataFrame, plan: Plan, balls: bool = True, table: bool = True) -> DataFrame:
    """key, node, w0, w1, ...: each fingerprint (in words of 64 bits) under its value of each segment (`table`), and under those with one set bit cleared (`balls`), there with node as -1 - node."""
    words = [f"w{i}" for i in range(plan.bits // 64)]
    names = ["key", "node", *words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                node = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                own = np.ascontiguousarray(raw).view(np.int64)
                set_ = np.unpackbits(raw, axis=1, bitorder="little")
                for s, (offset, width) in enumerate(plan.segments):
                    seg = set_[:, offset : offset + width].astype(np.int64)
                    value = (seg << np.arange(width, dtype=np.int64)).sum(axis=1) | (s << 32)
                    if table:
                        yield pa.record_batch([value, node, *own.T], names)
                    if balls:
                        i, bit = np.nonzero(seg)
                        yield pa.record_batch([value[i] & ~(np.int64(1) << bit), -1 - node[i], *own[i].T], names)

    return prints.select("node", "fp").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of all rows; binary columns with 64-bit offsets, since those of 32 bits end at 2 GB."""
    table = pa.Table.from_batches(parts)
    wide = pa.schema([f.with_type(pa.large_binary()) if pa.types.is_binary(f.type) else f for f in table.schema])
    (out,) = table.cast(wide).combine_chunks().to_batches()
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows in pieces that end where a key ends."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or last != keys[-1]):
            if cut:
                held.append(b.slice(0, cut))
            yield _joined(held)
            held = []
            b = b.slice(cut)
        elif cut:
            yield b.slice(0, cut)
            b = b.slice(cut)
        held.append(b)
        last = keys[-1]
    if held:
        yield _joined(held)


class _Sieve:
    """Lets a link pass that joins what the links before have not joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def _root(self, x: int) -> int:
        up = self.up
        top = x
        while (next_ := up.get(top, top)) != top:
            top = next_
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        kept: tuple[list[int], list[int]] = [], []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            r, s = self._root(x), self._root(y)
            if r != s:
                self.up[max(r, s)] = min(r, s)
                kept[0].append(x)
                kept[1].append(y)
        return kept


def _forest(prints: np.ndarray, starts: int, most: int, similar: Callable[[int, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (distance up to `most`, and `similar`) among the rows of a meeting, as far as they hang together with one of its first `starts` rows: positions a, b.

    Each row that is reached is compared with those not reached yet, so rows that hang together cost little.
    """
    left, rest = np.arange(len(prints)), prints
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(left) > 1 and left[0] < starts:
        queue, left, rest = [int(left[0])], left[1:], rest[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.flatnonzero(np.bitwise_count(rest ^ prints[i]).sum(axis=1, dtype=np.int32) <= most)
            if similar is not None and len(near):
                near = near[similar(i, left[near])]
            if len(near):
                new = left[near]
                a.append(np.full(len(new), i))
                b.append(new)
                queue += new.tolist()
                stays = np.ones(len(left), bool)
                stays[near] = False
                left, rest = left[stays], rest[stays]
    return np.concatenate(a), np.concatenate(b)


def _pairs(starts: np.ndarray, ends: np.ndarray, ball: np.ndarray, chunk: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of each table row with every later row of its group (a group's table rows come first)."""
    n = ends - starts
    if not len(n):
        return
    group = np.repeat(np.arange(len(n)), n)
    pos = np.arange(int(n.sum())) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.repeat(starts, n)
    mine = ~ball[pos]
    rows, stop = pos[mine], ends[group[mine]]
    many = stop - rows - 1
    cuts = np.searchsorted(np.cumsum(many), np.arange(chunk, int(many.sum()) + chunk, chunk))
    at = 0
    for cut in cuts:
        r, m = rows[at : cut + 1], many[at : cut + 1]
        at = cut + 1
        total = int(m.sum())
        if total:
            i = np.repeat(r, m)
            yield i, i + 1 + np.arange(total) - np.repeat(np.concatenate([[0], np.cumsum(m)[:-1]]), m)


def _meet(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) within the complete distance of what meets under a key, as many as it takes to hold together what hangs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = _Sieve()
        for piece in _whole_groups(batches):
            key, node = (piece.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            words = [piece.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2, piece.num_columns)]
            ball = node < 0
            node = np.where(ball, -1 - node, node)
            starts, ends = runs(key)
            table = np.add.reduceat(~ball, starts, dtype=np.int64) if len(starts) else starts
            some = (ends - starts > 1) & (table > 0)
            small = some & (ends - starts <= SMALL)
            for i, j in _pairs(starts[small], ends[small], ball):
                far = np.bitwise_count(words[-1][i] ^ words[-1][j]).astype(np.int32)
                near = np.flatnonzero((far <= plan.near) & (node[i] != node[j]))
                i, j, far = i[near], j[near], far[near]
                for w in words[:-1]:
                    far += np.bitwise_count(w[i] ^ w[j])
                near = far <= plan.distance
                a, b = new(node[i[near]], node[j[near]])
                if a:
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            prints = np.stack(words, axis=1)
            for s, e, n in zip(starts[some & ~small].tolist(), ends[some & ~small].tolist(), table[some & ~small].tolist(), strict=True):
                if (node[s:e] == node[s]).all():  # joined before
                    continue
                i, j = _forest(prints[s:e], n, plan.distance)
                a, b = new(node[s:e][i], node[s:e][j])
                for at in range(0, len(a), 20_000):
                    yield pa.record_batch([pa.array(a[at : at + 20_000], pa.int64()), pa.array(b[at : at + 20_000], pa.int64())], ["a", "b"])

    return run


def _sets(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """node and its distinct shingles' hashes, from node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            hashes = [np.unique(shingle_hashes(t, plan.words)).tobytes() for t in bytes_of(b, "text")]
            yield pa.record_batch([b.column(0), pa.array(hashes, pa.binary())], ["node", "hashes"])

    return run


def _verified(plan: Plan, by_print: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A spanning forest of each group's links: pairs whose sets are similar enough, and, with `by_print`, whose fingerprints are within the complete distance. Rows: key, node, hashes, and fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = _Sieve()
        for piece in _whole_groups(batches):
            key, node = (piece.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            raw = piece.column(2).to_pylist()
            prints = np.frombuffer(b"".join(piece.column(3).to_pylist()), np.uint64).reshape(len(key), -1) if by_print else np.zeros((len(key), 1), np.uint64)
            for s, e in zip(*map(np.ndarray.tolist, runs(key)), strict=True):
                if e - s < 2:
                    continue
                size = np.fromiter((len(x) // 8 for x in raw[s:e]), np.int64, e - s)
                ends = np.cumsum(size)
                known, ids = np.unique(np.frombuffer(b"".join(raw[s:e]), np.uint64), return_inverse=True)
                has = np.zeros(len(known), bool)

                def similar(i: int, j: np.ndarray, ids=ids, ends=ends, size=size, has=has) -> np.ndarray:
                    fit = np.flatnonzero((np.minimum(size[j], size[i]) >= plan.similarity * np.maximum(size[j], size[i]) - 1e-9) & (size[j] > 0))
                    if not len(fit) or not size[i]:
                        return np.zeros(0, np.int64)
                    k = j[fit]
                    mine = ids[ends[i] - size[i] : ends[i]]
                    has[mine] = True
                    cuts = np.concatenate([[0], np.cumsum(size[k])[:-1]])
                    both = np.add.reduceat(has[np.concatenate([ids[a:b] for a, b in zip((ends[k] - size[k]).tolist(), ends[k].tolist(), strict=True)])], cuts, dtype=np.int64)
                    has[mine] = False
                    return fit[both >= plan.similarity * (size[i] + size[k] - both) - 1e-9]

                i, j = _forest(prints[s:e], e - s, plan.distance if by_print else 64, similar)
                a, b = new(node[s:e][i], node[s:e][j])
                for at in range(0, len(a), 20_000):
                    yield pa.record_batch([pa.array(a[at : at + 20_000], pa.int64()), pa.array(b[at : at + 20_000], pa.int64())], ["a", "b"])

    return run


def _least_shared(size: int, similarity: float) -> int:
    """Of so many of its shingles in any fixed order, a set shares one with every similar set."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def _hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, hash, size: a row for each hash of a set."""
    for b in batches:
        raw = b.column(1).to_pylist()
        size = np.array([len(x) // 8 for x in raw], np.int64)
        yield pa.record_batch([np.repeat(b.column(0).to_numpy(zero_copy_only=False), size), np.frombuffer(b"".join(raw), np.int64), np.repeat(size, size)], ["node", "hash", "size"])


def _by_shingle(sets: DataFrame, plan: Plan) -> DataFrame:
    """key, node: each set under its rarest hashes, as far as another set has them too. sets: node, hashes."""
    rows = sets.mapInArrow(_hashes_of, "node bigint, hash bigint, size bigint")
    shared = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    order = Window.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "hash")
    most = F.element_at(F.array(*[F.lit(_least_shared(n, plan.similarity)) for n in range(1, int(SHORT / plan.similarity) + 1)]), F.col("size").cast("int"))
    ranked = rows.join(shared, "hash", "left").withColumn("place", F.row_number().over(order))
    return ranked.where((F.col("place") <= most) & F.col("n").isNotNull()).select(F.col("hash").alias("key"), "node")


def _grouped(members: DataFrame, sets: DataFrame, names: list[str], most: int) -> DataFrame:
    """key, node and `names` (of sets: node, bytes, ...) of each member of a key (key, node; each once), sorted by key; a key whose sets take more than `most` bytes is cut into blocks, and each pair of blocks has a key of its own."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = written(members.join(sets.select("node", "bytes"), "node").groupBy("key").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).where("n > 1"), "simhash-groups")
    parts = F.ceil(F.col("bytes") / most).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    pairs = F.when(parts > 1, F.transform(F.filter(F.sequence(F.lit(0), parts - 1), lambda k: k != own), lambda k: F.xxhash64("key", F.least(k, own), F.greatest(k, own)))).otherwise(F.array("key"))
    keyed = members.join(sums, "key").select(F.explode(pairs).alias("key"), "node")
    return keyed.join(sets.select("node", *names), "node").select("key", "node", *names).repartition(n, "key").sortWithinPartitions("key")


def _met(prints: DataFrame, plan: Plan, block: int, balls: bool, table: bool = True) -> DataFrame:
    """Links (a, b) between the nodes of `prints` (node, fp) that meet under a key."""
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _filed(prints, plan, balls, table)
    hot = written(_filed(prints, plan, balls=False).groupBy("key").count().where(F.col("count") > block), "simhash-hot")
    if not hot.isEmpty() and plan == EXACT:
        # What differs in three bits at most agrees in one of four pieces of the other segment: a hot value meets by these, which are exact too.
        other = F.when(F.shiftright("key", 32) == 0, F.shiftrightunsigned("w0", 32)).otherwise(F.col("w0").bitwiseAND(0xFFFFFFFF))
        pieces = F.array(*[F.xxhash64("key", F.lit(j), F.shiftright(other, 8 * j).bitwiseAND(255)) for j in range(4)])
        rows = rows.join(F.broadcast(hot), "key", "left").withColumn("key", F.explode(F.when(F.col("count").isNull(), F.array("key")).otherwise(pieces))).drop("count")
        hot = written(rows.where("node >= 0").groupBy("key").count().where(F.col("count") > block), "simhash-hot")
    if not hot.isEmpty():
        # A table row stays in one block and is looked up in the others; a lookup goes to all blocks. Fewer than one in `block` rows is a hot key.
        parts = F.ceil(F.col("count") / block).cast("int")
        node = F.when(F.col("node") < 0, -1 - F.col("node")).otherwise(F.col("node"))
        spread = rows.join(F.broadcast(hot), "key", "left").withColumn("own", F.pmod(F.xxhash64(node), parts).cast("int")).withColumn("part", F.explode(F.when(F.col("count").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), parts - 1))))
        away = F.coalesce((F.col("node") >= 0) & (F.col("own") != F.col("part")), F.lit(False))
        rows = spread.select(F.when(F.col("part").isNull(), F.col("key")).otherwise(F.xxhash64("key", "part")).alias("key"), F.when(away, -1 - F.col("node")).otherwise(F.col("node")).alias("node"), *rows.columns[2:])
    return rows.repartition(n, "key").sortWithinPartitions("key", F.col("node").desc()).mapInArrow(_meet(plan), "a bigint, b bigint")


def links(prints: DataFrame, plan: Plan = EXACT, block: int = BLOCK, texts: DataFrame | None = None, sets_bytes: int = SETS_BYTES) -> DataFrame:
    """Edges (a, b) between nodes, whose components are those of all links. prints: node bigint, fp binary; equal fingerprints once. Wide form: prints has `short`, the set of a document that may be similar to a short one, or null, and `long`, whether it may be similar to one that isn't short; texts: node, text."""
    if plan.similarity is None:
        return _met(prints, plan, block, balls=True)
    filed = prints.where("long").select("node", "fp")
    # Clusters: first what agrees in a segment, then by these what agrees up to a bit.
    first = written(connected_components(_met(filed, plan, block, balls=False)), "simhash-first")
    second = filed.join(first, "node", "left").select(F.coalesce("root", "node").alias("node"), "fp")
    second = written(connected_components(_met(second, plan, block, balls=True)), "simhash-second").select(F.col("node").alias("root"), F.col("root").alias("key"))
    # Nodes that the second round alone has joined stand in it under their own names.
    alone = second.join(first.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), "key")
    clusters = written(first.join(second, "root", "left").select("node", F.coalesce("key", "root").alias("key")).unionAll(alone.select("node", "key")), "simhash-clusters")
    # The sets are worked out for the documents of clusters alone.
    nodes = clusters.select("node")
    few = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    sets = written(texts.join(few, "node", "left_semi").select("node", "text").mapInArrow(_sets(plan), "node bigint, hashes binary"), "simhash-sets")
    known = written(sets.join(filed, "node").withColumn("bytes", F.length("hashes").cast("bigint")), "simhash-known")
    forget(sets)
    out = _grouped(clusters, known, ["hashes", "fp"], sets_bytes).mapInArrow(_verified(plan, True), "a bigint, b bigint")
    short = prints.where("short is not null").select("node", F.col("short").alias("hashes"), F.length("short").cast("bigint").alias("bytes"))
    shared = written(_by_shingle(short.select("node", "hashes"), plan), "simhash-short")
    return out.unionAll(_grouped(shared, short, ["hashes"], sets_bytes).mapInArrow(_verified(plan, False), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, plan: Plan = EXACT, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, fp, component_id for each row (and `row`, a struct of the columns in `carry`, and `first`: true for one row of each component).

    Rows whose fingerprints link belong together, and so on; component_id is the smallest id among them, the
    row itself included. Equal fingerprints always link; null and empty texts have the fingerprint zero. Of
    rows that tie in id the first written counts; null ids are larger than all others. Empty table: no rows.
    """
    names = carry or []
    wide = plan.similarity is not None
    added = ["fp", "short", "long"] if wide else ["fp"]
    kept = ["doc_id", *(["text"] if wide and text_col not in names else []), *(["row"] if names else [])]
    most = int(SHORT / plan.similarity) if wide else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp, short, long = [], [], []
            for t in bytes_of(b, *(("row", text_col) if inside else ("text",))):
                hashes = _hashes(t, plan)
                fp.append(_fingerprint(hashes, plan))
                short.append(hashes.tobytes() if 0 < len(hashes) <= most else None)
                long.append(len(hashes) > SHORT)
            new = [pa.array(fp, pa.binary()), *([pa.array(short, pa.binary()), pa.array(long, pa.bool_())] if wide else [])]
            yield pa.record_batch([*(c for c, f in zip(b.columns, b.schema.names, strict=True) if f in kept), *new], [*kept, *added])

    inside = text_col in names  # the text goes along once
    own = docs.select(col(id_col).alias("doc_id"), *([] if inside else [col(text_col).alias("text")]), *([F.struct(*[col(c) for c in names]).alias("row")] if names else []))
    made = own.mapInArrow(run, T.StructType([*(f for f in own.schema if f.name in kept), *(T.StructField(x, T.BooleanType() if x == "long" else T.BinaryType()) for x in added)]))
    rows = written(made.withColumn("rid", F.monotonically_increasing_id()), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    # Each fingerprint once; its node is the row id of its first row.
    prints = written(rows.groupBy("fp").agg(F.min(order).alias("first"), F.min("rid").alias("node"), *([F.min_by(x, "rid").alias(x) for x in ("short", "long")] if wide else [])), "simhash-prints")
    texts = rows.select(F.col("rid").alias("node"), (F.col("text") if "text" in kept else F.col("row").getField(text_col)).alias("text")) if wide else None
    roots = written(connected_components(links(prints, plan, texts=texts)), "simhash-roots")
    linked = prints.join(roots, "node", "left").select("fp", "first", F.coalesce("root", "node").alias("root"))
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    placed = linked.join(best, "root").select("fp", "best")
    return rows.join(placed, "fp").select("doc_id", "fp", F.col("best.id").alias("component_id"), *(["row"] if names else []), (F.col("rid") == F.col("best.rid")).alias("first"))


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without near-duplicates: of each group of documents that link by a similarity of word shingles the one with the smallest id stays.

    Null texts, empty ones and those without words are one group. Of rows that tie in id one stays; null ids are
    larger than all others. All columns pass through. Texts of any length are read; an empty table gives no rows.
    """
    g = near_duplicates(docs, for_similarity(similarity, words), id_col, text_col, carry=docs.columns)
    return g.where("first").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
