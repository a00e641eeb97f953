"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are reduced to lower-case letters and single spaces; n-grams of 1 to 3 characters are hashed to a fixed
number of features. Languages and document frequencies are counted over all learning documents; the pass over
the texts also keeps the counts of a bounded sample of each language. The model is trained on the sample with follow-the-regularised-leader
(FTRL-proximal, elastic net: L1 makes the weights sparse), and a temperature, fitted on a part of the sample
kept back, calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, crc_of_id, slices, texts_of, written

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
#: So many documents train the weights (chosen by a hash, each language by its share); document frequencies count all.
MAX_TRAIN = 6000
#: Of each language at least so many, or all that there are.
LEAST_TRAIN = 100
UNKNOWN = "und"
_TOP = 0x110000
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    if not _letters:
        table = np.full(_TOP, 32, np.uint32)
        for c in range(_TOP):
            if 0xD800 <= c < 0xE000:
                continue
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letters.append(table)
    return _letters[0]


def counts(text: str, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their counts; none if it has no letter."""
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = codes == 32
    if space.all():
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    codes = codes[~(space & np.concatenate([[True], space[:-1]]))]  # runs of spaces as one, none in front
    codes = np.concatenate([np.array([32], np.uint32), codes[: len(codes) - int(codes[-1] == 32)], np.array([32], np.uint32)])
    shift = np.uint32(32 - int(features).bit_length() + 1)
    hashes, h = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(codes) - n + 1] * _MIX[0] + codes[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            x = h * _MIX[1]
            hashes.append(((x ^ (x >> np.uint32(15))) * _MIX[2]) >> shift)
    total = np.bincount(np.concatenate(hashes), minlength=features)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Languages, IDF by feature, weights (features + 1 for the bias, languages), temperature."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[at]
        return (x / max(np.sqrt((x * x).sum()), 1e-12)).astype(np.float32)

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its calibrated probability; `und` and 0 for a text without a letter or a model without languages."""
        at, n = counts(text, len(self.idf))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        z = (self.vector(at, n) @ self.weights[at] + self.weights[-1]) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        return self.languages[int(p.argmax())], float(p.max())


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 3) -> np.ndarray:
    """FTRL-proximal on the softmax loss; returns the weights."""
    z, n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
    order = np.random.default_rng(7)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, features), np.append(x, 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, r = -4.0, 4.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", features: int = FEATURES, max_train: int = MAX_TRAIN) -> Model:
    """The model of the documents where `learn` holds and the language is not null. No such documents: a model without languages."""
    own = docs.where(learn & col(lang_col).isNotNull()).select(F.xxhash64(F.lit("langid"), col(id_col)).alias("h"), col(text_col).alias("text"), col(lang_col).alias("lang"))
    of = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}  # a row for each language
    number = sum(of.values())
    quota = {x: min(k, max(LEAST_TRAIN, -(-max_train * k // number))) for x, k in of.items()}
    below = {x: -(2**63) + quota[x] * 2**64 // k - (quota[x] == k) for x, k in of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(features, np.int64)
        for b in slices(batches):
            rows = []
            for h, text, lang in zip(b.column("h").to_pylist(), texts_of(b, "text"), b.column("lang").to_pylist(), strict=True):
                at, n = counts(text, features)
                seen[at] += 1
                if h <= below[lang] and len(at):
                    rows.append((h, lang, at, n))
            if rows:
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (2, 3)), pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64())], ["h", "lang", "at", "n", "feature", "df"])
        at = np.flatnonzero(seen).astype(np.int32)
        k = len(at)
        yield pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()), *(pa.nulls(k, pa.binary()) for _ in range(2)), pa.array(at), pa.array(seen[at])], ["h", "lang", "at", "n", "feature", "df"])

    found = written(own.mapInArrow(run, "h bigint, lang string, at binary, n binary, feature int, df bigint"), "langid")
    df = found.where("feature is not null").groupBy("feature").agg(F.sum("df").alias("df")).toPandas()  # `features` rows at most
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "at", "n"))
    most = F.create_map(*[F.lit(y) for x in quota.items() for y in x])[F.col("lang")] if quota else F.lit(0)
    sample = found.where("lang is not null").withColumn("k", order).where(F.col("k") <= most).select("lang", "k", "at", "n")
    idf = np.zeros(features)
    idf[df["feature"].to_numpy()] = np.log((1 + number) / (1 + df["df"].to_numpy())) + 1
    languages = tuple(sorted(of))
    model = Model(languages, idf, np.zeros((features + 1, len(languages))), 1.0)
    if not languages:
        return model
    index = {x: i for i, x in enumerate(languages)}
    rows, kept = [], []
    for r in sorted(sample.toLocalIterator(), key=lambda r: (r["lang"], r["k"])):  # bytes, since the driver may be small
        at, n = (np.frombuffer(bytes(r[c]), np.int32) for c in ("at", "n"))
        (rows if r["k"] % 5 else kept).append((at, model.vector(at, n), index[r["lang"]]))
    weights = _ftrl(rows, features, len(languages))
    kept = kept or rows
    scores = np.array([x @ weights[at] + weights[-1] for at, x, _ in kept])
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), _temperature(scores, np.array([y for *_, y in kept])))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """lang_pred and score for each row, after its id (doc_id) or, with `keep`, a struct `row` of those columns. Null texts and texts without a letter: `und`, 0."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # its size depends on the number of features and languages alone
    first = col(id_col).alias("doc_id") if keep is None else F.struct(*[col(c) for c in keep]).alias("row")
    inside = keep is not None and text_col in keep  # the text goes along once
    own = docs.select(first, *([] if inside else [col(text_col).alias("text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [shared.value.predict(t) for t in texts_of(b, *(("row", text_col) if inside else ("text",)))]
            yield pa.record_batch([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [b.schema.names[0], "lang_pred", "score"])

    return own.mapInArrow(run, T.StructType([own.schema.fields[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def learnt(id_col: str = "doc_id") -> Column:
    """The learning documents: a quarter, chosen by the crc32 of the id as text, is held out."""
    return crc_of_id(col(id_col)) % 4 != 2


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row, learnt from the rows not held out. Rows that repeat are scored alike; empty table: empty result."""
    got = identify(docs, train(docs, learnt(id_col), id_col, text_col, lang_col), id_col, text_col)
    return got.select("doc_id", (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score")


def keep_known_languages(docs: DataFrame, least: float = 0.4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` whose language is told with a probability of `least` or more, with all their columns."""
    got = identify(docs, train(docs, learnt(id_col), id_col, text_col, lang_col), id_col, text_col, keep=docs.columns)
    return got.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
