"""Mixing sources to target weights.

Each document gets a hash-random key. Within each source the keys are cut into equal ranges (the leading hex
digits: the hash is uniform, so the ranges are even, a hot source spreads over as many tasks as the others,
and a rerun cuts the same). The sums of the ranges give each range's offset, a sort within a range gives
each document's prefix sum of sizes, and the source's budget is cut exactly there: whole passes over the
source first, then documents in key order, the last of them in part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
RANGE_ROWS = 50_000


def _ranked(sources: DataFrame, parts: int) -> DataFrame:
    """`sources` with rank (from 0) by source in code point order, null last; distributed: ranges, their counts, ranks within."""
    last = F.col("source").isNull()
    ranged = written(sources.repartitionByRange(parts, last, F.col("source")).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range, not for each source
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source"))
    return ranged.withColumn("r", rank).join(offsets, "part").select("source", "source_size", (F.col("offset") + F.col("r") - 1).alias("rank"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, range_rows: int = RANGE_ROWS, carry: list[str] | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row (and `row`, a struct of the columns in `carry`).

    size: words of the text (null: 0). Sources in code point order (null last, a source of its own) have the
    weights in turn and share the sum of all sizes; no target is above max_epochs times its source's size,
    the excess goes to the others by weight until none is above. taken: words that the mix takes from the
    row, repeats counted; a source's sum is its target rounded down, a row's at most max_epochs sizes.
    Rows that tie in id are ordered by size, equal ones are interchangeable. Empty table: empty result; all
    sizes 0: targets 0.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(col(id_col).cast("string"), F.lit("")))).alias("key")
    rows = written(docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"), size.alias("size"), key, F.monotonically_increasing_id().alias("rid"), *([F.struct(*[col(c) for c in carry]).alias("row")] if carry else [])), "mix")
    n = rows.count()
    digits = max(1, math.ceil(math.log(max(1, n / range_rows), 16)))
    ranged = F.substring("key", 1, digits)
    full = written(rows.groupBy("source", ranged.alias("range")).agg(F.count("*").alias("n")).where(F.col("n") > 4 * range_rows).drop("n"), "mix-full")
    cell = ranged
    if not full.isEmpty():  # fewer than one in 4 * range_rows rows, as are the keys below
        inside = rows.withColumn("range", ranged).alias("r").join(F.broadcast(full.alias("f")), F.col("r.source").eqNullSafe(F.col("f.source")) & (F.col("r.range") == F.col("f.range")), "left_semi")
        hot = written(inside.groupBy("source", "key").agg(F.count("*").alias("n")).where(F.col("n") > range_rows).select(F.col("source").alias("hot_source"), F.col("key").alias("hot_key"), F.ceil(F.col("n") / range_rows).cast("int").alias("cells")), "mix-hot")
        rows = rows.join(F.broadcast(hot), rows["source"].eqNullSafe(F.col("hot_source")) & (F.col("key") == F.col("hot_key")), "left")
        further = F.concat("hot_key", F.lpad(F.col("size").cast("string"), 20, "0"), F.lpad(F.pmod(F.xxhash64("rid"), "cells").cast("string"), 10, "0"))
        cell = F.concat(ranged, F.coalesce(further, F.lit("")))
    rows = rows.withColumn("range", cell)
    cuts = written(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    sources = written(_ranked(cuts.groupBy("source").agg(F.sum("words").alias("source_size")), int(spark.conf.get("spark.sql.shuffle.partitions"))).select("source", "source_size", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint").alias("w")), "mix-weights")
    # Two numbers a round come to the driver: what is left to share, and the weights that share it.
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, share = total, sources.where("source_size > 0").agg(F.sum("w")).first()[0] or 1
    cap = F.col("source_size") * max_epochs
    while True:
        capped = (F.col("w") * F.lit(left).cast("decimal(38,0)") > cap * F.lit(share).cast("decimal(38,0)")) | (F.col("source_size") == 0)
        held, free = sources.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("w")))).first()
        new = (total - (held or 0), free or 1)
        if new == (left, share):
            break
        left, share = new
    given = F.col("w") * F.lit(left)
    sources = sources.select("source", "source_size", F.when(capped, cap.cast("double")).otherwise(given.cast("double") / F.lit(float(share))).alias("target"), F.when(capped, cap).otherwise(F.expr(f"(w * {left}L) div {share}L")).alias("budget"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select("source", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    plan = cuts.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.source", "range", "offset", "source_size", "target", "budget")
    within = Window.partitionBy("source", "range").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = placed.join(plan, same(placed, plan) & (placed["range"] == plan["range"]))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("offset") - F.col("own")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return out.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), *(["row"] if carry else []))
