"""Building blocks that SQL dialects spell differently: first row by order, best match, array joins, marked text.

All are DataFrame expressions; null ordering is always stated. None of them needs to know its tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by `order` (DISTINCT ON). The window group limit lets each map task keep one row a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """The first k rows of each key by `order`, with their rank from 1."""
    return df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank_col) <= k)


def first_by(value: str, *order: Column) -> Column:
    """Aggregate: `value` of the row that is first by ascending `order` (array_agg(... ORDER BY ...)[1])."""
    return F.min_by(value, F.struct(*order))


def all_or_nothing(value: str) -> Column:
    """Aggregate: the sum, if no row's value is null."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.sum(value))


def distinct_text(value: Column | str, separator: str = ", ") -> Column:
    """Aggregate: distinct values in order, joined; null if there are none (string_agg(DISTINCT ...))."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def distinct_array(value: Column | str) -> Column:
    """Aggregate: distinct values in order; null if there are none (array_agg(DISTINCT x ORDER BY x))."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.size(values) > 0, values)


def ordered_text(text: Column, *order: Column) -> Column:
    """Aggregate: texts in order, joined without a separator; equal places go by text."""
    parts = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("text"))))
    return F.array_join(F.transform(parts, lambda x: x["text"]), "")


def unnest_or(values: Column, fallback: Column) -> Column:
    """Generator: a row for each element, or one with the fallback where the array is null or empty."""
    return F.explode(F.when(F.coalesce(F.size(values), F.lit(0)) > 0, values).otherwise(F.array(fallback)))


def semi_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """`df` with a boolean column: some row of `other` has its keys (EXISTS in a select list). Null keys never match."""
    hits = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(hits, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def best_match(outer: DataFrame, inner: DataFrame, on: Column, key: Sequence[str], order: Sequence[Column], columns: Sequence[Column]) -> DataFrame:
    """Each row of `outer` (alias x, unique by `key`) with the first matching row of `inner` (alias o), or nulls: LATERAL ... ORDER BY ... LIMIT 1.

    The order may use both sides, which Spark's LATERAL refuses; so all matches are joined and ranked.
    """
    joined = outer.alias("x").join(inner.alias("o"), on, "left")
    rank = F.row_number().over(Window.partitionBy(*[F.col(f"x.{k}") for k in key]).orderBy(*order))
    return joined.withColumn("__rank", rank).where("__rank = 1").select("x.*", *columns)


def pairs_once(df: DataFrame, item: str, group: str) -> DataFrame:
    """Pairs of groups that share items, each pair once: group_a < group_b and the number of shared items.

    The join is on the item, so it makes as many rows as pairs within an item, whose groups are few labels.
    """
    one = df.select(item, group).distinct()
    a, b = one.select(item, F.col(group).alias("group_a")), one.select(item, F.col(group).alias("group_b"))
    return a.join(b, item).where("group_a < group_b").groupBy("group_a", "group_b").agg(F.count("*").alias("shared"))


def anti_where(df: DataFrame, other: DataFrame, on: Column) -> DataFrame:
    """Rows of `df` (alias l) without a row of `other` (alias r) that meets `on`; `on` should hold an equality for a hash join, alternatives may follow it."""
    return df.alias("l").join(other.alias("r"), on, "left_anti")


def covering_part(points: DataFrame, parts: DataFrame, key: str, pos: str, start: str = "start", end: str = "end") -> DataFrame:
    """Points with the part of their document that holds them: start <= pos < end (range join within an equality)."""
    return points.alias("p").join(parts.alias("q"), (F.col(f"p.{key}") == F.col(f"q.{key}")) & (F.col(f"q.{start}") <= F.col(f"p.{pos}")) & (F.col(f"p.{pos}") < F.col(f"q.{end}")), "left").select("p.*", *[F.col(f"q.{c}") for c in parts.columns if c != key])


def member_join(left: DataFrame, array_col: str, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows whose array holds the other side's key: exploded first, so that the join is an equality (x = ANY(array))."""
    exploded = (F.explode_outer if how == "left" else F.explode)(F.array_distinct(F.col(array_col)))
    return left.withColumn(key, exploded).join(right, key, how)


def replace_kept(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows, and the old ones whose keys are not among them."""
    return new.unionByName(old.join(new.select(*keys).distinct(), list(keys), "left_anti"))


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The old rows, and the new ones whose keys they lack (ON CONFLICT DO NOTHING)."""
    return old.unionByName(new.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the last by `order` (descending columns) of both (ON CONFLICT DO UPDATE)."""
    return first_per_key(old.unionByName(new), keys, order)


def optional(df: DataFrame, **values: object) -> DataFrame:
    """Equality filters for the parameters that are given; None filters nothing."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), ((k, v) for k, v in values.items() if v is not None), df)


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str = "s", end: str = "e") -> DataFrame:
    """Rows with `before`: how far the earlier intervals of the key reach (0 for the first), in order of start and end."""
    w = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.max(end).over(w), F.lit(0)))


def mark_spans(spans: DataFrame, texts: DataFrame, keys: Sequence[str], text_key: str, text: str = "text", left: str = "【", right: str = "】") -> DataFrame:
    """`marked`: the text with each span [s, e) in marks, overlapping ones without repeating text; spans covered by earlier ones vanish."""
    sub = lambda x, a, n: F.substring(x, a, n)
    seen = merge_intervals(spans, keys).where("e > before").join(texts.select(text_key, F.col(text).alias("__text")), text_key)
    from_ = F.greatest("s", "before")
    piece = F.concat(sub(F.col("__text"), F.col("before") + 1, F.greatest(F.col("s") - F.col("before"), F.lit(0))), F.lit(left), sub(F.col("__text"), from_ + 1, F.col("e") - from_), F.lit(right))
    marked = seen.groupBy(*keys, "__text").agg(ordered_text(piece, F.col("s"), F.col("e")).alias("head"), F.max("e").alias("last"))
    return marked.select(*keys, F.concat("head", sub(F.col("__text"), F.col("last") + 1, F.length("__text"))).alias("marked"))


def _range_of(key: Column, cuts: list, first: int = 0) -> Column:
    """How many of the ordered `cuts` are not above `key`, by halves; `first` for null."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(key >= F.lit(cuts[half]), _range_of(key, cuts[half + 1 :], first + half + 1)).otherwise(_range_of(key, cuts[:half], first))


def running_before(df: DataFrame, key: str, value: str, name: str, ranges: int = 64) -> DataFrame:
    """`df` with `name`: the sum of `value` over all rows with a smaller `key` (a number or a string, each once, none null).

    The keys are cut into ranges (a key each comes to the driver: quantiles of numbers; of strings, which have none
    here, every 64th of those with the smallest hashes), the ranges' sums give offsets, and a running sum is worked out
    within each range, so no task takes more than a range. The cuts decide only how even the ranges are.
    """
    if isinstance(df.schema[key].dataType, T.StringType):
        some = sorted((r[0] for r in df.select(key).orderBy(F.xxhash64(key)).limit(64 * ranges).collect()))
        cuts = [some[i * len(some) // ranges] for i in range(1, ranges)] if some else []
    else:
        cuts = df.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10_000).alias("c")).first()["c"] or []
    ranged = df.withColumn("__part", _range_of(F.col(key), sorted(set(cuts))))
    sums = ranged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))  # a row for each range
    offsets = sums.select("__part", before.alias("__before"))
    within = F.coalesce(F.sum(value).over(Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return ranged.withColumn("__within", within).join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__within")).drop("__part", "__before", "__within")
