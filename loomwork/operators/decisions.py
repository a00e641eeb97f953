"""Decisions over stored model scores: what counts as committed, assets, types, pair checks, links, and what is asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import relational as R


def committed_units(scores: DataFrame, floors: DataFrame, default: float = 0.8, ask_floor: float = 0.73) -> DataFrame:
    """Scores with committed (at the label set's own floor, or the default) and asked_yes. The floor is compared with the unrounded score; the rounded one is kept beside it."""
    s = scores.join(floors, "label_set", "left")
    return s.select(*scores.columns, (F.col("score") >= F.coalesce("floor", F.lit(default))).alias("committed"), (F.col("score") >= ask_floor).alias("asked_yes"), F.round("score", 4).alias("posterior"))


def sentence_assets(scores: DataFrame, floor: float, decay: float, paragraph_floor: float, multiple: bool = False) -> DataFrame:
    """Each unit's assets: unit_id, asset_level, asset_rank, asset_id, probability; a row of rank 0 for a unit without any.

    scores: unit_id, paragraph_id, ordinal, asset_id, p. A unit's own assets at the floor (level unit); else,
    with a decay, those whose sum own + decay^k x p(k-th earlier unit of the paragraph), at most 1, reaches the
    paragraph floor (level paragraph). The join is by paragraph and asset, which holds a few dozen units.
    """
    order = [F.col("p").desc(), F.col("asset_id").asc()]
    own = scores.where(F.col("p") >= floor).select("unit_id", "asset_id", "p")
    levels = [own.withColumn("asset_level", F.lit("unit"))]
    if decay:
        places = scores.select("unit_id", "paragraph_id", "ordinal").distinct().withColumn("place", F.row_number().over(Window.partitionBy("paragraph_id").orderBy("ordinal", "unit_id")))
        e = scores.join(places.select("unit_id", "place"), "unit_id").select("paragraph_id", "asset_id", F.col("place").alias("e_place"), "p")
        u = places.join(own.select("unit_id").distinct(), "unit_id", "left_anti").select("unit_id", "paragraph_id", "place")
        far = u.join(e, "paragraph_id").where("e_place <= place")
        total = F.round(F.sum(F.col("p") * F.pow(F.lit(decay), F.col("place") - F.col("e_place"))), 9)
        summed = far.groupBy("unit_id", "asset_id").agg(total.alias("sum")).where(F.col("sum") >= paragraph_floor)
        levels.append(summed.select("unit_id", "asset_id", F.least("sum", F.lit(1.0)).alias("p"), F.lit("paragraph").alias("asset_level")))
    won = levels[0] if len(levels) == 1 else levels[0].unionByName(levels[1])
    ranked = won.withColumn("asset_rank", F.row_number().over(Window.partitionBy("unit_id").orderBy(*order)))
    if not multiple:
        ranked = ranked.where("asset_rank = 1")
    return scores.select("unit_id").distinct().join(ranked, "unit_id", "left").select("unit_id", F.coalesce("asset_level", F.lit("none")).alias("asset_level"), F.coalesce("asset_rank", F.lit(0)).alias("asset_rank"), "asset_id", F.col("p").alias("probability"))


def type_winners(scores: DataFrame, floor: float, multiple: bool = True, other: str = "OTH.") -> DataFrame:
    """The types that count for each unit, likeliest first: those at the floor, types of the prefix `other` only where no other one counts. scores: unit_id, type_id, p."""
    s = scores.where(F.col("p") >= floor).withColumn("oth", F.startswith("type_id", F.lit(other)))
    approved = F.bool_or(~F.col("oth")).over(Window.partitionBy("unit_id"))
    counted = s.withColumn("approved", approved).where("not approved or not oth")
    types = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("k"), "type_id"))), lambda x: x["type_id"])
    out = counted.groupBy("unit_id").agg(types.alias("types"))
    return out if multiple else out.withColumn("types", F.slice("types", 1, 1))


def merge_types(winners: DataFrame, resolution: DataFrame) -> DataFrame:
    """Types replaced by what they are merged into, each shown once, in order. resolution: type_id, merged."""
    w = winners.select("unit_id", F.posexplode("types").alias("i", "type_id")).join(resolution, "type_id", "left").select("unit_id", "i", F.coalesce("merged", "type_id").alias("type_id"))
    first = w.groupBy("unit_id", "type_id").agg(F.min("i").alias("i"))
    return first.groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "type_id"))), lambda x: x["type_id"]).alias("types"))


def pair_decisions(scores: DataFrame, floor: float) -> DataFrame:
    """Pairs with both sides scored: both, only_a, only_b or neither at the floor. scores: unit_id, set_a, set_b, side (keep_a, keep_b), p."""
    side = lambda x: F.max(F.when(F.col("side") == x, F.col("p")))
    p = scores.groupBy("unit_id", "set_a", "set_b").agg(side("keep_a").alias("p_keep_a"), side("keep_b").alias("p_keep_b")).where("p_keep_a is not null and p_keep_b is not null")
    a, b = F.col("p_keep_a") >= floor, F.col("p_keep_b") >= floor
    return p.withColumn("decision", F.when(a & b, "both").when(a, "only_a").when(b, "only_b").otherwise("neither"))


def shared_assets(links: DataFrame, unit_assets: DataFrame, package_assets: DataFrame, yes: float, levels: tuple[str, ...]) -> DataFrame:
    """Links (unit_id, package_id, ...) with the assets that the unit carries at the levels that count and the package buys."""
    u = unit_assets.where(F.col("asset_level").isin(*[x for x in levels if x != "none"]) & F.col("asset_id").isNotNull()).groupBy("unit_id").agg(F.collect_set("asset_id").alias("ua"))
    p = package_assets.where(F.col("p") >= yes).groupBy("package_id").agg(F.collect_set("asset_id").alias("pa"))
    none = F.array().cast("array<string>")
    return links.join(u, "unit_id", "left").join(p, "package_id", "left").withColumn("shared_asset_ids", F.array_sort(F.array_intersect(F.coalesce("ua", none), F.coalesce("pa", none)))).drop("ua", "pa")


def candidate_pool(cosines: DataFrame, patterns: DataFrame, stored: DataFrame, gate: float, top: int) -> DataFrame:
    """Which units a label asks about, and by which route: cosine at the gate or among the top (embedding), a word pattern (pattern), both, or already answered (stored).

    cosines: label_id, unit_id, cosine; patterns and stored: label_id, unit_id.
    """
    key = ["label_id", "unit_id"]
    c = R.semi_flag(R.semi_flag(cosines, patterns, key, "by_pattern"), stored, key, "by_store")
    rank = F.row_number().over(Window.partitionBy("label_id").orderBy(F.col("cosine").desc(), "unit_id"))
    near = (F.col("cosine") >= gate) | ((F.col("rank") <= top) if top else F.lit(False))
    c = (c.withColumn("rank", rank) if top else c).withColumn("near", near)
    route = F.when(F.col("near") & F.col("by_pattern"), "both").when(F.col("by_pattern"), "pattern").when(F.col("near"), "embedding").when(F.col("by_store"), "stored")
    return c.withColumn("route", route).where("route is not null").select(*key, "cosine", "route")


def keep_first_route(new: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs keep the route and round by which they first entered."""
    p = previous.select(*keys, F.col("route").alias("__route"), F.col("round").alias("__round"))
    return new.join(p, keys, "left").withColumns({"route": F.coalesce("__route", "route"), "round": F.coalesce("__round", "round")}).drop("__route", "__round")


def stored_answers(items: DataFrame, answers: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Items with their stored answers, and those still to ask."""
    return items.join(answers, keys), items.join(answers.select(*keys).distinct(), keys, "left_anti")


def pattern_hits(units: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """label_id, unit_id, pattern_id of each word pattern that a unit's text matches; patterns ignore case unless case_sensitive.

    patterns (a label set's: a few dozen) are collected and become one expression a pattern, so that the texts
    are read once, without a join: Java compiles each constant pattern once.
    """
    found = []
    for p in patterns.select("label_id", "pattern_id", "pattern", "case_sensitive").orderBy("label_id", "pattern_id").collect():
        flags = "(?uU)" if p["case_sensitive"] else "(?iuU)"
        found.append(F.when(F.col(text).rlike(flags + p["pattern"]), F.struct(F.lit(p["label_id"]).alias("label_id"), F.lit(p["pattern_id"]).alias("pattern_id"))))
    if not found:
        return units.sparkSession.createDataFrame([], "label_id string, unit_id string, pattern_id string")
    return units.select("unit_id", F.explode(F.array_compact(F.array(*found))).alias("m")).select("m.label_id", "unit_id", "m.pattern_id")


def fits_that_apply(fits: DataFrame, questions: DataFrame, keys: list[str], default: Column) -> DataFrame:
    """Questions with the value of a fit made for the same question (by hash), else the default."""
    f = fits.select(*keys, F.col("question_sha").alias("__sha"), F.col("value").alias("__value"))
    return questions.join(f, keys, "left").withColumn("value", F.when(F.col("__sha") == F.col("question_sha"), F.col("__value")).otherwise(default)).drop("__sha", "__value")


def pairs_to_check(units: DataFrame) -> DataFrame:
    """Units that two label sets of a family both take: unit_id, set_a < set_b. units: unit_id, label_set, family, asked_yes."""
    u = units.where("asked_yes").select("unit_id", "label_set", "family").distinct()
    a, b = u.withColumnRenamed("label_set", "set_a"), u.withColumnRenamed("label_set", "set_b")
    return a.join(b, ["unit_id", "family"]).where("set_a < set_b").select("unit_id", "set_a", "set_b")


def answer_scores(answers: DataFrame, grades: tuple[str, ...] = ("2", "3")) -> DataFrame:
    """Answers (probabilities: map<string, double>) with their score."""
    return answers.withColumn("score", S.answer_score(F.col("probabilities"), grades))
