"""Grading by hand: strata and their targets, the draw, tasks and their fills, the grades they give, and grades matched to units."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import evaluation as E

#: Bands of a score from which tasks are drawn, how near a floor a score is hard, and grades that count as yes.
BANDS = (("p<0.3", 0.0, 0.3), ("p0.3-0.5", 0.3, 0.5), ("p0.5-0.7", 0.5, 0.7), ("p0.7+", 0.7, 1.01))
NEAR = 0.2
YES_GRADES = ("2", "3")


def band(score: Column, bands: Sequence[tuple[str, float, float]] = BANDS) -> Column:
    """The band that a score is in; null outside all."""
    return F.coalesce(*[F.when((score >= low) & (score < high), F.lit(name)) for name, low, high in bands])


def measure_strata(units: DataFrame, design: str = "train", near: float = NEAR) -> DataFrame:
    """item, line, stratum for each unit of each measure (label_set, unit_id, posterior, floor): by whether it is committed (design eval), else by how near it is to the floor."""
    p, f = F.col("posterior"), F.col("floor")
    s = F.when(p >= f, "eval:committed").otherwise("eval:not_committed") if design == "eval" else F.when(F.abs(p - f) <= near, "train:near").otherwise("train:far")
    return units.select(F.col("unit_id").alias("item"), F.concat(F.lit("measure:"), "label_set").alias("line"), F.concat(F.lit("measure:"), "label_set", F.lit(":"), s).alias("stratum"))


def band_strata(scores: DataFrame, kind: str, item: str, line: Column, prefix: str = "") -> DataFrame:
    """item, line, stratum for scores in a band (columns: the item's, p)."""
    b = band(F.col("p"))
    return scores.withColumn("__b", b).where("__b is not null").select(F.col(item).alias("item"), line.alias("line"), F.concat(F.lit(f"{kind}:{prefix}"), "__b").alias("stratum"))


def line_chances(lines: DataFrame, targets: Mapping[str, int], default: int) -> DataFrame:
    """item, line, chance: each line's largest chance over its strata; a stratum's is its target by its size. lines: item, line, stratum."""
    own = lines.select(F.struct("item", "line").alias("item"), "stratum").distinct()
    return E.inclusion(own, dict(targets), default).select("item.item", "item.line", "chance")


def with_assets(chances: DataFrame, committed: DataFrame, assets: DataFrame) -> DataFrame:
    """Chances where the asset lines of a committed unit have at least its measure line's chance, so that both are judged together. committed: item, label_set; assets: item, asset_id."""
    shown = chances.join(committed.select("item", F.concat(F.lit("measure:"), "label_set").alias("line")), ["item", "line"]).groupBy("item").agg(F.max("chance").alias("chance"))
    more = shown.join(assets.select("item", F.concat(F.lit("asset:"), "asset_id").alias("line")).distinct(), "item")
    return chances.unionByName(more.select("item", "line", "chance")).groupBy("item", "line").agg(F.max("chance").alias("chance"))


def draw_lines(chances: DataFrame, seed: str) -> DataFrame:
    """The lines drawn, with weight 1 / chance: an item's one permanent random number decides all its lines, so each is shown with its own chance."""
    return chances.withColumn("x", S.permanent_uniform(seed, F.col("item").cast("string"))).where("x < chance").withColumn("weight", 1 / F.col("chance"))


def fill_problems(tasks: DataFrame, fills: DataFrame) -> DataFrame:
    """task_id, problem: fills of no task or given twice, tasks not answered, answers that are not allowed. tasks: task_id, kind, allowed (array); fills: task_id, grade. An 'other' task may name several allowed ids by bars, or none."""
    g = F.lower(F.trim(F.coalesce("grade", F.lit(""))))
    f = fills.groupBy("task_id").agg(F.min(g).alias("grade"), F.count("*").alias("times"))
    both = tasks.join(f, "task_id", "full")
    several = F.filter(F.transform(F.split("grade", r"\|"), lambda x: F.trim(x)), lambda x: (x != "") & (x != "none"))
    bad = F.when(F.col("kind") == "other", F.size(F.array_except(several, "allowed")) > 0).otherwise(~F.array_contains("allowed", F.col("grade")))
    problem = F.when(F.col("kind").isNull(), "not a task").when(F.col("times").isNull(), "not answered").when(F.col("times") > 1, "answered twice").when(bad, "not allowed")
    return both.withColumn("problem", problem).where("problem is not null").select("task_id", "problem")


def is_yes(kind: Column, grade: Column) -> Column:
    """Whether a grade counts as yes: of measures and assets the high grades, of others 'yes'."""
    return F.when(kind.isin("measure", "asset"), grade.isin(*YES_GRADES)).otherwise(grade == "yes")


def grades_from(tasks: DataFrame, fills: DataFrame) -> DataFrame:
    """kind, label_set, label_id, item_sha, grade, weight: what filled tasks give. 'unsure' gives nothing; a type counts where its measure is graded yes; two measures of one block also answer their pair, with the larger weight.

    tasks: task_id, block, kind, label_set, label_id, item_sha, weight; fills: task_id, grade.
    """
    a = tasks.join(fills.select("task_id", F.lower(F.trim("grade")).alias("grade")), "task_id").where("grade <> 'unsure'")
    measures = a.where("kind = 'measure'")
    own = a.where(F.col("kind").isin("measure", "asset", "package_asset", "link"))
    parent = measures.where(F.col("grade").isin(*YES_GRADES)).select("block", "label_set").distinct()
    types = a.where("kind = 'type'").join(parent, ["block", "label_set"], "left_semi")
    plain = own.unionByName(types.select(own.columns)).select("kind", "label_set", "label_id", "item_sha", "grade", "weight")
    m = lambda s: measures.select("block", F.col("label_set").alias(f"set_{s}"), F.col("item_sha").alias(f"sha_{s}"), is_yes(F.lit("measure"), F.col("grade")).alias(f"yes_{s}"), F.col("weight").alias(f"w_{s}"))
    pairs = m("a").join(m("b"), "block").where("set_a < set_b")
    sides = F.explode(F.array(*[F.struct(F.lit(f"keep_{s}").alias("label_id"), F.col(f"sha_{s}").alias("item_sha"), F.when(F.col(f"yes_{s}"), "yes").otherwise("no").alias("grade")) for s in "ab"]))
    from_pairs = pairs.select(F.lit("pair").alias("kind"), F.concat_ws("|", "set_a", "set_b").alias("label_set"), sides.alias("s"), F.greatest("w_a", "w_b").alias("weight")).select("kind", "label_set", "s.label_id", "s.item_sha", "s.grade", "weight")
    several = F.explode(F.filter(F.transform(F.split("grade", r"\|"), lambda x: F.trim(x)), lambda x: (x != "") & (x != "none")))
    others = a.where("kind = 'other'").withColumn("one", several).select(F.lit("other").alias("kind"), F.col("one").alias("label_set"), F.lit("").alias("label_id"), "item_sha", F.lit("yes").alias("grade"), "weight")
    return plain.unionByName(from_pairs).unionByName(others)


def graded_units(grades: DataFrame, units: DataFrame, scores: DataFrame) -> DataFrame:
    """Grades with the units whose text they were given for (by its hash, never by place) and the scores those have now: p, y, w. grades: kind, label_set, label_id, item_sha, grade, weight; units: unit_id, text; scores: label_set, unit_id, p."""
    by_sha = units.select("unit_id", F.sha2("text", 256).alias("item_sha"))
    out = grades.join(by_sha, "item_sha").join(scores.select("label_set", "unit_id", "p"), ["label_set", "unit_id"])
    return out.select("label_set", "label_id", "unit_id", "p", is_yes(F.col("kind"), F.col("grade")).cast("int").alias("y"), F.coalesce(F.col("weight"), F.lit(1.0)).alias("w"))


def spot_check(tasks: DataFrame, fills: DataFrame) -> DataFrame:
    """A sheet for a second reader: a row for each task with its fill and an empty human_grade."""
    return tasks.join(fills.select("task_id", F.col("grade").alias("filled")), "task_id", "left").withColumn("human_grade", F.lit(""))


def marked_sentence(paragraph: Column, sentence: Column) -> Column:
    """The paragraph with the sentence in marks, as a reader is shown it; unmarked if it is not in it."""
    body = F.element_at(F.split(sentence, "\n"), -1)
    at = F.instr(paragraph, body)
    return F.when((at > 0) & (body != ""), F.concat(F.substring(paragraph, F.lit(1), at - 1), F.lit("»"), body, F.lit("«"), F.substring(paragraph, at + F.length(body), F.length(paragraph)))).otherwise(paragraph)


def rescaled(rows: DataFrame, label: str = "label_id", w: str = "w") -> DataFrame:
    """Rows whose weights sum, label by label, to the label's number of rows: what a fit over several labels takes, so that none drowns the others."""
    n = rows.groupBy(label).agg((F.count("*") / F.sum(w)).alias("__f"))
    return rows.join(n, label).withColumn(w, F.col(w) * F.col("__f")).drop("__f")


def latest_grades(grades: DataFrame, keys: Sequence[str], at: str = "graded_at") -> DataFrame:
    """Of grades given twice for one thing the last."""
    value = [c for c in grades.columns if c not in keys]
    last = grades.groupBy(*keys).agg(F.max(F.struct(F.col(at), *[c for c in value if c != at])).alias("g"))
    return last.select(*keys, *[F.col(f"g.{c}").alias(c) for c in value])
