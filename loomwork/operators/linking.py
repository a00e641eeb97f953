"""Records linked to packages by reference, package versions, and commitments paired with packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import relational as R


def link_records(records: DataFrame, packages: DataFrame, id_col: str) -> DataFrame:
    """Each record with package_id and package_link, how it was found; records that share an id share their candidates.

    No reference: no_reference. By project and reference: no package: not_in_plan; one: reference; several, of
    which one has the record's description key: reference_and_description; else ambiguous. The candidates of a
    reference are counted before the join, so that a reference that many packages share costs one row, and the
    description key is a second equality.
    """
    key = ["project_id", "borrower_ref_norm"]
    p = packages.where("coalesce(borrower_ref_norm, '') <> ''")
    by_ref = p.groupBy(*key).agg(F.count("*").alias("n_ref"), F.min("package_id").alias("only"))
    by_text = p.where("coalesce(description_match, '') <> ''").groupBy(*key, "description_match").agg(F.count("*").alias("n_text"), F.min("package_id").alias("same"))
    r = records.drop("package_id", "package_link").join(by_ref, key, "left").join(by_text, [*key, "description_match"], "left")
    own = Window.partitionBy(id_col)
    r = r.withColumns({c: f(c).over(own) for c, f in (("n_ref", F.sum), ("only", F.min), ("n_text", F.sum), ("same", F.min))})
    blank = F.coalesce("borrower_ref_norm", F.lit("")) == ""
    link = F.when(blank, "no_reference").when(F.col("n_ref").isNull(), "not_in_plan").when(F.col("n_ref") == 1, "reference").when(F.col("n_text") == 1, "reference_and_description").otherwise("ambiguous")
    found = F.when(link == "reference", F.col("only")).when(link == "reference_and_description", F.col("same"))
    return r.select(*[c for c in records.columns if c not in ("package_id", "package_link")], found.alias("package_id"), link.alias("package_link"))


def award_notices(awards: DataFrame, notices: DataFrame) -> DataFrame:
    """Each award with the notices of its project and reference, by id, joined by bars ('' without any).

    Where both are linked to a package it must be the same; an award without one skips ambiguous notices.
    """
    a = awards.where("coalesce(borrower_ref_norm, '') <> ''").select("award_id", "project_id", "borrower_ref_norm", F.col("package_id").alias("a_package"))
    n = notices.where("coalesce(borrower_ref_norm, '') <> ''").select("notice_id", "project_id", "borrower_ref_norm", F.col("package_id").alias("n_package"), "package_link")
    fits = F.when(F.col("a_package").isNull(), ~F.col("package_link").eqNullSafe("ambiguous")).otherwise(F.col("n_package").isNull() | (F.col("n_package") == F.col("a_package")))
    ids = a.join(n, ["project_id", "borrower_ref_norm"]).where(fits).groupBy("award_id").agg(F.array_join(F.array_sort(F.collect_set("notice_id")), "|").alias("notice_ids"))
    return awards.join(ids, "award_id", "left").withColumn("notice_ids", F.coalesce("notice_ids", F.lit("")))


def number_repeats(rows: DataFrame, keys: list[str], order: str, name: str = "nth") -> DataFrame:
    """Rows with the number, from 1, of their repeat of the keys in order."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def latest_versions(rows: DataFrame, key: list[str], project: str, disclosed: str, version: str) -> tuple[DataFrame, DataFrame]:
    """The newest version of each package, with in_latest_plan (its plan is its project's newest), and the superseded ones, with what replaced them."""
    w = Window.partitionBy(*key).orderBy(F.col(disclosed).desc_nulls_last(), F.col(version).desc_nulls_last())
    ranked = rows.withColumns({"__rank": F.row_number().over(w), "superseded_by": F.first(version).over(w), "__newest": F.max(disclosed).over(Window.partitionBy(project))})
    kept = ranked.where("__rank = 1").withColumn("in_latest_plan", F.coalesce(F.col(disclosed) == F.col("__newest"), F.lit(False))).drop("__rank", "__newest", "superseded_by")
    return kept, ranked.where("__rank > 1").drop("__rank", "__newest")


def package_keys(rows: DataFrame) -> DataFrame:
    """package_id: project and reference; with the hash of the description key where a plan version repeats the reference; with the repeat's number where that repeats too.

    Exact repeats within a version (all columns but the record's number) are dropped first. A reference that is
    shared in any version is keyed by its description in all.
    """
    same = [c for c in rows.columns if c != "package_version_id"]
    first = R.first_per_key(rows, same, [F.col("package_version_id").asc()])
    shared = first.groupBy("project_id", "plan_version", "borrower_ref_norm").agg(F.count("*").alias("n")).where("n > 1").select("project_id", "borrower_ref_norm").distinct().withColumn("shared", F.lit(True))
    keyed = first.join(shared, ["project_id", "borrower_ref_norm"], "left")
    base = F.concat_ws(":", "project_id", "borrower_ref_norm", F.when(F.col("shared"), F.substring(F.sha2("description_match", 256), 1, 8)))
    numbered = number_repeats(keyed.withColumn("package_id", base).drop("shared"), ["plan_version", "package_id"], "package_version_id")
    return numbered.withColumn("package_id", F.when(F.col("nth") > 1, F.concat_ws(":", "package_id", F.col("nth").cast("string"))).otherwise(F.col("package_id"))).drop("nth")


def resolve_status(packages: DataFrame, awards: DataFrame) -> DataFrame:
    """Each package's status by the latest dated evidence: its plan or a signed award, which wins on the same day and never overrides a final status."""
    signed = awards.where("package_id is not null and signed_date is not null").groupBy("package_id").agg(F.max("signed_date").alias("signed"))
    p = packages.join(signed, "package_id", "left")
    final = F.coalesce(F.col("status").isin("Signed", "Completed", "Terminated"), F.lit(False))
    plan = F.when(F.col("status").isNotNull() & (F.col("status") != "unknown"), F.struct(F.col("disclosed").alias("at"), F.lit(0).alias("rank"), F.col("status").alias("status"), F.lit("plan").alias("source")))
    award = F.when(F.col("signed").isNotNull() & ~final, F.struct(F.col("signed").alias("at"), F.lit(1).alias("rank"), F.lit("Signed").alias("status"), F.lit("award").alias("source")))
    best = F.greatest(plan, award)
    return p.select(*[c for c in packages.columns if c != "status"], F.coalesce(best["status"], F.lit("unknown")).alias("status"), best["source"].alias("status_source"), best["at"].alias("status_as_of"))


def pair_commitments(units: DataFrame, packages: DataFrame, unit_assets: DataFrame, package_assets: DataFrame, scores: DataFrame, top: int = 3) -> DataFrame:
    """Committed units with packages of their project: those that share an asset (route asset), and the `top` nearest others (route measure, with the rank).

    units: unit_id, project_id, label_set; scores: label_set, package_id, cosine. The nearest are ranked once a
    project and measure, then the unit's own asset pairs are taken out of a list long enough for any unit.
    """
    shared = units.join(unit_assets.select("unit_id", "asset_id"), "unit_id").join(packages.select("package_id", "project_id").join(package_assets.select("package_id", "asset_id"), "package_id"), ["project_id", "asset_id"])
    by_asset = shared.groupBy("unit_id", "label_set", "project_id", "package_id").agg(F.array_sort(F.collect_set("asset_id")).alias("shared_asset_ids"))
    ranked = units.join(packages.select("package_id", "project_id"), "project_id").join(scores, ["label_set", "package_id"]).join(by_asset.select("unit_id", "label_set", "package_id"), ["unit_id", "label_set", "package_id"], "left_anti")
    near = R.top_per_key(ranked, ["unit_id", "label_set", "project_id"], [F.col("cosine").desc(), F.col("package_id").asc()], top, "measure_rank")
    none = F.array().cast("array<string>")
    a = by_asset.select("unit_id", "label_set", "project_id", "package_id", "shared_asset_ids", F.lit("asset").alias("route"), F.lit(None).cast("int").alias("measure_rank"))
    return a.unionByName(near.select("unit_id", "label_set", "project_id", "package_id", none.alias("shared_asset_ids"), F.lit("measure").alias("route"), "measure_rank"))
