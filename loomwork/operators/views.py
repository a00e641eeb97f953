"""The views a user reads: packages and where they stand, projects, findings, commitments, measures.

Each view is a function of DataFrames, so that Catalyst prunes and pushes down through all of them. Dates that
a database would take from the clock are arguments. Views that others read often should be written once
(`writers.replace_table`), as commitments are.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import working
from . import relational as R

NO_ASSET, NO_TYPE = "(no asset)", "(no type)"
#: The order in which a commitment with several packages takes its status.
STATUS_ORDER = ("Overdue", "Planned", "Tendered", "Under implementation", "Contract signed", "Contract completed", "Not in latest plan", "Cancelled")


@dataclass(frozen=True)
class Settings:
    """The readings the views apply."""

    min_probability: float = 0.0
    link_levels: tuple[str, ...] = ("unit", "none")
    ipf_only: bool = True
    package_link_min: float = 0.7
    near_copy_share: float = 0.5
    apply_pair_checks: bool = True
    pair_check_floor: float = 0.58
    asset_yes: float = 0.67
    shingle_words: int = 6


def status_order(spark: SparkSession) -> DataFrame:
    """status_rank, package_status."""
    return spark.createDataFrame([(i, s) for i, s in enumerate(STATUS_ORDER, 1)], "status_rank int, package_status string")


def settings_row(spark: SparkSession, s: Settings) -> DataFrame:
    """The settings as a table of one row."""
    return spark.createDataFrame([(s.min_probability, list(s.link_levels), s.ipf_only, s.package_link_min, s.near_copy_share, s.apply_pair_checks, s.pair_check_floor, s.asset_yes, s.shingle_words)], "commitment_min_probability double, commitment_link_levels array<string>, ipf_only boolean, package_link_min_probability double, near_copy_share double, apply_measure_pair_checks boolean, pair_check_floor double, asset_yes double, shingle_words int")


# Packages


def packages_with_project(packages: DataFrame, projects: DataFrame) -> DataFrame:
    """Each package with its project's columns."""
    return packages.join(projects.select("project_id", "project_name", "country_name", "region", "practice", "managing_unit", "approval_fiscal_year", "approval_date"), "project_id", "left")


def latest_plan_packages(packages: DataFrame, projects: DataFrame) -> DataFrame:
    """Those in their project's newest plan."""
    return packages_with_project(packages, projects).where("in_latest_plan")


def records_with_package(records: DataFrame, packages: DataFrame, projects: DataFrame) -> DataFrame:
    """Notices or awards with the package they are linked to and their own project."""
    p = packages.select("package_id", *[F.col(c).alias(f"package_{c}") for c in ("description_clean", "status", "planned_date", "estimated_amount_usd", "component_number", "component_name")])
    return records.join(p, "package_id", "left").join(projects.select("project_id", "project_name", F.col("country_name").alias("project_country_name"), "region"), "project_id", "left")


def package_status(packages: DataFrame, notices: DataFrame, awards: DataFrame, as_of: datetime.date) -> DataFrame:
    """Where each package stands: the plan's final word, else a signed contract, else a notice, else its plan and dates."""
    today = F.lit(as_of)
    # The latest of each package as a maximum, which combines before the shuffle; null dates are the least.
    n = notices.where("package_id is not null").groupBy("package_id").agg(F.max(F.struct("publication_date", "notice_id", "deadline_date")).alias("n")).select("package_id", F.col("n.publication_date").alias("notice_date"), F.col("n.deadline_date").alias("notice_deadline"), F.lit(True).alias("has_notice"))
    a = awards.where("package_id is not null and signed_date is not null").groupBy("package_id").agg(F.max(F.struct("signed_date", "award_id", "supplier_name", "total_amount_usd")).alias("a")).select("package_id", "a.signed_date", F.col("a.supplier_name").alias("supplier"), F.col("a.total_amount_usd").alias("contract_amount_usd"))
    p = packages.join(n, "package_id", "left").join(a, "package_id", "left")
    due = S.due_date(F.col("planned_date"), F.col("revised_date"))
    final = F.create_map(*[F.lit(x) for kv in {"Completed": "Contract completed", "Signed": "Contract signed", "Under Implementation": "Under implementation", "Canceled": "Cancelled", "Terminated": "Cancelled"}.items() for x in kv])
    plan_says = F.try_element_at(final, F.coalesce("status", F.lit("")))
    signed, noticed, dropped = F.col("signed_date").isNotNull(), F.col("has_notice"), ~F.coalesce("in_latest_plan", F.lit(True))
    where = F.coalesce(plan_says, F.when(signed, "Contract signed").when(noticed, "Tendered").when(dropped, "Not in latest plan").when(due < today, "Overdue").otherwise("Planned"))
    coming = F.when(plan_says.isNotNull() | signed, None).when(noticed, F.when(F.col("notice_deadline") >= today, F.col("notice_deadline"))).when(dropped, None).when(due >= today, due)
    return p.select("package_id", "project_id", "description_clean", "category", "method_code", "estimated_amount_usd", "planned_date", "revised_date", due.alias("due_date"), F.col("status").alias("plan_status"), "in_latest_plan", "component_number", "component_name", "notice_date", "notice_deadline", "signed_date", "supplier", "contract_amount_usd", where.alias("package_status"), coming.alias("next_date"))


def upcoming_packages(packages: DataFrame, projects: DataFrame, status: DataFrame) -> DataFrame:
    """Packages that are planned and not overdue, with their project."""
    return packages_with_project(packages, projects).join(status.where("package_status = 'Planned'").select("package_id", "package_status", "due_date"), "package_id")


# Projects


def project_info(projects: DataFrame, documents: DataFrame, document_projects: DataFrame) -> DataFrame:
    """Each project with a name and place that are never blank, its ISO country and whether it is investment financing."""
    pad = documents.where("document_type = 'Project Appraisal Document'").select("document_id").join(document_projects, "document_id")
    p = R.semi_flag(projects, pad, ["project_id"], "has_pad")
    lending = F.col("lending_instrument")
    return p.select(
        "project_id", F.coalesce("project_name", F.concat(F.lit("(record pending: "), "project_id", F.lit(")"))).alias("project_name"), F.col("project_name").isNull().alias("is_record_pending"), "cohort_set", "status", "approval_date", "approval_fiscal_year", "closing_date", "commitment_usd_millions", "practice", "lending_instrument",
        F.coalesce("region", F.lit("(record pending)")).alias("region"), F.coalesce("country_name", F.lit("(record pending)")).alias("country_name"), S.iso_country_code(F.col("country_code")).alias("country_code"), F.coalesce(F.col("country_code").rlike("^[0-9]"), F.lit(False)).alias("is_regional"),
        F.coalesce((lending == "Investment Project Financing") | ((F.coalesce(lending, F.lit("")) == "") & F.col("has_pad")), F.lit(False)).alias("is_ipf"),
    )


def project_documents(documents: DataFrame, document_projects: DataFrame) -> DataFrame:
    """Each project's documents; the newest marked, with those of the same title and date."""
    d = document_projects.join(documents.select("document_id", "document_kind", "title", "disclosure_date", "pdf_url"), "document_id")
    newest = F.row_number().over(Window.partitionBy("project_id").orderBy(F.col("disclosure_date").desc_nulls_last(), F.col("document_id").desc()))
    same = F.collect_set("document_id").over(Window.partitionBy("project_id", "title", "disclosure_date"))
    others = F.array_sort(F.array_except(same, F.array("document_id")))
    twins = F.when(F.col("title").isNotNull() & F.col("disclosure_date").isNotNull() & (F.size(others) > 0), others)
    return d.select("project_id", "document_id", F.col("disclosure_date").alias("document_date"), "document_kind", "title", S.https(F.col("pdf_url")).alias("pdf_url"), (newest == 1).alias("is_latest"), twins.alias("same_title_and_date_as"))


def project_header(info: DataFrame, own_documents: DataFrame, as_of: datetime.date) -> DataFrame:
    """The head of a project page: days to closing, documents read, the latest one's date."""
    n = own_documents.groupBy("project_id").agg(F.count("*").alias("documents_read"), F.max("document_date").alias("latest_document_date"))
    out = info.join(n, "project_id", "left")
    return out.select("project_id", "project_name", "is_record_pending", "cohort_set", "country_name", "country_code", "region", "is_regional", "status", "approval_fiscal_year", "commitment_usd_millions", "closing_date", F.datediff("closing_date", F.lit(as_of)).alias("days_to_closing"), F.coalesce("documents_read", F.lit(0)).alias("documents_read"), "latest_document_date")


def project_components(components: DataFrame) -> DataFrame:
    """The components of each project's newest list, with the best cost found for each in any document of the project.

    components: one row a project. A cost of the same document is best, then one by name, then by number; the newest first.
    """
    latest = R.first_per_key(components, ["project_id"], [F.col("disclosure_date").desc_nulls_last(), F.col("document_id").desc()]).select("project_id", "document_id")
    named = components.withColumn("__name", F.coalesce("component_number", "component_name"))
    listed = R.first_per_key(named.join(latest, ["project_id", "document_id"]), ["project_id", "component_level", "__name"], [(F.col("read_from") == "heading").asc(), F.col("cost").isNull().asc(), F.col("component_id").asc()])
    x = listed.select("component_id", "project_id", "document_id", F.col("disclosure_date").alias("document_date"), "component_level", "component_number", "component_name", "name_key", "read_from")
    alike = S.same_component(F.col("o.name_key"), F.col("x.name_key"))
    on = (F.col("o.project_id") == F.col("x.project_id")) & (F.col("o.component_level") == F.col("x.component_level")) & (alike | (F.col("o.component_number") == F.col("x.component_number")))
    own = F.col("o.document_id") == F.col("x.document_id")
    how = F.when(F.col("o.document_id").isNull(), None).when(own, "same document").when(alike, "name").otherwise("number")
    out = R.best_match(x, components.where("cost is not null"), on, ["component_id"], [own.desc_nulls_last(), alike.desc_nulls_last(), F.col("o.disclosure_date").desc_nulls_last(), F.col("o.document_id").desc_nulls_last(), F.col("o.component_id").desc_nulls_last()], [F.col("o.cost").alias("cost"), F.col("o.document_id").alias("cost_document_id"), F.col("o.disclosure_date").alias("cost_document_date"), how.alias("cost_matched_by")])
    return out.drop("name_key").withColumn("cost_covers", F.when(F.col("cost").isNotNull(), "All sources (Bank and others)"))


def project_assets(unit_assets: DataFrame, paragraph_projects: DataFrame, labels: DataFrame) -> DataFrame:
    """Each project's assets, with the sentences that name them and those that take them from their paragraph."""
    names = labels.where("label_set = 'assets'").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("asset_name"))
    u = unit_assets.where("asset_level <> 'none'").join(paragraph_projects.select("paragraph_id", "project_id"), "paragraph_id")
    level = lambda x, c: F.when(F.col("asset_level") == x, F.col(c))
    n = u.groupBy("project_id", "asset_id").agg(F.countDistinct(level("unit", "unit_id")).alias("sentences_naming_it"), F.countDistinct(level("paragraph", "unit_id")).alias("sentences_from_paragraph"), F.countDistinct("paragraph_id").alias("paragraphs"), F.max(level("unit", "probability")).alias("best_probability"))
    return n.join(names, "asset_id", "left")


# Text, findings, links in their context


def paragraphs_with_document(paragraphs: DataFrame, documents: DataFrame) -> DataFrame:
    """Each paragraph with its document's title, kind and date."""
    return paragraphs.join(documents.select("document_id", "document_kind", F.col("title").alias("document_title"), "disclosure_date"), "document_id", "left")


def paragraph_project_links(paragraph_projects: DataFrame, projects: DataFrame) -> DataFrame:
    """Each paragraph and project, with the project's name and country."""
    return paragraph_projects.join(projects.select("project_id", "project_name", "country_name"), "project_id", "left")


def asset_map(unit_assets: DataFrame, units: DataFrame, labels: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Each sentence and asset given to it, with the text and component."""
    names = labels.where("label_set = 'assets'").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("asset_name"))
    return unit_assets.where("asset_level <> 'none'").join(units.select("unit_id", "document_id", F.col("text").alias("sentence_text")), "unit_id").join(names, "asset_id", "left").join(paragraphs.select("paragraph_id", "component_number", "component_name", "section_title", "block"), "paragraph_id", "left")


def findings_in_context(findings: DataFrame, labels: DataFrame, paragraphs: DataFrame, documents: DataFrame, paragraph_projects: DataFrame, projects: DataFrame) -> DataFrame:
    """Each finding sent to the model, once a project, with its measure, document and project."""
    pa = paragraphs_with_document(paragraphs, documents).select("paragraph_id", "document_title", "document_kind", "component_name", "section_title", F.col("text").alias("paragraph_text"))
    pp = paragraph_projects.select("paragraph_id", "project_id")
    return findings.where("was_sent").join(labels.select("label_set", "label_id", F.col("label_name").alias("measure_name")), ["label_set", "label_id"], "left").join(pa, "paragraph_id", "left").join(pp, "paragraph_id", "left").join(projects.select("project_id", "cohort_set", "project_name", "country_name"), "project_id", "left")


def packages_with_commitments(packages: DataFrame, projects: DataFrame, package_assets: DataFrame, links: DataFrame, s: Settings) -> DataFrame:
    """Each package with the assets it buys and the measures whose commitments link to it; nulls where there are none."""
    assets = package_assets.where(F.col("probability") >= s.asset_yes).groupBy("package_id").agg(R.distinct_array("asset_id").alias("asset_ids"))
    linked = F.col("probability") >= s.package_link_min
    of = links.groupBy("package_id").agg(R.distinct_array(F.when(linked, F.col("label_set"))).alias("measures_linked"), F.count_if(linked).alias("commitments_linked"), F.max("probability").alias("best_commitment_probability"))
    return packages_with_project(packages, projects).join(assets, "package_id", "left").join(of, "package_id", "left").withColumns({"commitments_linked": F.coalesce("commitments_linked", F.lit(0)), "is_upcoming": S.is_upcoming(F.col("status"))})


# Commitments


def commitment_units(findings: DataFrame, paragraph_projects: DataFrame, info: DataFrame, pair_checks: DataFrame, s: Settings) -> DataFrame:
    """Each committed unit that counts, once a project, asset and type, with its commitment's id.

    findings has asset_ids, asset_id, type_ids (arrays may be null or empty). Settings are literals, so that what
    they make constant is folded away.
    """
    f = findings.where("was_sent and is_committed").where((F.col("probability") >= s.min_probability) & F.coalesce("asset_level", F.lit("none")).isin(*s.link_levels))
    f = f.join(paragraph_projects.select("paragraph_id", "project_id"), "paragraph_id").join(info.where("is_ipf").select("project_id") if s.ipf_only else info.select("project_id"), "project_id")
    if s.apply_pair_checks:
        a = (F.col("r.set_a") == F.col("l.label_set")) & (F.col("r.p_keep_a") < s.pair_check_floor)
        b = (F.col("r.set_b") == F.col("l.label_set")) & (F.col("r.p_keep_b") < s.pair_check_floor)
        f = R.anti_where(f, pair_checks, (F.col("l.unit_id") == F.col("r.unit_id")) & (a | b))
    f = f.withColumn("asset_id", R.unnest_or(F.col("asset_ids"), F.coalesce("asset_id", F.lit(NO_ASSET))))
    f = f.withColumn("type_id", R.unnest_or(F.col("type_ids"), F.lit(NO_TYPE)))
    level = F.coalesce("asset_level", F.lit("none"))
    return f.drop("asset_ids", "type_ids").withColumns({"asset_from": F.when(level == "unit", "sentence").when(level == "paragraph", "paragraph").otherwise("none"), "wording": S.wording(F.col("text")), "commitment_id": S.commitment_id(F.col("project_id"), F.col("label_set"), F.col("asset_id"), F.col("type_id"))})


def commitment_package_status(units: DataFrame, links: DataFrame, status: DataFrame, s: Settings) -> DataFrame:
    """Each commitment and package linked to any of its sentences, with where the package stands."""
    keys = ["label_set", "label_id", "unit_id", "project_id"]
    linked = units.select("commitment_id", *keys).join(links.where(F.col("probability") >= s.package_link_min).select(*keys, "package_id", "probability"), keys)
    best = linked.groupBy("commitment_id", "package_id").agg(F.max("probability").alias("link_probability"), F.countDistinct("unit_id").alias("units_linked"))
    return best.join(status, "package_id")


def wording_overlap(findings: DataFrame, paragraph_projects: DataFrame, s: Settings) -> DataFrame:
    """For each committed unit and project: its runs of words, and how many other projects hold a share of them.

    A project that holds the share of a unit's runs holds at least one of its rarest ones, so many of them as the
    share may lack and one more: these alone find the candidates, and boilerplate, which every project has, meets
    nobody. For each candidate the runs are then counted by (run, project). A project counts for a run if a unit of
    it other than this one has the run: two distinct units settle that.
    """
    u = findings.where("was_sent and is_committed").select("unit_id", "paragraph_id", "text").join(paragraph_projects.select("paragraph_id", "project_id"), "paragraph_id")
    # A unit's runs are worked out once, however many projects it belongs to.
    spoken = working.written(u.select("unit_id", "text").distinct().select("unit_id", S.shingles(F.col("text"), s.shingle_words).alias("hs")), "runs")
    n = u.select("unit_id", "project_id").distinct().join(spoken.select("unit_id", F.size("hs").alias("runs")), "unit_id").select("unit_id", "project_id", "runs")
    of = u.select("unit_id", "project_id").distinct()
    flat = of.join(spoken, "unit_id").select("unit_id", "project_id", F.explode("hs").alias("h"))
    common = flat.groupBy("h").agg(F.count("*").alias("seen"), F.min("project_id").alias("p"), F.max("project_id").alias("q")).where("p <> q").select("h", "seen")
    own = working.written(flat.join(common, "h"), "shared-runs")
    held = own.groupBy("h", F.col("project_id").alias("other")).agg(F.min("unit_id").alias("one"), F.max("unit_id").alias("two"))
    unit = Window.partitionBy("unit_id", "project_id")
    need = F.ceil(F.col("runs") * s.near_copy_share)
    ranked = own.join(n, ["unit_id", "project_id"]).withColumns({"place": F.row_number().over(unit.orderBy("seen", "h")), "shared": F.count("*").over(unit)})
    rare = ranked.where(F.col("place") <= F.col("shared") - need + 1)  # the runs that none else has come first and find nobody
    other_unit = "one <> unit_id or two <> unit_id"
    candidates = rare.join(held, "h").where("other <> project_id").where(other_unit).select("unit_id", "project_id", "other").distinct()
    met = own.join(candidates, ["unit_id", "project_id"]).join(held, ["h", "other"]).where(other_unit)
    counted = met.groupBy("unit_id", "project_id", "other").agg(F.count("*").alias("runs_shared"))
    near = counted.join(n, ["unit_id", "project_id"]).where(F.col("runs_shared") >= s.near_copy_share * F.col("runs")).groupBy("unit_id", "project_id").agg(F.count("*").alias("near_copy_projects"))
    return n.join(near, ["unit_id", "project_id"], "left").withColumn("near_copy_projects", F.coalesce("near_copy_projects", F.lit(0)))


def dropped_by_restructuring(units: DataFrame, components: DataFrame, documents: DataFrame) -> DataFrame:
    """For each committed unit: whether a later restructuring deletes its component; null if it has none."""
    own = units.select("commitment_id", "unit_id", "project_id", "component_key", "document_id").join(documents.select("document_id", F.col("disclosure_date").alias("own_date")), "document_id", "left")
    deleted = components.where("read_from = 'restructuring' and action = 'Marked for Deletion'").select(F.col("project_id").alias("c_project"), "name_key", F.col("disclosure_date").alias("c_date"))
    hit = own.join(deleted, (F.col("project_id") == F.col("c_project")) & (F.col("c_date") > F.col("own_date")) & S.same_component(F.col("name_key"), F.col("component_key")), "left_semi").select("commitment_id", "unit_id").distinct().withColumn("hit", F.lit(True))
    out = own.join(hit, ["commitment_id", "unit_id"], "left")
    return out.select("commitment_id", "unit_id", F.when(F.coalesce("component_key", F.lit("")) != "", F.coalesce("hit", F.lit(False))).alias("dropped"))


def commitments(units: DataFrame, documents: DataFrame, overlap: DataFrame | None, dropped: DataFrame, package_links: DataFrame, info: DataFrame, own_components: DataFrame, own_assets: DataFrame, labels: DataFrame, types: DataFrame) -> DataFrame:
    """One row for each commitment: project x asset x measure x type. Without `overlap`, which is dear, same_wording_projects is null: for counts that don't read it."""
    near = units.withColumn("near_copy_projects", F.lit(None).cast("bigint")) if overlap is None else units.join(overlap.select("unit_id", "project_id", "near_copy_projects"), ["unit_id", "project_id"], "left")
    none = F.lit(None).cast("bigint") if overlap is None else F.lit(0)
    u = near.join(documents.select("document_id", "disclosure_date"), "document_id", "left").join(dropped.distinct(), ["commitment_id", "unit_id"], "left")
    part = F.nullif(F.coalesce(F.nullif(F.col("subcomponent_number"), F.lit("")), F.col("component_number")), F.lit(""))
    c = u.groupBy("commitment_id", "project_id", "label_set", "asset_id", "type_id").agg(
        F.when(F.bool_or(F.col("asset_from") == "sentence"), "sentence").otherwise(F.min("asset_from")).alias("asset_from"), R.distinct_text(part).alias("components"), F.countDistinct("wording").alias("sentences"), F.countDistinct("paragraph_id").alias("paragraphs"), F.countDistinct("document_id").alias("documents"),
        F.max("probability").alias("strongest_p"), F.bool_and("dropped").alias("dropped_by_restructuring"), F.min("disclosure_date").alias("first_seen_date"), F.coalesce(F.max("near_copy_projects"), none).alias("same_wording_projects"),
    )
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in STATUS_ORDER]), F.col("package_status")), F.lit(0))
    p = package_links.groupBy("commitment_id").agg(F.count("*").alias("linked_packages"), R.first_by("package_status", F.when(rank == 0, 999).otherwise(rank), F.col("package_id")).alias("status"), F.min("next_date").alias("next_date"), F.sum("estimated_amount_usd").alias("linked_package_estimate_usd"), F.count("estimated_amount_usd").alias("linked_packages_with_estimate"))
    priced = own_components.where("component_level = 'component'").select("project_id", "component_number", "cost")
    cost = units.where("coalesce(component_number, '') <> ''").select("commitment_id", "project_id", "component_number").distinct().join(priced, ["project_id", "component_number"], "left").groupBy("commitment_id").agg(R.all_or_nothing("cost").alias("component_cost"))
    measure = R.first_per_key(labels.where("label_set <> 'assets'"), ["label_set"], [F.col("label_id").asc()]).select("label_set", F.col("label_name").alias("measure_name"), "family")
    asset = labels.where("label_set = 'assets'").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("own_asset_name"))
    type_ = R.first_per_key(types, ["label_set", "type_id"], [F.col("label_id").asc()]).select("label_set", "type_id", F.col("type_name").alias("own_type_name"))
    named = own_assets.where("sentences_naming_it > 0").select("project_id", "asset_id").distinct().withColumn("in_map", F.lit(True))
    out = c.join(info.select("project_id", "project_name", "cohort_set", "country_name", "country_code", "region", "is_regional", F.col("commitment_usd_millions").alias("project_commitment_usd_m")), "project_id")
    out = out.join(p, "commitment_id", "left").join(cost, "commitment_id", "left").join(measure, "label_set", "left").join(asset, "asset_id", "left").join(type_, ["label_set", "type_id"], "left").join(named, ["project_id", "asset_id"], "left")
    return out.withColumns({
        "asset_name": F.coalesce("own_asset_name", "asset_id"), "type_name": F.coalesce("own_type_name", "type_id"), "asset_link_level": F.col("asset_from"), "asset_in_asset_map": F.when(F.col("asset_id") != NO_ASSET, F.coalesce("in_map", F.lit(False))),
        "linked_packages": F.coalesce("linked_packages", F.lit(0)), "linked_packages_with_estimate": F.coalesce("linked_packages_with_estimate", F.lit(0)), "status": F.coalesce("status", F.lit("No package found")),
    }).drop("own_asset_name", "own_type_name", "in_map")


def commitment_sentences(units: DataFrame, paragraphs: DataFrame, documents: DataFrame) -> DataFrame:
    """Each commitment's distinct wordings, by their strongest unit, with the page they stand on."""
    best = R.first_per_key(units, ["commitment_id", "wording"], [F.col("probability").desc(), F.col("unit_id").asc()])
    out = best.select("commitment_id", "unit_id", "wording", "text", "probability", "document_id", "paragraph_id").join(paragraphs.select("paragraph_id", "section_title", F.col("page_from").alias("page_number")), "paragraph_id", "left").join(documents.select("document_id", "document_kind", F.col("disclosure_date").alias("document_date"), "pdf_url"), "document_id", "left")
    return out.withColumn("pdf_url", F.concat(S.https(F.col("pdf_url")), F.when(F.col("page_number").isNotNull(), F.concat(F.lit("#page="), F.col("page_number").cast("string"))).otherwise("")))


def commitment_evidence(units: DataFrame, search_units: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Each commitment's paragraphs, with its sentences marked and the strongest of them."""
    spans = units.select("commitment_id", "unit_id", "paragraph_id").distinct().join(search_units.select("unit_id", F.col("text_start").alias("s"), F.col("text_end").alias("e")), "unit_id").select("commitment_id", "paragraph_id", "s", "e").distinct()
    inside = spans.join(paragraphs.select("paragraph_id", F.length("text").alias("n")), "paragraph_id").where("s >= 0 and e <= n").drop("n")
    marked = R.mark_spans(inside, paragraphs, ["commitment_id", "paragraph_id"], "paragraph_id")
    best = units.groupBy("commitment_id", "paragraph_id").agg(F.countDistinct("wording").alias("sentences"), F.max("probability").alias("strongest_p"), R.first_by("text", -F.col("probability"), F.col("unit_id")).alias("key_sentence"))
    out = best.join(paragraphs.select("paragraph_id", "text", "section_title"), "paragraph_id").join(marked, ["commitment_id", "paragraph_id"], "left")
    return out.withColumn("paragraph_marked", F.coalesce("marked", "text")).drop("marked", "text")


# Links and roll-ups in their context


def package_assets_in_context(package_assets: DataFrame, packages: DataFrame, projects: DataFrame, labels: DataFrame) -> DataFrame:
    """Each package and asset that was asked (package_id, asset_id, probability), with the asset's name, the package and its project."""
    names = labels.where("label_set = 'assets'").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("asset_name"))
    p = packages.select("package_id", "project_id", "description_clean", "category", "method_code", "status", "planned_date", "estimated_amount_usd", "in_latest_plan", "component_number", "component_name")
    out = package_assets.join(p, "package_id").join(projects.select("project_id", "cohort_set", "project_name", "country_name", "region"), "project_id", "left").join(names, "asset_id", "left")
    return out.withColumn("is_upcoming", S.is_upcoming(F.col("status")))


def commitment_packages_in_context(links: DataFrame, context: DataFrame, packages: DataFrame) -> DataFrame:
    """Each asked pair of a finding (of findings_in_context) and a package, with both."""
    keys = ["label_set", "label_id", "unit_id", "project_id"]
    f = context.select(*keys, "measure_name", "cohort_set", "project_name", "country_name", "is_committed", F.col("probability").alias("commitment_probability"), F.col("text").alias("commitment_text"), F.col("component_number").alias("commitment_component_number"))
    p = packages.select("package_id", F.col("description_clean").alias("package_description"), "category", "method_code", "status", "planned_date", "estimated_amount_usd", "in_latest_plan", F.col("component_number").alias("package_component_number"), F.col("component_name").alias("package_component_name"))
    return links.join(f, keys).join(p, "package_id").withColumn("is_upcoming", S.is_upcoming(F.col("status")))


def grades_with_text(scores: DataFrame, units: DataFrame, labels: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Each unit's answer for each asset (unit_id, paragraph_id, asset_id, p) with the asset's name, the sentence and its paragraph."""
    names = labels.where("label_set = 'assets'").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("asset_name"))
    out = scores.join(names, "asset_id", "left").join(units.select("unit_id", F.col("text").alias("sentence_text")), "unit_id", "left")
    return out.join(paragraphs.select("paragraph_id", "component_number", "component_name", "section_title", "block", F.col("text").alias("paragraph_text")), "paragraph_id", "left")


def search_paragraphs_with_text(rollup: DataFrame, paragraphs: DataFrame, labels: DataFrame) -> DataFrame:
    """The search's roll-up (of search.paragraph_rollup) with the label's name and the paragraph."""
    named = R.first_per_key(labels, ["label_id"], [F.col("label_set").asc()]).select("label_id", "label_name")
    return rollup.join(named, "label_id", "left").join(paragraphs.select("paragraph_id", "component_number", "component_name", "section_title", "text"), "paragraph_id", "left")


def data_as_of(loads: DataFrame) -> DataFrame:
    """One row: when the data was loaded last, and from which release. loads: release_id, loaded_at."""
    return loads.agg(F.max(F.struct("loaded_at", "release_id")).alias("l")).select("l.release_id", "l.loaded_at")


def upcoming_by_component(upcoming: DataFrame, asset_sentences: DataFrame) -> DataFrame:
    """Packages still to come with the sentences of the asset map under their component in their project. asset_sentences: project_id, component_number, asset_id, probability, paragraph_id."""
    a = asset_sentences.select("project_id", "component_number", "asset_id", "probability", "paragraph_id")
    return upcoming.join(a, ["project_id", "component_number"], "left")


# Measures


def measure_overlap(findings: DataFrame) -> DataFrame:
    """For each pair of measures: the committed units they share, and the share of the smaller one's."""
    u = findings.where("was_sent and is_committed").select("label_set", "unit_id").distinct()
    n = u.groupBy("label_set").agg(F.count("*").alias("n"))
    pairs = R.pairs_once(u, "unit_id", "label_set")
    out = pairs.join(n.select(F.col("label_set").alias("group_a"), F.col("n").alias("units_a")), "group_a").join(n.select(F.col("label_set").alias("group_b"), F.col("n").alias("units_b")), "group_b")
    share = F.round(F.col("shared").cast("decimal(20,6)") / F.least("units_a", "units_b"), 3).cast("double")
    return out.select(F.col("group_a").alias("label_set_a"), F.col("group_b").alias("label_set_b"), F.col("shared").alias("shared_units"), "units_a", "units_b", share.alias("share_of_smaller"))


def measure_summary(labels: DataFrame, all_commitments: DataFrame, quality: DataFrame) -> DataFrame:
    """One row for each active measure: what is found of it, and its latest grading (an evaluation before a training sheet)."""
    m = R.first_per_key(labels.where("label_set <> 'assets' and is_active"), ["label_set"], [F.col("label_id").asc()]).select("label_set", F.col("label_name").alias("measure_name"), "family")
    c = all_commitments.groupBy("label_set").agg(F.count("*").alias("commitments"), F.countDistinct("project_id").alias("projects"), F.countDistinct(F.when(~F.col("is_regional"), F.col("country_name"))).alias("countries"), F.countDistinct(F.when(F.col("type_id") != NO_TYPE, F.col("type_id"))).alias("types"))
    q = R.first_per_key(quality, ["label_set"], [(F.col("sheet") == "evaluation").desc(), F.col("evaluated_at").desc(), F.col("graded_units").desc()]).select("label_set", F.col("sheet").alias("graded_sheet"), "graded_units")
    return m.join(c, "label_set", "left").join(q, "label_set", "left").withColumns({k: F.coalesce(k, F.lit(0)) for k in ("commitments", "projects", "countries", "types")})


# The application's helpers


def headline(df: DataFrame) -> DataFrame:
    """One row: commitments, projects, countries of projects that are not regional, measures, the share with a package (null without any)."""
    return df.agg(F.count("*").alias("commitments"), F.countDistinct("project_id").alias("projects"), F.countDistinct(F.when(~F.col("is_regional"), F.col("country_code"))).alias("countries"), F.countDistinct("label_set").alias("measures"), F.try_divide(F.count_if(F.col("linked_packages") > 0), F.count("*")).alias("share_linked"))


def count_by(df: DataFrame, *by: str) -> DataFrame:
    """Group sizes, groups of nulls included, the largest first."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *by)


PROJECT_COLUMNS = ("project_id", "region", "country_name", "practice", "cohort_set", "approval_fiscal_year")


def tally(df: DataFrame, by: list[str], base: DataFrame, unit: str = "rows") -> DataFrame:
    """n (rows or distinct projects) a group, `of`: projects of `base` that share its project columns (all if none is among `by`), and the share."""
    n = df.groupBy(*by).agg((F.count("*") if unit == "rows" else F.countDistinct("project_id")).alias("n"))
    shared = [c for c in by if c in PROJECT_COLUMNS and c in base.columns]
    of = base.groupBy(*shared).agg(F.countDistinct("project_id").alias("of"))
    if shared:
        on = None
        for c in shared:
            e = n[c].eqNullSafe(of[c])
            on = e if on is None else on & e
        out = n.join(of, on, "left").select(*[n[c] for c in by], "n", F.coalesce("of", F.lit(0)).alias("of"))
    else:
        out = n.crossJoin(of)  # one row
    return out.withColumn("share", F.try_divide("n", "of"))


def board(df: DataFrame) -> DataFrame:
    """Where each project stands: a row for each stage and project, stages in their order, then most commitments, with their types."""
    types = F.array_sort(F.collect_set(F.when(F.col("type_name") != NO_TYPE, F.col("type_name"))))
    staged = df.withColumn("stage", S.stage_of(F.col("status"))) if "stage" not in df.columns else df
    out = staged.groupBy("stage", "project_id", "project_name").agg(F.count("*").alias("commitments"), F.array_join(types, ", ").alias("types"))
    order = F.array_position(F.array(*[F.lit(s) for s in (*S.STAGES, S.NO_STAGE)]), F.col("stage"))
    return out.orderBy(order, F.col("commitments").desc(), "project_name")
