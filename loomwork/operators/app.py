"""What the application reads: frames of commitments, projects, sentences and packages, and the counts of its About page.

Each reader is a function of the views; filters that are not given filter nothing. Orders are those a page shows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import relational as R
from .views import NO_ASSET, NO_TYPE

#: The package statuses of the coming-up list.
COMING_UP = ("Overdue", "Planned", "Tendered")


def place() -> Column:
    """A project's country; of a regional one its region."""
    return F.when(F.coalesce("is_regional", F.lit(False)), F.col("region")).otherwise(F.col("country_name"))


def commitments(all_commitments: DataFrame, header: DataFrame, cohort: str | None = None) -> DataFrame:
    """One row for each commitment, with its project's place and approval year and its procurement stage."""
    own = ("commitment_id", "project_id", "project_name", "cohort_set", "country_name", "country_code", "region", "is_regional", "family", "label_set", "measure_name", "asset_id", F.coalesce("asset_name", F.lit(NO_ASSET)).alias("asset_name"), "type_id", F.coalesce("type_name", F.lit(NO_TYPE)).alias("type_name"), "status", "next_date", "sentences", "strongest_p", "linked_packages")
    out = R.optional(all_commitments, cohort_set=cohort).select(*own).join(header.select("project_id", "approval_fiscal_year"), "project_id", "left")
    return out.withColumns({"stage": S.stage_of(F.col("status")), "place": place()}).orderBy("project_name", "measure_name", "asset_name", "type_name")


def projects(header: DataFrame, info: DataFrame, ipf_only: bool = True, cohort: str | None = None) -> DataFrame:
    """The projects that commitments can come from: with a document read, of the instruments that count."""
    counted = info.where("is_ipf") if ipf_only else info
    out = R.optional(header.where("documents_read > 0"), cohort_set=cohort).join(counted.select("project_id"), "project_id", "left_semi")
    return out.select("project_id", "project_name", "cohort_set", "country_name", "country_code", "region", "is_regional", "approval_fiscal_year", place().alias("place")).orderBy("project_name")


def sentences(own: DataFrame, commitment_ids: DataFrame | None = None) -> DataFrame:
    """The sentences (of views.commitment_sentences) of the commitments asked for, strongest first, with how firm they are."""
    some = own if commitment_ids is None else own.join(commitment_ids.select("commitment_id").distinct(), "commitment_id", "left_semi")
    out = some.select("commitment_id", "unit_id", "text", "page_number", "pdf_url", F.col("probability").alias("posterior_probability"), S.firmness(F.col("text")).alias("firmness"), "document_kind", "document_date")
    return out.orderBy("commitment_id", F.col("posterior_probability").desc(), F.length("text"), "unit_id")


def evidence(own: DataFrame, commitment_ids: DataFrame | None = None) -> DataFrame:
    """The strongest sentence of each commitment asked for."""
    first = R.first_per_key(sentences(own, commitment_ids), ["commitment_id"], [F.col("posterior_probability").desc(), F.length("text").asc(), F.col("unit_id").asc()])
    return first.select("commitment_id", "text", "page_number", "pdf_url", "posterior_probability", "document_kind", "document_date")


def measure_types(types: DataFrame, label_set: str | None = None) -> DataFrame:
    """The types of each measure, or of one."""
    return R.optional(types, label_set=label_set).select("label_set", "type_id", "type_name").distinct().orderBy("label_set", "type_name")


def assets(labels: DataFrame) -> DataFrame:
    """The active assets."""
    return labels.where("label_set = 'assets' and is_active").select(F.col("label_id").alias("asset_id"), F.col("label_name").alias("asset_name")).orderBy("asset_name")


def packages(package_status: DataFrame, project_id: str | None = None) -> DataFrame:
    """The packages linked to commitments (views.commitment_package_status), once each by their surest link, with the date that matters and which it is: planned (still to come), signed, or was due."""
    first = R.first_per_key(R.optional(package_status, project_id=project_id), ["package_id"], [F.col("link_probability").desc(), F.col("commitment_id").asc()])
    kind = F.when(F.col("next_date").isNotNull(), "planned").when(F.col("signed_date").isNotNull(), "signed").when(F.col("due_date").isNotNull(), "was due")
    out = first.select("package_id", F.col("description_clean").alias("description"), "category", "method_code", "estimated_amount_usd", "package_status", "next_date", "due_date", "signed_date", S.stage_of(F.col("package_status")).alias("stage"), F.coalesce("next_date", "signed_date", "due_date").alias("date"), kind.alias("date_kind"))
    return out.orderBy(F.col("date").asc_nulls_last(), "package_id")


def project(project_id: str, header: DataFrame, own_assets: DataFrame, components: DataFrame, documents: DataFrame, package_status: DataFrame) -> dict[str, DataFrame]:
    """What a project's page shows beside its commitments."""
    one = lambda df: df.where(F.col("project_id") == project_id)
    return {
        "header": one(header),
        "assets": one(own_assets).orderBy(F.col("sentences_naming_it").desc_nulls_last(), "asset_name"),
        "components": one(components).orderBy("component_number"),
        "documents": one(documents).orderBy("document_date"),
        "packages": packages(package_status, project_id),
    }


def coming_up(package_status: DataFrame, all_commitments: DataFrame, cohort: str | None = None, family: str | None = None) -> DataFrame:
    """The packages still to come that a commitment is linked to, soonest first, once a project, with the measures."""
    c = R.optional(all_commitments, cohort_set=cohort, family=family).select("commitment_id", F.col("project_id"), "project_name", "country_name", "region", "is_regional", "measure_name")
    s = package_status.where(F.col("package_status").isin(*COMING_UP)).select("commitment_id", "package_id", F.col("description_clean").alias("description"), "package_status", F.coalesce("next_date", "due_date").alias("date"), "estimated_amount_usd")
    keys = ["package_id", "project_id", "project_name", "country_name", "region", "is_regional", "description", "package_status", "date", "estimated_amount_usd"]
    out = s.join(c, "commitment_id").groupBy(*keys).agg(R.distinct_text("measure_name", "; ").alias("measures"))
    return out.withColumn("place", place()).orderBy(F.col("date").asc_nulls_last(), "project_name", "package_id")


def about(t: Mapping[str, DataFrame], link_floor: float, ipf_only: bool = True) -> DataFrame:
    """group, name, value: the counts of the About page, over the operations that count and their documents.

    t: info, header, document_projects, units, findings, pair_checks, commitment_units, commitments, unit_assets,
    packages, notices, awards, package_assets, package_status, labels, types.
    """
    counted = F.col("is_ipf") if ipf_only else F.lit(True)
    both = t["header"].select("project_id", "documents_read").join(t["info"].select("project_id", "is_ipf", "status", "lending_instrument"), "project_id")
    read, none = F.col("documents_read") > 0, F.col("documents_read") == 0
    scope = both.where(read & counted).select("project_id")
    documents = t["document_projects"].join(scope, "project_id", "left_semi").select("document_id").distinct()
    in_documents = lambda df: df.join(documents, "document_id", "left_semi")
    in_scope = lambda df: df.join(scope, "project_id", "left_semi")
    units = in_documents(t["units"]).select("unit_id")
    of_units = lambda df: df.join(units, "unit_id", "left_semi")
    n, distinct = F.count("*"), lambda c, when=None: F.countDistinct(c if when is None else F.when(when, F.col(c)))
    pipeline = F.col("status") == "Pipeline"
    other = F.col("lending_instrument").isin("Development Policy Lending", "Program-for-Results Financing")
    parts = (
        ("projects", both, {"cohort": n, "with_document": F.count_if(read), "in_scope": F.count_if(read & counted), "not_approved": F.count_if(none & pipeline), "other_instrument": F.count_if(none & ~F.coalesce(pipeline, F.lit(False)) & other), "other_with_document": F.count_if(read & ~counted)}),
        ("text", documents, {"documents": n}),
        ("text", units, {"sentences": n}),
        ("measures", in_documents(t["findings"].where("was_sent and is_committed")), {"at_threshold": distinct("unit_id")}),
        ("measures", of_units(t["pair_checks"]), {"overlap_tested": distinct("unit_id")}),
        ("measures", t["commitment_units"], {"kept": distinct("unit_id"), "with_type": distinct("unit_id", F.col("type_id") != NO_TYPE)}),
        ("measures", t["commitments"], {"commitments": n, "commitment_projects": distinct("project_id")}),
        ("assets", of_units(t["unit_assets"].where("asset_level = 'unit'")), {"at_threshold": distinct("unit_id")}),
        ("procurement", in_scope(t["packages"]), {"packages": n, "package_projects": distinct("project_id")}),
        ("procurement", in_scope(t["notices"]), {"notices": n}),
        ("procurement", in_scope(t["awards"]), {"contracts": n}),
        ("procurement", in_scope(t["package_assets"]), {"tested": distinct("package_id"), "with_asset": distinct("package_id", F.col("probability") >= link_floor)}),
        ("procurement", t["package_status"], {"linked_packages": distinct("package_id")}),
        ("procurement", t["commitments"], {"linked_commitments": F.count_if(F.col("linked_packages") > 0)}),
        ("labels", t["labels"], {"measures": distinct("label_set", (F.col("label_set") != "assets") & F.col("is_active")), "assets": F.count_if((F.col("label_set") == "assets") & F.col("is_active"))}),
        ("labels", t["types"], {"types_defined": F.count_if(~F.startswith("type_name", F.lit("OTH."))), "types_proposed": F.count_if(F.startswith("type_name", F.lit("OTH.")))}),
    )
    out = None
    for group, df, counts in parts:
        row = df.agg(*[c.alias(name) for name, c in counts.items()])
        rows = row.select(F.explode(F.array(*[F.struct(F.lit(group).alias("group"), F.lit(name).alias("name"), F.col(name).cast("bigint").alias("value")) for name in counts])).alias("r")).select("r.*")
        out = rows if out is None else out.unionAll(rows)
    return out
