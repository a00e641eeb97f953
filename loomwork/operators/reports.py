"""What a selection of projects holds and where it stands: summaries, packages to come, open notices, the tables cut to it; and samples and sensitivity reports."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import extraction as X
from . import relational as R


def selected_tables(selection: DataFrame, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables cut to the selected projects (project_id): by project_id, by any of project_ids (an array), or, where a table has neither, by its paragraph."""
    ids = selection.select("project_id").distinct()
    out: dict[str, DataFrame] = {}
    for name, df in tables.items():
        if "project_id" in df.columns:
            out[name] = df.join(ids, "project_id", "left_semi")
        elif "project_ids" in df.columns:
            held = df.select("project_ids").distinct().withColumn("project_id", F.explode("project_ids")).join(ids, "project_id", "left_semi").select("project_ids").distinct()
            out[name] = df.join(held, "project_ids", "left_semi")
    for name, df in tables.items():
        if name not in out and "paragraph_id" in df.columns and "paragraphs" in out:
            out[name] = df.join(out["paragraphs"].select("paragraph_id").distinct(), "paragraph_id", "left_semi")
    return out


def _counts(df: DataFrame, key: str, value: str, name: str, by_size: bool) -> DataFrame:
    """project_id and a text 'value n; value n': by size, then by value, or by value alone."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    order = F.struct(*([(-F.col("n")).alias("o")] if by_size else []), F.coalesce(value, F.lit("")).alias("v"), F.col("n"))
    listed = F.transform(F.array_sort(F.collect_list(order)), lambda x: F.concat(x["v"], F.lit(" "), x["n"].cast("string")))
    return n.groupBy(key).agg(F.array_join(listed, "; ").alias(name))


def latest_components(components: DataFrame) -> DataFrame:
    """project_id, components ('1. Roads (US$5.00m); ...'), components_cost_usd_m: the top-level components of each project's newest list, of tables rather than headings where it has some, each number once."""
    tops = components.where((F.col("level") == "component") & (F.coalesce("number", F.lit("")) != ""))
    newest = tops.groupBy("project_id").agg(F.max("disclosure_date").alias("__on"))
    last = tops.join(newest, "project_id").where(F.col("disclosure_date") == F.col("__on"))
    table = F.col("source").isin("datasheet", "restructuring")
    pick = last.withColumn("__any", F.bool_or(table).over(Window.partitionBy("project_id"))).where(~F.col("__any") | table)
    order = F.transform(F.regexp_extract_all("number", F.lit("([0-9]+)"), 1), lambda x: x.cast("int"))
    one = R.first_per_key(pick, ["project_id", "number"], [F.col("name").asc()])
    text = F.concat("number", F.lit(". "), "name", F.when(F.col("cost").isNotNull(), F.concat(F.lit(" (US$"), F.format_string("%.2f", F.col("cost").cast("double")), F.lit("m)"))).otherwise(""))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"])
    return one.groupBy("project_id").agg(F.array_join(listed, "; ").alias("components"), F.round(F.coalesce(F.sum("cost"), F.lit(0)).cast("double"), 2).alias("components_cost_usd_m"))


def summary(selection: DataFrame, documents: DataFrame, components: DataFrame, packages: DataFrame, notices: DataFrame, awards: DataFrame, today: datetime.date) -> DataFrame:
    """One row for each selected project: its documents, components, packages by status, what is still to come and what of it is late, notices, contracts. Every table is summed by project before it is joined; a project without rows has zeros and nulls."""
    on = F.lit(today)
    up = S.is_upcoming(F.col("status"))
    amount = F.coalesce(F.col("estimated_amount_usd").cast("double"), F.lit(0.0))
    p = packages.groupBy("project_id").agg(
        F.max("plan_disclosure_date").alias("latest_plan_date"), F.count("*").alias("packages"), F.count_if(up).alias("upcoming_packages"), F.count_if(up & ~F.col("in_latest_plan")).alias("upcoming_not_in_latest_plan"), F.round(F.sum(F.when(up, amount).otherwise(0.0)), 2).alias("upcoming_estimated_usd"), F.count_if(up & (F.col("planned_date") < on)).alias("upcoming_planned_date_passed"), F.min(F.when(up & (F.col("planned_date") >= on), F.col("planned_date"))).alias("next_planned_date"),
    )
    d = documents.groupBy("project_id").agg(F.count("*").alias("documents"), F.max("disclosure_date").alias("latest_document_date"))
    n = notices.groupBy("project_id").agg(F.count("*").alias("notices"), F.count_if(F.col("deadline_date") >= on).alias("open_notices"), F.max("publication_date").alias("latest_notice_date"))
    a = awards.groupBy("project_id").agg(F.count("*").alias("contracts_signed"), F.round(F.sum(F.coalesce(F.col("total_amount_usd").cast("double"), F.lit(0.0))), 2).alias("contracts_value_usd"), F.max("signed_date").alias("latest_contract_date"))
    out = selection
    for part in (d, _counts(documents, "project_id", "document_kind", "documents_by_kind", False), latest_components(components), p, _counts(packages, "project_id", "status", "packages_by_status", True), n, a):
        out = out.join(part, "project_id", "left")
    zero = ("documents", "packages", "upcoming_packages", "upcoming_not_in_latest_plan", "upcoming_planned_date_passed", "notices", "open_notices", "contracts_signed")
    return out.withColumns({**{c: F.coalesce(c, F.lit(0)) for c in zero}, **{c: F.coalesce(c, F.lit(0.0)) for c in ("upcoming_estimated_usd", "contracts_value_usd")}})


def upcoming(packages: DataFrame, notices: DataFrame) -> DataFrame:
    """Packages still to come, soonest first, those without a date last, with how many notices they have and the latest one's dates."""
    n = notices.where("package_id is not null").groupBy("package_id").agg(F.count("*").alias("notices"), F.max(F.struct("publication_date", "notice_id", "deadline_date")).alias("last"))
    out = packages.where(S.is_upcoming(F.col("status"))).join(n, "package_id", "left").withColumns({"notices": F.coalesce("notices", F.lit(0)), "latest_notice_date": F.col("last.publication_date"), "latest_notice_deadline": F.col("last.deadline_date")}).drop("last")
    return out.orderBy(F.col("planned_date").asc_nulls_last(), "project_id", "package_id")


def open_notices(notices: DataFrame, packages: DataFrame, today: datetime.date) -> DataFrame:
    """Notices whose deadline is today or later, soonest first, with their package's status and estimate."""
    p = packages.select("package_id", F.col("status").alias("package_status"), F.col("estimated_amount_usd").alias("package_estimated_amount"))
    return notices.where(F.col("deadline_date") >= F.lit(today)).join(p, "package_id", "left").orderBy("deadline_date", "project_id", "notice_id")


def sample_documents(documents: DataFrame, n: int, first: Sequence[str] = ("pad", "additional_financing")) -> DataFrame:
    """The same n documents of a store each time: appraisals first, then by the hash of their id. A sample is the point."""
    return documents.orderBy((~F.col("document_kind").isin(*first)).asc(), F.sha2("document_id", 256), "document_id").limit(n)


def seeded_sample(items: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n items by their permanent random numbers under a seed: the same each time, and a larger n adds to it. A sample is the point."""
    return items.withColumn("x", S.permanent_uniform(seed, F.col(key).cast("string"))).orderBy("x", key).limit(n)


def component_closing(units: DataFrame) -> DataFrame:
    """One row: paragraphs, how many stand under a component when components close with their section and when they run on, and how many differ. units: as component_tags, with for_model."""
    a = X.component_tags(units).select("unit_id", F.struct("component_number", "subcomponent_number").alias("a"))
    b = X.component_tags(units, close_at_section=False).select("unit_id", F.struct("component_number", "subcomponent_number").alias("b"))
    both = units.where("for_model").select("unit_id").join(a, "unit_id").join(b, "unit_id")
    return both.agg(F.count("*").alias("paragraphs"), F.count_if(F.col("a.component_number") != "").alias("tagged_default"), F.count_if(F.col("b.component_number") != "").alias("tagged_run_on"), F.count_if(F.col("a") != F.col("b")).alias("differ"))


def sentence_rules(paragraphs: DataFrame, minimums: Sequence[int] = (3, 2, 4)) -> DataFrame:
    """least, sentences, changed: for each least number of words, how many sentences there are and how many paragraphs are split otherwise than by the first. paragraphs: text."""

    @F.pandas_udf("array<struct<n: int, changed: boolean>>")
    def split(text: pd.Series) -> pd.Series:
        each = text.map(lambda x: [X.split_sentences(x or "", m) for m in minimums])
        return each.map(lambda ss: [{"n": len(s), "changed": s != ss[0]} for s in ss])

    rows = paragraphs.select(F.posexplode(split("text")).alias("i", "s"))
    named = F.element_at(F.array(*[F.lit(m) for m in minimums]), F.col("i") + 1)
    return rows.groupBy(named.alias("least")).agg(F.sum("s.n").alias("sentences"), F.count_if(F.col("s.changed")).alias("changed"))


def paragraph_changes(default: DataFrame, other: DataFrame) -> DataFrame:
    """One row: paragraphs of another reading, and the share of the default reading's words in paragraphs that it lacks (repeats counted). Both: document_id, text."""
    n = lambda df, c: df.groupBy("document_id", "text").agg(F.count("*").alias(c))
    both = n(default, "here").join(n(other, "there"), ["document_id", "text"], "left")
    words = S.token_count(F.col("text"))
    lost = both.agg(F.sum(words * F.greatest(F.col("here") - F.coalesce("there", F.lit(0)), F.lit(0))).alias("lost"), F.sum(words * F.col("here")).alias("all"))
    return other.agg(F.count("*").alias("paragraphs")).crossJoin(F.broadcast(lost)).select("paragraphs", F.coalesce(F.try_divide("lost", "all"), F.lit(0.0)).alias("share_changed"))  # one row each


def token_range(words: Column, characters: Column) -> Column:
    """struct<by_words, by_characters>: two estimates of a text's tokens, 1.3 a word and one for four characters."""
    return F.struct(F.floor(words * 1.3).cast("bigint").alias("by_words"), F.floor(characters / 4).cast("bigint").alias("by_characters"))


def slug(text: Column) -> Column:
    """A name for files: small letters and digits, anything else one underscore, at most forty characters; null if nothing is left or the name is taken."""
    s = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when((s != "") & ~s.isin("assets", "scale"), F.substring(s, 1, 40))
