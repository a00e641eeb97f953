"""What a model is shown of a unit or package, and the rows that its answers are published as."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import decisions as DC
from . import relational as R


def corpus(units: DataFrame, paragraphs: DataFrame, components: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """Units joined to all that a question needs: text with its lead-in, section, paragraph, component ('2.1 Bridges'), and vector.

    units: unit_id, paragraph_id, document_id, text, lead_text; paragraphs: paragraph_id, section_title, text,
    component_number, subcomponent_number, component_name, subcomponent_name; components: document_id, number, name, source.
    """
    named = R.first_per_key(components, ["document_id", "number"], [(F.col("source") == "heading").asc(), F.col("name").asc()]).select("document_id", F.col("number").alias("__number"), F.col("name").alias("__name"))
    p = paragraphs.select("paragraph_id", F.coalesce("section_title", F.lit("")).alias("section"), F.col("text").alias("paragraph"), F.nullif("subcomponent_number", F.lit("")).alias("__sub"), F.nullif("component_number", F.lit("")).alias("__comp"), "component_name", "subcomponent_name").withColumn("__number", F.coalesce("__sub", "__comp"))
    out = units.select("unit_id", "paragraph_id", "document_id", F.concat_ws("\n", "lead_text", "text").alias("text")).join(p, "paragraph_id", "left").join(named, ["document_id", "__number"], "left")
    own = F.coalesce("__name", F.when(F.col("__sub").isNotNull(), F.col("subcomponent_name")).otherwise(F.col("component_name")), F.lit(""))
    label = F.when(F.col("__number").isNotNull(), F.trim(F.concat_ws(" ", "__number", own)))
    out = out.withColumn("component", label).select("unit_id", "paragraph_id", "document_id", "text", "section", "paragraph", "component")
    return out if vectors is None else out.join(vectors.select("unit_id", "embedding"), "unit_id", "left")


def sentence_states(own: DataFrame, with_paragraph: bool = False) -> DataFrame:
    """unit_id, state (JSON: section, sentence, component where it has one, and the paragraph if asked for), state_sha; own: of `corpus`."""
    fields = [F.col("section"), F.col("text").alias("sentence"), F.col("component"), *([F.col("paragraph")] if with_paragraph else [])]
    return own.select("unit_id", F.to_json(F.struct(*fields)).alias("state")).withColumn("state_sha", F.sha2("state", 256))


def context_prefix(own: DataFrame) -> DataFrame:
    """unit_id, prefix: 'Section: ... Component: ...' as far as they are known. own: unit_id, section, component_name."""
    part = lambda label, c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(f"{label}: "), F.trim(c), F.lit(".")))
    return own.select("unit_id", F.concat_ws(" ", part("Section", F.col("section")), part("Component", F.col("component_name"))).alias("prefix"))


def package_texts(packages: DataFrame) -> DataFrame:
    """package_id, project_id, text, sha, component of the packages worth asking about: no placeholders, none without words."""
    text = F.trim(F.regexp_replace(F.coalesce("description_clean", F.lit("")), r"(?U)\s+", " "))
    component = F.trim(F.concat_ws(" ", F.coalesce("component_number", F.lit("")), F.coalesce("component_name", F.lit(""))))
    return packages.where(~F.coalesce("is_placeholder", F.lit(False))).select("package_id", "project_id", text.alias("text"), component.alias("component")).where("text <> ''").withColumn("sha", F.sha2("text", 256))


def pair_states(pairs: DataFrame, own: DataFrame, packages: DataFrame) -> DataFrame:
    """unit_id, package_id, state (JSON: commitment, package, and the components of both where known). pairs: unit_id, package_id; own: of `corpus`; packages: of package_texts."""
    u = own.select("unit_id", F.col("text").alias("commitment"), F.col("component").alias("commitment_component"))
    p = packages.select("package_id", F.col("text").alias("package"), F.nullif("component", F.lit("")).alias("package_component"))
    both = pairs.join(u, "unit_id").join(p, "package_id")
    return both.select("unit_id", "package_id", F.to_json(F.struct("commitment", "package", "commitment_component", "package_component")).alias("state"))


def text_vectors(texts: DataFrame, cache: DataFrame, longest: int = 28_000) -> tuple[DataFrame, DataFrame]:
    """Texts with their vectors by content (sha, embedding), and the distinct ones still to embed. A text that does not have the hash it came with, or is too long, is an error. texts: id, text, sha."""
    bad = texts.where((F.sha2("text", 256) != F.col("sha")) | (F.length("text") > longest))
    if wrong := bad.select("id").limit(5).collect():
        raise ValueError(f"texts that changed or are too long: {[r[0] for r in wrong]}")
    todo = texts.select("sha", "text").distinct().join(cache.select("sha"), "sha", "left_anti")
    return texts.join(cache.select("sha", "embedding"), "sha"), todo


def measure_rows(units: DataFrame, answers: DataFrame, assets: DataFrame, own_scores: DataFrame, types: DataFrame, patterns: DataFrame) -> DataFrame:
    """The decision table of measures: one row for each unit that was asked, with its route, patterns, firmness, assets, posterior and types.

    units: unit_id, text; answers: label_set, label_id, unit_id, route, round, cosine, posterior, committed; assets: of
    decisions.sentence_assets; own_scores: unit_id, asset_id, p; types: label_set, unit_id, types (of merge_types);
    patterns: of decisions.pattern_hits.
    """
    won = assets.where("asset_rank > 0").groupBy("unit_id").agg(F.first("asset_level").alias("asset_link_level"), F.transform(F.array_sort(F.collect_list(F.struct("asset_rank", "asset_id", "probability"))), lambda x: F.struct(x["asset_id"].alias("a"), x["probability"].alias("p"))).alias("won"))
    best = own_scores.groupBy("unit_id").agg(F.min(F.struct((-F.col("p")).alias("k"), "asset_id")).alias("b")).select("unit_id", F.col("b.asset_id").alias("asset_unit"), F.round(-F.col("b.k"), 4).alias("asset_p_unit"))
    hit = patterns.groupBy("label_id", "unit_id").agg(F.array_join(F.array_sort(F.collect_set("pattern_id")), "|").alias("patterns"))
    out = answers.join(units.select("unit_id", "text"), "unit_id").join(won, "unit_id", "left").join(best, "unit_id", "left").join(hit, ["label_id", "unit_id"], "left").join(types, ["label_set", "unit_id"], "left")
    shown = F.when(F.col("committed"), F.coalesce("types", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    ids = F.coalesce(F.transform("won", lambda x: x["a"]), F.array().cast("array<string>"))
    level = F.coalesce("asset_link_level", F.lit("none"))
    return out.select(
        "label_set", "label_id", "unit_id", "route", "round", F.round("cosine", 6).alias("score"), F.coalesce("patterns", F.lit("")).alias("patterns"), S.firmness(F.col("text")).alias("firmness"), "asset_unit", "asset_p_unit", F.array_join(F.when(level == "unit", ids).otherwise(F.array().cast("array<string>")), "|").alias("assets_yes"), F.try_element_at(ids, F.lit(1)).alias("asset_link"), level.alias("asset_link_level"),
        F.round(F.try_element_at("won", F.lit(1))["p"], 4).alias("asset_link_p"), F.array_join(ids, "|").alias("asset_links"), "committed", F.round("posterior", 4).alias("p_committed_calibrated"), F.array_join(shown, "|").alias("types_yes"), F.try_element_at(shown, F.lit(1)).alias("best_type"),
    )


def asset_rows(assets: DataFrame, own_scores: DataFrame) -> DataFrame:
    """The decision table of assets: a unit's assets in order (one row of rank 0 without any), beside its own best one."""
    best = own_scores.groupBy("unit_id").agg(F.min(F.struct((-F.col("p")).alias("k"), "asset_id")).alias("b")).select("unit_id", F.col("b.asset_id").alias("own_best_asset_id"), F.round(-F.col("b.k"), 4).alias("own_best_probability"))
    return assets.join(best, "unit_id", "left").withColumn("probability", F.round("probability", 4))


def package_links(links: DataFrame, unit_assets: DataFrame, package_scores: DataFrame, yes: float, levels: tuple[str, ...]) -> DataFrame:
    """The decision table of links: each asked pair with the assets that unit and package share. links: unit_id, package_id, ...; package_scores: package_id, asset_id, p."""
    return DC.shared_assets(links, unit_assets, package_scores, yes, levels)
