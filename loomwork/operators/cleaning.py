"""Procurement rows cleaned: closed value sets, methods, amounts and dates from the words, components, audit checks.

Values of closed sets are Column expressions over constant maps, so they stay in the JVM. What walks a text (other
cells cut out of a description, words repaired, marks read) is in `extraction`, run in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocabulary as V
from . import extraction as X
from . import relational as R

UNKNOWN = "unknown"


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _flat(values: dict[str, str], drop: str) -> dict[str, str]:
    """The map by keys without some characters; of keys that then agree the first counts."""
    out: dict[str, str] = {}
    for k, v in values.items():
        out.setdefault(k.translate({ord(c): None for c in drop}), v)
    return out


def norm_status(value: Column) -> Column:
    """A status cell's status: by its words, by its letters where a space broke a word, or, of six letters or more, by the one status that begins so; else 'unknown'."""
    key = S.enum_key(F.coalesce(value, F.lit("")))
    flat = F.replace(key, F.lit(" "), F.lit(""))
    spelled = _flat(V.STATUS, " ")
    starts = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in spelled.items()])

    def found(f: Column) -> Column:
        hits = F.array_distinct(F.transform(F.filter(starts, lambda s: F.startswith(s["k"], f)), lambda s: s["v"]))
        return F.coalesce(F.try_element_at(_map(spelled), f), F.when((F.length(f) >= 6) & (F.size(hits) == 1), F.try_element_at(hits, F.lit(1))), F.lit(UNKNOWN))

    return F.when(key == "", UNKNOWN).otherwise(F.coalesce(F.try_element_at(_map(V.STATUS), key), F.transform(F.array(flat), found)[0]))


def norm_category(value: Column) -> Column:
    """goods, works, consultant_services or non_consulting_services by a cell's words, or by the group in a reference; else 'unknown'."""
    text = S.collapse(F.coalesce(value, F.lit("")))
    key = F.regexp_replace(F.lower(text), r"^[ .:;]+|[ .:;]+$", "")
    group = F.lower(F.regexp_extract(F.upper(text), "-(GO|CW|CS|NC)-", 1))
    return F.coalesce(F.try_element_at(_map(V.CATEGORIES), key), F.try_element_at(_map(V.CATEGORIES), group), F.lit(UNKNOWN))


def reference_method(ref: Column) -> Column:
    """The method code in a borrower reference ('...-GO-RFB2' has RFB), else ''. A code may run on into a suffix unless it has two letters; the longest counts."""
    codes = {c: c for c in V.METHOD_NAMES} | V.REFERENCE_CODES
    ordered = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(codes[c]).alias("v")) for c in sorted(codes, key=lambda c: (-len(c), c))])
    token = F.regexp_extract(S.norm_ref(ref), "(?:^|-)(?:CW|GO|CS|NC)-?([A-Z]+)", 1)
    fits = lambda t: F.filter(ordered, lambda x: (x["c"] == t) | ((F.length(x["c"]) > 2) & F.startswith(t, x["c"])))
    return F.coalesce(F.transform(F.array(token), lambda t: F.when(t != "", F.get(fits(t), F.lit(0))["v"]))[0], F.lit(""))


def _for_category(code: Column, category: Column) -> Column:
    """A direct selection of consultants has a code of its own."""
    return F.when((code == "DIR") & category.eqNullSafe(F.lit("consultant_services")), "CDS").otherwise(code)


def norm_method(value: Column, category: Column) -> Column:
    """The method code by a reference's code or a cell's words (spaces and hyphens aside); else 'unknown'."""
    by_ref = reference_method(value)
    key = S.enum_key(F.coalesce(value, F.lit("")))
    by_word = F.coalesce(F.try_element_at(_map(V.METHOD_WORDS), key), F.try_element_at(_map(_flat(V.METHOD_WORDS, " -")), F.regexp_replace(key, r"[\s-]+", "")))
    return F.when(by_ref != "", by_ref).otherwise(F.coalesce(_for_category(by_word, category), F.lit(UNKNOWN)))


def method_in_cells(cells: Column, category: Column) -> Column:
    """The method whose clipped words come first among a row's other cells; else 'unknown'."""
    flat = F.regexp_replace(S.enum_key(F.coalesce(cells, F.lit(""))), r"[\s\-']+", "")
    place = lambda f: F.array_min(F.filter(F.array(*[F.struct(F.instr(f, F.lit(k)).alias("at"), F.lit(v).alias("v")) for k, v in V.CLIPPED_METHODS.items()]), lambda x: x["at"] > 0))
    return F.coalesce(_for_category(F.transform(F.array(flat), place)[0]["v"], category), F.lit(UNKNOWN))


def resolve_method(method: Column, cells: Column, ref: Column, category: Column) -> Column:
    """struct<method, method_source>: the method cell, else the clipped one among other cells, else the reference."""
    tried = ((norm_method(method, category), "method_cell"), (method_in_cells(cells, category), "clipped_method_cell"), (norm_method(ref, F.lit("")), "reference"))
    each = F.filter(F.array(*[F.struct(m.alias("method"), F.lit(s).alias("method_source")) for m, s in tried]), lambda x: x["method"] != UNKNOWN)
    return F.coalesce(F.get(each, F.lit(0)), F.struct(F.lit(UNKNOWN).alias("method"), F.lit("").alias("method_source")))


def norm_approach(value: Column) -> Column:
    """A market approach as plans print it, with a broken last word mended and spaces around its dash."""
    whole = F.regexp_replace(S.collapse(F.coalesce(value, F.lit(""))), r"Internationa\s+l\b", "International")
    return F.trim(F.regexp_replace(whole, r"\s*[-/]\s*", " - "))


def chain_ref(ref: Column) -> Column:
    """The package's reference in a printed chain: 'BJ-UCP / PADA-43641-GO-RFQ' has the second. Of the first three parts those that look like references count, a later one only with a figure; a number alone ends them."""
    parts = F.transform(F.slice(F.split(F.coalesce(ref, F.lit("")), " / "), 1, 3), lambda p: F.trim(p))
    looks = lambda p: p.rlike("^[A-Z0-9][A-Z0-9–—-]{1,40}$") & ~p.rlike("^[0-9]+$")
    step = lambda s, p: F.struct(
        (s["on"] & looks(p) & ((s["i"] == 0) | p.rlike("[0-9]"))).alias("on"), (s["i"] + 1).alias("i"), F.when(s["on"] & looks(p) & p.rlike("[0-9]"), p).otherwise(s["ref"]).alias("ref")
    )
    return F.aggregate(parts, F.struct(F.lit(True).alias("on"), F.lit(0).alias("i"), F.coalesce(ref, F.lit("")).alias("ref")), step, lambda s: s["ref"])


def component_index(components: DataFrame) -> DataFrame:
    """project_id, components: each project's components (number, name, key, document), each key once, from its newest document; names of fewer than four letters don't count. components: project_ids (array), number, name, document_id, disclosure_date."""
    bare = F.trim(F.regexp_replace(F.coalesce("name", F.lit("")), r"(?iu)^(?:component|sub-?component)\s*[0-9]+(?:\.[0-9]+)?\s*[.:\-–]?\s*", ""))
    each = components.select(F.explode("project_ids").alias("project_id"), F.coalesce("number", F.lit("")).alias("number"), bare.alias("name"), S.name_key(bare).alias("key"), F.coalesce("document_id", F.lit("")).alias("document_id"), F.coalesce(F.col("disclosure_date").cast("string"), F.lit("")).alias("on"))
    first = R.first_per_key(each.where("project_id <> '' and length(key) >= 4"), ["project_id", "key"], [F.col("on").desc(), F.col("document_id").asc(), F.col("number").asc()])
    listed = F.array_sort(F.collect_list(F.struct(F.col("on").alias("o"), "number", "name", "key", "document_id")))
    return first.groupBy("project_id").agg(F.transform(listed, lambda c: F.struct(c["number"].alias("number"), c["name"].alias("name"), c["key"].alias("key"), c["document_id"].alias("document_id"))).alias("components"))


def clean_packages(rows: DataFrame, components: DataFrame | None = None, vocabulary: DataFrame | None = None) -> DataFrame:
    """Plan rows with what cleaning adds; nulls in a cell count as empty.

    rows: project_id, borrower_ref, description, category_raw, method_raw, cells_raw, market_approach, status_raw,
    planned_date, estimated_amount (text). The other cells go out of the description first, then words are
    repaired, marks read, a stitched neighbour cut, and a component at the end taken off. Amount and date come from the
    words only where the plan gives none. components: of component_index.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    raw = S.collapse(text("description"))
    df = rows.withColumns({"__raw": raw, "__own": F.coalesce("borrower_ref", F.lit(""))})
    parts = X.clean_descriptions(df.withColumn("description", F.col("__raw")), vocabulary).drop("__own")
    df = parts.join(components, "project_id", "left") if components is not None else parts.withColumn("components", F.lit(None).cast("array<struct<number: string, name: string, key: string, document_id: string>>"))
    df = X.package_components(df)
    category = norm_category(F.col("category_raw"))
    given = F.nullif(text("estimated_amount"), F.lit(""))
    said = S.money_in(F.col("__raw")).cast("decimal(20,2)").cast("string")
    out = df.withColumns({"category": category, "__m": resolve_method(F.col("method_raw"), F.col("cells_raw"), F.col("borrower_ref"), category)})
    return out.withColumns({
        "borrower_ref_norm": S.norm_ref(F.col("borrower_ref")), "description_match": S.match_key(F.col("description_clean")), "description_sha256": F.sha2("description_clean", 256), "description_lang": S.detect_lang(F.col("__raw")), "is_placeholder": S.is_placeholder(F.col("description_clean")),
        "method": F.col("__m.method"), "method_source": F.col("__m.method_source"), "method_name": F.coalesce(F.try_element_at(_map(V.METHOD_NAMES), F.col("__m.method")), F.lit("")), "market_approach": norm_approach(F.col("market_approach")), "status": norm_status(F.col("status_raw")),
        "estimated_amount": F.coalesce(given, said), "amount_source": F.when(given.isNotNull(), "plan").when(said.isNotNull(), "description").otherwise(""), "planned_date": F.coalesce(F.nullif(text("planned_date"), F.lit("")), F.nullif(S.date_in(F.col("__raw")), F.lit(""))),
    }).drop("__raw", "__m", "components")


def clean_records(rows: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Notices or awards (borrower_ref, description, category_raw, method_raw) cleaned as packages are, without components: the reference out of its chain first."""
    own = chain_ref(F.col("borrower_ref"))
    df = rows.withColumns({"borrower_ref": own, "description": S.collapse(F.coalesce("description", F.lit("")))})
    df = X.clean_descriptions(df, vocabulary).drop("cells")
    category = norm_category(F.col("category_raw"))
    return df.withColumns({"borrower_ref_norm": S.norm_ref(F.col("borrower_ref")), "description_match": S.match_key(F.col("description_clean")), "description_lang": S.detect_lang(F.col("description")), "is_placeholder": S.is_placeholder(F.col("description_clean")), "category": category, "method": norm_method(F.col("method_raw"), category)})


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def procurement_checks() -> tuple[tuple[str, str, tuple[str, ...], Column], ...]:
    """Audit checks over cleaned rows: name, severity, the columns they need, whether a row is hit. Names and patterns."""
    last = F.regexp_extract(F.regexp_replace(_text("description_clean"), r"[ .()]+$", ""), "([A-Za-z]+)[^A-Za-z]*$", 1)
    return (
        ("description carries a second borrower reference", "defect", ("description_clean",), _text("description_clean").rlike(X.SECOND_REFERENCE)),
        ("table header text leaked into a description", "defect", ("description_clean",), _text("description_clean").rlike(r"Activity Reference No\.|Description\s+Component|Project Implementation agency|Loan / Credit No")),
        ("whitespace not collapsed", "defect", ("description",), _text("description") != F.trim(F.regexp_replace(_text("description"), r"(?U)\s+", " "))),
        ("description ends mid-word", "defect", ("description_clean",), (F.length(last) > 3) & (last != F.upper(last)) & ~last.rlike("[aeiouAEIOU]")),
        ("borrower reference absent", "defect", ("borrower_ref",), F.trim(_text("borrower_ref")) == ""),
        ("borrower reference not normalised", "defect", ("borrower_ref", "borrower_ref_norm"), (_text("borrower_ref") != "") & (S.norm_ref(F.col("borrower_ref")) != _text("borrower_ref_norm"))),
        ("placeholder description", "soft", ("is_placeholder",), F.coalesce(F.col("is_placeholder").cast("boolean"), F.lit(False))),
        ("category unmapped", "defect", ("category",), F.col("category").eqNullSafe(F.lit(UNKNOWN))),
        ("method unmapped", "soft", ("method",), F.col("method").eqNullSafe(F.lit(UNKNOWN))),
        ("status unmapped", "soft", ("status",), F.col("status").eqNullSafe(F.lit(UNKNOWN))),
        ("status raw present but unmapped", "soft", ("status", "status_raw"), (F.trim(_text("status_raw")) != "") & F.col("status").eqNullSafe(F.lit(UNKNOWN))),
        ("description too short to match on", "soft", ("description",), F.regexp_count(_text("description"), F.lit("[A-Za-zÀ-ɏ]{2,}")) < 3),
        ("planned date after revised date", "source", ("planned_date", "revised_date"), _text("planned_date").rlike(r"^\d{4}-\d{2}-\d{2}$") & _text("revised_date").rlike(r"^\d{4}-\d{2}-\d{2}$") & (_text("planned_date") > _text("revised_date"))),
        ("signed package with no amount", "soft", ("status", "estimated_amount"), F.col("status").isin("Signed", "Completed") & F.trim(_text("estimated_amount")).isin("", "0.00", "0")),
        ("lot or phase marker left at the edge of the description", "defect", ("description_clean",), _text("description_clean").rlike(r"(?i)\(\s*RE-?BID\s*\)|(?:^|[-–:(]\s*)(?:LOTS?|PHASE)\s*[-#:]?\s*(?:\d+|[IVX]+)\s*\)?\s*$|^\s*(?:LOTS?|PHASE)\s*[-#:]?\s*(?:\d+|[IVX]+)\s*[-–:]")),
        ("another cell of the plan row left in the description", "defect", ("description_clean",), _text("description_clean").rlike(r"\b(?:IDA|IBRD|TF|COFN)\s*/\s*[A-Z]?\d{3,}|(?:Open|Limited|Direct)\s*-\s*(?:National|Internationa)|Single Stage\s*-\s*(?:One|Two)")),
        ("component not found", "soft", ("component_number",), _text("component_number") == ""),
        ("supplier amount exceeds the contract amount", "source", ("supplier_amount", "total_amount"), F.coalesce(F.col("supplier_amount").try_cast("double"), F.lit(0.0)) > F.coalesce(F.col("total_amount").try_cast("double"), F.lit(0.0)) + 0.01),
        ("notice with no description", "source", ("notice_id", "description"), F.trim(_text("description")) == ""),
    )


def audit_procurement(rows: DataFrame) -> DataFrame:
    """check, severity, hits, scope, percent for each check whose columns `rows` has, all in one pass."""
    own = [c for c in procurement_checks() if set(c[2]) <= set(rows.columns)]
    row = rows.agg(F.count("*").alias("scope"), *[F.count_if(c).alias(f"c{i}") for i, (*_, c) in enumerate(own)])
    each = [F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(f"c{i}").alias("hits")) for i, (n, s, *_) in enumerate(own)]
    return row.select("scope", F.explode(F.array(*each)).alias("r")).select("r.check", "r.severity", "r.hits", "scope", F.round(F.try_divide(F.lit(100.0) * F.col("r.hits"), "scope"), 2).alias("percent"))
