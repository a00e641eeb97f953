"""Operators over units of text: copies, templates, lead-ins, furniture, short units, vocabularies, audit checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import working
from . import extraction as X
from . import relational as R


def copies(units: DataFrame) -> DataFrame:
    """unit_id, copy_of for each unit: the first unit (by document, then unit) with the same words, null for that one itself.

    A minimum by the wording's digest (128 bits stand for it), joined back: a wording that very many units share is
    a hot key of a join, which is split, not of a window.
    """
    w = units.select("unit_id", "document_id", F.md5(S.wording(F.col("text"))).alias("w"))
    first = w.groupBy("w").agg(F.min(F.struct("document_id", "unit_id")).alias("first"))
    return w.join(first, "w").select("unit_id", F.when(F.col("first.unit_id") != F.col("unit_id"), F.col("first.unit_id")).alias("copy_of"))


def copy_lists(units: DataFrame) -> DataFrame:
    """unit_id, copies: the other units of each original's wording, in order."""
    return copies(units).where("copy_of is not null").groupBy(F.col("copy_of").alias("unit_id")).agg(F.array_sort(F.collect_set("unit_id")).alias("copies"))


def template_scores(units: DataFrame, n: int = 6, least: int = 2) -> DataFrame:
    """For each unit (with its project): template_projects, other projects with the very words, and template_share, the share of its runs of n words that at least `least` other projects have, to two places.

    Runs are counted with their repeats in the unit, as distinct ones in the corpus; hashes of 64 bits stand for them.
    The digests and hashes of a text are worked out once and written.
    """
    u = working.written(units.select("unit_id", "project_id", F.md5(S.wording(F.col("text"))).alias("w"), S.positional_shingles(F.col("text"), n).alias("hs")), "templates")
    exact = u.select("w", "project_id").distinct().groupBy("w").agg((F.count("*") - 1).alias("template_projects"))
    flat = u.select("unit_id", "project_id", F.explode(F.array_distinct("hs")).alias("h"))
    known = flat.select("h", "project_id").distinct().groupBy("h").agg(F.count("*").alias("projects")).where(F.col("projects") > least)
    hit = flat.join(known, "h", "left_semi").groupBy("unit_id").agg(F.count("*").alias("hit"))
    out = u.join(exact, "w").join(hit, "unit_id", "left")
    share = F.when(F.size("hs") > 0, F.round(F.coalesce("hit", F.lit(0)) / F.size("hs"), 2)).otherwise(F.lit(0.0))
    return out.select("unit_id", "project_id", "template_projects", share.alias("template_share"))


def lead_ins(sentences: DataFrame) -> DataFrame:
    """Sentences with lead_in: for a list item, the last sentence before it in the paragraph that is none."""
    w = Window.partitionBy("paragraph_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return sentences.withColumn("lead_in", F.when(F.col("list_item"), F.last(F.when(~F.col("list_item"), F.col("sentence_id")), ignorenulls=True).over(w)))


def repeated_lines(lines: DataFrame, share: float = 0.3, least: int = 3) -> DataFrame:
    """Lines without those whose fingerprint recurs in a band of the page on a share of a document's pages (at least `least`). lines: document_id, page, band, text."""
    f = lines.withColumn("fp", S.line_fingerprint(F.col("text")))
    pages = lines.groupBy("document_id").agg(F.countDistinct("page").alias("pages"))
    seen = f.groupBy("document_id", "band", "fp").agg(F.countDistinct("page").alias("n")).join(pages, "document_id")
    often = seen.where(F.col("n") >= F.greatest(F.lit(least), F.ceil(F.col("pages") * share))).select("document_id", "band", "fp")
    return f.join(often, ["document_id", "band", "fp"], "left_anti").select(*lines.columns)


#: Fixed patterns: what tells a citation and its source, verbs, what a commitment says, and a title's number; words that a title leaves small.
CITATION = r"(?iU)\b(?:19|20)\d\d[a-z]?\b|\[link\]|\bhttps?:|www\."
SOURCE = r"\b(?:Report|Paper|Profile|Database|Portal|Note|Study|Brief|Review|Survey|Outlook|Index|Series|Washington|Retrieved|Available|accessed|et al|Journal|Working|ITU|GSMA|OECD|Bank)\b"
VERB = r"(?i)\b(?:will|shall|would|should|must|is|are|was|were|be|been|being|has|have|had|can|could|may|might|do|does|did)\b"
FIRM = r"(?i)\b(?:will|shall)\b"
NUMBERED = r"^(?:\d+(?:\.\d+)*\.?|\(?[ivxlc]+\)|\(?[a-z]\)|[A-Z]\.)\s"
MINOR = ("and", "or", "of", "the", "for", "to", "in", "on", "a", "an", "with", "by", "at", "from")
ROW_VERB = r"(?i)\b(?:will|shall|would|should|must|is|are|was|were|be|been|has|have|include[sd]?|support[sd]?|finance[sd]?|provide[sd]?|ensure[sd]?)\b"
BOILERPLATE_SECTION = r"(?i)grievance"
RESULTS_SECTION = r"(?i)results? (?:framework|matrix|indicators?)\b|\bindicators?\b|monitoring (?:and|&) evaluation"
_WORDS = r"(?U)([^\W\d_]{2,})"


def left_out(text: Column, kind: Column, has_lead_in: Column) -> Column:
    """Why a unit is not searched: 'reference' (a note that cites), 'fragment' (a scrap or a title), else ''. What says will or shall is searched, and so is a list item with a lead-in."""
    words = F.regexp_extract_all(text, F.lit(_WORDS), 1)
    n = F.size(words)
    cites = ((n < 12) & ~text.rlike(VERB)) | ((n < 40) & text.rlike(CITATION) & text.rlike(SOURCE))
    note = F.when(n < 4, "reference").when(text.rlike(FIRM), "").when(cites, "reference").otherwise("")
    content = F.filter(words, lambda w: ~F.lower(w).isin(*MINOR))
    capitals = F.size(F.filter(content, lambda w: w.rlike(r"^\p{Lu}")))
    bare = F.trim(text)
    title = (n <= 10) & (F.size(content) > 0) & (bare.rlike(NUMBERED) | ~bare.rlike(r"[.;:]$")) & (capitals >= 0.8 * F.size(content))
    return F.when(kind == "footnote", note).when(has_lead_in | text.rlike(FIRM), "").when((n < 4) | title, "fragment").otherwise("")


def prose_row(text: Column) -> Column:
    """Whether a table row (caption — cells) reads as prose: fifteen words, a verb, and fewer than a fifth of the tokens figures."""
    cells = F.regexp_replace(text, "^(?s).*? — ", "")
    tokens = F.split(F.trim(F.regexp_replace(cells, r"(?U)\s+", " ")), " ")
    figures = F.size(F.filter(tokens, lambda x: x.rlike(r"^[\d.,%$()\-–]+$")))
    return (F.regexp_count(cells, F.lit(_WORDS)) >= 15) & cells.rlike(ROW_VERB) & (figures < 0.2 * F.size(tokens))


def search_units(paragraphs: DataFrame, sentences: DataFrame, component_keys: DataFrame) -> DataFrame:
    """Every unit that may be searched, with its place, lead-in, why it is left out, and the earlier unit that it copies.

    paragraphs: paragraph_id, document_id, block, section_title, for_model, component_number, component_name, text;
    sentences (of extraction.sentences): sentence_id, paragraph_id, ordinal, char_start, char_end, text, list_item;
    component_keys: document_id, number, name_key. Sentences of the paragraphs that go to the model, its footnotes
    whole, and rows of tables that read as prose (outside standard sections), long ones by sentence.
    """
    own = paragraphs.join(component_keys.select("document_id", F.col("number").alias("component_number"), F.col("name_key").alias("__key")), ["document_id", "component_number"], "left")
    key = F.when(F.coalesce("component_number", F.lit("")) != "", F.coalesce("__key", S.name_key(F.coalesce("component_name", F.lit("")))))
    p = own.select("paragraph_id", "document_id", "block", F.coalesce("section_title", F.lit("")).alias("section_title"), "component_number", key.alias("component_key"), F.coalesce("for_model", F.lit(False)).alias("for_model"), F.col("text").alias("whole"))
    place = ["paragraph_id", "document_id", "block", "component_number", "component_key"]
    led = lead_ins(sentences).join(p.where("for_model").select("whole", *place), "paragraph_id")
    lead = sentences.select(F.col("sentence_id").alias("lead_in"), F.col("text").alias("lead_text"))
    s = led.join(lead, "lead_in", "left").select(F.col("sentence_id").alias("unit_id"), F.lit("sentence").alias("kind"), *place, F.col("char_start").cast("int").alias("char_start"), F.col("char_end").cast("int").alias("char_end"), "text", "lead_text", F.lit(False).alias("target"))
    n = p.where("for_model and block = 'footnote'").select(F.col("paragraph_id").alias("unit_id"), F.lit("footnote").alias("kind"), *place, F.lit(0).alias("char_start"), F.length("whole").alias("char_end"), F.col("whole").alias("text"), F.lit(None).cast("string").alias("lead_text"), F.lit(False).alias("target"))
    rows = p.where((F.col("block") == "table") & ~F.col("section_title").rlike(BOILERPLATE_SECTION) & prose_row(F.col("whole")))
    cut = X.table_units(rows.select("paragraph_id", F.col("whole").alias("text"))).join(rows.select(*place, "section_title"), "paragraph_id")
    r = cut.select("unit_id", F.lit("table").alias("kind"), *place, "char_start", "char_end", "text", "lead_text", F.col("section_title").rlike(RESULTS_SECTION).alias("target"))
    u = s.unionByName(n).unionByName(r).withColumn("left_out", F.when(F.col("target"), "indicator").otherwise(left_out(F.col("text"), F.col("kind"), F.col("lead_text").isNotNull() & (F.col("kind") != "table"))))
    words = F.array_join(F.regexp_extract_all(F.lower(F.concat_ws("\n", "lead_text", "text")), F.lit(_WORDS), 1), " ")
    keyed = u.withColumn("__w", F.when(F.col("left_out") == "", F.md5(words)))
    first = keyed.where("__w is not null").groupBy("__w").agg(F.min(F.struct("document_id", "unit_id")).alias("__first"))
    return keyed.join(first, "__w", "left").withColumn("copy_of", F.when(F.col("__first.unit_id") != F.col("unit_id"), F.col("__first.unit_id"))).drop("__w", "__first", "target")


def short_title(text: Column) -> Column:
    """Whether a text of few words is the title of a section in Roman figures ('IV. COSTS') or of an annex ('Annex 2: Costs'), by case: no word of such letters alone ('Ci.'), no reference to an annex ('Annex 1). The ...')."""
    roman = text.rlike(r"(?Ud)^\s*[IVX]+\.\s+[A-Z][^a-z]*(?:[A-Z].*)?\s*$")
    annex = r"(?Ud)^\s*(?:ANNEX|Annex|APPENDIX|Appendix)\s+(?:[0-9]{1,2}|[IVX]{1,4})\s*(?:[:.\-\x{2013}]\s*)?(.*)$"
    rest = F.regexp_extract(text, annex, 1)
    line = F.length(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")) <= 110
    return roman | (text.rlike(annex) & line & ~rest.startswith(")") & ~rest.rlike(r"(?U)[.!?]\s+[A-Z]|\.\s*$"))


def split_short(units: DataFrame, least: int = 5, tokens: Column | None = None, title: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Units of enough tokens, headings and titles, and the rejected ones with the reason.

    `tokens` (a number) and `title` (a boolean) tell both in another way than token_count and short_title.
    """
    n = S.token_count(F.col("text")) if tokens is None else tokens
    kept = (n >= least) | (F.col("block") == "heading") | (short_title(F.col("text")) if title is None else title)
    return units.where(kept), units.where(~F.coalesce(kept, F.lit(False))).select("unit_id", "document_id", F.lit("short").alias("reason"), F.length("text").alias("n_chars"))


def vocabulary(texts: DataFrame, key: str = "text") -> DataFrame:
    """word, n: lower-cased words of each distinct text, counted."""
    return texts.select(key).distinct().select(F.explode(F.regexp_extract_all(F.lower(key), F.lit(r"(?U)(\p{L}+)"), 1)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def corpus_vocabulary(descriptions: DataFrame, prose: DataFrame) -> DataFrame:
    """word, n, prose, names: how often each word stands in the distinct descriptions and in the prose, in the prose alone, and there as a name with capitals inside. Both: text. The prose is counted whole, a description once however often it is printed."""
    pattern = r"(?U)([^\W\d_]+)"
    words = lambda df: df.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("w"))
    d = words(descriptions.select("text").distinct()).select("w", F.lit(0).alias("p"))
    both = d.unionByName(words(prose).select("w", F.lit(1).alias("p")))
    named = F.col("w").rlike(r"\p{Ll}\p{Lu}") & (F.col("p") == 1)
    return both.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"), F.sum("p").alias("prose"), F.count_if(named).alias("names"))


def row_text(cells: Column, header: Column, caption: Column) -> Column:
    """A table row as text: 'caption — header: value · header: value', or its cells by bars where the header does not fit; empty cells are left out, an empty row is empty."""
    filled = lambda x: F.coalesce(x, F.lit("")) != ""
    named = F.filter(F.zip_with(header, cells, lambda h, v: F.when(filled(v), F.when(filled(h), F.concat(h, F.lit(": "), v)).otherwise(v))), lambda x: x.isNotNull())
    body = F.when(F.size(header) == F.size(cells), F.array_join(named, " · ")).otherwise(F.array_join(F.filter(cells, filled), " | "))
    return F.when(filled(caption) & (body != ""), F.concat(caption, F.lit(" — "), body)).otherwise(body)


#: Audit checks over a text: name, severity, predicate. The patterns.
CHECKS: tuple[tuple[str, str, str], ...] = (
    ("unicode replacement character", "defect", "\\x{FFFD}"),
    ("control or format character", "defect", "[\\p{Cc}\\p{Cf}&&[^\\n\\t]]"),
    ("private use area character", "defect", "\\p{Co}"),
    ("footnote marker glued to a word", "defect", "\\b[a-z]{3,}(\\d{1,3})\\b"),
    ("paragraph opens as a footnote body", "defect", "^\\s*(\\d{1,3})[A-Z][a-z]"),
    ("page number left inline", "defect", "\\bPage \\d{1,4}\\b"),
    ("whitespace run of 3-5 spaces", "defect", "\\S {3,5}\\S"),
    ("whitespace run of 6+ spaces", "defect", "\\S {6,}\\S"),
    ("smart quote, ligature or hyphen left unfolded", "defect", "[‘’“”‐‑–—ﬁﬂ]"),
    ("starts mid-sentence", "soft", "^\\p{Ll}(?![.)])"),
    ("no sentence-ending punctuation", "soft", "[^.!?:;\"')\\]\\s]\\s*$"),
)


def audit(units: DataFrame, checks: tuple[tuple[str, str, str], ...] = CHECKS) -> DataFrame:
    """check, severity, hits, scope, percent: all checks in one pass over the texts."""
    t = F.col("text")
    row = units.agg(F.count("*").alias("scope"), F.count_if(S.looks_tabular(t)).alias("tab"), *[F.count_if(t.rlike(p)).alias(f"c{i}") for i, (_, _, p) in enumerate(checks)])
    each = [F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(f"c{i}").alias("hits")) for i, (n, s, _) in enumerate(checks)]
    each.append(F.struct(F.lit("tabular: numeric tokens over a third").alias("check"), F.lit("defect").alias("severity"), F.col("tab").alias("hits")))
    return row.select("scope", F.explode(F.array(*each)).alias("r")).select("r.check", "r.severity", "r.hits", "scope", F.round(F.try_divide(F.lit(100.0) * F.col("r.hits"), "scope"), 2).alias("percent"))


def clean_share(units: DataFrame, checks: tuple[tuple[str, str, str], ...] = CHECKS) -> DataFrame:
    """block, units, words, characters, clean: how many units of a block no defect check hits."""
    t = F.col("text")
    hit = F.lit(False)
    for _, severity, pattern in checks:
        if severity == "defect":
            hit = hit | t.rlike(pattern)
    return units.groupBy("block").agg(F.count("*").alias("units"), F.sum(S.token_count(t)).alias("words"), F.sum(F.length(t)).alias("characters"), F.count_if(~hit).alias("clean"))


def despacing_collisions(texts: DataFrame, key: str = "text") -> DataFrame:
    """Match keys that more than one text has."""
    return texts.groupBy(S.match_key(F.col(key)).alias("match_key")).agg(F.countDistinct(key).alias("n")).where("n > 1")


def value_profile(df: DataFrame, fields: list[str], top: int = 20) -> DataFrame:
    """field, value, n, rank, distinct: the most frequent values of each field. A report: the cut is its point."""
    flat = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("x.*")
    n = flat.groupBy("field", "value").agg(F.count("*").alias("n"))
    distinct = n.groupBy("field").agg(F.count("value").alias("distinct"))
    return R.top_per_key(n, ["field"], [F.col("n").desc(), F.col("value").asc_nulls_last()], top).join(distinct, "field")


def uncovered(types: DataFrame, queries: DataFrame, keys: list[str]) -> DataFrame:
    """Types that no search phrase is tagged with."""
    return types.join(queries.select(*keys).distinct(), keys, "left_anti")


def changed_text(old: DataFrame, new: DataFrame) -> DataFrame:
    """Units whose text hash changed under the same parser: a re-parse that is not stable."""
    o = old.select("unit_id", F.col("parser").alias("o_parser"), F.col("text_sha256").alias("o_sha"))
    return new.join(o, "unit_id").where("parser = o_parser and text_sha256 <> o_sha").select("unit_id", "parser", "o_sha", "text_sha256")
