"""Component lists of documents: tables of restructuring papers, headings, clean names, numbers given by name; and project rows."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import relational as R
from .extraction import walk_groups

#: The words for a component, numbers in words, what happens to a component, and rows that end a list.
WORD = r"(?:Component|Composante|Componente|Komponen)"
SUB_WORD = r"(?:Sub-?component|Sous-composante|Subcomponente)"
IN_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
_NUMBER = rf"(?:[0-9]{{1,2}}|{'|'.join(IN_WORDS)})"
ACTION = re.compile(r"revised|new|no change|marked for deletion|dropped|cancelled|unchanged", re.I)
END_ROW = re.compile(r"implementing agency|organizations|project financing|total|borrower|financing|summary|front.end fee|(?:ida|ibrd)\s*$", re.I)
#: Fixed patterns: headings of components and their parts, a cost in a heading, an indicator's name.
HEADING = re.compile(rf"\s*{WORD}\s*([0-9]{{1,2}})(?:\s*[:.\-–)]\s*|\s+(?=(?-i:[A-Z(])))(.+?)\s*$", re.I)
SUB_HEADING = re.compile(rf"\s*{SUB_WORD}\s*([0-9]{{1,2}})\.([0-9]{{1,2}})\s*[:.\-–)]?\s*(.+?)\s*$", re.I)
NUMBER_HEADING = re.compile(rf"\s*(?:{SUB_WORD})?\s*([0-9]{{1,2}})\.([0-9]{{1,2}})\.?\s*[:.\-–)]?\s*([A-ZÀ-Þ].+?)\s*$", re.I)
COST = re.compile(r"\(\s*(?:US\$|USD|\$|EUR|€|SDR)\s*([0-9.,]+)\s*(million|m|billion)?", re.I)
INDICATOR = re.compile(r"(?:Number|Percentage|Share|Proportion)\s+of\b|.*=", re.I)


def figure(text: str) -> float | None:
    """A cell that holds one figure (which may have wrapped), else None."""
    if not re.fullmatch(r"[0-9,.\s$]+", text or ""):
        return None
    plain = re.sub(r"(?<=[0-9,.])\s+(?=[0-9])", "", text).strip(" $").replace(",", "")
    return float(plain) if re.fullmatch(r"[0-9]+(?:\.[0-9]+)?", plain) else None


def in_millions(value: float | None) -> str:
    """A cost in millions to two places: what is 10,000 or more was printed in full."""
    return "" if value is None else f"{value / 1e6 if value >= 10_000 else value:.2f}"


def split_number(name: str, position: int) -> tuple[str, str, bool]:
    """A component's number (its position where none is printed), its name up to the next component's, and whether the number is printed."""
    m = re.match(rf"\s*(?:{WORD}\s*)?({_NUMBER})\s*[.:)\-–]?\s+(.+)$", name, re.I | re.S)
    number, rest = (m.group(1).lower(), m.group(2)) if m else (str(position), name)
    rest = re.split(rf"\s{WORD}\s*{_NUMBER}\b", rest, maxsplit=1, flags=re.I)[0]
    return str(IN_WORDS.index(number) + 1) if number in IN_WORDS else number, rest.strip(" -–:"), m is not None


def unpack_rows(grid: Sequence[Sequence[str | None]]) -> list[list[str]]:
    """Rows that pack several components into one, as one row each: the cell whose lines name two or more is cut at each; figures and other lines are dealt out where there is one for each."""
    out = []
    opens = re.compile(rf"\s*{WORD}\s*{_NUMBER}\b", re.I)
    for row in grid:
        lines = [[x for x in (c or "").split("\n") if x.strip()] for c in row]
        named = [sum(bool(opens.match(x)) for x in cell) for cell in lines]
        k = max(named, default=0)
        if k < 2:
            out.append([" ".join(cell) for cell in lines])
            continue
        main = named.index(k)
        starts = sorted({0, *(i for i, x in enumerate(lines[main]) if opens.match(x))})
        names = [" ".join(lines[main][a:b]) for a, b in zip(starts, [*starts[1:], None], strict=True)]
        for i, name in enumerate(names):
            new = []
            for j, cell in enumerate(lines):
                figures = [x for x in cell if figure(x) is not None]
                each = figures if len(figures) == len(names) else cell if not figures and len(cell) == len(names) else []
                new.append(name if j == main else each[i] if each else "" if i else " ".join(cell))
            out.append(new)
    return out


def read_restructuring(grid: Sequence[Sequence[str | None]]) -> list[dict]:
    """Components of a table 'current component | cost | action | proposed component | cost'. What is proposed stands; the current name and cost where nothing is. Figures and names belong to the side of the action column they stand on; a row without a cost goes on with the name above."""
    rows = [[" ".join(c.split()) for c in r] for r in unpack_rows(grid)]
    at = next((i for i, r in enumerate(rows) if "current component" in " ".join(r).lower()), None)
    if at is None:
        return []
    middle = next((j for j, c in enumerate(rows[at]) if "action" in c.lower()), len(rows[at]) // 2)
    out: list[dict] = []
    for r in rows[at + 1 :]:
        costs = {side: [v for j, c in enumerate(r) if side(j) and (v := figure(c)) is not None] for side in (lambda j: j < middle, lambda j: j > middle)}
        before, after = costs.values()
        names = [" ".join(c for j, c in enumerate(r) if c and side(j) and figure(c) is None and not ACTION.fullmatch(c)) for side in (lambda j: j < middle, lambda j: j > middle)]
        if re.fullmatch(r"(?:component\s*)?name|cost", names[0] or names[1], re.I) or not any(r):
            continue
        if not before and not after:
            if out and names[out[-1]["side"]]:
                out[-1]["name"] = f"{out[-1]['name']} {names[out[-1]['side']]}"
            continue
        side = int(len(re.sub(rf"^{WORD}\s*\S+\s*[-–:.]?", "", names[1], flags=re.I).strip()) > 3)
        if not names[side]:
            continue
        if END_ROW.match(names[side]):
            break
        number, name, printed = split_number(names[side], len(out) + 1)
        out.append({"number": number, "name": name, "number_printed": printed, "cost_usd_m": in_millions((after or before)[-1]), "cost_before_usd_m": in_millions(before[-1]) if before and after else "", "action": next((c for c in r if ACTION.fullmatch(c)), ""), "side": side})
    return [{k: v for k, v in c.items() if k != "side"} for c in out]


def read_headings(units: Sequence[Mapping]) -> list[dict]:
    """Components and their parts from a document's headings in order (block, text), each number once. A bare 'N.M title' is a part only of a component that came before; indicators and rates are none."""
    out: dict[tuple[str, str], dict] = {}
    for u in units:
        text = u["text"] or ""
        if u["block"] != "heading":
            first = text.split("\n", 1)[0]
            if u["block"] not in ("narrative", "annex") or first == text or len(first.split()) > 30:
                continue
            text = first
        sub = SUB_HEADING.match(text)
        if m := HEADING.match(text):
            key, name = ("component", m.group(1)), m.group(2)
        elif m := sub or NUMBER_HEADING.match(text):
            key, name = ("subcomponent", f"{m.group(1)}.{m.group(2)}"), m.group(3)
            if not sub and ("component", m.group(1)) not in out:
                continue
        else:
            continue
        if key in out or INDICATOR.match(name):
            continue
        cost = COST.search(name)
        value = float(cost.group(1).replace(",", "").rstrip(".")) * (1000 if (cost.group(2) or "").lower() == "billion" else 1) if cost else None
        out[key] = {"level": key[0], "number": key[1], "name": name[: cost.start() if cost else None].strip(" :-–("), "cost_usd_m": "" if value is None else f"{value:.2f}"}
    return list(out.values())


def clean_name(name: str) -> str:
    """A component's name without its number, a cost in brackets or at the end, a sentence that follows, figures of other cells, and a tail read twice; '' if no name is left (it begins in lower case)."""
    n = re.sub(r"^(?:Component|Sub-?component)\s*[0-9]+(?:\.[0-9]+)?\s*[.:\-–]?\s*", "", name or "", flags=re.I)
    n = re.split(r"\s*\((?=[^)]*(?:US\$|U\$|US%|IDA|IBRD|SDR|Estimated|[Uu]p to|million|xxx|GoM|PCM))", n, maxsplit=1)[0].split("**")[0]
    n = re.split(r"\.\s+(?=(?:This|The|It|These|Under|Proposed)\b)", n, maxsplit=1)[0]
    for tail in (r"\s*[-–]?\s*(?:US)?\$\s*[0-9.,]+\s*(?:m|million)?\)?\s*$", r"(?:\s+(?:[0-9.,]+|N/A))+$", r"\s+The World Bank$"):
        n = re.sub(tail, "", n)
    words = n.strip(" :-–(.;,").split()
    twice = next((k for k in range(len(words) // 2, 0, -1) if words[-k:] == words[-2 * k : -k]), 0)
    n = " ".join(words[: len(words) - twice])
    return "" if n[:1].islower() else n


def document_headings(units: DataFrame) -> DataFrame:
    """The components by heading of each document; units: document_id, ordinal, block, text. A document's headings are walked in order; only headings and first lines of titled lists leave the scan."""

    def walk(rows: list[dict]) -> list[tuple]:
        found = [(rows[0]["document_id"], c["level"], c["number"], clean_name(c["name"]), c["cost_usd_m"]) for c in read_headings(rows)]
        return [r for r in found if r[3]]

    some = units.where((F.col("block") == "heading") | (F.col("block").isin("narrative", "annex") & F.contains("text", F.lit("\n"))))
    line = F.when(F.col("block") == "heading", F.col("text")).otherwise(F.concat(F.substring_index("text", "\n", 1), F.lit("\n.")))
    return walk_groups(some.where("document_id is not null").select("document_id", "ordinal", "block", line.alias("text")), ["document_id"], ["ordinal"], walk, "document_id string, level string, number string, name string, cost_usd_m string")


def restructuring_tables(tables: DataFrame) -> DataFrame:
    """The components of each restructuring table (document_id, grid: array of arrays of cells)."""
    names = ["number", "name", "number_printed", "cost_usd_m", "cost_before_usd_m", "action"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, *(c[n] for n in names)) for d, g in zip(pdf["document_id"], pdf["grid"], strict=True) if g is not None for c in read_restructuring([list(r) for r in g])]
            yield pd.DataFrame(rows, columns=["document_id", *names])

    return tables.select("document_id", "grid").mapInPandas(run, "document_id string, number string, name string, number_printed boolean, cost_usd_m string, cost_before_usd_m string, action string")


def number_by_name(components: DataFrame) -> DataFrame:
    """Components with the numbers that their tables did not print: the number that headings and numbered tables of the project give the same name, those of the own document first; else the position, or the least free number.

    components: document_id, project_id, source, level, number, name_key, number_printed. Numbers known by name are
    joined by project; within a document, which lists a few dozen, they are dealt out in order.
    """
    c = components.withColumn("__row", F.monotonically_increasing_id())
    table = F.col("source").isin("datasheet", "restructuring") & (F.coalesce("level", F.lit("component")) == "component") & (F.coalesce("number", F.lit("")) != "") & F.col("number_printed").eqNullSafe(F.lit(False))
    known = components.where((F.coalesce("level", F.lit("component")) == "component") & (F.coalesce("number", F.lit("")) != "") & ((F.col("source") == "heading") | F.coalesce("number_printed", F.lit(False)))).select("project_id", F.col("document_id").alias("k_document"), F.col("name_key").alias("k_key"), F.col("number").alias("k_number"))
    open_ = c.where(table)
    met = open_.join(known, "project_id").where(S.same_component(F.col("name_key"), F.col("k_key")))
    best = met.groupBy("__row").agg(F.min(F.struct((F.col("k_document") != F.col("document_id")).cast("int").alias("far"), F.col("k_key").alias("key"), F.col("k_number").alias("number"))).alias("b")).select("__row", F.col("b.number").alias("hit"))

    def deal(rows: list[dict]) -> list[tuple]:
        taken: set[str] = set()
        numbers: dict[int, str] = {}
        for r in rows:
            if isinstance(r["hit"], str) and r["hit"] not in taken:
                numbers[r["__row"]] = r["hit"]
                taken.add(r["hit"])
        for r in rows:
            if r["__row"] not in numbers:
                numbers[r["__row"]] = r["number"] if r["number"] not in taken else next(str(i) for i in range(1, len(rows) + len(taken) + 2) if str(i) not in taken)
                taken.add(numbers[r["__row"]])
        return list(numbers.items())

    dealt = walk_groups(open_.join(best, "__row", "left").select("document_id", "project_id", "__row", "number", "hit"), ["document_id", "project_id"], ["__row"], deal, "__row bigint, __number string")
    return c.join(dealt, "__row", "left").withColumn("number", F.coalesce("__number", "number")).drop("__row", "__number")


def component_keys(components: DataFrame) -> DataFrame:
    """document_id, number, name_key: each component's key in each document, the data sheet's before a heading's."""
    first = R.first_per_key(components.where("coalesce(name_key, '') <> ''"), ["document_id", "number"], [(F.col("source") == "heading").asc(), F.col("name_key").asc()])
    return first.select("document_id", "number", "name_key")


# Projects


def sectors(record: Sequence[tuple[Column, Column]]) -> Column:
    """Sector names with their percentages ('Water (60%); Energy (40%)'), those without a name left out."""
    each = [F.when(F.coalesce(name, F.lit("")) != "", F.concat(name, F.lit(" ("), F.coalesce(share.cast("string"), F.lit("")), F.lit("%)"))) for name, share in record]
    return F.concat_ws("; ", *each)


def unit_codes(owner: Column) -> Column:
    """The unit codes that an owner's name holds, by bars: of each part (by semicolons) those in brackets, else one that it begins with; each once."""
    part = lambda p: F.transform(F.array(F.trim(p)), lambda x: F.coalesce(F.nullif(F.regexp_extract_all(x, F.lit(r"\(([A-Z][A-Z0-9]{3,5})\)"), 1), F.array().cast("array<string>")), F.regexp_extract_all(x, F.lit(r"^([A-Z][A-Z0-9]{3,5})\b"), 1)))[0]
    return F.array_join(F.array_distinct(F.flatten(F.transform(F.split(F.coalesce(owner, F.lit("")), ";"), part))), "|")


def managing_units(documents: DataFrame) -> DataFrame:
    """project_id, managing_unit, unit_document_id, unit_as_of: the owner of each project's newest document that names one. documents: project_id, document_id, owner_unit, disclosure_date."""
    owner = F.trim(F.coalesce("owner_unit", F.lit("")))
    newest = documents.where(~owner.isin("", "N/A", "NA")).groupBy("project_id").agg(F.max(F.struct("disclosure_date", "document_id", owner.alias("owner"))).alias("d"))
    return newest.select("project_id", F.col("d.owner").alias("managing_unit"), F.col("d.document_id").alias("unit_document_id"), F.col("d.disclosure_date").alias("unit_as_of"))


def project_rows(cohort: DataFrame, records: DataFrame, documents: DataFrame) -> DataFrame:
    """One row for each project of the cohort (project_id, cohort_set) from its fetched record, if any, and the owner of its newest document.

    records: project_id, project_name, status, boardapprovaldate, closingdate, approvalfy, regionname, countryshortname,
    owner practice info (project_gp_info), fetched. has_record is null for a project that was not fetched.
    """
    r = records.select(
        "project_id", F.lit(True).alias("__fetched"), S.collapse(F.coalesce("project_name", F.lit(""))).alias("project_name"), F.coalesce("status", F.lit("")).alias("status"), S.iso_date(F.col("boardapprovaldate"), "mdy").alias("approval_date"), S.iso_date(F.col("closingdate"), "mdy").alias("closing_date"), F.coalesce("regionname", F.lit("")).alias("region"), F.coalesce("countryshortname", F.lit("")).alias("country_name"),
        F.nullif(F.coalesce(F.col("approvalfy").cast("string"), F.lit("")), F.lit("")).alias("__fy"), F.array_join(S.practices(F.col("project_gp_info")), "|").alias("practice"), F.greatest(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c in ("project_name", "status", "boardapprovaldate", "regionname")]).alias("__any"),
    )
    out = cohort.join(r, "project_id", "left").join(managing_units(documents), "project_id", "left")
    year = S.fiscal_year(F.try_to_date("approval_date", "yyyy-MM-dd")).cast("string")
    blanks = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("project_name", "status", "approval_date", "closing_date", "region", "country_name", "practice", "managing_unit", "unit_document_id", "unit_as_of")}
    return out.withColumns({"has_record": F.when(F.col("__fetched"), F.col("__any") == 1), "approval_fy": F.coalesce("__fy", year, F.lit("")), "unit_code": unit_codes(F.col("managing_unit")), **blanks}).drop("__fetched", "__fy", "__any")

