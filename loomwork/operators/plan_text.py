"""The tables of a procurement plan's text: where they are, which columns they print, and the rows of those whose columns were lost.

A rendition either keeps the columns apart by runs of spaces or is collapsed, one cell a line; then cells are told
apart by what they hold. Everything runs over one plan at a time, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import vocabulary as V
from .extraction import LOAN

#: Fixed patterns: a section's name alone on a line, the heading of the first column, and a borrower reference.
SECTION = re.compile(r"\s*(" + "|".join(n.replace(" ", "[- ]") for n in V.SECTIONS) + r")\s*", re.I)
ANCHOR = "Activity Reference No"
_JOINT = r"\s?[-–—]{1,2}\s?"
REFERENCE = rf"[A-Z][A-Z0-9]+(?:{_JOINT}(?:[A-Z0-9]+ [A-Z0-9]+(?={_JOINT})|[A-Z0-9]+(?:\.[0-9]+)*|\([0-9.]+\)?)){{1,7}}"
ROW_START = re.compile(rf"\s*({REFERENCE})\s*(/|$)")
#: Fixed patterns: amounts and dates, a loan cell, the first cell after a description, and lines of a heading printed again.
FIGURE = re.compile(r"(?P<amount>[0-9,]+\.[0-9]{2})|(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2})")
LOAN_CELL = re.compile(r"\s*(?:IDA|IBRD|TF|GRANT|CREDIT|DON|PRET|COFN)\s*/\s*\S", re.I)
CELL_OPENS = re.compile(
    r"(?:Post|Prior|A posteriori|A priori)(?:$|\s+(?=Request|Direct|Quality|Consultant|Least|Individual|S[eé]lection|Demande|Appel|Entente|Passation|Individuel|Open|Limited))"
    r"|Request for (?:Bids|Quota|Propos)|Direct Selection|Quality And Cost|Quality Based|Consultant Qualification|Least Cost Selection|Individual Consult|Single Source Selection|Framework Agreement"
    r"|S[eé]lection fond|S[eé]lection au moindre|Demande de prix|Appel d'offres|Entente directe|Passation de march|Consultant individuel|Individuel$|(?:Open|Limited|Direct)\s*[-/]\s*(?:National|Internationa)|Single Stage",
    re.I,
)
HEADING_AGAIN = re.compile(
    r"\s*(?:Activity Reference No|Loan / Credit|Component\s*$|Review Type|Method\s*$|Market Approac|Procurement Pro|Procureme\b|Prequalification|High SEA/SH|Estimated Am|Actual Am|Process St|Draft Pre-qualification|Draft Bidding"
    r"|Specific Procurement|Bidding Documents|Proposal Submission|Bid Evaluation|Signed Contract\s*$|Contract Complet|Terms of Reference\s*$|Expression of Interest|Short List|Invitation to Identifie|Draft Negotiated"
    r"|(?:Planned|Actual)(?:\s+(?:Planned|Actual))*\s*$|Page [0-9]+\s*$|nt Docume|ount \(US\$|atus\s*$|cess\s*$|\(Y/N\)\s*$|isk\s*$|ation R)",
    re.I,
)
#: Lines of a heading at most, how soon its first column must follow, gaps that show columns, letters that tell a label, and the share of rows with a figure from which a collapsed table is trusted.
HEADING_LINES, ANCHOR_LINES, WIDE_GAPS, LABEL_LETTERS, ALIGNED = 22, 3, 3, 5, 0.8


@dataclass
class Table:
    """One section's table: its name, its first line in the plan, its heading and what follows."""

    section: str
    start: int
    heading: list[str]
    body: list[str] = field(default_factory=list)

    @property
    def end(self) -> int:
        return self.start + len(self.heading) + len(self.body)


def find_tables(lines: Sequence[str]) -> list[Table]:
    """The tables in order: a section's name with the first column's heading soon after; its heading runs to the first row."""
    tables: list[Table] = []
    for i, line in enumerate(lines):
        name = SECTION.fullmatch(line)
        if name and any(ANCHOR in x for x in lines[i + 1 : i + 1 + ANCHOR_LINES]):
            tables.append(Table(" ".join(name.group(1).upper().replace("-", " ").split()), i, [line]))
        elif tables:
            t = tables[-1]
            in_heading = not t.body and len(t.heading) < HEADING_LINES and not ROW_START.match(line)
            (t.heading if in_heading else t.body).append(line)
    return tables


def is_collapsed(table: Table) -> bool:
    """Whether no line of the heading still shows columns."""
    return not any(len(re.findall(r"\S {2,}\S", line)) >= WIDE_GAPS for line in table.heading)


def catalogue(section: str) -> tuple[tuple[str, str], ...]:
    """The columns and first milestones that a section may print, in print order."""
    special = V.CONSULTING_COLUMNS if section in ("CONSULTING FIRMS", "INDIVIDUAL CONSULTANTS") else V.GOODS_COLUMNS + V.CONSULTING_COLUMNS
    return V.COLUMNS + special + V.MONEY_COLUMNS + tuple((f"_milestone_{i}", m) for i, m in enumerate(V.MILESTONES.get(section, ())))


def label_places(heading: Sequence[str], label: str) -> tuple[tuple[int, int], ...]:
    """Where as much of a label as is printed anywhere begins in the heading's lines, and how many letters that is; LABEL_LETTERS at least."""
    for n in range(len(label), LABEL_LETTERS - 1, -1):
        if places := {x for line in heading for x in _places(line, label[:n])}:
            return tuple((x, n) for x in sorted(places))
    return ()


def _places(line: str, part: str) -> Iterator[int]:
    at = line.find(part)
    while at >= 0:
        yield at
        at = line.find(part, at + 1)


def solve_columns(heading: Sequence[str], section: str) -> list[tuple[str, int]]:
    """The columns that a heading prints and where, from left to right: as many as can stand in print order, of such choices the one with the most letters found."""
    columns = catalogue(section)
    places = [label_places(heading, label) for _, label in columns]

    @lru_cache(maxsize=None)
    def best(k: int, after: int) -> tuple[int, int, tuple[tuple[str, int], ...]]:
        if k == len(columns):
            return 0, 0, ()
        top = best(k + 1, after)
        for x, n in places[k]:
            if x > after:
                count, letters, rest = best(k + 1, x)
                if (count + 1, letters + n) > top[:2]:
                    top = (count + 1, letters + n, ((columns[k][0], x), *rest))
        return top

    return list(best(0, -1)[2])


def present_columns(table: Table) -> list[str]:
    """The columns (not milestones) that a table prints. Without columns to go by, the labels' presence decides."""
    return list(_present(tuple(table.heading), table.section, is_collapsed(table)))


@lru_cache(maxsize=10_000)
def _present(heading: tuple[str, ...], section: str, collapsed: bool) -> tuple[str, ...]:
    """present_columns of a heading; plans print the same ones again and again."""
    whole = ["\n".join(heading)]
    found = [name for name, label in catalogue(section) if label_places(whole, label)] if collapsed else [name for name, _ in solve_columns(heading, section)]
    return tuple(x for x in found if not x.startswith("_"))


def _tokens(lines: Sequence[str]) -> Iterator[tuple[str, str]]:
    """(kind, text) of the amounts, dates and words of a record, in print order."""
    for line in lines:
        at = 0
        for m in FIGURE.finditer(line):
            if words := line[at : m.start()].strip():
                yield "text", words
            yield m.lastgroup, m.group()
            at = m.end()
        if words := line[at:].strip():
            yield "text", words


def _description(words: Sequence[str]) -> tuple[str, str]:
    """The words before the first figure as description and other cells: a loan's number ends the description unless the next word goes on in lower case; a method or the like ends it too."""
    own: list[str] = []
    cells: list[str] = []
    now = own
    for text in words:
        at = 0
        for m in [*LOAN.finditer(text), None]:
            piece = text[at : m.start() if m else len(text)].strip()
            if piece:
                if now is own and (CELL_OPENS.match(piece) or (own and own[-1] is None and not piece[:1].islower())):
                    now = cells
                now.append(piece)
            if m:
                at = m.end()
                if now is own:
                    own.append(None)  # a loan's number stood here
    return " ".join(x for x in own if x), " ".join(cells)


def read_collapsed(table: Table) -> list[dict]:
    """The rows of a table that lost its columns. Amounts stand in the printed columns' order; the status is the text after the last amount before a date. A record that a page's heading interrupts keeps its words only."""
    estimated = bool(label_places(["\n".join(table.heading)], "Estimated Amount (US$)"))
    records: list[list[str]] = []
    for line in table.body:
        if ROW_START.match(line):
            records.append([line])
        elif records:
            records[-1].append(line)
    rows = []
    for record in records:
        lines = [x for x in record if not HEADING_AGAIN.match(x)]
        torn = len(lines) < len(record)
        tokens = list(_tokens(lines))
        amounts = [] if torn else [(i, x) for i, (kind, x) in enumerate(tokens) if kind == "amount"]
        money = [x for _, x in amounts[:2]]
        if not estimated:
            money = ["", *money[:1]]
        after = tokens[amounts[-1][0] + 1 :] if amounts else []
        status = next(iter(after), ("", ""))
        first_figure = next((i for i, (kind, _) in enumerate(tokens) if kind != "text"), len(tokens))
        words = [x for _, x in tokens[:first_figure]]
        description, cells = _description(words)
        rows.append({
            "section": table.section, "borrower_ref": ROW_START.match(record[0]).group(1), "description": description, "cells": cells, "loan": next((x for kind, x in tokens if kind == "text" and LOAN_CELL.match(x)), ""),
            "estimated_amount": money[0] if money else "", "actual_amount": money[1] if len(money) > 1 else "", "status_raw": status[1] if status[0] == "text" else "", "dates": [] if torn else [x for kind, x in tokens if kind == "date"], "interleaved": torn,
        })
    return rows


def is_aligned(rows: Sequence[dict], floor: float = ALIGNED) -> bool:
    """Whether enough rows of a collapsed table carry a figure for its columns to be trusted; no rows are."""
    return not rows or sum(bool(r["estimated_amount"] or r["actual_amount"]) for r in rows) >= floor * len(rows)


def plan_tables(plans: DataFrame) -> DataFrame:
    """plan_version, section, first_line, end_line, collapsed, aligned (of a collapsed one, whether its figures are trusted), columns for each table of each plan (plan_version, text); a null text has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for v, text in zip(pdf["plan_version"], pdf["text"], strict=True):
                for t in find_tables((text or "").split("\n")):
                    lost = is_collapsed(t)
                    rows.append((v, t.section, t.start, t.end, lost, is_aligned(read_collapsed(t)) if lost else True, present_columns(t)))
            yield pd.DataFrame(rows, columns=["plan_version", "section", "first_line", "end_line", "collapsed", "aligned", "columns"])

    return plans.select("plan_version", "text").mapInPandas(run, "plan_version string, section string, first_line int, end_line int, collapsed boolean, aligned boolean, columns array<string>")


def collapsed_packages(plans: DataFrame) -> DataFrame:
    """The packages of the collapsed tables of each plan (plan_version, text), numbered in their order; figures only of tables that are aligned."""
    names = ["section", "borrower_ref", "description", "cells", "loan", "estimated_amount", "actual_amount", "status_raw", "dates", "interleaved"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for v, text in zip(pdf["plan_version"], pdf["text"], strict=True):
                found = [r for t in find_tables((text or "").split("\n")) if is_collapsed(t) for rows in [read_collapsed(t)] for r in (rows if is_aligned(rows) else [x | {"estimated_amount": "", "actual_amount": "", "status_raw": ""} for x in rows])]
                out += [(f"{v}:{i:05d}", v, *(r[n] for n in names)) for i, r in enumerate(found)]
            yield pd.DataFrame(out, columns=["package_version_id", "plan_version", *names])

    return plans.select("plan_version", "text").mapInPandas(run, "package_version_id string, plan_version string, section string, borrower_ref string, description string, cells string, loan string, estimated_amount string, actual_amount string, status_raw string, dates array<string>, interleaved boolean")
