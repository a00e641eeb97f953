"""Licence scan by a positional index of rare tokens, in DataFrame functions alone.

The licence vocabulary is the words of the templates' phrases. One pass over the texts keeps, for each file,
the postings of these words: (position, word), in order. Document frequencies over all files give each phrase its
rarest word, and the templates an index: a rare word leads to the phrases it is the rarest of, each with its
place in the phrase and the other words by relative position. A file looks up its rare words alone; what the
index holds for one is intersected with the postings around it by relative position (all words of a phrase are
licence words, so the posting o words on is the o-th next one), and what is left are the places where a phrase
stands. A label needs its mandatory phrases. So a file costs its postings, however many templates there are, and
nothing is exploded or grouped by document: rows never meet and repeated ids do no harm.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, written

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    """A label, phrases that must all stand in a file, and phrases that strengthen it."""

    label: str
    mandatory: tuple[str, ...]
    further: tuple[str, ...] = ()


#: Key phrases of well-known licence notices.
TEMPLATES = (
    Template("gpl", ("free software foundation", "general public license"), ("redistribute it and or modify it", "without any warranty", "you should have received a copy of the gnu general public license")),
    Template("gpl-3.0", ("gnu general public license version 3",)),
    Template("gpl-3.0", ("gnu gpl version 3",)),
    Template("gpl-3.0", ("gplv3",)),
    Template("gpl-2.0", ("gnu general public license version 2",)),
    Template("gpl-2.0", ("gplv2",)),
    Template("lgpl", ("gnu lesser general public license",), ("free software foundation",)),
    Template("lgpl", ("gnu library general public license",), ("free software foundation",)),
    Template("agpl", ("gnu affero general public license",), ("free software foundation",)),
    Template("gfdl", ("gnu free documentation license",), ("with no invariant sections",)),
    Template("apache-2.0", ("apache license version 2 0",), ("you may not use this file except in compliance with the license", "without warranties or conditions of any kind")),
    Template("apache-2.0", ("www apache org licenses license 2 0",)),
    Template("mit", ("permission is hereby granted free of charge", "to deal in the software without restriction"), ("the software is provided as is without warranty of any kind",)),
    Template("mit", ("released under the mit license",)),
    Template("mit-0", ("mit no attribution",)),
    Template("bsd", ("redistribution and use in source and binary forms",), ("this software is provided by the copyright holders and contributors as is", "redistributions of source code must retain the above copyright notice")),
    Template("bsd-3-clause", ("redistribution and use in source and binary forms", "to endorse or promote products derived from this software"), ("redistributions in binary form must reproduce the above copyright notice",)),
    Template("bsd-2-clause", ("bsd 2 clause",)),
    Template("bsd-3-clause", ("bsd 3 clause",)),
    Template("mpl-2.0", ("mozilla public license",), ("this source code form is subject to the terms",)),
    Template("mpl-1.1", ("mozilla public license version 1 1",)),
    Template("epl", ("eclipse public license",), ("accompanying program is provided under the terms",)),
    Template("cddl", ("common development and distribution license",)),
    Template("cpl", ("common public license version 1 0",)),
    Template("eupl", ("european union public licence",)),
    Template("osl", ("open software license",)),
    Template("afl", ("academic free license",)),
    Template("artistic", ("artistic license",), ("standard version",)),
    Template("zlib", ("this software is provided as is without any express or implied warranty", "altered source versions must be plainly marked as such")),
    Template("bsl-1.0", ("boost software license",)),
    Template("isc", ("permission to use copy modify and or distribute this software for any purpose",), ("with or without fee is hereby granted",)),
    Template("isc", ("isc license",)),
    Template("unlicense", ("free and unencumbered software released into the public domain",), ("for more information please refer to http unlicense org",)),
    Template("wtfpl", ("do what the fuck you want to public license",)),
    Template("postgresql", ("postgresql license",)),
    Template("python", ("python software foundation license",)),
    Template("openssl", ("openssl license",)),
    Template("ofl-1.1", ("sil open font license",)),
    Template("ms-pl", ("microsoft public license",)),
    Template("odbl", ("open database license",)),
    Template("odc-by", ("open data commons attribution license",)),
    Template("cc-by-sa", ("cc by sa",)),
    Template("cc-by-sa", ("creative commons attribution sharealike",)),
    Template("cc-by-sa", ("creative commons attribution share alike",)),
    Template("cc-by-nc", ("cc by nc",)),
    Template("cc-by-nc", ("creative commons attribution noncommercial",)),
    Template("cc-by-nd", ("cc by nd",)),
    Template("cc-by-nd", ("creative commons attribution noderivatives",)),
    Template("cc-by", ("creative commons attribution",)),
    Template("cc0", ("cc0 1 0",)),
    Template("cc0", ("creative commons zero",)),
    Template("public-domain", ("dedicated to the public domain",)),
    Template("all-rights-reserved", ("all rights reserved",), ("no part of this",)),
)


def _phrases(templates: tuple[Template, ...]) -> list[str]:
    return list(dict.fromkeys([p for p, _ in BASE] + [p for t in templates for p in (*t.mandatory, *t.further)]))


def _index(phrases: list[str], idf: dict[str, float]) -> dict[str, list[dict]]:
    """For each word that is the rarest of a phrase: the phrases (p), its place in them (k), the other words (w) by their distance (o)."""
    out: dict[str, list[dict]] = {}
    for p, phrase in enumerate(phrases):
        words = phrase.split()
        k = max(range(len(words)), key=lambda i: (idf[words[i]], -i))
        out.setdefault(words[k], []).append({"p": p, "k": k, "rest": [{"o": i - k, "w": w} for i, w in enumerate(words) if i != k]})
    return out


def _constant(value: object, kind: str) -> Column:
    """A constant of a nested type; Catalyst works it out once. Its size is that of the templates."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _places(hits: Column, phrases: list[str], idf: dict[str, float]) -> Column:
    """(p, s) for each phrase and each start of it, by the file's rare words, each looked up in the index."""
    index = _index(phrases, idf)
    held = _constant(index, "map<string, array<struct<p: int, k: int, rest: array<struct<o: int, w: string>>>>>")
    rare = F.array_compact(F.transform(hits, lambda h, n: F.when(h["w"].isin(*index), F.struct(h["i"].alias("i"), h["w"].alias("w"), n.alias("n")))))

    def stands(x: Column, e: Column) -> Column:
        def next_to(r: Column) -> Column:
            other = F.get(hits, x["n"] + r["o"])
            return F.coalesce((other["i"] == x["i"] + r["o"]) & (other["w"] == r["w"]), F.lit(False))

        return F.forall(e["rest"], next_to) & (x["n"] >= e["k"])

    return F.flatten(F.transform(rare, lambda x: F.transform(F.filter(held[x["w"]], lambda e: stands(x, e)), lambda e: F.struct(e["p"].alias("p"), (x["i"] - e["k"]).alias("s")))))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row.

    Words are counted from 0 over the whole text, lower-cased in A-Z; a null or empty text has none: counts 0,
    no places, empty labels, score 0. score: the largest share, by inverse document frequency, of a labelled
    template's phrases that stand in the file; 1 for a base phrase. Rows that repeat are treated alike; an
    empty table gives an empty result.
    """
    phrases = _phrases(templates)
    vocabulary = sorted({w for p in phrases for w in p.split()})
    plain = F.translate(F.coalesce(col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = F.split(plain, SEPARATOR)
    own = docs.select(col(id_col).alias("doc_id"), split.alias("words"))
    lead = (F.element_at("words", 1) == "").cast("int")  # a text that begins with a separator
    found = F.transform("words", lambda w, i: F.when(w.isin(*vocabulary), F.struct(i.alias("i"), w.alias("w"))))
    hits = F.array_compact(found)
    empties = lead + F.when((F.size("words") > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)
    index = written(
        own.select("doc_id", (F.size("words") - empties).cast("bigint").alias("n_words"), lead.alias("lead"), hits.alias("hits")).select("doc_id", "n_words", F.transform("hits", lambda h: F.struct((h["i"] - F.col("lead")).alias("i"), h["w"].alias("w"))).alias("hits")),
        "licences",
    )
    seen = index.where(F.size("hits") > 0).select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()  # a row for each word of the vocabulary
    df = {r["w"]: r["n"] for r in seen}
    idf = {w: 1.0 / (1 + df.get(w, 0)) for w in vocabulary}
    n = index.count()
    weight = {p: sum(math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in p.split()) for p in phrases}
    number = {p: k for k, p in enumerate(phrases)}
    some = index.select("doc_id", "n_words", F.when(F.size("hits") > 0, _places(F.col("hits"), phrases, idf)).alias("places"))
    some = some.select("doc_id", "n_words", F.coalesce("places", F.array().cast("array<struct<p: int, s: int>>")).alias("places"))
    some = some.withColumn("base", F.filter("places", lambda x: x["p"] < len(BASE))).withColumn("found", F.array_distinct(F.transform("places", lambda x: x["p"])))
    judged = [{"label": t.label, "must": [number[p] for p in t.mandatory], "all": [{"p": number[p], "wt": weight[p]} for p in (*t.mandatory, *t.further)], "total": sum(weight[p] for p in (*t.mandatory, *t.further))} for t in templates]
    held = _constant(judged, "array<struct<label: string, must: array<int>, all: array<struct<p: int, wt: double>>, total: double>>")
    has = lambda p: F.array_contains("found", p)
    told = F.when(F.size("found") > 0, F.transform(F.filter(held, lambda t: F.forall(t["must"], has)), lambda t: F.struct(t["label"].alias("label"), (F.aggregate(F.filter(t["all"], lambda x: has(x["p"])), F.lit(0.0), lambda s, x: s + x["wt"]) / t["total"]).alias("score"))))
    some = some.withColumn("told", F.coalesce(told, F.array().cast("array<struct<label: string, score: double>>")))
    labels = _constant([x for _, x in BASE], "array<string>")
    based = F.transform("base", lambda x: labels[x["p"]])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return some.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["s"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["s"])).cast("bigint").alias("last_word"),
        joined(based).alias("base_labels"),
        joined(F.concat(based, F.transform("told", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.round(F.least(F.coalesce(F.array_max(F.transform("told", lambda x: x["score"])), F.lit(0.0)), F.lit(1.0)), 9)).alias("score"),
    )


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """DuckDB SQL for the rows of scan_licences over `documents`: each word stands between bars of its own, so a phrase is a substring."""
    quote = lambda x: "'" + x + "'"
    needle = lambda p: quote("".join(f"|{w}|" for w in p.split()))
    phrases = _phrases(templates)
    vocabulary = sorted({w for p in phrases for w in p.split()})
    stands = lambda p: f"contains(s, {needle(p)})"
    at = lambda p: f"(length(s) - length(replace(s, {needle(p)}, ''))) // length({needle(p)})"
    bars = lambda x: f"(length({x}) - length(replace({x}, '|', ''))) // 2"
    first = lambda p: f"CASE WHEN {stands(p)} THEN {bars(f'substring(s, 1, instr(s, {needle(p)}) - 1)')} END"
    last = lambda p: f"CASE WHEN {stands(p)} THEN {bars(f'substring(s, 1, length(s) - instr(reverse(s), reverse({needle(p)})) - length({needle(p)}) + 1)')} END"
    weight = lambda p: f"(SELECT wt FROM pw WHERE p = {quote(p)})"
    labelled = [(t.label, " AND ".join(stands(p) for p in t.mandatory), (*t.mandatory, *t.further)) for t in templates]
    scores = [f"CASE WHEN {stands(p)} THEN 1.0 END" for p, _ in BASE] + [f"CASE WHEN {c} THEN ({' + '.join(f'CASE WHEN {stands(p)} THEN {weight(p)} ELSE 0.0 END' for p in ps)}) / ({' + '.join(map(weight, ps))}) END" for _, c, ps in labelled]
    joined = lambda xs: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(xs) + "], lambda x: x IS NOT NULL))), ',')"
    base = [f"CASE WHEN {stands(p)} THEN {quote(x)} END" for p, x in BASE]
    more = [f"CASE WHEN {c} THEN {quote(x)} END" for x, c, _ in labelled]
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
d AS (SELECT x, count(*) AS df FROM (SELECT unnest(list_distinct(ws)) AS x FROM w) u WHERE x IN ({", ".join(map(quote, vocabulary))}) GROUP BY x),
pw AS (SELECT p, sum(ln((1 + (SELECT count(*) FROM w)) / (1 + coalesce(df, 0))) + 1) AS wt FROM (SELECT p, unnest(string_split(p, ' ')) AS x FROM (SELECT unnest([{", ".join(map(quote, phrases))}]) AS p) q) r LEFT JOIN d USING (x) GROUP BY p),
t AS (SELECT doc_id, len(ws) AS n_words, '|' || array_to_string(ws, '||') || '|' AS s FROM w)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST({" + ".join(at(p) for p, _ in BASE)} AS BIGINT) AS n_base,
  CAST(least({", ".join(first(p) for p, _ in BASE)}) AS BIGINT) AS first_word, CAST(greatest({", ".join(last(p) for p, _ in BASE)}) AS BIGINT) AS last_word,
  {joined(base)} AS base_labels, {joined(base + more)} AS labels, round(coalesce(greatest({", ".join(scores)}), 0.0), 9) AS score FROM t
"""
