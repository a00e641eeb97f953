"""Scalar functions as Column expressions; none of them leaves the JVM.

Patterns that must treat letters, digits, spaces and case as Unicode does carry (?U) or (?iuU).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Statuses of a package that is still to come.
UPCOMING = ("Pending", "Pending Implementation", "Under Review", "Planned")
#: Characters that are folded to plain ones, and those that are spelled out.
FOLD_FROM = "\u00a0\u202f\u2009\u2007\u2018\u2019\u201a\u201b\u201c\u201d\u00ab\u00bb\u2013\u2212\u2010\u2011\u25cf\u27a2\u25aa\uf0b7\uf06c\uf0a7\uf0d8\uf076\uf05b\uf05d\uf020\uf02e"
FOLD_TO = "    ''''\"\"\"\"----" + "\u2022" * 8 + "[] ."
LIGATURES = (("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"))
#: Marker words that tell a language.
MARKERS = {
    "en": ("a", "and", "construction", "for", "installation", "of", "provision", "services", "study", "supply", "support", "the", "to", "with"),
    "fr": ("acquisition", "au", "aux", "construction", "d", "dans", "de", "des", "du", "et", "fourniture", "l", "la", "le", "les", "pour", "prestation", "recrutement", "travaux"),
    "es": ("adquisición", "con", "construcción", "consultoría", "de", "del", "el", "en", "la", "las", "los", "obras", "para", "servicios", "suministro", "y"),
    "pt": ("a", "aquisição", "as", "com", "construção", "contratação", "da", "de", "do", "e", "em", "fornecimento", "o", "obras", "os", "para", "serviços"),
}
#: Descriptions that say nothing, and categories that are none.
PLACEHOLDERS = ("-", "a definir", "aucun", "aucune", "n/a", "na", "nao", "nil", "none", "not applicable", "não", "por definir", "tba", "tbc", "tbd", "to be defined", "to be determined", "unknown", "à définir")
CATEGORIES_ALONE = ("civil works", "consultancy", "consultant services", "consulting", "furniture", "general", "goods", "non consulting services", "services", "supply", "works")
#: Fixed patterns: a borrower reference alone, and the words of a plan row's other cells.
REFERENCE_ALONE = r"^[A-Z]{2}-[A-Z0-9]{1,12}-[0-9]{2,10}-[A-Z]{2}-[A-Z0-9]{2,6}$"
CELL_WORDS = r"(?iuU)^(?:\s|post(?:erior)?|prior|open|limited|direct|national|international|individual|single|stage|one|two|envelope|internationa|[-/,.()])+$"
#: Fixed patterns: wordings of what a project does, and of what should follow.
ACTIVITY = (
    r"\b(?:will|shall|to) (?:also |further |specifically |be )?(?:be )?"
    r"(?:financ|fund|support|install|deploy|build|construct|establish|develop|procur|integrat|link|connect|upgrad|rehabilitat|conduct|carr(?:y|ied) out|undertak|prepar|"
    r"design|implement|introduc|provid|acquir|equip|strengthen(?:ed|ing)? (?:the|its)|set up|put in place|creat|adopt|requir|includ|incorporat|expand|digiti[sz]|"
    r"mainstream|assess|map|bur(?:y|ied)|elevat|reinforc|harden|relocat|backup|back up)\w*"
    r"|\b(?:is|are) (?:being |to be )?(?:financed|supported|required|included|integrated|deployed|installed|built|procured|conducted|undertaken|planned|designed)\b"
    r"|\b(?:activities|investments) (?:will )?includ\w*|\bthe following\b|\bincludes?\b|\bsupported by the (?:project|component)|\bunder (?:this |the )?(?:sub-?)?component\b"
    r"|\bthe (?:project|component|program(?:me)?) (?:will )?(?:finances?|supports?)\b|^\(?[a-z0-9ivx]{1,4}[).]\s"
)
OUTCOME = (
    r"\bwill (?:also |further |thus |therefore |thereby |in turn |greatly )?"
    r"(?:enable|allow|help|contribut|improv|enhanc|increas|reduc|mitigat|facilitat|make it|lead|result|benefit|boost|promot|foster|minimi[sz]|lower|empower)\w*"
    r"|\bby enabling\b|\b(?:is|are) expected to\b"
)
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def due_date(planned: Column, revised: Column) -> Column:
    """The revised date where there is one, else the planned."""
    return F.coalesce(revised, planned)


def is_upcoming(status: Column) -> Column:
    """Whether the plan's status says that the package is still to come; null stays null."""
    return status.isin(*UPCOMING)


def iso_country_code(code: Column) -> Column:
    """Two-letter code in capitals: null for regional codes (a digit first), CD for the old ZR."""
    return F.when(code.isNull() | code.rlike("^[0-9]"), None).when(F.upper(code) == "ZR", "CD").otherwise(F.upper(code))


def https(url: Column) -> Column:
    """The link with http:// made https://."""
    return F.regexp_replace(url, "^http://", "https://")


def same_component(a: Column, b: Column) -> Column:
    """Equal name keys, or one a prefix of the other with both of 12 characters or more; an empty or null key is like none."""
    prefix = (F.least(F.length(a), F.length(b)) >= 12) & (F.startswith(a, b) | F.startswith(b, a))
    return F.coalesce((F.coalesce(a, F.lit("")) != "") & ((a == b) | prefix), F.lit(False))


def fold_chars(text: Column) -> Column:
    """Quotes, hyphens, bullets and special spaces made plain, ligatures spelled out, format characters dropped."""
    out = F.translate(text, FOLD_FROM, FOLD_TO)
    for mark, plain in LIGATURES:
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return F.regexp_replace(out, r"\p{Cf}", "")


def collapse(text: Column) -> Column:
    """Folded, without replacement characters, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.replace(fold_chars(text), F.lit("�"), F.lit("")), r"(?U)\s+", " "))


def match_key(text: Column) -> Column:
    """What descriptions are compared by: collapsed, lower case, sharp s spelled out, no spaces."""
    return F.regexp_replace(F.replace(F.lower(collapse(text)), F.lit("ß"), F.lit("ss")), r"(?U)\s+", "")


def norm_ref(ref: Column) -> Column:
    """A borrower reference in capitals and digits, anything else one hyphen, none at the ends; null is empty."""
    return F.regexp_replace(F.regexp_replace(F.upper(collapse(F.coalesce(ref, F.lit("")))), "[^A-Z0-9]+", "-"), "^-+|-+$", "")


def unaccent(text: Column) -> Column:
    """Latin letters without their accents (the precomposed ones of Western and Central European languages)."""
    pairs = {"a": "àáâãäåāăą", "c": "çćĉċč", "d": "ďđ", "e": "èéêëēĕėęě", "g": "ĝğġģ", "i": "ìíîïĩīĭįı", "l": "ĺļľł", "n": "ñńņň", "o": "òóôõöøōŏő", "r": "ŕŗř", "s": "śŝşšș", "t": "ţťț", "u": "ùúûüũūŭůűų", "y": "ýÿ", "z": "źżž"}
    low_from, low_to = "".join(pairs.values()), "".join(k * len(v) for k, v in pairs.items())
    up = [(a.upper(), b.upper()) for a, b in zip(low_from, low_to, strict=True) if len(a.upper()) == 1 and a.upper() != a and a != "ı"]
    return F.translate(text, low_from + "".join(a for a, _ in up), low_to + "".join(b for _, b in up))


def enum_key(value: Column) -> Column:
    """A vocabulary value for comparing: collapsed, no accents, lower case, no marks at the ends."""
    return F.regexp_replace(F.lower(unaccent(collapse(value))), r"^[ .:;]+|[ .:;]+$", "")


def name_key(name: Column) -> Column:
    """A component's name for comparing: without 'Component N:', no accents, letters and digits alone."""
    bare = F.regexp_replace(name, r"(?iuU)^\s*(sub-?)?component\s*[0-9.]*\s*[:.\-–]?\s*", "")
    return F.regexp_replace(F.lower(unaccent(bare)), "[^a-z0-9]+", "")


def line_fingerprint(line: Column) -> Column:
    """A line without white space and digits, lower case: equal for page headers that differ in the page."""
    return F.lower(F.regexp_replace(line, r"(?U)[\s\d]", ""))


def token_count(text: Column) -> Column:
    """Runs of what is not white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))


def numeric_share(text: Column) -> Column:
    """The share of tokens that are figures; null without tokens."""
    figures = F.regexp_count(text, F.lit(r"(?U)(?<!\S)[($€£]*[0-9][0-9.,:/%-]*\)?(?!\S)"))
    return F.try_divide(figures, token_count(text))


def looks_tabular(text: Column) -> Column:
    """A table read as running text: of six tokens or more many are figures, or many characters digits, and few are words of four letters or more. Null is none."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)([\w'’-]+)"), 1)
    figure = lambda x: x.rlike(r"(?U)^[\d.,%()$-]+$")
    n, digits = F.size(tokens), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?U)\d"))
    figures, words = F.size(F.filter(tokens, figure)), F.size(F.filter(tokens, lambda x: (F.length(x) > 3) & ~x.rlike(r"(?U)^\d+$")))
    return (n >= 6) & ((figures / n >= 0.35) | (digits / F.greatest(F.length(text), F.lit(1)) >= 0.20)) & (words / n < 0.45)


def iso_date(value: Column, order: str = "") -> Column:
    """A date as YYYY-MM-DD from an ISO date (a time may follow), D-Mon-YYYY or figures; '' if none, ambiguous or impossible.

    Of two figures one above 12 is the day, whatever the order; where both may be the month, order ('mdy' or 'dmy')
    decides, and without it the date is ambiguous. Years of two figures are of this century.
    """
    named, plain, iso = r"^([0-9]{1,2})[- ]([A-Za-z]{3})[a-z]*[- ,]+([0-9]{4})$", r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{2,4})$", r"^([0-9]{4})-([0-9]{2})-([0-9]{2})"
    by_order = F.lit(order == "mdy") if order else F.lit(None).cast("boolean")
    day = lambda d: F.date_format(F.try_to_date(d, "yyyy-M-d"), "yyyy-MM-dd")

    def of_figures(d: Column) -> Column:
        a, b, year = d["a"], d["b"], F.lpad(F.when(d["y"] < 100, d["y"] + 2000).otherwise(d["y"]).cast("string"), 4, "0")
        month_first = F.when((a > 12) & (b <= 12), False).when((b > 12) & (a <= 12), True).otherwise(by_order)
        return _with(month_first, lambda m: F.when(m.isNotNull(), F.concat_ws("-", year, F.when(m, a).otherwise(b), F.when(m, b).otherwise(a))))

    def read(v: Column) -> Column:
        part = lambda text, pattern, i: F.regexp_extract(text, pattern, i)
        month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(part(v, named, 2)))

        def read_first(first: Column) -> Column:  # what stands before a time
            figures = F.struct(*[part(first, plain, i + 1).try_cast("int").alias(c) for i, c in enumerate("aby")])
            return F.when(first.rlike(iso), part(first, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)).when(v.rlike(named), F.concat_ws("-", part(v, named, 3), month, part(v, named, 1))).when(first.rlike(plain), _with(figures, of_figures))

        return _with(F.regexp_extract(v, r"(?U)^(\S+)", 1), read_first)

    return F.coalesce(day(_with(F.trim(F.coalesce(value, F.lit(""))), read)), F.lit(""))


def number(text: Column) -> Column:
    """A figure with thousands commas and a currency mark as a double; null if it is none."""
    return F.regexp_replace(text, r"[,\s$€£]|(?i)us\$|usd", "").try_cast("double")


def to_millions(text: Column, header: Column | None = None) -> Column:
    """A cost in millions: as printed where the header says so or the figure is small, in units from 10,000 on."""
    n = number(text)
    said = F.lit(False) if header is None else F.coalesce(header.rlike(r"(?i)million|\bmn?\b"), F.lit(False))
    return F.when(~said & (n >= 10_000), n / 1e6).otherwise(n)


#: Fixed patterns: a figure with a currency mark before or after it, and the scale that may follow; the words of each scale.
_SCALE = r"(?:millions?|mn|m|millones|milh[oõ]es|milliards?|billions?|bn|b)"
MONEY = rf"(?iu)(?:US\$|USD|\$|EUR|€|GBP|£)\s?([0-9.,]+)(?:\s?({_SCALE})\b)?|([0-9.,]+)(?:\s?({_SCALE}))?\s?(?:US\$|USD|EUR|€|GBP|£)"
MILLION = ("million", "millions", "mn", "m", "millones", "milhoes", "milhões")
BILLION = ("billion", "billions", "bn", "b", "milliard", "milliards")


def money_value(figure: Column, scale: Column) -> Column:
    """A printed figure as a number: a comma before one or two last digits is a decimal one, others part thousands; times its scale. Null if it is none."""
    raw = F.regexp_replace(F.trim(F.coalesce(figure, F.lit(""))), r"^[.,]+|[.,]+$", "")
    plain = F.when(raw.rlike(r"^[0-9]{1,3}(\.[0-9]{3})*,[0-9]{1,2}$"), F.translate(raw, ",.", ".")).otherwise(F.replace(raw, F.lit(","), F.lit("")))
    times = F.lower(F.coalesce(scale, F.lit("")))
    return plain.try_cast("double") * F.when(times.isin(*MILLION), 1e6).when(times.isin(*BILLION), 1e9).otherwise(1.0)


def money_in(text: Column) -> Column:
    """The first amount with a currency in a text, to the cent; null if there is none."""
    part = lambda i: F.regexp_extract(text, MONEY, i)
    before = part(1) != ""
    return F.round(money_value(F.when(before, part(1)).otherwise(part(3)), F.when(before, part(2)).otherwise(part(4))), 2)


#: Fixed pattern: a date amid a text.
DATE_IN_TEXT = r"\b([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4}|[0-9]{1,2}[- ][A-Za-z]{3}[- ][0-9]{4})\b"


def date_in(text: Column) -> Column:
    """The first date in a text as YYYY-MM-DD; '' if there is none that can be told."""
    return iso_date(F.regexp_extract(F.coalesce(text, F.lit("")), DATE_IN_TEXT, 1))


def detect_lang(text: Column, default: str = "en") -> Column:
    """The language with the most marker words; where two share the lead, or there are none, the default."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-záàâãéêíóôõúüçñ]+)"), 1)
    among = lambda v: lambda w: w.isin(*v)

    def leader(ws: Column) -> Column:
        counted = F.array(*[F.struct(F.size(F.filter(ws, among(v))).alias("n"), F.lit(k).alias("lang")) for k, v in MARKERS.items()])
        return _with(F.array_sort(counted), lambda c: F.when((F.element_at(c, -1)["n"] > 0) & (F.element_at(c, -1)["n"] > F.element_at(c, -2)["n"]), F.element_at(c, -1)["lang"]).otherwise(F.lit(default)))

    return _with(words, leader)


def is_placeholder(description: Column) -> Column:
    """Descriptions that say nothing: empty, a known stand-in, a category, a reference, words of other cells, or fewer than two words."""
    s = collapse(F.coalesce(description, F.lit("")))
    key = F.regexp_replace(F.lower(s), r"^[ .:;]+|[ .:;]+$", "")
    return (s == "") | key.isin(*PLACEHOLDERS, *CATEGORIES_ALONE) | F.replace(F.upper(s), F.lit(" "), F.lit("")).rlike(REFERENCE_ALONE) | s.rlike(CELL_WORDS) | (F.regexp_count(s, F.lit("[A-Za-zÀ-ÿ]{2,}")) < 2)


def firmness(text: Column) -> Column:
    """'activity' where a text says that something is done or delivered, else 'outcome' where it says what should follow, else 'none'."""
    return F.when(text.rlike("(?iuU)" + ACTIVITY), "activity").when(text.rlike("(?iuU)" + OUTCOME), "outcome").otherwise("none")


def component_mentions(text: Column) -> Column:
    """Numbers of the components a text names, each once, in numeric order."""
    one = F.regexp_extract_all(text, F.lit(r"(?iu)\b(?:sub-?)?components?\s+([0-9]+(?:\.[0-9]+)*)"), 1)
    also = F.regexp_extract_all(text, F.lit(r"(?iu)\bcomponents?\s+[0-9]+(?:\.[0-9]+)*(?:\s*,\s*[0-9]+(?:\.[0-9]+)*)*\s*(?:,|and|&)\s*([0-9]+(?:\.[0-9]+)*)"), 1)
    keyed = F.transform(F.array_distinct(F.concat(one, also)), lambda x: F.struct(F.transform(F.split(x, r"\."), lambda p: p.cast("int")).alias("k"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def clean_component_name(name: Column) -> Column:
    """A component's name without its number, a trailing cost and marks at the ends."""
    bare = F.regexp_replace(name, r"(?iu)^\s*(?:sub-?)?component\s*[0-9.]*\s*[:.\-–—]*\s*|^\s*[0-9]+(?:\.[0-9]+)*[.):\s]+", "")
    bare = F.regexp_replace(bare, r"(?iu)\s*[(\[]?\s*(?:US\$|USD|\$)\s*[0-9][0-9.,]*\s*(?:million|m)?[^)\]]*[)\]]?\s*$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+", " "), r"^[\s.:;,–—-]+|[\s.:;,–—-]+$", "")


def fiscal_year(approval: Column) -> Column:
    """The fiscal year that begins in July and is named after the year it ends in."""
    return (F.year(approval) + (F.month(approval) >= 7).cast("int")).cast("int")


def practices(info: Column, codes: bool = False) -> Column:
    """The names (or codes) in a practice string with tags, distinct, in their order."""
    tag = "<GP_PRACTICE_CODE>([^<]*)</GP_PRACTICE_CODE>" if codes else r"(?s)<GP_PRACTICE_NAME><!\[CDATA\[(.*?)\]\]"
    each = F.transform(F.regexp_extract_all(F.coalesce(info, F.lit("")), F.lit(tag), 1), lambda x: F.trim(x))
    return F.array_distinct(F.filter(each, lambda x: x != ""))


def document_kind(doc_type: Column, title: Column) -> Column:
    """The kind of a document by its type, else by its title."""
    both = F.lower(F.concat_ws(" ", doc_type, title))
    return F.when(both.contains("restructuring"), "restructuring_paper").when(both.contains("additional financing"), "additional_financing").when(both.contains("project appraisal document"), "appraisal").when(both.contains("project paper"), "project_paper").when(both.contains("program document"), "program_document").otherwise("other")


def commitment_id(project: Column, label_set: Column, asset: Column, type_: Column) -> Column:
    """md5 of the four parts, joined by bars."""
    return F.md5(F.concat_ws("|", project, label_set, asset, type_))


def permanent_uniform(seed: str, item: Column) -> Column:
    """A number in [0, 1) that an item keeps under a seed: the first 60 bits of a SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(seed + "\t"), item), 256), 1, 15), 16, 10).cast("bigint") / F.lit(float(16**15))


def cosine(a: Column, b: Column) -> Column:
    """The dot product of two unit vectors, in double; for few rows (operators/search.py has the way for many)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def wording(text: Column) -> Column:
    """Lower case with white space squeezed: what word-for-word copies share."""
    return F.regexp_replace(F.lower(text), r"\s+", " ")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _runs(words: Column, n: int, short: bool) -> Column:
    """A 64-bit hash of each run of n of an array's words, from the words' hashes; of fewer words one run (`short`) or none."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    run = lambda hs: lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(n)])
    return _with(hashed, lambda hs: F.when(F.size(hs) >= (1 if short else n), F.transform(F.sequence(F.lit(0), F.greatest(F.size(hs) - n, F.lit(0))), run(hs))).otherwise(F.array().cast("array<bigint>")))


def shingles(text: Column, n: int = 6) -> Column:
    """Distinct 64-bit hashes of runs of n words of ASCII letters and digits; a shorter text is one run."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    return F.array_distinct(_runs(words, n, short=True))


def positional_shingles(text: Column, n: int = 6) -> Column:
    """Hashes of runs of n words of two letters or more, repeats included; none for a shorter text."""
    return _runs(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\p{L}{2,})"), 1), n, short=False)


def answer_score(probabilities: Column, grades: tuple[str, ...] = ("2", "3")) -> Column:
    """The share of an answer's probability on the counted grades; a total of 0 counts as 1."""
    total = F.aggregate(F.map_values(probabilities), F.lit(0.0), lambda s, v: s + v)
    counted = F.aggregate(F.map_values(F.map_filter(probabilities, lambda k, v: k.isin(*grades))), F.lit(0.0), lambda s, v: s + v)
    return counted / F.when(total == 0, 1.0).otherwise(total)


#: The stages of procurement in a page's order, and the package statuses of each.
STAGES = {
    "Completed": ("Contract completed",),
    "Under way": ("Under implementation", "Contract signed"),
    "Coming up": ("Overdue", "Planned", "Tendered"),
    "Package dropped": ("Not in latest plan", "Cancelled"),
}
NO_STAGE = "No package linked"


def stage_of(status: Column) -> Column:
    """The stage of procurement that a package status stands for."""
    return F.coalesce(*[F.when(status.isin(*v), F.lit(k)) for k, v in STAGES.items()], F.lit(NO_STAGE))


def lenient(value: Column, kind: str) -> Column:
    """A text as integer (truncated), numeric, boolean, date, timestamp or array (by bars); null where it is none."""
    v = F.nullif(value, F.lit(""))
    if kind == "integer":
        return v.try_cast("double").try_cast("int")
    if kind == "numeric":
        return F.replace(v, F.lit(","), F.lit("")).try_cast("double")
    if kind == "boolean":
        return F.when(F.lower(v) == "true", True).when(F.lower(v) == "false", False)
    if kind == "date":
        return F.when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(v, "yyyy-MM-dd"))
    if kind == "timestamp":
        return v.try_cast("timestamp")
    if kind == "array":
        return F.filter(F.split(v, r"\|"), lambda x: x != "")
    return v


def unreadable(value: Column, kind: str) -> Column:
    """Aggregate: how many values are there but can't be read as their kind."""
    return F.count_if(value.isNotNull() & (value != "") & lenient(value, kind).isNull())
