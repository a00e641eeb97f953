"""Personal data: base patterns with checks, and candidates that boosted trees judge.

The base spans are those of four patterns, leftmost and without overlap, that pass their check. Beside them,
high-recall generators propose further spans, which may overlap: spelled-out e-mail addresses, IPv6 and defanged
addresses, cards and phones in other formats, and what stands where a secret (a token, a key, a password) is
given. Boosted trees over format and context judge them; each kind's threshold is
calibrated on held-out examples for a precision; of overlapping accepted ones the likeliest stays, and none
touches a base span. No table has labels for personal data, so the trees learn from generated examples of
known answer (fixed seed); tests measure them on spans planted in prose of the documents' kind.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import gbdt
from .common import col, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
#: What the method alone finds comes after the base kinds.
ALL_KINDS = (*KINDS, "secret")
PRECISION = 0.97
EXAMPLES = 8000

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match never starts within digits, so the look-behind only saves time
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base spans by kind as listed, then start; offsets in code points, end exclusive."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:  # the address around each @, the local part as far back as it goes
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_AT = re.compile(r"[\x20]?[\[({]at[\])}][\x20]?|\x20at\x20|\x20@\x20", re.I)
_NAME_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,4}", re.I)
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
_IP_DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20?\[dot\]\x20?)[0-9]{1,3}){3}(?![0-9.])")
_GIVEN = re.compile(r"(?:key|token|secret|passw(?:or)?d|pwd|credentials?|bearer)[\"']?\s{0,3}(?::=|=>|[:=]|\x20)\s{0,3}[\"']?([A-Za-z0-9_+/=.~-]{8,200})", re.I)
_LONG = re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])")
_CALL = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])(?:[0-9]{2,4}[\x20.-]){0,3}[0-9]{2,5}(?![0-9])")


def candidates(text: str) -> list[Span]:
    """What the generators propose; spans may overlap."""
    out: list[Span] = []
    for m in _AT.finditer(text):
        name, domain = _NAME_BEFORE.search(text, max(0, m.start() - 64), m.start()), _SPELLED.match(text, m.end())
        if name and domain:
            out.append(("email", name.start(), domain.end()))
    if ":" in text:
        out += [("ip", m.start(), m.end()) for m in _IP6.finditer(text)]
    if "]" in text or ")" in text:
        out += [("ip", m.start(), m.end()) for m in _IP_DEFANGED.finditer(text)]
    out += [("secret", m.start(1), m.end(1)) for m in _GIVEN.finditer(text)]
    if _DIGIT.search(text):
        out += [("card", m.start(), m.end()) for m in _LONG.finditer(text)]
        out += [("phone", m.start(), m.end()) for m in _CALL.finditer(text) if 7 <= len(_digits(m.group())) <= 15]
    return out


#: Words that speak for a kind, and words that speak against personal data.
_FOR = {
    "email": ("mail", "contact", "write", "reach", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "ping", "ipv6"),
    "card": ("card", "visa", "amex", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon", "appel", "llame", "cell"),
    "secret": ("api", "access", "auth", "token", "secret", "password", "passwd", "pwd", "bearer", "private", "credential"),
}
_AGAINST = ("order", "invoice", "isbn", "version", "sku", "ref", "date", "token", "serial", "page", "id", "total", "time", "sum", "pos")


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span."""
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - 40) : a].lower(), text[b : b + 20].lower()
    d = _digits(s)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", s) if g]
    near = re.findall(r"[a-z0-9]+", before)[-4:]
    try:
        six = float(":" in s and ipaddress.ip_address(s).version == 6)
    except ValueError:
        six = 0.0
    seps = [c for c in s if not c.isalnum()]
    seen = Counter(s)
    entropy = -sum(n / len(s) * math.log2(n / len(s)) for n in seen.values())
    turns = sum(x.isdigit() != y.isdigit() for x, y in zip(s, s[1:], strict=False)) / len(s)
    parts = [int(x) for x in re.findall(r"[0-9]+", s)] if kind == "ip" and ":" not in s else []
    return [
        *(float(kind == k) for k in ALL_KINDS), entropy, turns, sum(map(str.isupper, s)) / len(s), float(all(c in "0123456789abcdefABCDEF" for c in s)), float(len(parts) == 4 and max(parts) <= 255), float(len(s)), float(len(d)), len(d) / len(s), float(len(d) >= 12 and luhn(d)), six, float(len(groups)), float(len(groups[0])) if groups else 0.0, float(len(groups[-1])) if groups else 0.0,
        float(len(set(seps))), float("(" in s), float("." in s), float("/" in s), float("-" in s), float(" " in s), float("dot" in s.lower()), float("[" in s or "{" in s), float(len(set(d))), float(d[:2] in ("19", "20")), float(d[:1] == "0"),
        float(any(w.startswith(x) for w in near for x in _FOR[kind])), float(any(w == x for w in near for x in _AGAINST)), float(text[a - 1 : a].isalnum()) if a else 0.0, float(after[:1].isalnum()), float(before.rstrip()[-1:] in ("=", '"', "#")), float(before.rstrip()[-1:] == ":"),
        float(groups[-1].isalpha() and 2 <= len(groups[-1]) <= 6) if groups else 0.0,
    ]


def _example(r: random.Random) -> tuple[str, Span, int] | None:
    """A text with one candidate of known answer."""
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en")) for _ in range(r.randint(1, 4)))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    kind, yes = r.choice(ALL_KINDS), r.random() < 0.5
    if kind == "email":
        at, dot = r.choice(((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), (" @ ", "."), (" [at] ", ".")))
        s = f"{word()}{r.choice(('', '.', '_'))}{word()}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'fr', 'es', 'example' + dot + 'com'))}" if yes else f"{word()} at {word()}.{r.choice((word().title(), num(2), word()))}"
    elif kind == "ip":
        dotted = r.choice(("[.]", "(.)", "[dot]")).join(str(r.randint(0, 255 if yes else 999)) for _ in range(4))
        if not yes and all(int(x) <= 255 for x in re.findall("[0-9]+", dotted)):
            dotted = "999" + dotted
        s = dotted if r.random() < 0.3 else ":".join(f"{r.getrandbits(16):x}" for _ in range(8)) if yes and r.random() < 0.5 else f"2001:db8::{r.getrandbits(16):x}:{r.getrandbits(16):x}" if yes else r.choice((f"{num(2)}:{num(2)}:{num(2)}", ":".join(num(2) for _ in range(6)), f"{num(1)}:{num(3)}:{num(2)}:{num(2)}"))
    elif kind == "card":
        n = r.choice((13, 14, 15, 15, 16)) if yes else r.choice((13, 14, 15, 16, 18))
        d = num(n)
        while luhn(d) != yes:
            d = num(n)
        cut = r.choice((None, (4, 6), (4, 4, 4)))
        sep = r.choice(" -./") if n == 16 else r.choice(" -")
        s = d if not cut else sep.join(d[i:j] for i, j in zip((0, *np.cumsum(cut).tolist()), (*np.cumsum(cut).tolist(), n), strict=True) if d[i:j])
    elif kind == "secret":
        hexed = "".join(r.choice("0123456789abcdef") for _ in range(r.choice((16, 20, 24, 32, 40, 64))))
        mixed = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-") for _ in range(r.randint(12, 64)))
        s = r.choice((hexed, mixed, "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"{word()}{num(3)}{r.choice('_-+')}{word().title()}{num(4)}")) if yes else r.choice((f"{word()}{word()}{word()}{word()}", f"{word()}-{word()}-{word()}-{word()}", f"{word()}.{word()}.{word()}.{word()}", f"{num(4)}-{num(2)}-{num(2)}", f"{word()}_{word()}_{word()}_{word()}", "=" * 12, "." * 10))
        name, link, quote = r.choice(("token", "api_key", "API-key", "secret", "password", "passwd", "access_key", "client_secret", "Bearer")), r.choice((" = ", "=", ": ", " := ", " ") if yes else (": ", " ", " = ")), r.choice(('"', "'", ""))
        text = f"{' '.join(word() for _ in range(r.randint(0, 6)))} {name}{link}{quote}{s}{quote} {' '.join(word() for _ in range(r.randint(0, 4)))}"
        found = [c for c in candidates(text) if c[0] == kind]
        return (text, max(found, key=lambda c: c[2] - c[1]), int(yes)) if found else None
    else:
        sep = r.choice(" -.")
        s = r.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"00{num(2)} {num(2)} {num(3)} {num(4)}", f"0{num(3)}/{num(3)} {num(3)}")) if yes else r.choice((f"20{num(2)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.20{num(2)}", f"{num(3)}.{num(4)}", f"{num(4)}/{num(4)}", f"{num(3)} {num(3)} {num(3)}", f"{num(4)}-{num(4)}", f"{num(3)}-{num(1)}{num(2)}-{num(5)}-{num(1)}"))
    cue = r.random()
    lead = f"{r.choice(_FOR[kind])}{r.choice((': ', ' '))}" if (cue < 0.6) == yes and cue < 0.7 else f"{r.choice(_AGAINST)} " if not yes and cue > 0.5 else ""
    text = f"{' '.join(word() for _ in range(r.randint(0, 6)))} {lead}{s}{r.choice((' ', '. ', ', ', ''))}{' '.join(word() for _ in range(r.randint(0, 4)))}"
    found = [c for c in candidates(text) if c[0] == kind]
    return (text, max(found, key=lambda c: c[2] - c[1]), int(yes)) if found else None


@dataclass(frozen=True)
class Judge:
    """The trees, and for each kind the score from which a candidate is personal data."""

    forest: gbdt.Forest
    thresholds: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Accepted candidates without overlap, among themselves (the likeliest first) or with base spans."""
        held = _Held((a, b) for _, a, b in base)
        found = [c for c in candidates(text) if held.free(c[1], c[2])]
        if not found:
            return []
        scores = self.forest.score(np.array([features(text, c) for c in found]))
        taken: list[Span] = []
        for p, c in sorted(zip((-scores).tolist(), found, strict=True)):
            if -p >= self.thresholds[c[0]] and held.free(c[1], c[2]):
                held.add(c[1], c[2])
                taken.append(c)
        return taken


class _Held:
    """Stretches of a text, those that overlap as one, and whether another is free of them."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)  # those from k on begin at b or later
        return not k or self.ends[k - 1] <= a

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def train(examples: int = EXAMPLES, precision: float = PRECISION, seed: int = 11) -> Judge:
    """Trees from generated examples; thresholds from a fourth of them held out: the least score from which on each kind has the precision, 0.5 at least."""
    r = random.Random(seed)
    made = [e for e in (_example(r) for _ in range(examples)) if e]
    x, y = np.array([features(t, s) for t, s, _ in made]), np.array([e[2] for e in made], float)
    kinds = np.array([s[0] for _, s, _ in made])
    cut = len(made) * 3 // 4
    forest = gbdt.fit(x[:cut], y[:cut], trees=60)
    scores = forest.score(x[cut:])
    thresholds = {}
    for k in ALL_KINDS:
        p, t = scores[kinds[cut:] == k], y[cut:][kinds[cut:] == k]
        order = np.argsort(-p)
        right = np.cumsum(t[order]) / np.arange(1, len(p) + 1)
        good = np.flatnonzero(right >= precision)
        thresholds[k] = max(0.5, float(p[order][good[-1]])) if len(good) else 2.0
    return Judge(forest, thresholds)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (ALL_KINDS.index(s[0]), s[1], s[2])))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", judge: Judge | None = None, redacted: bool = True) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 (of the base spans), spans (all), n_added, n_spans, and with `redacted` redacted_text for each row.

    Offsets are code points of the whole text. A null text is empty: no spans. Rows that repeat are treated
    alike; an empty table gives an empty result. In redacted_text each span is replaced by its kind in angle
    brackets; where base spans of two kinds overlap, their union is replaced by the first.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(judge or train())  # of a fixed size
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans", *(["redacted_text"] if redacted else [])]
    kinds = [*(pa.int64() for _ in KINDS), pa.string(), pa.string(), pa.int64(), pa.int64(), *([pa.string()] if redacted else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows: list[list] = []
            for text in texts_of(b, "text"):
                base = base_spans(text)
                every = base + shared.value.added(text, base)
                row = [*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), len(every) - len(base), len(every)]
                rows.append([*row, redact(text, every)] if redacted else row)
            yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", *names])

    fields = ", ".join(f"{n} {'string' if k == pa.string() else 'bigint'}" for n, k in zip(names, kinds, strict=True))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, {fields}")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind."""
    if not spans:
        return text
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
