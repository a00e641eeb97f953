"""Main text of web pages as the maximum-scoring subsequence of their words and tags.

A page is a sequence of tags and runs of words. Words score positive, less where they stand in elements that
labelled pages show to hold other things; tags outside an article score negative, the more the more often they
stand outside main text. One linear scan finds the contiguous region with the highest sum; of its words those
whose own score is negative (an advert or a form amid the article) are left out. Names that labelled pages show on
both (a section 'legal' may be a footer or a chapter) don't decide: there the element's own text does, prose
against short or linked words. The weights are log odds counted on labelled pages: `labelled_pages` writes them
from templates with known main text (fixed seed), and more can be given.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, slices, texts_of

#: Fixed values of HTML: elements without content, elements whose content is no text of the page, elements within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml".split())
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An open paragraph ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_PART = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")
#: An unclosed element without text of the page ends where one of these begins.
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(ENDS_P))}|body|html|head)\b", re.I)

#: An element whose name doesn't decide holds main text if it has so many words outside links, and of its words at most this share within.
PROSE_WORDS, PROSE_LINKS = 25, 0.3

#: The most that one stretch of unwanted words costs.
BRIDGE = -4.0

#: A token: "tag" and its name or "text" and the decoded text, and the names of the elements it stands in; class and id names have the element's number.
Token = tuple[str, str, tuple[str, ...]]


def tokens(page: str) -> Iterator[Token]:
    """Tags and text runs of a page; unclosed elements end with their parents, unknown closing tags are ignored."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    keys: tuple[str, ...] = ()  # each name once, so that deep nesting costs no more than wide
    open_: Counter[str] = Counter()
    at = number = 0

    def close(name: str) -> None:
        nonlocal keys
        while open_[name]:
            last, _ = stack.pop()
            open_[last] -= 1
            if last == name:
                break
        else:
            return
        keys = stack[-1][1] if stack else ()

    n = len(page)
    unclosed: set[str] = set()
    last_end = page.rfind(">") + 1  # no tag ends after it; a comment may still begin
    while at < n:
        m = _TOKEN.search(page, at, last_end) if at < last_end else None
        comment = page.find("<!--", at) if not m else -1
        end = m.start() if m else comment if comment >= 0 else n
        if end > at:
            run = page[at:end]
            yield "text", " " if run.isspace() else html.unescape(run), keys
        if not m or (m.group().startswith("<!--") and not m.group().endswith("-->")):
            return
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        if m.group(1) or m.group(4):
            yield "tag", name, keys
            close(name)
            continue
        attributes = m.group(3) or m.group(6) or ""
        if name in RAW and not attributes.rstrip().endswith("/"):
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at) if name not in unclosed else None
            if stop:
                at = stop.end()
            else:  # nowhere from here on
                unclosed.add(name)
                block = _BLOCK.search(page, at)
                at = block.start() if block else n
            yield "tag", name, keys
            continue
        if name in ENDS_P and open_["select"]:
            close("select")
        if name in ENDS_P and open_["p"]:
            close("p")
        elif name == "li" and any(x[0] == "li" for x in stack[-4:]) and not any(x[0] in ("ul", "ol") for x in stack[-1:]):
            close("li")
        if name in VOID or attributes.rstrip().endswith("/"):
            yield "tag", name, keys
            continue
        own = ["@link"] if name == "a" else [] if name in INLINE else [name]
        if attributes:
            for a, *v in _ATTRIBUTE.findall(attributes):
                a, v = a.lower(), "".join(v)
                if a in ("class", "id", "role") and name not in ("html", "body"):  # there they tell of the page, not of its words
                    own += ["." + w.lower() for w in _PART.findall(v)]
                elif (a == "hidden" and v.strip().lower() != "until-found") or (a == "style" and _NO_DISPLAY.search(v)) or (a == "aria-hidden" and v.strip().lower() == "true"):
                    own.append("@hidden")
        inner = keys[max((keys.index(x) for x in ("article", "main") if x in keys), default=0) :]  # names above an article count anew in it
        known = {k.partition("#")[0] for k in inner}
        if new := [k for k in dict.fromkeys(own) if k not in known]:
            number += 1
            keys = (*keys, *(f"{k}#{number}" if k[0] == "." else k for k in new))
        stack.append((name, keys))
        open_[name] += 1
        yield "tag", name, keys


@dataclass(frozen=True)
class Weights:
    """Score of a word by the element it stands in, and of a tag by its name."""

    element: dict[str, float]
    tag: dict[str, float]

    def word(self, keys: tuple[str, ...], whole: bool, prose: Mapping[str, bool]) -> float:
        """1 unless some element around speaks against it; `whole`: the page has an article, and this is not in it; `prose`: of numbered elements, whether they hold prose."""
        worst = 1.0
        for k in keys:
            w = self.element.get(k.partition("#")[0], 1.0)
            worst = min(worst, w if w else 1.0 if prose.get(k) else -1.0)
        return max(-1.0, min(worst, self.element.get("@outside", -1.0) if whole else 1.0))


def _prose(seen: list[Token]) -> dict[str, bool]:
    """Whether each numbered element holds prose."""
    plain, linked = Counter(), Counter()
    for kind, value, keys in seen:
        if kind == "text" and (n := len(value.split())):
            (linked if "@link" in keys else plain).update(dict.fromkeys((k for k in keys if "#" in k), n))
    return {k: n >= PROSE_WORDS and linked[k] <= PROSE_LINKS * (n + linked[k]) for k, n in plain.items()}


def learn(pages: Iterable[tuple[str, set[str]]]) -> Weights:
    """Weights from (page, words of its main text); a word of both main text and the rest should be rare among them."""
    inside, outside, tag_in, tag_all = Counter(), Counter(), Counter(), Counter()
    for page, main in pages:
        seen = list(tokens(page))
        has = _scope(seen)
        near = False
        for kind, value, keys in seen:
            if kind == "tag":
                tag_all[value] += 1
                tag_in[value] += near
                continue
            words = value.split()
            if not words:
                continue
            good = sum(w in main for w in words)
            near = good * 2 > len(words)
            for k in {*(k.partition("#")[0] for k in keys if k != "@link"), *(["@outside"] if has and has not in keys else [])}:
                inside[k] += good
                outside[k] += len(words) - good
    # An element that holds no main text at all counts against its words even where it is rare.
    element = {k: math.log((inside[k] + 0.5) / (outside[k] + 0.5)) for k in {*inside, *outside}}
    element = {k: -1.0 if inside[k] * 20 < outside[k] else 0.0 if k[0] == "." and outside[k] * 20 > inside[k] else max(w, 0.25) for k, w in element.items()}  # 0: can't tell
    tag = {k: -0.05 - 0.6 * (1 - tag_in[k] / n) for k, n in tag_all.items()}
    return Weights(element, tag)


def _scope(seen: list[Token]) -> str:
    """`article` or `main` if the page has text in one, else nothing."""
    for name in ("article", "main"):
        if any(kind == "text" and name in keys and not value.isspace() for kind, value, keys in seen):
            return name
    return ""


def _holders(seen: list[Token], scope: str) -> set[str]:
    """Names of elements around the article that hold most of its words: they are around the page's main part, whatever they are called. Hidden stays hidden."""
    total, held = 0, Counter()
    for kind, value, keys in seen:
        if scope and kind == "text" and scope in keys:
            n = len(value.split())
            total += n
            held.update(dict.fromkeys(keys[: keys.index(scope)], n))
    return {k for k, n in held.items() if n * 2 > total and k != "@hidden"}


def region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the highest positive sum, the first and shortest such; (0, 0) if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best + 1e-9:
            best, at = total, (start, i + 1)
    return at


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the main text, joined by one space; empty if there is none."""
    seen = list(tokens(page))
    scope = _scope(seen)
    holders, prose = _holders(seen, scope), _prose(seen)
    scores = []
    good, price = [], 0.0
    for kind, value, keys in seen:
        inside = bool(scope) and scope in keys
        if holders and inside:
            at = keys.index(scope)
            keys = (*(k for k in keys[:at] if k not in holders), *keys[at:])
        w = weights.word(keys, bool(scope) and not inside, prose)
        good.append(w > 0)
        if w > 0:
            price = 0.0
            scores.append(len(value.split()) * w if kind == "text" else 0.0 if inside or value in RAW else weights.tag.get(value, -0.3))
        else:  # what is left out anyway may stand amid main text: within an article it costs nothing, elsewhere as a whole BRIDGE at most
            cost = 0.0 if inside else max(BRIDGE - price, (len(value.split()) if kind == "text" else 1) * w)
            price += cost
            scores.append(cost)
    a, b = region(scores)
    blocks, now = [], []
    for i, (kind, value, _) in enumerate(seen):
        if kind == "text":
            if a <= i < b and good[i]:
                now.append(value)
        elif value not in INLINE:
            if now:
                blocks.append("".join(now))
            now = []
    if now:
        blocks.append("".join(now))
    return " ".join(x for x in (_SPACE.sub(" ", x).strip() for x in blocks) if x)


_PLACES = (
    ("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("button", ""), ("div", "nav"), ("div", "navbar"), ("div", "menu"), ("div", "header"), ("div", "footer"), ("div", "sidebar"), ("div", "ad"), ("div", "ads"), ("div", "advert"),
    ("div", "advertisement"), ("div", "banner"), ("div", "sponsored"), ("div", "sponsor"), ("div", "promo"), ("div", "promotion"), ("div", "cookie"), ("div", "cookies"), ("div", "consent"), ("div", "notice"), ("div", "alert"), ("div", "popup"), ("div", "modal"), ("div", "overlay"), ("div", "newsletter"), ("div", "subscribe"),
    ("div", "signup"), ("div", "login"), ("div", "share"), ("div", "social"), ("div", "related"), ("div", "recommended"), ("div", "breadcrumb"), ("div", "breadcrumbs"), ("div", "pagination"), ("section", "comments"), ("div", "comment"), ("div", "disqus"), ("div", "respond"), ("div", "reply"), ("ol", "commentlist"), ("div", "widget"),
    ("div", "toolbar"), ("div", "copyright"), ("div", "legal"), ("div", "disclaimer"), ("div", "gdpr"), ("div", "@hidden"), ("p", "skip"), ("div", "toc"), ("div", "search"), ("dialog", ""), ("select", ""),
)
#: Names from above that sections of an article bear too.
_ALSO = ("legal", "search", "notice", "alert", "disclaimer", "copyright", "header", "footer", "banner", "widget", "toolbar", "overlay", "login", "signup", "respond", "reply")


def labelled_pages(number: int = 400, seed: int = 3) -> Iterator[tuple[str, set[str]]]:
    """Pages from templates, with the words of their main text: an article with paragraphs, headings, lists, quotes and tables, and around and sometimes in it what is not main text."""
    r = random.Random(seed)
    word = lambda x: x + "".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(3, 8)))
    some = lambda x, a, b: " ".join(word(x) for _ in range(r.randint(a, b)))

    def other(t: str, c: str) -> str:
        attribute = " hidden" if c == "@hidden" else f' class="{c}"' if c and r.random() < 0.8 else f' id="{c}"' if c else ""
        inner = r.choice((lambda: some("q", 2, 14), lambda: "<ul>" + "".join(f"<li><a href='#'>{some('q', 1, 2)}</a></li>" for _ in range(r.randint(2, 7))) + "</ul>", lambda: f"<p>{some('q', 4, 30)}</p>"))()
        return f"<{t}{attribute}>{inner}</{t}>"

    for i in range(number):
        main = []
        for _ in range(r.randint(2, 9)):
            kind = r.choice(("p", "p", "p", "p", "h2", "h3", "ul", "ol", "figcaption", "blockquote", "pre", "table", "section", "div", "figure"))
            text = some("w", 5, 60)
            block = f"<{kind}><li>{text}</li><li>{some('w', 3, 9)} <a href='x'>{word('w')}</a></li></{kind}>" if kind in ("ul", "ol") else f"<table><tr><td>{text}</td><th>{word('w')}</th></tr></table>" if kind == "table" else f"<{kind}><p>{text} <em>{word('w')}</em> <b>{word('w')}</b><br>{some('w', 2, 9)}</p></{kind}>" if kind in ("blockquote", "section", "div") else f"<{kind}>{text} <span>{word('w')}</span></{kind}>"
            if r.random() < 0.2:
                block = f"<{r.choice(('section', 'div'))} {r.choice(('class', 'id'))}='{r.choice(_ALSO)}'>{block}<p>{some('w', 25, 60)}</p>"
                block += "</section>" if block.startswith("<section") else "</div>"
            main.append(block)
            if r.random() < 0.15:
                main.append(other(*r.choice(_PLACES)))
        wrap = r.choice(("article", "main", "div class='content'", "div id='post'", "section", "article"))
        head = f"<h1>{some('w', 2, 9)}</h1>"
        around = [other(*_PLACES[(i * 5 + k) % len(_PLACES)]) for k in range(6)]
        page = f"<html><head><title>{some('q', 2, 5)}</title><script>var a='</p>';</script></head><body>{''.join(around[:3])}<{wrap}>{head}{''.join(main)}</{wrap.split()[0]}>{''.join(around[3:])}</body></html>"
        yield page, {w for t in tokens(page) if t[0] == "text" for w in t[1].split() if w.startswith("w")}


def extract_main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) for each row of `pages` (page_id, url, html).

    A null or empty page, and one without main text, gives an empty text. Rows that repeat are treated alike;
    an empty table gives an empty result. Whole pages of any length are read.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(weights or learn(labelled_pages()))  # a few hundred names
    own = pages.select(col("page_id").alias("page_id"), col("url").alias("url"), col("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [main_text(x, shared.value) for x in texts_of(b, "html")]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return own.mapInArrow(run, f"page_id {own.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")
