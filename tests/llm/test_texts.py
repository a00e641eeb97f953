"""Packing, chunk fingerprints, page text and licences against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomwork.llm import cdc, htmlmain, licences, packing

from . import cases

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check_plan(histogram):
    used, sequences = Counter(), defaultdict(list)
    for length, rank, count, each, first, offset in packing.plan(histogram):
        assert rank == used[length] and count % each == 0
        used[length] += count
        for k in range(count // each):
            sequences[first + k].append((offset, length * each))
    assert used == Counter(histogram)
    for v in sequences.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    return len(sequences), -(-sum(k * n for k, n in histogram.items()) // packing.CAPACITY)


def test_plans_are_whole_and_tight():
    r = random.Random(1)
    for histogram, slack in (({}, 0), ({1: 1}, 0), ({4096: 3, 1: 5}, 0), ({2049: 10, 2047: 10}, 0), ({1000: 100_003}, 600), (Counter(min(4096, int(r.lognormvariate(6, 1.2)) + 1) for _ in range(20_000)), 1)):
        n, least = check_plan(histogram)
        assert n <= least + slack
    check_plan(Counter(r.randint(1300, 4096) for _ in range(2000)))


def test_ids_equal_the_tokenizer():
    whole, words = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    r = random.Random(4)
    texts = ["a\x1cb  c d é <|endoftext|>x it's 'S DON'T ΣΑΣ İx", "áb", "", "ﬁ ½ 12345 …!?#", "Ǆ ß ª ² a\xadb z y ŉ Ŀ"]
    texts += ["".join(r.choice("abZ'sS tdl012!?.,;éÉßœŒ<|>́ Σ漢- ") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t, ids in zip(texts, words.batch([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_packing(spark):
    data = cases.rows()
    whole = Tokenizer.from_file(TOKENIZER)
    got = packing.pack_documents(cases.frame(spark, data), TOKENIZER).collect()
    want = Counter()
    for i, t, *_ in data:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == want
    sequences = defaultdict(list)
    for x in got:
        sequences[x.sequence_id].append((x.offset, x.length))
    for v in sequences.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(sequences) <= -(-sum(x.length for x in got) // 4096) + 1
    assert packing.pack_documents(cases.empty(spark), TOKENIZER).count() == 0


def reference_boundaries(data):
    h, out, s = 0, [], 0
    hashes = []
    for b in data:
        h = ((h << 1) + int(cdc._GEAR[b])) & 0xFFFFFFFF
        hashes.append(h)
    n = len(data)
    while n - s > cdc.MIN:
        for i in range(s + cdc.MIN - 1, min(s + cdc.MAX, n)):
            if hashes[i] & int(cdc.HARD if i < s + cdc.NORMAL else cdc.EASY) == 0:
                break
        else:
            i = min(s + cdc.MAX, n) - 1
        s = i + 1
        out.append(s)
    return out + ([n] if s < n else [])


def test_boundaries_equal_the_rolling_hash():
    r = random.Random(5)
    for n in (0, 1, 12, 13, 40, 500, 5000):
        data = bytes(r.choice(b"abcdef ghij") for _ in range(n))
        ends = cdc.boundaries(data)
        assert ends == reference_boundaries(data)
        if len(ends) > 3:
            assert cdc.boundaries(data, ends[1]) == ends[2:]


def test_chunk_fingerprints(spark):
    data = cases.rows(5, 80)  # null ids, which come first, included
    got = defaultdict(list)
    for x in cdc.fingerprint_documents(cases.frame(spark, data)).collect():
        got[x.doc_id].append(x)
    order = sorted(((i, t or "") for i, t, *_ in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert sum(map(len, got.values())) == len(data)
    by_text = {}
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        new = (t[: len(t) - n] + following[:n]).encode()
        sets = [cdc.chunk_set(d, reference_boundaries(d)) for d in (t.encode(), new, following.encode())]
        want = (len(t), __import__("hashlib").sha256(new).hexdigest(), cdc.as_text(sets[0]), cdc.as_text(sets[1]), cdc.likeness(sets[0], sets[1]), cdc.likeness(sets[0], sets[2]))
        assert want in [(x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint, x.near_edited, x.near_next) for x in got[i]]
        assert by_text.setdefault(t, want[2]) == want[2]
    assert cdc.fingerprint_documents(cases.empty(spark)).count() == 0
    (one,) = cdc.fingerprint_documents(cases.frame(spark, data[:1])).collect()
    assert one.near_next == 1.0


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), (None, ""), ("<p>hello   world&nbsp;x</p>", "hello world x"), ("plain &amp; text", "plain & text"), ("a<b", "a<b"),
    ("<div class='cookie-notice'>Accept all of our cookies now please</div><article><p>a<b>b</b> c</p><aside>side words</aside><p>d</p><form>name <input></form></article><section class=comments><p>nice post, thanks!</p></section>", "ab c d"),
    ('<a title="x>y">t</a><script>if(a<b){}</script> and more words', "t and more words"), ("<nav>only nav</nav>", ""), ("<p>unclosed <b>bold<p>next", "unclosed bold next"),
    ("<nav><ul><li><a href='/x'>home page</a></li></ul></nav><!-- ad --><div class='ad'>buy this very nice thing today</div><article><h1>Title</h1><p>First &eacute;.<br>Second.</p></article><footer>&copy; me and others</footer>", "Title First é. Second."),
])
def test_pages(spark, page, text):
    df = spark.createDataFrame([(1, None, page)], "page_id bigint, url string, html string")
    (got,) = htmlmain.extract_main_text(df, htmlmain.learn(htmlmain.labelled_pages(60))).collect()
    assert (got.text, got.n_chars, got.url) == (text, len(text), None)


def test_odd_pages_take_linear_time():
    weights = htmlmain.learn(htmlmain.labelled_pages(60))
    for page in ("<div>" * 60_000 + "word " * 10 + "</i>" * 60_000, "<p>" * 60_000 + "word " * 10):
        assert htmlmain.main_text(page, weights) == " ".join(["word"] * 10)
    assert htmlmain.main_text('<a "' * 50_000, weights)
    assert htmlmain.main_text("a <!-- never closed <b>bold</b> more", weights) == "a"
    assert htmlmain.main_text("<p>a<!-- c -->b</p>", weights) == "ab"


def test_labelled_pages_are_read_again():
    weights = htmlmain.learn(htmlmain.labelled_pages())
    right, all_ = 0, 0
    for page, main in htmlmain.labelled_pages(100, seed=99):
        found = set(htmlmain.main_text(page, weights).split())
        right += len(found & main)
        all_ += len(found | main)
    assert right / all_ > 0.97


def test_empty_pages(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert htmlmain.extract_main_text(df).count() == 0


def reference_words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_licences(spark):
    r = random.Random(6)
    bits = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "license.", "CC-BY", "CC BY-NC", "The MIT License", "GNU General Public License, version 3", "other", "émit license"]
    data = cases.rows() + [(5000 + i, " ".join(r.choice(bits) for _ in range(r.randint(1, 25))), "en", "s") for i in range(200)]
    data.append((6000, "Permission is hereby granted, free of charge, to any person ... to deal in the Software without restriction", "en", "s"))
    got = licences.scan_licences(cases.frame(spark, data)).collect()
    want = Counter()
    for i, t, *_ in data:
        w = reference_words(t)
        at = [(k, x) for p, x in licences.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want[(i, len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))] += 1
    assert Counter((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got) == want
    for x in got:
        assert set(x.base_labels.split(",")) - {""} <= set(x.labels.split(",")) and 0 <= x.score <= 1
    (mit,) = [x for x in got if x.doc_id == 6000]
    assert mit.labels == "mit" and mit.base_labels == "" and mit.score > 0
    assert licences.scan_licences(cases.empty(spark)).count() == 0


def test_html_words_are_not_lost_to_what_is_around_them():
    weights = htmlmain.learn(htmlmain.labelled_pages())
    text = "These are the words of a long enough article about rivers and the towns that stand beside them."
    article = f"<article><p>{text}</p></article>"
    for page in (
        f'<body><article style="overflow:hidden"><p>{text}</p></article></body>', f'<body><div class="overflow-hidden">{article}</div></body>', f'<body><div aria-hidden="false">{article}</div></body>',
        f'<body class="has-sidebar">{article}</body>', f'<body class="has-sidebar"><div><p>{text}</p></div></body>', f'<body><div class="layout has-sidebar">{article}<div class="sidebar"><p>other words</p></div></div></body>', f'<body><div data-title="hidden">{article}</div></body>',
    ):
        assert htmlmain.main_text(page, weights) == text, page
    for hidden in ("hidden", 'style="color:red; display: none"', "aria-hidden='true'", 'HIDDEN=""'):
        assert htmlmain.main_text(f"<body><article><p>{text}</p><div {hidden}><p>left out</p></div></article></body>", weights) == text
    assert htmlmain.main_text(f'<body><div class="has-sidebar"><article><p>{text}</p><div class="sidebar"><p>left out</p></div></article></div></body>', weights) == text


def test_region_is_the_best_of_all_parts():
    r = random.Random(31)
    for _ in range(300):
        scores = [r.choice((-3.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0)) for _ in range(r.randint(0, 14))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max([0.0, *sums.values()])
        a, b = htmlmain.region(scores)
        assert sum(scores[a:b]) == pytest.approx(best)
        if best > 0:
            assert (a, b) == min(((x, y) for (x, y), v in sums.items() if v == pytest.approx(best)), key=lambda s: (s[1], -s[0]))


def test_text_of_an_article_stays_whatever_its_parts_are_called():
    weights = htmlmain.learn(htmlmain.labelled_pages())
    long = " ".join(f"word{i}" for i in range(40))
    for page, want in (
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given.</p></article>", "Let x=2 be given."),
        ("<article><p>before all</p><object data='x'><p>text of the object</p></object><p>after it</p></article>", "before all text of the object after it"),
        (f"<article><p>one two three</p><select><option>a<option>b<p>{long}</p></article>", f"one two three {long}"),
        (f"<article><h1>Title</h1><section id='legal'><p>{long}</p></section><div class='search-results-study'><p>{long}</p></div></article>", f"Title {long} {long}"),
        (f"<article><h1>Title</h1><div class='legal'><a href='/x'>Terms</a> <a href='/y'>Privacy</a></div><p>{long}</p></article>", f"Title {long}"),
        (f"<body><article><p>{long}</p><div class='ad'>{long}</div><p>end of it</p></article><div class='comments'><p>{long}</p></div></body>", f"{long} end of it"),
        (f"<div><p>{long}</p><p>{long}</p></div><div class='promo'><p>buy it now</p></div>", f"{long} {long}"),
        (f"<article><p>{long}</p><iframe><p>{long}</p></article>", f"{long} {long}"),
    ):
        assert htmlmain.main_text(page, weights) == want, page


def test_pages_that_repeat_and_clash(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("text", T.IntegerType()), T.StructField("n_chars", T.StringType())])
    rows = [(1, "u", "<article><p>a b c d</p></article>", 3, "x"), (1, "u", "<article><p>a b c d</p></article>", 4, "y"), (None, None, None, None, None), (2, "v", "", 1, "z")]
    got = htmlmain.extract_main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((x.page_id or 0, x.url or "", x.text, x.n_chars) for x in got) == [(0, "", "", 0), (1, "u", "a b c d", 7), (1, "u", "a b c d", 7), (2, "v", "", 0)]
    assert htmlmain.extract_main_text(spark.createDataFrame([], schema)).count() == 0
