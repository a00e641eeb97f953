"""Exact and near duplicates, and the mixture, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash

from loomwork.llm import components, mixing, packing, radix, simhash

from . import cases


def test_radix_equals_brute_force(spark):
    data = cases.rows()
    got = radix.exact_duplicates(cases.frame(spark, data)).collect()
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[t or ""].append(i)
    size = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in v if i is not None), default=None), len(v)) for t, v in groups.items()}
    assert len(got) == len(data)
    assert Counter(r.text_sha256 for r in got) == Counter({h: n for h, (_, n) in size.items()})
    for r in got:
        assert (r.keep_id, r.group_size) == size[r.text_sha256]
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == set(size) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_radix_splits_long_common_beginnings(spark):
    base = "a" * 3000
    data = [(i, base + x, "en", "s") for i, x in enumerate(["", "b", "c", "b", "", "b" * 2000, "b" * 2000])]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in radix.exact_duplicates(cases.frame(spark, data)).collect()}
    assert got == {0: (4, 2), 4: (4, 2), 1: (3, 2), 3: (3, 2), 2: (2, 1), 5: (6, 2), 6: (6, 2)}


def test_dedup_keeps_all_columns(spark):
    data = cases.rows()
    df = cases.frame(spark, data)
    out = radix.drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert out.count() == len({t or "" for _, t, *_ in data})


def test_empty_tables(spark):
    e = cases.empty(spark)
    assert radix.exact_duplicates(e).count() == 0
    assert simhash.near_duplicates(e).count() == 0
    assert simhash.drop_near_duplicates(e).count() == 0
    assert mixing.mix_sources(e).count() == 0


def reference_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reference_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark):
    r = random.Random(2)
    data = cases.rows(2, 60)  # null ids, which are larger than all others, included
    for i in range(60):  # near copies: a long text with one word changed
        w = cases.prose(random.Random(5), "en", 300).split()
        w[r.randrange(len(w))] = "changed"
        data.append((1000 + i, " ".join(w), "en", "s"))
    got = simhash.near_duplicates(cases.frame(spark, data)).collect()
    prints = [reference_fingerprint(t) for _, t, *_ in data]
    root = reference_components(prints)
    least = {}
    for (i, *_), c in zip(data, root, strict=True):
        least[c] = min(i, least.get(c, i), key=lambda x: (x is None, x))
    want = Counter((i, f.to_bytes(8, "little"), least[c]) for (i, *_), f, c in zip(data, prints, root, strict=True))
    assert Counter((x.doc_id, bytes(x.fp), x.component_id) for x in got) == want
    assert Counter(x.component_id for x in got if x.first) == Counter(least.values())


def test_hot_values_are_cut_into_blocks_without_losing_links(spark):
    r = np.random.default_rng(3)
    base = int(r.integers(1 << 62))
    prints = sorted({base ^ sum(1 << int(b) for b in r.integers(0, 40, r.integers(0, 5))) for _ in range(600)} | {int(x) for x in r.integers(1 << 62, size=300)})
    df = spark.createDataFrame([(i, bytearray(p.to_bytes(8, "little"))) for i, p in enumerate(prints)], "node bigint, fp binary")
    got = {x.node: x.root for x in components.connected_components(simhash.links(df, block=50)).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == reference_components(prints)


def test_similar_documents_go_and_others_stay(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    texts = [[r.choice(words) for _ in range(r.randint(80, 400))] for _ in range(150)]
    data = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    for i in range(0, 150, 3):  # one word changed in the middle: similarity over 0.85
        t = list(texts[i])
        t[len(t) // 2] = "changed"
        data.append((1000 + i, " ".join(t), "en", "s"))
    for i in range(1, 150, 3):  # a third replaced: similarity far below 0.8
        t = list(texts[i])
        t[: len(t) // 3] = [r.choice(words) for _ in range(len(t) // 3)]
        data.append((2000 + i, " ".join(t), "en", "s"))
    kept = {x.doc_id for x in simhash.drop_near_duplicates(cases.frame(spark, data)).collect()}
    assert kept >= set(range(150)) | {i for i, *_ in data if i >= 2000}
    assert len([i for i in kept if 1000 <= i < 2000]) <= 2


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    got = {x.node: x.root for x in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {x: y for x, y in got.items()} == {x: find(x) for a, b in edges for x in (a, b) if a != b}


def test_mixture(spark):
    data = cases.rows()
    got = mixing.mix_sources(cases.frame(spark, data), range_rows=20).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, t, _, s in data:
        sizes[s] += len((t or "").encode().split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped = {s for s in order if not sizes[s]}
    while True:  # share, cap, share again
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and weight[s] * left > 3 * sizes[s] * share}
        if not new:
            break
        capped |= new
    target = {s: float(3 * sizes[s]) if s in capped else weight[s] * left / share for s in order}
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by[(r.source_size, r.target)].append(r.taken)
    assert sum(sum(v) for v in by.values()) == sum(int(target[s]) for s in order)
    assert {(sizes[s], round(target[s], 6)) for s in order} == {(a, round(b, 6)) for a, b in by}
    again = mixing.mix_sources(cases.frame(spark, data), range_rows=1000).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_short_similar_documents_all_link(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [[r.choice(words) for _ in range(r.randint(5, 20))] for _ in range(150)]
    for t in texts[:150]:
        texts.append([*t, "more"])
        texts.append(["x", *t] if r.random() < 0.5 else t[:-1])
    texts = list(dict.fromkeys(" ".join(t) for t in texts))
    sets = [set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = simhash.near_duplicates(cases.frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), simhash.for_similarity(0.8)).collect()
    assert len({find(i) for i in range(len(texts))}) < len(texts) - 50
    assert {x.doc_id: x.component_id for x in got} == {i: find(i) for i in range(len(texts))}


def test_whole_groups_keep_rows_beyond_2_gb():
    big = pa.array([b"\0" * (60 << 20)] * 12, pa.binary())
    batches = [pa.record_batch([np.full(12, 7), big], ["key", "hashes"])] * 3  # 2.1 GB under one key
    assert sum(x.num_rows for x in simhash._whole_groups(iter(batches))) == 36


def jaccard_components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def drifting(r, n, words=200):
    """Texts of which each is another with a few words changed, so that they hang together by chains."""
    texts = [[f"w{r.randrange(3000)}" for _ in range(words)]]
    while len(texts) < n:
        t = list(r.choice(texts[-20:]))
        for _ in range(r.randint(1, 5)):
            t[r.randrange(words)] = f"w{r.randrange(3000)}"
        texts.append(t)
    return [" ".join(t) for t in texts]


def prints_of(spark, texts, plan):
    hashes = [np.unique(simhash.shingle_hashes(t.encode(), 5)) for t in texts]
    rows = [(i, bytearray(simhash.fingerprint(t.encode(), plan)), bytearray(h.tobytes()) if len(h) <= 80 else None, len(h) > 64) for i, (t, h) in enumerate(zip(texts, hashes, strict=True))]
    return spark.createDataFrame(rows, "node bigint, fp binary, short binary, long boolean")


def test_large_groups_are_cut_into_blocks_and_equal_brute_force(spark):
    r = random.Random(12)
    plan = simhash.for_similarity(0.8)
    texts = drifting(r, 150) + drifting(r, 60, 40) + [" ".join(f"w{r.randrange(3000)}" for _ in range(r.choice((30, 66, 78, 150)))) for _ in range(60)]
    texts += [" ".join([*t.split(), "x", "y"]) for t in texts[-60::2]]
    want = jaccard_components([set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in texts])
    prints, docs = prints_of(spark, texts, plan), spark.createDataFrame(list(enumerate(texts)), "node bigint, text string")
    for sets_bytes, block in ((1 << 25, 20_000), (20_000, 30)):
        edges = simhash.links(prints, plan, block, docs, sets_bytes).collect()
        root = {x.node: x.root for x in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        got = [root.get(i, i) for i in range(len(texts))]
        assert sum(a != b for a, b in zip(got, want, strict=True)) <= 2
        assert all(want[i] == want[j] for i, j in enumerate(got))


def test_a_group_of_near_copies_costs_few_rows_a_document(spark):
    plan = simhash.for_similarity(0.8)
    texts = drifting(random.Random(13), 400)
    met = simhash._met(prints_of(spark, texts, plan).select("node", "fp"), plan, 20_000, balls=False).count()
    assert 399 <= met <= 4 * 400  # a task reports a document once at most; there are 4
    edges = simhash.links(prints_of(spark, texts, plan), plan, texts=spark.createDataFrame(list(enumerate(texts)), "node bigint, text string")).count()
    assert edges <= 4 * 400


def test_recall_at_the_threshold(spark):
    """Pairs of a similarity between 0.80 and 0.82, the hardest that must link, each of its own words."""
    r = random.Random(14)
    texts, pairs = [], []
    while len(pairs) < 400:
        n = r.choice((70, 90, 120, 300, 800))
        a = [f"w{len(pairs)}x{r.randrange(10**6)}" for _ in range(n)]
        b = list(a)
        shared = lambda b=b, a=a: (lambda x, y: len(x & y) / len(x | y))(*(set(simhash.shingle_hashes(" ".join(t).encode(), 5).tolist()) for t in (a, b)))
        while shared() > 0.82:
            b[r.randrange(n)] = f"v{r.randrange(10**6)}"
        if shared() >= 0.8:
            pairs.append(n)
            texts += [" ".join(a), " ".join(b)]
    got = {x.doc_id: x.component_id for x in simhash.near_duplicates(cases.frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), simhash.for_similarity(0.8)).collect()}
    found = [got[2 * k] == got[2 * k + 1] for k in range(len(pairs))]
    assert sum(found) / len(found) >= 0.97
    assert {got[2 * k] for k in range(len(pairs))} == set(range(0, 2 * len(pairs), 2))


def test_an_id_that_many_rows_have_is_cut_into_ranges(spark):
    r = random.Random(15)
    data = [(None if i % 3 else i, cases.prose(r, "en", 5 + i % 4), "en", "hot" if i % 2 else "other") for i in range(900)]
    mixed = [mixing.mix_sources(cases.frame(spark, data), range_rows=n) for n in (20, 20, 10_000)]
    rows = [Counter((x.doc_id, x.size, x.source_size, x.target, x.taken) for x in m.collect()) for m in mixed]
    assert rows[0] == rows[1]
    total = lambda c: sum(k[4] * n for k, n in c.items())
    assert total(rows[0]) == total(rows[2]) and sum(rows[0].values()) == 900
    cut = packing.pack_documents(cases.frame(spark, data), public_tokenizers.path("word_bpe_49k.json")).collect()
    ends = defaultdict(list)
    for x in cut:
        ends[x.sequence_id].append((x.offset, x.length))
    assert len(cut) == 900 and all(sum(n for _, n in v) <= 4096 and sorted(v)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(v), sorted(v)[1:], strict=False)) for v in ends.values())


def test_radix_spreads_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(radix, "HOT", 4)
    data = [(i, "same text " * 30 if i % 3 else f"same text {'x' * (i % 50)}", "en", "s") for i in range(400)]
    got = radix.exact_duplicates(cases.frame(spark, data)).collect()
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[t].append(i)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(i, max(v), len(v), i == max(v)) for v in groups.values() for i in v}


def test_each_side_of_a_bound_gives_the_same_groups(spark, monkeypatch):
    """Sets fetched by a broadcast or a shuffle, meetings searched by pairs or by rows: plans differ, groups don't."""
    plan = simhash.for_similarity(0.8)
    texts = drifting(random.Random(17), 90, 120)
    frame = cases.frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    groups = lambda: {x.doc_id: x.component_id for x in simhash.near_duplicates(frame, plan).collect()}
    one = groups()
    monkeypatch.setattr(simhash, "BROADCAST_NODES", 0)
    monkeypatch.setattr(simhash, "SMALL", 2)
    assert groups() == one and len(set(one.values())) < 90


def test_hot_values_meet_by_pieces(spark):
    """Fingerprints that share a segment and differ elsewhere, far more than a block holds, among strangers."""
    r = np.random.default_rng(23)
    half = int(r.integers(1 << 31))
    prints = sorted({half | int(x) << 32 for x in r.integers(1 << 31, size=300)} | {(half | int(x) << 32) ^ (1 << int(b)) ^ (1 << int(c)) for x, b, c in zip(r.integers(1 << 31, size=300), r.integers(0, 63, 300), r.integers(32, 63, 300), strict=True)})
    prints = sorted({*prints, *(p ^ (1 << int(b)) for p, b in zip(prints, r.integers(0, 63, len(prints)), strict=True))})
    df = spark.createDataFrame([(i, bytearray(p.to_bytes(8, "little"))) for i, p in enumerate(prints)], "node bigint, fp binary")
    got = {x.node: x.root for x in components.connected_components(simhash.links(df, block=100)).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == reference_components(prints)
