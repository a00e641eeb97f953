"""The pipeline's stages over a small table, and the entry that registers them."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from loomwork.llm import simhash

from . import cases


def test_stages(spark, tmp_path):
    docs = cases.frame(spark, cases.rows(9, 200))
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != "pack":
            assert docs.columns == names
    ids = {k: [r.doc_id for r in v] for k, v in seen.items()}
    assert not set(ids["language_id"]) & {250, 251, 252, 253, 254}
    assert len({r.text for r in seen["exact_dedup"]}) == len(seen["exact_dedup"])
    assert len(ids["near_dedup"]) <= len(ids["exact_dedup"]) and len(ids["near_dedup"]) > 180
    filled = defaultdict(int)
    for r in seen["pack"]:
        filled[r.sequence_id] += r.length
    assert filled and max(filled.values()) <= 4096


def test_stages_equal_brute_force(spark, tmp_path):
    """Each stage against a plain version over its own input."""
    r = random.Random(31)
    data = [(i, cases.prose(r, r.choice(("en", "fr", "de")), r.randint(30, 200)), "en", f"s{i % 3}") for i in range(150)]
    data += [(200 + i, data[i][1], "en", "s0") for i in range(0, 60, 2)]  # exact copies
    for i in range(60):  # near copies, in chains
        w = data[r.randrange(len(data))][1].split()
        w[r.randrange(len(w))] = "changed"
        data.append((300 + i, " ".join(w), "en", "s1"))
    data += [(500, None, "en", "s1"), (501, "", "en", "s1"), (502, "12 34", "en", "s2")]
    docs = cases.frame(spark, data)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/b-{name}")
        docs = spark.read.parquet(f"{tmp_path}/b-{name}")
        seen[name] = [(x.doc_id, x.text or "", x.source) for x in docs.collect()]
    assert {500, 501, 502}.isdisjoint(i for i, *_ in seen["language_id"]) and len(seen["language_id"]) >= 230
    last = {}
    for i, t, _ in seen["language_id"]:
        last[t] = max(i, last.get(t, i))
    assert sorted(i for i, *_ in seen["exact_dedup"]) == sorted(last.values())
    rows = sorted(seen["exact_dedup"])
    sets = [set(simhash.shingle_hashes(t.encode(), 5).tolist()) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = {rows[find(i)][0] for i in range(len(rows))}
    got = {i for i, *_ in seen["near_dedup"]}
    assert want <= got and len(got - want) <= 2 and len(want) < len(rows) - 10
    size = {i: len(t.split()) for i, t, _ in seen["near_dedup"]}
    times = Counter(i for i, *_ in seen["mix"])
    assert set(times) <= set(size) and max(times.values()) <= 3
    by_source = {s: sum(size[i] for i, _, x in seen["near_dedup"] if x == s) for s in ("s0", "s1", "s2")}
    total = sum(by_source.values())
    target = {s: w * total / 6 for w, s in enumerate(sorted(by_source), 1)}
    if all(target[s] <= 3 * by_source[s] for s in by_source):
        for s in by_source:  # whole documents: the last one of a source may be taken in part
            words = sum(size[i] for i, _, x in seen["mix"] if x == s)
            assert 0 <= words - target[s] <= max(size.values())


def test_a_run_leaves_the_result_of_another(spark, tmp_path):
    for k in range(2):
        cases.frame(spark, cases.rows(20 + k, 60)).write.parquet(f"{tmp_path}/d{k}/documents.parquet")
    one = corpus_pipeline.run(spark, f"{tmp_path}/d0")
    two = corpus_pipeline.run(spark, f"{tmp_path}/d1")
    assert one.count() > 30 and two.count() > 30


def test_empty(spark, tmp_path):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_entry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
