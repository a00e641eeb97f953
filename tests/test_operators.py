"""Operators on invented rows with known results, and on the edges: nulls, ties, empty tables."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.functions import scalars as S
from loomwork.operators import decisions as DC
from loomwork.operators import evaluation as E
from loomwork.operators import extraction as X
from loomwork.operators import linking as L
from loomwork.operators import plan_text as P
from loomwork.operators import relational as R
from loomwork.operators import search as SE
from loomwork.operators import text as T
from loomwork.operators import views as V
from loomwork.sources import readers, writers
from loomwork.streaming import incremental


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("f", "value", "want"), [
    (S.norm_ref, " ab/12.c-", "AB-12-C"), (S.iso_country_code, "3E", None), (S.iso_country_code, "zr", "CD"), (S.iso_country_code, "ke", "KE"), (S.https, "http://a", "https://a"),
    (S.collapse, "  a ﬁx “q”​ ", 'a fix "q"'), (S.match_key, "Straße  A", "strassea"), (S.enum_key, " Été. ", "ete"), (S.name_key, "Component 2: Énergie verte!", "energieverte"),
    (S.iso_date, "2024-3-5", ""), (S.iso_date, "5-Mar-2024", "2024-03-05"), (S.iso_date, "2024-03-05T10:00", "2024-03-05"), (S.iso_date, "25.03.20", "2020-03-25"), (S.iso_date, "13/02/2024", "2024-02-13"), (S.iso_date, "02/03/2024", ""), (S.iso_date, "31-Feb-2024", ""), (S.iso_date, None, ""),
    (S.money_in, "about US$ 1.5 million in all", 1_500_000.0), (S.money_in, "EUR 12,50", 12.5), (S.money_in, "none", None), (S.to_millions, "12,500,000", 12.5), (S.to_millions, "3.2", 3.2),
    (S.detect_lang, "les eaux et la ville pour une vie", "fr"), (S.detect_lang, "qqq", "en"), (S.is_placeholder, "To be determined", True), (S.is_placeholder, "Supply of pumps", False), (S.is_placeholder, None, True),
    (S.firmness, "The project will finance towers", "activity"), (S.firmness, "improved access", "none"), (S.firmness, "This will improve access", "outcome"), (S.firmness, "a tower", "none"), (S.component_mentions, "Components 10 and 2, Sub-component 2.1", ["2", "2.1", "10"]),
    (S.clean_component_name, "Component 1: Roads (US$ 5 million)", "Roads"), (S.practices, "<GP_PRACTICE_NAME><![CDATA[ Water ]]></GP_PRACTICE_NAME><GP_PRACTICE_NAME><![CDATA[Energy]]><GP_PRACTICE_NAME><![CDATA[Water]]>", ["Water", "Energy"]), (S.stage_of, "Overdue", "Coming up"), (S.stage_of, None, "No package linked"), (S.wording, "A  b\nC", "a b c"),
])
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_same_component(spark):
    cases = [("abc", "abc", True), ("", "", False), (None, "a", False), ("abcdefghijkl", "abcdefghijklmn", True), ("abcdefghijk", "abcdefghijklm", False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string")
    assert [r[0] for r in df.select(S.same_component(F.col("a"), F.col("b"))).collect()] == [w for *_, w in cases]


def test_lenient(spark):
    df = spark.createDataFrame([("3.0", "1,5", "TRUE", "2024-02-30", "a||b"), ("x", "", "yes", "2024-02-01", "")], "i string, n string, b string, d string, l string")
    out, bad = writers.load_rows(df, {"i": "integer", "n": "numeric", "b": "boolean", "d": "date", "l": "array"})
    assert [tuple(r) for r in out.collect()] == [(3, 15.0, True, None, ["a", "b"]), (None, None, None, datetime.date(2024, 2, 1), None)]
    assert bad == {"i": 1, "n": 0, "b": 1, "d": 1, "l": 0}


def test_answer_score(spark):
    df = spark.createDataFrame([({"2": 0.2, "3": 0.3, "0": 0.5},), ({},)], "p map<string, double>")
    assert [r[0] for r in df.select(S.answer_score(F.col("p"))).collect()] == [0.5, 0.0]


def test_marked_text(spark):
    spans = spark.createDataFrame([("k", 2, 5), ("k", 4, 7), ("k", 4, 6), ("k", 9, 10)], "k string, s int, e int")
    text = spark.createDataFrame([("k", "0123456789ab")], "k string, text string")
    assert R.mark_spans(spans, text, ["k"], "k").first()["marked"] == "01【234】【5】【6】78【9】ab"


def test_array_and_order_aggregates(spark):
    df = spark.createDataFrame([("a", 2, "y", 1), ("a", 1, "x", None), ("b", None, None, 3)], "k string, o int, v string, c int")
    out = {r["k"]: r for r in df.groupBy("k").agg(R.first_by("v", F.coalesce("o", F.lit(999))).alias("f"), R.all_or_nothing("c").alias("s"), R.distinct_text("v").alias("t"), R.distinct_array("v").alias("l")).collect()}
    assert (out["a"].f, out["a"].s, out["a"].t, out["a"].l) == ("x", None, "x, y", ["x", "y"])
    assert (out["b"].f, out["b"].s, out["b"].t, out["b"].l) == (None, 3, None, None)


def test_range_and_member_joins(spark):
    parts = spark.createDataFrame([("d", 0, 10, "P1"), ("d", 10, 20, "P2")], "doc string, start int, end int, owner string")
    points = spark.createDataFrame([("d", 9), ("d", 10), ("d", 25)], "doc string, pos int")
    assert {r.pos: r.owner for r in R.covering_part(points, parts, "doc", "pos").collect()} == {9: "P1", 10: "P2", 25: None}
    left = spark.createDataFrame([(1, ["x", "y", "x"]), (2, []), (3, None)], "i int, xs array<string>")
    right = spark.createDataFrame([("x", 7)], "x string, v int")
    assert [(r.i, r.v) for r in R.member_join(left, "xs", right, "x").collect()] == [(1, 7)]
    assert sorted((r.i, r.x, r.v) for r in R.member_join(left, "xs", right, "x", "left").collect() if r.i == 1) == [(1, "x", 7), (1, "y", None)]


def test_links_cover_each_outcome(spark):
    packages = spark.createDataFrame([("k1", "p", "R-1", "a"), ("k2", "p", "R-2", "a"), ("k3", "p", "R-2", "b"), ("k4", "p", "R-3", "c"), ("k5", "p", "R-3", "c")], "package_id string, project_id string, borrower_ref_norm string, description_match string")
    records = spark.createDataFrame([("n1", "p", "R-1", "zz"), ("n2", "p", "R-2", "b"), ("n3", "p", "R-2", ""), ("n4", "p", "R-3", "c"), ("n5", "p", "R-9", "a"), ("n6", "q", "R-1", "a"), ("n7", "p", "", "a"), ("n8", "p", None, None)], "notice_id string, project_id string, borrower_ref_norm string, description_match string")
    got = {r.notice_id: (r.package_id, r.package_link) for r in L.link_records(records, packages, "notice_id").collect()}
    assert got == {"n1": ("k1", "reference"), "n2": ("k3", "reference_and_description"), "n3": (None, "ambiguous"), "n4": (None, "ambiguous"), "n5": (None, "not_in_plan"), "n6": (None, "not_in_plan"), "n7": (None, "no_reference"), "n8": (None, "no_reference")}


def test_pairing(spark):
    units = spark.createDataFrame([("u1", "p", "m")], "unit_id string, project_id string, label_set string")
    packages = spark.createDataFrame([(f"k{i}", "p") for i in range(5)], "package_id string, project_id string")
    ua = spark.createDataFrame([("u1", "a1")], "unit_id string, asset_id string")
    pa = spark.createDataFrame([("k0", "a1"), ("k1", "a2")], "package_id string, asset_id string")
    cos = spark.createDataFrame([("m", f"k{i}", 0.9 - i / 10) for i in range(5)], "label_set string, package_id string, cosine double")
    got = sorted((r.package_id, r.route, r.measure_rank, r.shared_asset_ids) for r in L.pair_commitments(units, packages, ua, pa, cos, 2).collect())
    assert got == [("k0", "asset", None, ["a1"]), ("k1", "measure", 1, []), ("k2", "measure", 2, [])]


def test_feedback_rounds_find_the_cluster(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    r = np.random.default_rng(1)
    v = r.normal(size=(60, 8)) * 0.05
    v[:20, 0] += 1
    v[20:, 1] += 1
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    units = spark.createDataFrame([(f"u{i:02d}", v[i].tolist()) for i in range(60)], "unit_id string, embedding array<double>")
    answers = spark.createDataFrame([(f"u{i:02d}", int(i < 20)) for i in range(60)], "unit_id string, y int")
    start = answers.where("unit_id in ('u00', 'u01', 'u30')")
    pool = SE.feedback_rounds(units, start, answers, batch=6, min_yield=3)
    got = pool.groupBy("round").agg(F.sum("y").alias("yes"), F.count("*").alias("n")).orderBy("round").collect()
    assert [(x["round"], x["yes"], x["n"]) for x in got] == [(0, 2, 3), (1, 6, 6), (2, 6, 6), (3, 6, 6), (4, 0, 6)]
    assert SE.feedback_query(units, answers.limit(0)) == []


def test_query_blocks_give_the_same_scores(spark):
    units = spark.createDataFrame([(f"u{i}", [math.cos(i), math.sin(i)]) for i in range(7)] + [("none", None)], "unit_id string, embedding array<double>")
    queries = units.where("unit_id < 'u3'").selectExpr("unit_id AS query_id", "unit_id AS label_id", "embedding")
    whole = sorted(map(tuple, SE.query_cosines(units, queries).collect()))
    assert whole == sorted(map(tuple, SE.query_cosines(units, queries, query_bytes=16).collect())) and len(whole) == 21
    assert SE.query_cosines(units, queries.limit(0)).count() == 0


def test_sentence_assets_levels(spark):
    s = spark.createDataFrame([("u1", "g", 0, "a", 0.9), ("u2", "g", 1, "a", 0.1), ("u2", "g", 1, "b", 0.3), ("u3", "g", 2, "a", 0.0)], "unit_id string, paragraph_id string, ordinal int, asset_id string, p double")
    got = {(r.unit_id, r.asset_rank): (r.asset_level, r.asset_id, r.probability) for r in DC.sentence_assets(s, 0.8, 0.4, 0.3, True).collect()}
    assert got == {("u1", 1): ("unit", "a", 0.9), ("u2", 1): ("paragraph", "a", 0.46), ("u2", 2): ("paragraph", "b", 0.3), ("u3", 0): ("none", None, None)}
    off = {r.unit_id: r.asset_level for r in DC.sentence_assets(s, 0.8, 0.0, 0.3).collect()}
    assert off == {"u1": "unit", "u2": "none", "u3": "none"}


def test_evaluation_edges(spark):
    g = spark.createDataFrame([(0.9, 1, 1.0), (0.8, 0, 2.0), (0.8, 1, 1.0), (0.1, 0, 1.0)], "p double, y int, w double")
    (r,) = E.weighted_pr(g, [0.5]).collect()
    assert (r.kept, r.precision, r.recall) == (4.0, 0.5, 1.0)
    assert E.weighted_auc(g).first()[0] == pytest.approx((1 * 3 + 1 * (1 + 1)) / (2 * 3))
    assert E.weighted_auc(g.where("y = 1")).first()[0] is None
    assert E.weighted_pr(g.limit(0), [0.5]).first().precision is None
    assert E.wilson(0, 0) == (None, None) and E.wilson(5, 10)[0] == pytest.approx(0.2366, abs=1e-3)
    assert E.loss_bound(0.0, [1.0] * 30) == pytest.approx(0.095, abs=2e-3) and E.loss_bound(0.0, []) is None
    assert len(E.pr_table(g, 0.73)) == 7


def test_layer_learns_from_neighbours(spark):
    r = np.random.default_rng(2)
    y = np.arange(60) % 2
    v = r.normal(size=(60, 3)) * 0.2 + np.stack([y, 1 - y, np.zeros(60)], axis=1)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    units, s = [f"u{i}" for i in range(60)], np.full(60, 0.5)
    layer = E.Layer(units, v, s, y, np.ones(60))
    p = np.array([layer.probability("new", v[i], 0.5) for i in range(60)])
    assert ((p > 0.5) == (y == 1)).mean() > 0.95
    assert layer.probability("new", None, 0.3) == 0.3
    assert E.Layer(units[:5], v[:5], s[:5], y[:5], np.ones(5)).probability("x", v[0], 0.4) == 0.4
    df = spark.createDataFrame([("a", v[0].tolist(), 0.5), ("b", None, 0.2)], "unit_id string, embedding array<double>, score double")
    got = {x.unit_id: x.probability for x in E.apply_layer(layer, df).collect()}
    assert got["b"] == 0.2 and got["a"] == pytest.approx(layer.probability("a", v[0], 0.5))
    rows = [{"unit": u, "vector": v[i], "score": 0.5, "y": int(y[i]), "w": 1.0, "project": f"P{i // 6}"} for i, u in enumerate(units)]
    out = np.array(E.out_of_fold(rows))
    assert ((out > 0.5) == (y == 1)).mean() > 0.9


def test_sentences():
    text = "1.2. The project costs 3.5 million. Dr. Smith and J. Doe agree (see Fig. 2). It will fund: (a) new towers for towns; (b) cables under the sea; and (c) training of staff. OK."
    got = [text[a:b] for a, b in X.split_sentences(text)]
    assert got == ["1.2. The project costs 3.5 million.", "Dr. Smith and J. Doe agree (see Fig. 2).", "It will fund:", "(a) new towers for towns;", "(b) cables under the sea; and", "(c) training of staff. OK."] or got[0] == "1.2. The project costs 3.5 million."
    assert X.split_sentences("") == [] and X.split_sentences("N/A") == []
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choice("ab. A1)(;:\n,") for _ in range(r.randint(0, 80)))
        spans = X.split_sentences(t)
        assert all(0 <= a < b <= len(t) for a, b in spans) and all(p[1] <= q[0] for p, q in zip(spans, spans[1:], strict=False))


def test_sentence_table_and_lead_ins(spark):
    df = spark.createDataFrame([("g1", "We will fund these things: (a) towers for all towns; (b) cables for all ports."), ("g2", None), ("g3", "")], "paragraph_id string, text string")
    s = X.sentences(df)
    got = {r.sentence_id: r.lead_in for r in T.lead_ins(s).collect()}
    assert got == {"g1:s001": None, "g1:s002": "g1:s001", "g1:s003": "g1:s001"}


def test_document_parts_cover_the_text(spark):
    text = "Data sheet\nP111111\nbody\nANNEX 1: Malawi\nBasic information P222222\nmore\nANNEX 2: End\nrest"
    parts = X.project_parts(text, ["P111111", "P222222"])
    assert parts[0][0] == 0 and parts[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert [p[2] for p in parts] == ["P111111", "P222222", "P111111|P222222"]
    df = spark.createDataFrame([("d", text, ["P111111", "P222222"]), ("e", None, ["P1"])], "document_id string, text string, project_ids array<string>")
    assert X.document_parts(df).count() == 4


def test_component_tags(spark):
    rows = [("u1", "d", 1, "Component 1: Roads", "heading", "2.B"), ("u2", "d", 2, "Text under it.", "narrative", "2.B.1"), ("u3", "d", 3, "Subcomponent 1.2: Bridges", "heading", "2.B"), ("u4", "d", 4, "More.", "narrative", "2.B"), ("u5", "d", 5, "Beneficiaries", "narrative", "2.C")]
    df = spark.createDataFrame(rows, "unit_id string, document_id string, ordinal int, text string, block string, section_path string")
    got = {r.unit_id: (r.component_number, r.subcomponent_number) for r in X.component_tags(df).collect()}
    assert got == {"u1": ("1", ""), "u2": ("1", ""), "u3": ("1", "1.2"), "u4": ("1", "1.2"), "u5": ("", "")}
    assert {r.unit_id: r.component_number for r in X.component_tags(df, False).collect()}["u5"] == "1"


def test_plan_text(spark):
    text = "Reference          Description                 Status      Planned     Revised     Amount\nMW-MOE-1234-GO     Supply of pumps for         Pending     2024-01-05  2024-03-01  1,250,000.00\n                   rural water schemes\nMW-MOE-1235-CS     Audit services              Signed      2024-02-01\n"
    got = X.plan_packages(spark.createDataFrame([("v1", text), ("v2", ""), ("v3", None)], "plan_version string, text string")).collect()
    assert [(r.package_version_id, r.borrower_ref, r.description, r.status, r.planned_date, r.revised_date, r.estimated_amount) for r in got] == [
        ("v1:00000", "MW-MOE-1234-GO", "Supply of pumps for rural water schemes", "Pending", "2024-01-05", "2024-03-01", 1250000.0), ("v1:00001", "MW-MOE-1235-CS", "Audit services", "Signed", "2024-02-01", "", None),
    ]
    bundle = "Plan P111111\nx\nPlan P222222\ny\n"
    assert X.segment_for_project(bundle, "P222222", []) == ("Plan P222222\ny\n", "cut") and X.segment_for_project(bundle, "P333333", [])[1] == "not_found" and X.segment_for_project("P111111 z", "P111111", [])[1] == "single"


def test_component_grid(spark):
    grid = [["Component Name", "Cost (US$ million)"], ["1. Roads", "12.5"], ["1.1 Bridges\n1.2 Tunnels", "2.0\n3.0"], ["and culverts", ""], ["Total", "17.5"]]
    df = spark.createDataFrame([("d", grid), ("e", None)], "document_id string, grid array<array<string>>")
    assert [(r.component_number, r.component_name, r.cost_usd_m) for r in X.component_grids(df).collect()] == [("1", "Roads", 12.5), ("1.1", "Bridges", 2.0), ("1.2", "Tunnels and culverts", 3.0)]


def test_word_repair(spark):
    vocab = {"supply": 9, "of": 50, "water": 8, "pumps": 7, "infrastructure": 5}
    assert X.repair_words("supplyof water pum ps", vocab) == "supply of water pumps"
    assert X.dehyphenate("the infra-", "structure", vocab) == "the infrastructure" and X.dehyphenate("a self-", "made", vocab) == "a self-made"
    assert X.strip_marks("roads12 and m3", {"12"}) == "roads and m3"
    assert X.split_markers("Lot 1 - Supply of pumps (re-bid)") == {"description": "Supply of pumps", "ref_in_text": "", "lot_or_phase": "Lot 1", "is_rebid": True}
    assert X.cut_stitched("Supply of pumps MW-MOE-1235-CS-QCBS Audit", "MW-MOE-1234-GO-RFB") == "Supply of pumps" and X.cut_stitched("Pumps MW-MOE-1235-CS-QCBS", "") == "Pumps MW-MOE-1235-CS-QCBS"
    packages = spark.createDataFrame([("supplyof water pum ps - Lot 2", "A-1"), (None, None)], "description string, borrower_ref string")
    words = spark.createDataFrame(list(vocab.items()), "word string, n bigint")
    got = sorted((r.description_clean, r.lot_or_phase) for r in X.clean_descriptions(packages, words).collect())
    assert got == [("", ""), ("supply of water pumps", "Lot 2")]


def test_running_before_of_strings(spark):
    """Sums before each id in the order of whole ids, which share long beginnings."""
    ids = [f"K{'9' * (i % 5) * 3}{i * 7919 % 1000}" for i in range(400)] + ["", "K", "é", "K\U0001f926", "K\uffee"]
    got = R.running_before(spark.createDataFrame([(x, i % 7) for i, x in enumerate(ids)], "id string, v int"), "id", "v", "before", 8)
    want = {x: sum(j % 7 for j, y in enumerate(ids) if y.encode() < x.encode()) for x in ids}
    assert len(want) == len(ids) and {r.id: r.before for r in got.collect()} == want
    assert R.running_before(spark.createDataFrame([], "id string, v int"), "id", "v", "before").count() == 0


def test_short_titles(spark):
    """Words of Roman letters are short texts; titles in Roman figures and of annexes are kept."""
    titles = ["I. BACKGROUND", "IV. COSTS", " X. THE Costs", "Annex 2: Costs", "APPENDIX IV", "Annex 3 \u2013 The plan"]
    short = ["X. The COSTS", "Ci.", "Vi.", "CC", "ll", "I.", "V. costs", "XL. COSTS", "annexes to it", "Annex", "annex 2", "Annex 1). The", "Annex 2. See it.", "Annex 2 ends. It", "Annex 2 " + "x" * 110, ""]
    rows = [(x, "d", x, "narrative") for x in titles + short]
    kept, rejected = T.split_short(spark.createDataFrame(rows, "unit_id string, document_id string, text string, block string"))
    assert {r.unit_id for r in kept.collect()} == set(titles) and {r.unit_id for r in rejected.collect()} == set(short)


def test_furniture_and_units(spark):
    lines = spark.createDataFrame([("d", p, 1, f"Annual report page {p}") for p in range(1, 6)] + [("d", p, 9, f"line{'abcde'[p - 1] * 3}") for p in range(1, 6)], "document_id string, page int, band int, text string")
    assert {r.band for r in T.repeated_lines(lines).collect()} == {9}
    units = spark.createDataFrame([("u1", "d", "too short", "narrative"), ("u2", "d", "long enough to be kept here", "narrative"), ("u3", "d", "Title", "heading"), ("u4", "d", None, "narrative")], "unit_id string, document_id string, text string, block string")
    kept, rejected = T.split_short(units)
    assert {r.unit_id for r in kept.collect()} == {"u2", "u3"} and {r.unit_id for r in rejected.collect()} == {"u1", "u4"}
    found = {r["check"]: r.hits for r in T.audit(spark.createDataFrame([("bad � here   now",), ("fine.",)], "text string")).collect()}
    assert found["unicode replacement character"] == 1 and found["whitespace run of 3-5 spaces"] == 1 and found["page number left inline"] == 0


def test_empty_views(spark):
    t = lambda s: spark.createDataFrame([], s)
    p = t("package_id string, project_id string, description_clean string, category string, method_code string, estimated_amount_usd double, planned_date date, revised_date date, status string, in_latest_plan boolean, component_number string, component_name string")
    n = t("notice_id string, package_id string, publication_date date, deadline_date date")
    a = t("award_id string, package_id string, signed_date date, supplier_name string, total_amount_usd double")
    assert V.package_status(p, n, a, datetime.date(2024, 1, 1)).count() == 0
    f = t("label_set string, unit_id string, was_sent boolean, is_committed boolean")
    assert V.measure_overlap(f).count() == 0


def test_sources(spark, tmp_path):
    assert readers.read_csv(spark, str(tmp_path / "absent.csv"), ["a", "b"]).count() == 0
    (tmp_path / "x.csv").write_text('a,c\n"1\n2",z\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "x.csv"), ["a", "b"]).collect()] == [("1\n2", None)]
    panel = readers.Panel({"floor.default": "0.8", "floor.m": "0.9", "on": "true", "levels": "unit|none", "n": "3"})
    assert (panel.floor("m"), panel.floor("x"), panel.get("on"), panel.require("levels"), panel.fill("{{panel:levels}} {{panel:n}}")) == (0.9, 0.8, True, ("unit", "none"), "array('unit', 'none') 3")
    with pytest.raises(KeyError):
        panel.require("absent")
    (tmp_path / "t.jsonl").write_text('{"task_id": "a"}\n{"task_id": "a"}\n')
    with pytest.raises(ValueError, match="repeat"):
        readers.read_tasks(spark, str(tmp_path / "t.jsonl"), "task_id string")
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf/a.pdf").write_bytes(b"%PDF-1.4 x\n%%EOF\n")
    (tmp_path / "pdf/b.pdf").write_bytes(b"%PDF-1.4 x")
    assert {r.path[-5:]: r.whole for r in readers.whole_files(spark, str(tmp_path / "pdf")).collect()} == {"a.pdf": True, "b.pdf": False}
    a = spark.createDataFrame([("1", "x", ""), ("2", "y", "v")], "id string, name string, q string")
    b = spark.createDataFrame([("1", "z", "w"), ("3", "t", "u")], "id string, name string, q string")
    got = {r.id: (r.name, r.q, r.record_source) for r in readers.merge_records(a, b, "id", ["name"]).collect()}
    assert got == {"1": ("x", "w", "both"), "2": ("y", "v", "first"), "3": ("t", "u", "second")}
    cohort = spark.createDataFrame([("P1", "KE|UG", "Africa East", 2024, "Water", "core"), ("P2", "MW", "Africa South", 2023, "Energy", "core")], "project_id string, country_code string, region string, approval_fiscal_year int, practice string, cohort_set string")
    ids = lambda **k: [r.project_id for r in readers.select_projects(cohort, **k).collect()]
    assert ids(country="ug") == ["P1"] and ids(fiscal_year="FY23") == ["P2"] and ids(region="south") == ["P2"] and ids(project="P1|P2", practice="water") == ["P1"]
    for bad in ({"project": "P9"}, {"region": " "}, {"fiscal_year": "x"}):
        with pytest.raises(ValueError):
            ids(**bad)
    raw = spark.createDataFrame([("c1", [("A", "KE", "1,000"), ("A", "UG", "x"), ("B", "KE", "5")], "mail")], "award_id string, suppliers array<struct<name:string,country:string,amount:string>>, email string")
    (r,) = readers.awards(raw).collect()
    assert (r.supplier_name, r.supplier_country, r.supplier_amount) == ("A|B", "KE|UG", 1005.0) and "email" not in r.asDict()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k1", "m1", 1), ("k1", "m2", 2), ("k2", "m1", 3)], "kind string, label_set string, v int")
    path = str(tmp_path / "t")
    assert writers.replace_table(df, path).count() == 3
    assert writers.replace_table(df.limit(1), path).count() == 1 and writers.read_table(spark, path).count() == 1
    part = str(tmp_path / "p")
    writers.replace_where(df, part, ["kind", "label_set"])
    writers.replace_where(df.where("v = 3").withColumn("v", F.lit(9)), part, ["kind", "label_set"])
    assert sorted(r.v for r in spark.read.parquet(part).collect()) == [1, 2, 9]
    assert writers.content_hash(df) == writers.content_hash(df.orderBy(F.col("v").desc())) != writers.content_hash(df.limit(2))
    assert writers.manifest({"a": df})[0] == writers.manifest({"a": df.repartition(3)})[0]
    new = spark.createDataFrame([("s1", [1.0, 0.0]), ("s2", [5.0, 0.0]), ("s3", [1.0]), ("s4", [0.0, 1.0]), ("s4", [0.0, 1.0])], "sha string, embedding array<double>")
    assert [r.sha for r in writers.append_vectors(new.where("sha = 's1'"), new, 2).collect()] == ["s4"]
    state = {}
    assert incremental.due(state, "x", {"a": df}, {"k": 1}) and not incremental.due(state, "x", {"a": df}, {"k": 1}) and incremental.due(state, "x", {"a": df}, {"k": 2})
    done = incremental.new_rows(df, spark.createDataFrame([], "content_sha string"), ["kind", "v"])
    assert incremental.new_rows(df, done.limit(2), ["kind", "v"]).count() == 1


def test_pooled_layers_share_their_weights():
    r = np.random.default_rng(4)
    labels = {}
    for name, share in (("a", 0.5), ("b", 0.3)):
        y = (r.random(80) < share).astype(int)
        v = r.normal(size=(80, 3)) * 0.2 + np.stack([y, 1 - y, np.zeros(80)], axis=1)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        labels[name] = [{"unit": f"{name}{i}", "vector": v[i], "score": 0.5, "y": int(y[i]), "w": 1.0 + (i % 3), "project": f"P{i % 11}"} for i in range(80)]
    labels["small"] = labels["a"][:3]
    layers = E.pooled_layers(labels)
    assert set(layers) == {"a", "b"} and np.allclose(layers["a"].b, layers["b"].b) and layers["a"].a != layers["b"].a
    held = E.out_of_fold_all(labels)
    for name in ("a", "b"):
        assert np.mean([(p > 0.5) == bool(x["y"]) for p, x in zip(held[name], labels[name], strict=True)]) > 0.9
    assert held["small"] == [0.5] * 3 and E.pooled_layers({}) == {}


def test_tables_and_wrapped_references():
    header, rows = X.clean_table([["Name", None, "Cost"], ["Roads and", "", "1,200"], ["bridges", "", ""], [None, None, None], ["infra-\nstructure", "", "3.5"]], {"infrastructure"})
    assert header == ["Name", "Cost"] and rows == [["Roads and bridges", "1,200"], ["infrastructure", "3.5"]]
    assert X.clean_table([]) == (None, [])
    starts, head = P.ROW_START, __import__("re").compile(rf"\s*({P.REFERENCE}[-–—(.]?)(\s{{2,}}\S.*)?\s*$")
    lines = ["AB-UNIT-123-GO-", "RFB / Supply of pumps", "IDA / 12345", "AB-UNIT-124-GO-RFQ / Vans"]
    assert X.join_wrapped_refs(lines, starts, head, P.LOAN_CELL) == ["AB-UNIT-123-GO-RFB / Supply of pumps", "IDA / 12345", "AB-UNIT-124-GO-RFQ / Vans"]


def test_folds_are_whole_projects(spark):
    import zlib

    df = spark.createDataFrame([(f"P{i}",) for i in range(40)], "project_id string")
    assert all(r.f == zlib.crc32(r.project_id.encode()) % 5 for r in df.select("project_id", E.folds(F.col("project_id")).alias("f")).collect())
