"""Fetching through a given transport, stored files, runs, fits, batches and derived tables."""

import json

import pytest
from pyspark.sql import functions as F

from loomwork import __main__ as command
from loomwork.sources import fetching, readers, runs, working


def listing(n, total=None):
    def get(address, parameters):
        at, size = parameters["os"], parameters["rows"]
        return json.dumps({"total": total if total is not None else n, "items": [{"id": i} for i in range(at, min(n, at + size))]}).encode()

    return get


def test_pages_stop_at_the_total_and_refuse_less():
    items, total = (lambda a: a["items"]), (lambda a: a["total"])
    assert [x["id"] for x in fetching.pages(listing(250), "x", {}, items, total)] == list(range(250))
    assert list(fetching.pages(listing(0), "x", {}, items, total)) == []
    with pytest.raises(fetching.Refused):
        list(fetching.pages(listing(250, 300), "x", {}, items, total))
    assert len(list(fetching.pages(listing(250), "x", {}, items, lambda a: None))) == 250
    for body in (b"<!DOCTYPE html>", b" <html>", b"{torn"):
        with pytest.raises(fetching.Refused):
            fetching.json_body(body)


def test_listing_as_a_table(spark):
    def get(address, parameters):
        at, size = parameters["os"], parameters["rows"]
        return json.dumps({"items": [{"id": i} for i in range(at, min(95, at + size))]}).encode()

    assert sorted(r.id for r in fetching.fetch_table(spark, get, "x", {}, 95, "id bigint", "items", size=20, tasks=2).collect()) == list(range(95))


def test_spend():
    s = fetching.Spend(1.0)
    s.add("ask", 0.6)
    with pytest.raises(fetching.Refused):
        s.add("more", 0.5)
    assert s.left() == pytest.approx(0.4)


def test_ledger(spark):
    ledger = spark.createDataFrame([("ask:1", 0.5, "2024-01-01"), ("ask:2", 0.25, "2024-02-01"), ("embed", 0.1, "2024-03-01")], "step string, cost double, at string").withColumn("at", F.col("at").cast("timestamp"))
    assert fetching.cap_left(ledger, 1.0, "2024-01-15") == pytest.approx(0.65)
    assert {r.stage: (r.calls, r.cost) for r in runs.stage_spend(ledger).collect()} == {"ask": (2, 0.75), "embed": (1, 0.1)}
    started = ledger.withColumn("started_at", F.col("at"))
    assert [r.step for r in runs.earlier_runs(started, "2024-02-15", 1).collect()] == ["ask:2"]


def test_files_keep_their_old_bytes(spark, tmp_path):
    path = f"file://{tmp_path}/a.json"
    assert fetching.store_keeping_old(spark, path, b"one") and not fetching.store_keeping_old(spark, path, b"one")
    assert fetching.store_keeping_old(spark, path, b"two") and fetching.read_whole(spark, path) == b"two"
    assert [p.read_bytes() for p in tmp_path.iterdir() if p.name.startswith("a.json.") and not p.name.endswith(".crc")] == [b"one"]
    assert fetching.read_whole(spark, f"file://{tmp_path}/none") is None


def test_runs_of_other_units_are_refused(spark, tmp_path):
    units = spark.createDataFrame([("u1", "a"), ("u2", "b")], "unit_id string, text string")
    queries, scores = spark.createDataFrame([("q", "x")], "query_id string, query string"), spark.createDataFrame([("u1", "q", 0.5)], "unit_id string, query_id string, cosine double")
    runs.write_run(queries, scores, units, f"{tmp_path}/run")
    q, s = runs.load_run(spark, f"{tmp_path}/run", units.orderBy("unit_id"))
    assert q.count() == 1 and s.first()["cosine"] == 0.5
    with pytest.raises(runs.Stale):
        runs.load_run(spark, f"{tmp_path}/run", units.limit(1))


def test_fits_replace_their_kind_and_set(spark, tmp_path):
    f = lambda *rows: spark.createDataFrame(list(rows), "kind string, label_set string, label_id string, value double")
    out = runs.write_fits(f(("gate", "m1", "a", 1.0), ("gate", "m1", "b", 2.0), ("gate", "m2", "a", 3.0)), f(("gate", "m1", "a", 9.0)), f"{tmp_path}/fits")
    assert sorted(map(tuple, out.collect())) == [("gate", "m1", "a", 9.0), ("gate", "m2", "a", 3.0)]


def test_batches_keep_both_bounds(spark):
    items = spark.createDataFrame([(f"q{i % 2}", f"s{i:04d}", "x" * (10 + i % 90)) for i in range(500)] + [("q0", "long", "x" * 900)], "question_sha string, state_sha string, state string")
    got = runs.ask_batches(items, 7, 300, spread=3).join(items, ["question_sha", "state_sha"])
    sizes = got.groupBy("batch").agg(F.count("*").alias("n"), F.sum(F.length("state")).alias("c"), F.countDistinct("question_sha").alias("q")).collect()
    assert got.count() == 501 and all(r.q == 1 and r.n <= 7 and (r.c <= 300 or r.n == 1) for r in sizes)


def test_derived_tables(spark, tmp_path):
    units = spark.createDataFrame([("u1", "d", 6, 9, 0, 4), ("u2", "d", 0, 4, None, None)], "unit_id string, document_id string, char_start int, char_end int, lead_start int, lead_end int")
    texts = spark.createDataFrame([("d", "lead: own.")], "document_id string, text string")
    assert {r.unit_id: r.text for r in runs.unit_rows(units, texts).collect()} == {"u1": "lead\nown", "u2": "lead"}
    documents = spark.createDataFrame([("d", ["P1", "P2"]), ("e", ["P3"])], "document_id string, project_ids array<string>")
    parts = spark.createDataFrame([("d", ["P2"]), ("d", ["P9", "P2"])], "document_id string, project_ids array<string>")
    assert {r.document_id: (r.project_ids, r.listed_project_ids) for r in runs.document_owners(documents, parts).collect()} == {"d": (["P2", "P9"], ["P1", "P2"]), "e": (["P3"], ["P3"])}
    raw = spark.createDataFrame([("1.0", "", "x")], "a string, b string, c string")
    assert [tuple(r) for r in runs.schema_columns(raw, {"a": "n", "b": "note", "z": "none"}, {"n": "integer"}).collect()] == [(1, None)]
    runs.scratch_files(spark, f"{tmp_path}/s", "roads", {"name": "Roads", "definition": "d"}, ["a", "b"], ["w"])
    assert spark.read.csv(f"{tmp_path}/s/roads_queries", header=True).count() == 2
    assert runs.brief({"raw": raw}) == ["raw: 1 rows"]


def test_working_tables_are_written_once(spark):
    df = spark.range(10).withColumn("x", F.rand())
    one = working.written(df, "t")
    assert sorted(one.collect()) == sorted(one.collect()) and one.columns == df.columns


def test_command_line(capsys):
    assert command.main(["list"]) == 0 and "package_status" in capsys.readouterr().out


def test_label_files(spark, tmp_path):
    (tmp_path / "roads.csv").write_text('roads_id,roads_name,definition,active,family\nr1,Roads,"all  of\nthem",TRUE,climate\nr2,Paths,few,false,\n')
    (tmp_path / "roads_patterns.csv").write_text("label_id,pattern_id,pattern,flags,active\nr1,w1,\\broads?\\b,,true\nr1,w2,UPS,CASE_SENSITIVE,true\nr1,w3,x,,false\n")
    (tmp_path / "bad_patterns.csv").write_text("label_id,pattern_id,pattern,flags,active\nr1,w1,(,,true\n")
    got = [tuple(r) for r in readers.load_set(spark, str(tmp_path), "roads").orderBy("label_id").collect()]
    assert got == [("r1", "Roads", "all of them", True, "climate", "roads"), ("r2", "Paths", "few", False, "", "roads")]
    assert [(r.pattern_id, r.case_sensitive) for r in readers.load_patterns(spark, str(tmp_path), "roads").orderBy("pattern_id").collect()] == [("w1", False), ("w2", True)]
    assert readers.load_types(spark, str(tmp_path), "roads").count() == 0 and readers.load_patterns(spark, str(tmp_path), "none").count() == 0
    with pytest.raises(ValueError):
        readers.load_patterns(spark, str(tmp_path), "bad")


def test_views_are_made_in_order_and_a_failure_is_named(spark):
    panel = readers.Panel({"floor.default": "0.8"})
    files = {"02_b.sql": "CREATE OR REPLACE TEMP VIEW b_view AS SELECT x + 1 AS y FROM a_view;\n", "01_a.sql": "-- first\nCREATE OR REPLACE TEMP VIEW a_view AS SELECT {{panel:floor.default}} AS x;\n"}
    assert readers.apply_views(spark, panel, files) == ["01_a.sql", "02_b.sql"]
    assert float(spark.table("b_view").first()["y"]) == 1.8
    with pytest.raises(RuntimeError, match="03_c"):
        readers.apply_views(spark, panel, {"03_c.sql": "SELECT * FROM no_such_table"})
