"""The domain tables hold all rows of the tables that they map."""

import os

import pytest
from pyspark.sql import functions as F

from loomwork.operators import linking
from loomwork.plans import domain

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def t(spark):
    return domain.tables(spark, SF)


def test_notices_and_awards_are_all_lines_of_their_status(t):
    lines = t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
    assert t["notices"].count() == lines.where("l_linestatus = 'O'").count() > 0
    assert t["awards"].count() == lines.where("l_returnflag = 'R'").count() > 0


def test_records_that_share_an_id_share_their_candidates(spark):
    records = spark.createDataFrame([("n1", "P1", "R1", "d"), ("n1", "P1", "R1", "d"), ("n2", "P1", "R1", "d")], "notice_id string, project_id string, borrower_ref_norm string, description_match string").withColumn("package_id", F.lit(None).cast("string"))
    packages = spark.createDataFrame([("K1", "P1", "R1", "e")], "package_id string, project_id string, borrower_ref_norm string, description_match string")
    got = sorted((r.notice_id, r.package_id, r.package_link) for r in linking.link_records(records, packages, "notice_id").collect())
    assert got == [("n1", None, "ambiguous")] * 2 + [("n2", "K1", "reference")]


def test_paragraphs_hold_the_text_of_all_documents(t):
    texts = {r.doc_id: r.text for r in t["documents"].select("doc_id", "text").collect()}
    got = {int(r.paragraph_id[1:]): r.text for r in t["paragraphs"].select("paragraph_id", "text").collect()}
    assert got == {g: " ".join(texts[i] for i in range(g, g + 5) if texts.get(i) is not None) for g in {i - i % 5 for i in texts}}


def test_checks_qualities_and_scores_are_of_all_rows(t):
    assert t["pair_checks"].count() == t["documents"].count()
    assert t["measure_quality"].count() == t["events"].count()
    assert t["asset_scores"].count() == t["units"].count() * t["embeddings"].select("label").distinct().count()
