"""Each registered query against its SQL on the smallest data."""

import os

import pytest

from loomwork.plans import registry

from . import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, connection, name):
    oracle.check(registry.QUERIES[name](spark, SF), registry.ORACLE_SQL[name], connection)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql(spark, name):
    assert registry.QUERIES[name](spark, SF).count() >= 0


def _with(folder, table, rows):
    """The smallest data with `rows` (a SELECT over its tables) in place of one table."""
    for t in oracle.TABLES:
        if t != table and os.path.exists(f"{SF}/{t}.parquet"):
            os.symlink(f"{SF}/{t}.parquet", folder / f"{t}.parquet")
    oracle.connect(SF).execute(f"COPY ({rows}) TO '{folder / table}.parquet' (FORMAT parquet)")
    return str(folder)


def test_places_of_long_package_ids(spark, tmp_path):
    """Ids of up to 13 digits that differ in the last ones only, one of them null: each has its own place."""
    sf = _with(tmp_path, "orders", "SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1234567890000 WHEN o_orderkey % 3 = 1 THEN o_orderkey * 1009 ELSE nullif(o_orderkey, 2) END AS o_orderkey, * EXCLUDE (o_orderkey) FROM orders")
    oracle.check(registry.QUERIES["commitment_pairs"](spark, sf), registry.ORACLE_SQL["commitment_pairs"], oracle.connect(sf))


def test_short_texts_of_odd_words(spark, tmp_path):
    """Words of Roman letters, what looks like a title, and white space outside ASCII."""
    texts = ["Ci.", "Vi. ", "CC\n", "ll", "I. BACKGROUND", "VI. DE ES.", "Annex 2: Costs", "annexes", "a\xa0b\xa0c\xa0d\xa0e", "a\x0bb\x0bc\x0bd\x0be", "a b c　d e", "a b c d e", "a\tb\fc\rd\ne", "", " ", "\U0001f926\U0001f3fc é", "Ci. de la en un"]
    each = ", ".join("'" + x + "'" for x in texts)
    sf = _with(tmp_path, "documents", f"SELECT doc_id, coalesce([{each}][doc_id + 1], text) AS text, * EXCLUDE (doc_id, text) FROM documents")
    oracle.check(registry.QUERIES["short_units"](spark, sf), registry.ORACLE_SQL["short_units"], oracle.connect(sf))
