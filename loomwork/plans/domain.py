"""The domain tables over the driver's data.

Each table is one SELECT that Spark SQL and DuckDB read alike, so that a query and its oracle start from the
same rows: Spark runs it over temporary views, an oracle has it as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels", "conversations")
AS_OF = "1998-06-01"

#: In order of dependence.
TABLES: dict[str, str] = {
    "projects": """
SELECT 'P' || CAST(c_custkey AS STRING) AS project_id, CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS project_name,
       CASE WHEN c_custkey % 5 = 0 THEN 'contributor' ELSE 'core' END AS cohort_set, CASE WHEN c_acctbal < 0 THEN 'Closed' ELSE 'Active' END AS status,
       CAST(CAST('1995-01-01' AS DATE) + CAST(c_custkey % 1500 AS INT) AS DATE) AS approval_date, CAST(1995 + c_custkey % 6 AS INT) AS approval_fiscal_year,
       CASE WHEN c_custkey % 7 <> 0 THEN CAST(CAST('1997-01-01' AS DATE) + CAST(c_custkey % 1400 AS INT) AS DATE) END AS closing_date,
       CASE WHEN c_custkey % 13 <> 0 THEN r_name END AS region,
       CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '3E' WHEN n_nationkey = 3 THEN 'zr' ELSE lower(substring(n_name, 1, 2)) END AS country_code,
       CASE WHEN c_custkey % 13 <> 0 THEN n_name END AS country_name,
       CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN 'Development Policy Lending' ELSE 'Investment Project Financing' END AS lending_instrument,
       c_acctbal AS commitment_usd_millions, c_mktsegment AS practice, 'unit ' || CAST(c_custkey % 9 AS STRING) AS managing_unit
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "packages": """
SELECT 'K' || CAST(o_orderkey AS STRING) AS package_id, 'P' || CAST(o_custkey AS STRING) AS project_id, 'REF-' || CAST(o_orderkey % 700 AS STRING) AS borrower_ref_norm,
       'supply of item ' || CAST(o_orderkey % 37 AS STRING) || ' for ' || lower(o_orderpriority) AS description_clean, 'supplyofitem' || CAST(o_orderkey % 3 AS STRING) AS description_match,
       CASE WHEN o_orderkey % 5 = 0 THEN 'Goods' WHEN o_orderkey % 5 = 1 THEN 'Works' ELSE 'Consulting' END AS category, substring(o_orderpriority, 1, 1) AS method_code,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) END AS estimated_amount_usd,
       CAST(o_orderdate AS DATE) AS planned_date, CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 45 AS DATE) END AS revised_date,
       CASE WHEN o_orderkey % 23 = 0 THEN 'Terminated' WHEN o_orderkey % 19 = 0 THEN 'Completed' WHEN o_orderkey % 17 = 0 THEN 'Under Implementation' WHEN o_orderstatus = 'F' THEN 'Signed' WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'Pending' ELSE 'Under Review' END AS status,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 6 <> 0 END AS in_latest_plan,
       CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey % 4 + 1 AS STRING) END AS component_number, 'component ' || CAST(o_orderkey % 4 + 1 AS STRING) AS component_name
FROM orders""",
    "notices": """
SELECT 'N' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS notice_id, CASE WHEN l_partkey % 9 <> 0 THEN 'K' || CAST(l_orderkey AS STRING) END AS package_id,
       'P' || CAST(o_custkey AS STRING) AS project_id, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'REF-' || CAST((o_orderkey + l_linenumber % 2) % 700 AS STRING) END AS borrower_ref_norm, 'supplyofitem' || CAST(l_partkey % 3 AS STRING) AS description_match,
       CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END AS publication_date, CASE WHEN l_partkey % 6 <> 0 THEN CAST(CAST(l_shipdate AS DATE) + 40 AS DATE) END AS deadline_date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O'""",
    "awards": """
SELECT 'A' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS award_id, CASE WHEN l_partkey % 8 <> 0 THEN 'K' || CAST(l_orderkey AS STRING) END AS package_id,
       'P' || CAST(o_custkey AS STRING) AS project_id, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'REF-' || CAST((o_orderkey + l_linenumber % 2) % 700 AS STRING) END AS borrower_ref_norm, 'supplyofitem' || CAST(l_partkey % 3 AS STRING) AS description_match,
       CASE WHEN l_partkey % 10 <> 0 THEN CAST(l_shipdate AS DATE) END AS signed_date, 'supplier ' || CAST(l_suppkey AS STRING) AS supplier_name, CAST(round(l_extendedprice) AS BIGINT) AS total_amount_usd
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
    "docs": """
SELECT 'D' || CAST(d AS STRING) AS document_id, CASE WHEN d % 3 = 0 THEN 'Project Paper' ELSE 'Project Appraisal Document' END AS document_type, 'kind ' || CAST(d % 3 AS STRING) AS document_kind, 'title ' || CAST(d % 40 AS STRING) AS title,
       CASE WHEN d % 10 <> 0 THEN CAST(CAST('1996-01-01' AS DATE) + CAST(d % 60 AS INT) * 7 AS DATE) END AS disclosure_date, CASE WHEN d % 2 = 0 THEN 'http://x.example/' ELSE 'https://x.example/' END || CAST(d AS STRING) AS pdf_url,
       'P' || CAST(d % 50 + 1 AS STRING) AS project_1, CASE WHEN d % 6 = 0 THEN 'P' || CAST((d + 7) % 50 + 1 AS STRING) END AS project_2
FROM (SELECT DISTINCT doc_id - doc_id % 10 AS d FROM documents) t""",
    "document_projects": """
SELECT document_id, project_1 AS project_id FROM docs UNION ALL SELECT document_id, project_2 FROM docs WHERE project_2 IS NOT NULL""",
    "paragraphs": """
SELECT 'G' || CAST(g AS STRING) AS paragraph_id, 'D' || CAST(g - g % 10 AS STRING) AS document_id, t.text, 'section ' || CAST(g % 7 AS STRING) AS section_title, CASE WHEN g % 20 = 0 THEN 'annex' ELSE 'narrative' END AS block,
       CASE WHEN g % 4 = 0 THEN NULL ELSE CAST(g % 4 AS STRING) END AS component_number, CASE WHEN g % 4 = 0 THEN NULL ELSE 'component ' || CAST(g % 4 AS STRING) END AS component_name, CASE WHEN g % 12 = 5 THEN CAST(g % 4 AS STRING) || '.1' ELSE '' END AS subcomponent_number, CASE WHEN g % 12 = 5 THEN 'part' ELSE '' END AS subcomponent_name, CASE WHEN g % 9 <> 0 THEN CAST(g % 30 AS INT) END AS page_from
FROM (SELECT doc_id - doc_id % 5 AS g, concat_ws(' ', max(CASE WHEN doc_id % 5 = 0 THEN text END), max(CASE WHEN doc_id % 5 = 1 THEN text END), max(CASE WHEN doc_id % 5 = 2 THEN text END), max(CASE WHEN doc_id % 5 = 3 THEN text END), max(CASE WHEN doc_id % 5 = 4 THEN text END)) AS text FROM documents GROUP BY doc_id - doc_id % 5) t""",
    "paragraph_projects": """
SELECT p.paragraph_id, p.document_id, x.project_id FROM paragraphs p JOIN document_projects x ON x.document_id = p.document_id""",
    "units": """
SELECT 'U' || CAST(doc_id AS STRING) AS unit_id, doc_id AS n, 'sentence' AS unit_kind, 'G' || CAST(doc_id - doc_id % 5 AS STRING) AS paragraph_id, 'D' || CAST(doc_id - doc_id % 10 AS STRING) AS document_id, text,
       CAST(doc_id % 5 AS INT) AS ordinal, CAST((doc_id % 5) * 13 AS INT) AS text_start, CAST((doc_id % 5) * 13 + 20 AS INT) AS text_end
FROM documents""",
    "label_sets": """
SELECT 'm' || CAST(k AS STRING) AS label_set, 'l' || CAST(k AS STRING) AS label_id, 'measure ' || CAST(k AS STRING) AS label_name, CASE WHEN k % 2 = 0 THEN 'climate' ELSE 'cloud' END AS family, k <> 5 AS is_active FROM (SELECT DISTINCT label % 6 AS k FROM embeddings) t
UNION ALL SELECT 'assets', 'a' || CAST(k AS STRING), 'asset ' || CAST(k AS STRING), '', true FROM (SELECT DISTINCT label AS k FROM embeddings) t""",
    "findings": """
SELECT f.*, u.unit_kind, u.paragraph_id, u.document_id, u.text FROM (
  SELECT 'm' || CAST((doc_id + j) % 5 AS STRING) AS label_set, 'l' || CAST((doc_id + j) % 5 AS STRING) AS label_id, 'U' || CAST(doc_id AS STRING) AS unit_id,
         doc_id % 11 <> 0 AS was_sent, CAST((doc_id * 37 + j * 101) % 1000 AS DOUBLE) / 1000 AS probability, (doc_id * 37 + j * 101) % 1000 >= 400 AS is_committed,
         CASE (doc_id + j) % 4 WHEN 0 THEN NULL WHEN 1 THEN 'paragraph' ELSE 'unit' END AS asset_level, CASE WHEN (doc_id + j) % 4 <> 0 THEN 'a' || CAST(doc_id % 6 AS STRING) END AS asset_1, CASE WHEN (doc_id + j) % 4 = 2 THEN 'a' || CAST((doc_id + 3) % 6 AS STRING) END AS asset_2,
         CASE WHEN doc_id % 3 <> 0 THEN 't' || CAST(doc_id % 4 AS STRING) END AS type_1, CASE WHEN doc_id % 9 = 1 THEN 't' || CAST((doc_id + 2) % 4 AS STRING) END AS type_2,
         CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'componentname' || CAST(doc_id % 4 AS STRING) END AS component_key, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 4 AS STRING) END AS component_number
  FROM documents CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2) k WHERE j = 0 OR (doc_id + j) % 3 = 0
) f JOIN units u ON u.unit_id = f.unit_id""",
    "pair_checks": """
SELECT 'U' || CAST(doc_id AS STRING) AS unit_id, 'm' || CAST(doc_id % 5 AS STRING) AS set_a, 'm' || CAST((doc_id + 1) % 5 AS STRING) AS set_b, CAST((doc_id * 53) % 100 AS DOUBLE) / 100 AS p_keep_a, CAST((doc_id * 71) % 100 AS DOUBLE) / 100 AS p_keep_b
FROM documents""",
    "commitment_packages": """
SELECT f.label_set, f.label_id, f.unit_id, x.project_id, p.package_id, CAST((u.n * 31 + length(p.package_id) * 17) % 100 AS DOUBLE) / 100 AS probability
FROM findings f JOIN units u ON u.unit_id = f.unit_id JOIN paragraph_projects x ON x.paragraph_id = f.paragraph_id JOIN packages p ON p.project_id = x.project_id
WHERE f.is_committed AND f.was_sent AND p.component_number = f.component_number""",
    "components": """
SELECT 'C' || CAST(p_partkey AS STRING) AS component_id, 'P' || CAST(p_partkey % 50 + 1 AS STRING) AS project_id, 'D' || CAST((p_partkey % 90) * 10 AS STRING) AS document_id, CASE WHEN p_partkey % 3 = 0 THEN 'heading' WHEN p_partkey % 31 = 1 THEN 'restructuring' ELSE 'datasheet' END AS read_from,
       CASE WHEN p_partkey % 10 <> 0 THEN CAST(CAST('1996-01-01' AS DATE) + CAST(p_partkey % 90 AS INT) * 7 AS DATE) END AS disclosure_date, CASE WHEN p_partkey % 4 = 0 THEN 'subcomponent' ELSE 'component' END AS component_level,
       CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey % 5 + 1 AS STRING) END AS component_number, p_name AS component_name, 'componentname' || CAST(p_partkey % 4 AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN 'long' ELSE '' END AS name_key,
       CASE WHEN p_partkey % 3 = 1 THEN CAST(round(p_retailprice) AS BIGINT) END AS cost, CASE WHEN p_partkey % 31 = 1 THEN 'Marked for Deletion' END AS action
FROM part""",
    "unit_assets": """
SELECT unit_id, paragraph_id, 'a' || CAST(n % 6 AS STRING) AS asset_id, CASE n % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'paragraph' ELSE 'unit' END AS asset_level, CAST((n * 41) % 1000 AS DOUBLE) / 1000 AS probability FROM units
UNION ALL SELECT unit_id, paragraph_id, 'a' || CAST((n + 2) % 6 AS STRING), 'unit', CAST((n * 43) % 1000 AS DOUBLE) / 1000 FROM units WHERE n % 3 = 0""",
    "asset_scores": """
SELECT unit_id, paragraph_id, ordinal, 'a' || CAST(k AS STRING) AS asset_id, CAST((n * (37 + k)) % 1000 AS DOUBLE) / 1000 AS p FROM units CROSS JOIN (SELECT DISTINCT label AS k FROM embeddings) t""",
    "grades": """
SELECT doc_id AS item_id, quality AS y, CAST((doc_id * 61) % 1000 AS DOUBLE) / 1000 AS p, CAST(1 + doc_id % 4 AS DOUBLE) AS w, doc_id % 7 AS stratum FROM labels""",
    "answers": """
SELECT event_id, user_id, event_type AS stage, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 1000 AS DOUBLE) / 1000 END AS p, CAST(round(value * 100) AS BIGINT) AS cost, ts FROM events""",
    "measure_quality": """
SELECT 'm' || CAST(user_id % 6 AS STRING) AS label_set, CASE WHEN event_id % 3 = 0 THEN 'evaluation' ELSE 'training' END AS sheet, event_id AS graded_units, ts AS evaluated_at FROM events""",
}

#: What each table reads, for the oracles' common table expressions.
NEEDS: dict[str, tuple[str, ...]] = {
    "document_projects": ("docs",),
    "paragraph_projects": ("paragraphs", "document_projects"),
    "findings": ("units",),
    "commitment_packages": ("findings", "units", "paragraph_projects", "packages"),
    "unit_assets": ("units",),
    "asset_scores": ("units",),
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw and the domain tables as DataFrames; nothing runs until they are read."""
    out = {}
    for name in RAW:
        out[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        out[name].createOrReplaceTempView(name)
    for name, sql in TABLES.items():
        out[name] = spark.sql(sql)
        out[name].createOrReplaceTempView(name)
    return out


def oracle(sql: str, *names: str) -> str:
    """`sql` (a SELECT, or further CTEs and a SELECT after a leading comma) with the domain tables it names."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in NEEDS.get(name, ()):
            add(x)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    body = sql.strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in order)
    return f"WITH {ctes}{body}" if body.startswith(",") else f"WITH {ctes}\n{body}"
