"""Links, search, decisions, evaluation, text and scalar operators over the domain tables, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import cleaning as CL
from ..operators import decisions as DC
from ..operators import evaluation as E
from ..operators import linking as L
from ..operators import relational as R
from ..operators import search as SE
from ..operators import text as T
from . import view_queries
from .view_queries import query

# Links

_CAND = "cand AS (SELECT r.{id} AS rid, count(p.package_id) AS n, min(p.package_id) AS one, count(p.package_id) FILTER (WHERE p.description_match = r.description_match AND p.description_match <> '') AS m, min(p.package_id) FILTER (WHERE p.description_match = r.description_match AND p.description_match <> '') AS same FROM {t} r LEFT JOIN packages p ON p.project_id = r.project_id AND p.borrower_ref_norm = r.borrower_ref_norm AND r.borrower_ref_norm <> '' GROUP BY 1)"
_LINK = "CASE WHEN coalesce(r.borrower_ref_norm, '') = '' THEN 'no_reference' WHEN c.n = 0 THEN 'not_in_plan' WHEN c.n = 1 THEN 'reference' WHEN c.m = 1 THEN 'reference_and_description' ELSE 'ambiguous' END"
_LINKED = f"SELECT r.* EXCLUDE (package_id), CASE {_LINK} WHEN 'reference' THEN c.one WHEN 'reference_and_description' THEN c.same END AS package_id, {_LINK} AS package_link"


@query(f", {_CAND.format(id='notice_id', t='notices')} {_LINKED} FROM notices r JOIN cand c ON c.rid = r.notice_id", "notices", "packages")
def links_outcome(t):
    return L.link_records(t["notices"], t["packages"], "notice_id")


@query(
    f""", {_CAND.format(id="notice_id", t="notices")}, n AS ({_LINKED} FROM notices r JOIN cand c ON c.rid = r.notice_id), {_CAND.format(id="award_id", t="awards").replace("cand AS", "cand2 AS")}, a AS ({_LINKED} FROM awards r JOIN cand2 c ON c.rid = r.award_id)
SELECT a.*, coalesce((SELECT string_agg(DISTINCT n.notice_id, '|' ORDER BY n.notice_id) FROM n WHERE n.project_id = a.project_id AND n.borrower_ref_norm = a.borrower_ref_norm AND a.borrower_ref_norm <> '' AND CASE WHEN a.package_id IS NULL THEN n.package_link <> 'ambiguous' ELSE n.package_id IS NULL OR n.package_id = a.package_id END), '') AS notice_ids FROM a""",
    "notices", "awards", "packages",
)
def award_notice_ids(t):
    n = L.link_records(t["notices"], t["packages"], "notice_id")
    return L.award_notices(L.link_records(t["awards"], t["packages"], "award_id"), n)


_VERSIONS = "v AS (SELECT project_id, borrower_ref_norm, planned_date AS disclosed, package_id AS plan_version, status FROM packages)"


@query(f", {_VERSIONS} SELECT project_id, borrower_ref_norm, disclosed, plan_version, status, coalesce(disclosed = max(disclosed) OVER (PARTITION BY project_id), false) AS in_latest_plan FROM v QUALIFY row_number() OVER (PARTITION BY project_id, borrower_ref_norm ORDER BY disclosed DESC NULLS LAST, plan_version DESC) = 1", "packages")
def latest_version(t):
    v = t["packages"].select("project_id", "borrower_ref_norm", F.col("planned_date").alias("disclosed"), F.col("package_id").alias("plan_version"), "status")
    return L.latest_versions(v, ["project_id", "borrower_ref_norm"], "project_id", "disclosed", "plan_version")[0]


@query(f", {_VERSIONS}, r AS (SELECT *, row_number() OVER w AS k, first_value(plan_version) OVER w AS superseded_by FROM v WINDOW w AS (PARTITION BY project_id, borrower_ref_norm ORDER BY disclosed DESC NULLS LAST, plan_version DESC)) SELECT * EXCLUDE (k) FROM r WHERE k > 1", "packages")
def superseded_versions(t):
    v = t["packages"].select("project_id", "borrower_ref_norm", F.col("planned_date").alias("disclosed"), F.col("package_id").alias("plan_version"), "status")
    return L.latest_versions(v, ["project_id", "borrower_ref_norm"], "project_id", "disclosed", "plan_version")[1]


_PLAN = "pl AS (SELECT 'P' || CAST(o_custkey % 40 AS VARCHAR) AS project_id, 'v' || CAST(o_orderkey % 3 AS VARCHAR) AS plan_version, 'R' || CAST(o_orderkey % 25 AS VARCHAR) AS borrower_ref_norm, 'd' || CAST(o_orderkey % 2 AS VARCHAR) AS description_match, o_orderkey % 7 AS amount, CAST(o_orderkey AS BIGINT) AS package_version_id FROM orders)"


@query(
    "WITH " + _PLAN + """, d AS (SELECT * FROM pl QUALIFY row_number() OVER (PARTITION BY project_id, plan_version, borrower_ref_norm, description_match, amount ORDER BY package_version_id) = 1),
s AS (SELECT DISTINCT project_id, borrower_ref_norm FROM (SELECT project_id, plan_version, borrower_ref_norm FROM d GROUP BY ALL HAVING count(*) > 1)),
b AS (SELECT d.*, d.project_id || ':' || d.borrower_ref_norm || CASE WHEN s.project_id IS NOT NULL THEN ':' || substring(sha256(d.description_match), 1, 8) ELSE '' END AS base FROM d LEFT JOIN s USING (project_id, borrower_ref_norm)),
k AS (SELECT *, row_number() OVER (PARTITION BY plan_version, base ORDER BY package_version_id) AS nth FROM b)
SELECT project_id, plan_version, borrower_ref_norm, description_match, amount, package_version_id, base || CASE WHEN nth > 1 THEN ':' || CAST(nth AS VARCHAR) ELSE '' END AS package_id FROM k""",
)
def package_keys(t):
    k = F.col("o_orderkey")
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    plan = t["orders"].select(s("P", F.col("o_custkey") % 40).alias("project_id"), s("v", k % 3).alias("plan_version"), s("R", k % 25).alias("borrower_ref_norm"), s("d", k % 2).alias("description_match"), (k % 7).alias("amount"), k.cast("bigint").alias("package_version_id"))
    return L.package_keys(plan)


@query(
    """, s AS (SELECT package_id, max(signed_date) AS signed FROM awards WHERE package_id IS NOT NULL AND signed_date IS NOT NULL GROUP BY 1),
e AS (SELECT p.package_id, p.planned_date AS disclosed, p.status, CASE WHEN p.status IN ('Signed', 'Completed', 'Terminated') THEN NULL ELSE s.signed END AS signed FROM packages p LEFT JOIN s USING (package_id))
SELECT package_id, disclosed, CASE WHEN signed IS NOT NULL AND (status IS NULL OR signed >= disclosed) THEN 'Signed' ELSE coalesce(status, 'unknown') END AS status,
  CASE WHEN signed IS NOT NULL AND (status IS NULL OR signed >= disclosed) THEN 'award' WHEN status IS NOT NULL THEN 'plan' END AS status_source, CASE WHEN signed IS NOT NULL AND (status IS NULL OR signed >= disclosed) THEN signed WHEN status IS NOT NULL THEN disclosed END AS status_as_of FROM e""",
    "packages", "awards",
)
def resolved_status(t):
    return L.resolve_status(t["packages"].select("package_id", F.col("planned_date").alias("disclosed"), "status"), t["awards"])


# Search

_VEC = "vec AS (SELECT 'V' || CAST(vec_id AS VARCHAR) AS unit_id, CAST(embedding AS DOUBLE[]) AS e, vec_id, label FROM embeddings), qs AS (SELECT 'Q' || CAST(vec_id AS VARCHAR) AS query_id, 'l' || CAST(label % 3 AS VARCHAR) AS label_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1), sc AS (SELECT unit_id, query_id, label_id, round(list_inner_product(vec.e, qs.e), 6) AS cosine FROM vec, qs), pc AS (SELECT *, 100.0 * cume_dist() OVER (PARTITION BY query_id ORDER BY cosine) AS percentile FROM sc)"


def _vectors(t):
    units = t["embeddings"].select(F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("unit_id"), "embedding", "vec_id", F.concat(F.lit("G"), F.floor(F.col("vec_id") / 7).cast("string")).alias("paragraph_id"), F.concat(F.lit("P"), (F.col("vec_id") % 23).cast("string")).alias("project_id"))
    q = R.first_per_key(t["embeddings"], ["label"], [F.col("vec_id").asc()]).select(F.concat(F.lit("Q"), F.col("vec_id").cast("string")).alias("query_id"), F.concat(F.lit("l"), (F.col("label") % 3).cast("string")).alias("label_id"), "embedding")
    return units, q


@query(f"WITH {_VEC} SELECT * FROM sc")
def cosine_scores(t):
    return SE.query_cosines(*_vectors(t))


@query(f"WITH {_VEC} SELECT unit_id, query_id, label_id, cosine, round(percentile, 9) AS percentile FROM pc")
def percentile_within_query(t):
    return SE.with_percentiles(SE.query_cosines(*_vectors(t))).withColumn("percentile", F.round("percentile", 9))


_HITS = f"{_VEC}, hb AS (SELECT label_id, unit_id, max(cosine) AS score, arg_min(query_id, (-cosine, query_id)) AS query_id, max(percentile) AS percentile, count(*) FILTER (WHERE percentile >= 90) AS queries_agree FROM pc GROUP BY 1, 2), hr AS (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY score DESC, unit_id) AS rank FROM hb WHERE score >= 0.1 AND percentile >= 90)"


@query(f"WITH {_HITS} SELECT * REPLACE (round(percentile, 9) AS percentile) FROM hr WHERE rank <= 40")
def cosine_hits(t):
    return SE.hits(SE.query_cosines(*_vectors(t)), min_score=0.1, min_percentile=90, top=40).withColumn("percentile", F.round("percentile", 9))


@query(f"WITH {_HITS}, g AS (SELECT hr.*, 'G' || CAST(vec_id // 7 AS VARCHAR) AS paragraph_id FROM hr JOIN vec USING (unit_id)) SELECT label_id, paragraph_id, max(score) AS best_score, arg_min(unit_id, (-score, rank)) AS best_unit_id, arg_min(query_id, (-score, rank)) AS best_query_id, round(max(percentile), 9) AS best_percentile, count(*) AS units_hit FROM g GROUP BY 1, 2")
def paragraph_rollup(t):
    units, q = _vectors(t)
    found = SE.hits(SE.query_cosines(units, q), min_score=0.1, min_percentile=90)
    return SE.paragraph_rollup(found, units).withColumn("best_percentile", F.round("best_percentile", 9))


_NEAR = f"{_VEC}, nn AS (SELECT s.unit_id AS seed_id, u.unit_id, round(1 - round(list_inner_product(u.e, s.e), 6), 6) AS distance FROM vec s, vec u WHERE s.vec_id % 100 = 0 AND s.unit_id <> u.unit_id), nr AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY distance, unit_id) AS rank FROM nn)"


@query(f"WITH {_NEAR} SELECT * FROM nr WHERE rank <= 20")
def similar_units(t):
    units, _ = _vectors(t)
    return SE.nearest_units(units, units.where("vec_id % 100 = 0"), 20)


@query(f"WITH {_NEAR}, p AS (SELECT nr.*, 'P' || CAST(vec_id % 23 AS VARCHAR) AS project_id FROM nr JOIN vec USING (unit_id) WHERE rank <= 60) SELECT project_id, round(1 - min(distance), 6) AS closeness, count(DISTINCT unit_id) AS close_units FROM p WHERE project_id <> 'P0' GROUP BY 1 ORDER BY closeness DESC, project_id LIMIT 6")
def similar_projects(t):
    units, _ = _vectors(t)
    return SE.similar_projects(SE.nearest_units(units, units.where("vec_id % 100 = 0"), 60), units.select("unit_id", "project_id"), "P0", 6)


# Decisions


@query(", fl AS (SELECT 'm1' AS label_set, 0.9 AS floor UNION ALL SELECT 'm2', 0.5) SELECT f.label_set, f.unit_id, f.probability AS score, f.probability >= coalesce(fl.floor, 0.8) AS committed, f.probability >= 0.73 AS asked_yes, round(f.probability, 4) AS posterior FROM findings f LEFT JOIN fl USING (label_set)", "findings")
def committed_units(t):
    f = t["findings"].select("label_set", "unit_id", F.col("probability").alias("score"))
    return DC.committed_units(f, f.sparkSession.createDataFrame([("m1", 0.9), ("m2", 0.5)], "label_set string, floor double"))


@query(
    """, o AS (SELECT unit_id, asset_id, p, 'unit' AS asset_level FROM asset_scores WHERE p >= 0.8),
d AS (SELECT a.unit_id, b.asset_id, round(sum(b.p * pow(0.4, a.ordinal - b.ordinal)), 9) AS s FROM (SELECT DISTINCT unit_id, paragraph_id, ordinal FROM asset_scores WHERE unit_id NOT IN (SELECT unit_id FROM o)) a JOIN asset_scores b ON b.paragraph_id = a.paragraph_id AND b.ordinal <= a.ordinal GROUP BY 1, 2),
w AS (SELECT * FROM o UNION ALL SELECT unit_id, asset_id, least(s, 1.0), 'paragraph' FROM d WHERE s >= 0.6),
r AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY p DESC, asset_id) AS k FROM w)
SELECT u.unit_id, coalesce(r.asset_level, 'none') AS asset_level, coalesce(r.k, 0) AS asset_rank, r.asset_id, r.p AS probability FROM (SELECT DISTINCT unit_id FROM asset_scores) u LEFT JOIN r USING (unit_id)""",
    "asset_scores",
)
def decayed_assets(t):
    return DC.sentence_assets(t["asset_scores"], 0.8, 0.4, 0.6, multiple=True)


_TS = "ts AS (SELECT 'U' || CAST(doc_id AS VARCHAR) AS unit_id, CASE WHEN k = 3 THEN 'OTH.x' ELSE 't' || CAST(k AS VARCHAR) END AS type_id, CAST((doc_id * (17 + 6 * k)) % 100 AS DOUBLE) / 100 AS p FROM documents, range(0, 4) r(k))"


def _type_scores(t):
    k = F.col("k")
    d = t["documents"].select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return d.select(F.concat(F.lit("U"), F.col("doc_id").cast("string")).alias("unit_id"), F.when(k == 3, "OTH.x").otherwise(F.concat(F.lit("t"), k.cast("string"))).alias("type_id"), ((F.col("doc_id") * (17 + 6 * k)) % 100).cast("double").alias("p")).withColumn("p", F.col("p") / 100)


@query(f"WITH {_TS}, y AS (SELECT *, type_id LIKE 'OTH.%' AS oth FROM ts WHERE p >= 0.7), z AS (SELECT *, bool_or(NOT oth) OVER (PARTITION BY unit_id) AS approved FROM y) SELECT unit_id, string_agg(type_id, '|' ORDER BY p DESC, type_id) AS types FROM z WHERE NOT (approved AND oth) GROUP BY 1")
def type_winners(t):
    return DC.type_winners(_type_scores(t), 0.7).withColumn("types", F.array_join("types", "|"))


@query(f"WITH {_TS}, y AS (SELECT *, type_id LIKE 'OTH.%' AS oth FROM ts WHERE p >= 0.7), z AS (SELECT *, bool_or(NOT oth) OVER (PARTITION BY unit_id) AS approved FROM y), m AS (SELECT unit_id, CASE WHEN type_id IN ('t0', 't1') THEN 't0' ELSE type_id END AS type_id, row_number() OVER (PARTITION BY unit_id ORDER BY p DESC, type_id) AS i FROM z WHERE NOT (approved AND oth)), f AS (SELECT unit_id, type_id, min(i) AS i FROM m GROUP BY 1, 2) SELECT unit_id, string_agg(type_id, '|' ORDER BY i) AS types FROM f GROUP BY 1")
def merged_types(t):
    w = DC.type_winners(_type_scores(t), 0.7)
    return DC.merge_types(w, w.sparkSession.createDataFrame([("t1", "t0")], "type_id string, merged string")).withColumn("types", F.array_join("types", "|"))


@query("SELECT unit_id, set_a, set_b, p_keep_a, p_keep_b, CASE WHEN p_keep_a >= 0.58 AND p_keep_b >= 0.58 THEN 'both' WHEN p_keep_a >= 0.58 THEN 'only_a' WHEN p_keep_b >= 0.58 THEN 'only_b' ELSE 'neither' END AS decision FROM pair_checks WHERE unit_id NOT LIKE '%7'", "pair_checks")
def pair_decisions(t):
    p = t["pair_checks"]
    sides = p.select("unit_id", "set_a", "set_b", F.explode(F.array(F.struct(F.lit("keep_a").alias("side"), F.col("p_keep_a").alias("p")), F.struct(F.lit("keep_b").alias("side"), F.col("p_keep_b").alias("p")))).alias("x")).select("unit_id", "set_a", "set_b", "x.side", "x.p")
    return DC.pair_decisions(sides.where("not (unit_id like '%7' and side = 'keep_b')"), 0.58)


@query("SELECT f.* EXCLUDE (asset_1, asset_2, type_1, type_2, text) FROM findings f WHERE NOT EXISTS (SELECT 1 FROM pair_checks c WHERE c.unit_id = f.unit_id AND ((c.set_a = f.label_set AND c.p_keep_a < 0.58) OR (c.set_b = f.label_set AND c.p_keep_b < 0.58)))", "findings", "pair_checks")
def pair_drop_anti(t):
    a = (F.col("r.set_a") == F.col("l.label_set")) & (F.col("r.p_keep_a") < 0.58)
    b = (F.col("r.set_b") == F.col("l.label_set")) & (F.col("r.p_keep_b") < 0.58)
    return R.anti_where(t["findings"].drop("asset_1", "asset_2", "type_1", "type_2", "text"), t["pair_checks"], (F.col("l.unit_id") == F.col("r.unit_id")) & (a | b))


@query("SELECT f.label_set, f.unit_id, f.probability, s.f AS floor FROM findings f CROSS JOIN (SELECT 0.7 AS f) s WHERE f.probability >= s.f", "findings")
def settings_cross(t):
    one = view_queries.V.settings_row(t["findings"].sparkSession, view_queries.S).select(F.col("package_link_min_probability").alias("floor"))
    return t["findings"].select("label_set", "unit_id", "probability").crossJoin(F.broadcast(one)).where("probability >= floor")


@query(
    f"WITH {_VEC}, pat AS (SELECT DISTINCT 'l' || CAST(label % 3 AS VARCHAR) AS label_id, unit_id FROM vec WHERE vec_id % 50 = 0), st AS (SELECT 'l0' AS label_id, unit_id FROM vec WHERE vec_id % 90 = 1), b AS (SELECT label_id, unit_id, max(cosine) AS cosine FROM sc GROUP BY 1, 2), k AS (SELECT b.*, (cosine >= 0.3 OR row_number() OVER (PARTITION BY label_id ORDER BY cosine DESC, unit_id) <= 25) AS near, EXISTS (SELECT 1 FROM pat WHERE pat.label_id = b.label_id AND pat.unit_id = b.unit_id) AS pt, EXISTS (SELECT 1 FROM st WHERE st.label_id = b.label_id AND st.unit_id = b.unit_id) AS so FROM b) SELECT label_id, unit_id, cosine, CASE WHEN near AND pt THEN 'both' WHEN pt THEN 'pattern' WHEN near THEN 'embedding' ELSE 'stored' END AS route FROM k WHERE near OR pt OR so"
)
def candidate_pool(t):
    units, q = _vectors(t)
    best = SE.query_cosines(units, q).groupBy("label_id", "unit_id").agg(F.max("cosine").alias("cosine"))
    v = units.join(t["embeddings"].select("vec_id", "label"), "vec_id")
    pat = v.where("vec_id % 50 = 0").select(F.concat(F.lit("l"), (F.col("label") % 3).cast("string")).alias("label_id"), "unit_id")
    return DC.candidate_pool(best, pat, v.where("vec_id % 90 = 1").select(F.lit("l0").alias("label_id"), "unit_id"), 0.3, 25)


@query("SELECT 'l1' AS label_id, unit_id, 'w1' AS pattern_id FROM units WHERE regexp_matches(text, '(^|[^a-zA-Z])licensed ([a-z ]*)under', 'i') UNION ALL SELECT 'l2', unit_id, 'w2' FROM units WHERE regexp_matches(text, 'CC BY')", "units")
def pattern_hits(t):
    p = t["units"].sparkSession.createDataFrame([("l1", "w1", "(^|[^a-zA-Z])licensed ([a-z ]*)under", False), ("l2", "w2", "CC BY", True)], "label_id string, pattern_id string, pattern string, case_sensitive boolean")
    return DC.pattern_hits(t["units"], p)


# Evaluation

_PR = "SELECT t.f AS floor, coalesce(sum(w) FILTER (WHERE p >= t.f), 0) AS kept, sum(w) FILTER (WHERE p >= t.f AND y = 1) / nullif(sum(w) FILTER (WHERE p >= t.f), 0) AS precision, coalesce(sum(w) FILTER (WHERE p >= t.f AND y = 1), 0) / nullif(sum(w) FILTER (WHERE y = 1), 0) AS recall FROM grades, t GROUP BY 1"


@query(f", t AS (SELECT unnest([0.3, 0.5, 0.6, 0.7, 0.8, 0.9]) AS f) {_PR}", "grades")
def weighted_pr(t):
    return E.weighted_pr(t["grades"], [0.3, 0.5, 0.6, 0.7, 0.8, 0.9])


@query(f", t AS (SELECT unnest(range(1, 100)) / 100.0 AS f), g AS ({_PR}), k AS (SELECT *, precision >= 0.85 AS good FROM g WHERE kept > 0) SELECT CAST(floor AS DOUBLE) AS floor, precision, recall FROM k ORDER BY good DESC, CASE WHEN good THEN recall ELSE precision END DESC, CASE WHEN good THEN -floor ELSE floor END LIMIT 1", "grades")
def suggested_floor(t):
    return E.suggest_floor(t["grades"], 0.85)


@query("SELECT round(sum(a.w * b.w * CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / sum(a.w * b.w), 9) AS auc FROM grades a, grades b WHERE a.y = 1 AND b.y = 0", "grades")
def weighted_auc(t):
    return E.weighted_auc(t["grades"]).withColumn("auc", F.round("auc", 9))


@query("SELECT sum(w) * sum(w) / sum(w * w) AS n FROM grades", "grades")
def effective_n(t):
    return t["grades"].agg(E.effective_n().alias("n"))


@query(
    ", y AS (SELECT p AS cosine, item_id % 5 = 0 AS pattern, w FROM grades WHERE y = 1), a AS (SELECT sum(w) AS total, count(*) AS n FROM y), e AS (SELECT cosine, sum(w) AS w FROM y WHERE NOT pattern GROUP BY 1), b AS (SELECT cosine, coalesce(sum(w) OVER (ORDER BY cosine ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM e) SELECT max(cosine) AS gate, round(max(below / total), 6) AS lost, any_value(n) AS n FROM b, a WHERE below / total <= 0.05 AND n >= 10 HAVING count(*) > 0",
    "grades",
)
def skip_gate(t):
    return E.skip_gate(t["grades"].where("y = 1").select(F.col("p").alias("cosine"), (F.col("item_id") % 5 == 0).alias("pattern"), "w"), max_loss=0.05)


_MEMBERS = "m AS (SELECT item_id AS item, 's' || CAST(stratum AS VARCHAR) AS stratum FROM grades UNION ALL SELECT item_id, 'y' || CAST(y AS VARCHAR) FROM grades), z AS (SELECT stratum, count(*) AS size FROM m GROUP BY 1), ch AS (SELECT item, max(least(1.0, CASE WHEN stratum = 'y0' THEN 30 ELSE 10 END / size)) AS chance FROM m JOIN z USING (stratum) GROUP BY 1)"


def _chances(t):
    s = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    m = t["grades"].select(F.col("item_id").alias("item"), s("s", "stratum").alias("stratum")).unionAll(t["grades"].select("item_id", s("y", "y")))
    return E.inclusion(m, {"y0": 30}, 10)


@query(f", {_MEMBERS} SELECT item, chance FROM ch", "grades")
def inclusion_chances(t):
    return _chances(t)


@query(f", {_MEMBERS}, x AS (SELECT *, CAST(('0x' || substring(sha256('draw-1' || chr(9) || CAST(item AS VARCHAR)), 1, 15)) AS BIGINT) / pow(16.0, 15) AS x FROM ch) SELECT item, chance, x, 1 / chance AS weight FROM x WHERE x < chance", "grades")
def permanent_draw(t):
    return E.draw(_chances(t), "draw-1")


@query("SELECT stage, count(*) AS n, count(p) AS answered, sum(cost) AS cost, sum(cost) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS cost_since FROM answers GROUP BY 1", "answers")
def spend_by_stage(t):
    return t["answers"].groupBy("stage").agg(F.count("*").alias("n"), F.count("p").alias("answered"), F.sum("cost").alias("cost"), F.sum(F.when(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"), F.col("cost"))).alias("cost_since"))


# Sinks' merges


@query("SELECT unit_id, p_keep_a FROM (SELECT unit_id, p_keep_a, 1 AS o FROM pair_checks WHERE p_keep_b < 0.5 UNION ALL SELECT unit_id, 0.0, 2 FROM pair_checks WHERE p_keep_b >= 0.3) QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY o DESC) = 1", "pair_checks")
def upsert_last_wins(t):
    p = t["pair_checks"]
    old = p.where("p_keep_b < 0.5").select("unit_id", "p_keep_a", F.lit(1).alias("o"))
    return R.upsert(old, p.where("p_keep_b >= 0.3").select("unit_id", F.lit(0.0).alias("p_keep_a"), F.lit(2).alias("o")), ["unit_id"], [F.col("o").desc()]).drop("o")


@query("SELECT unit_id, p_keep_a FROM pair_checks WHERE p_keep_b < 0.5 UNION ALL SELECT unit_id, 0.0 FROM pair_checks WHERE p_keep_b >= 0.5", "pair_checks")
def insert_if_absent(t):
    p = t["pair_checks"]
    return R.insert_absent(p.where("p_keep_b < 0.5").select("unit_id", "p_keep_a"), p.where("p_keep_b >= 0.3").select("unit_id", F.lit(0.0).alias("p_keep_a")), ["unit_id"])


# Text


@query(r", w AS (SELECT unit_id, document_id, regexp_replace(lower(text), '\s+', ' ', 'g') AS w FROM units), f AS (SELECT *, first_value(unit_id) OVER (PARTITION BY w ORDER BY document_id, unit_id) AS o FROM w) SELECT unit_id, nullif(o, unit_id) AS copy_of FROM f", "units")
def copies(t):
    return T.copies(t["units"])


@query(
    r""", u AS (SELECT unit_id, 'P' || CAST(n % 9 AS VARCHAR) AS project_id, regexp_replace(lower(text), '\s+', ' ', 'g') AS w, regexp_extract_all(lower(text), '\p{L}{2,}') AS ws FROM units),
x AS (SELECT w, count(DISTINCT project_id) - 1 AS template_projects FROM u GROUP BY 1),
s AS (SELECT DISTINCT unit_id, project_id, array_to_string(ws[i:i + 5], ' ') AS h FROM (SELECT *, unnest(range(1, len(ws) - 4)) AS i FROM u WHERE len(ws) >= 6)),
k AS (SELECT h FROM s GROUP BY 1 HAVING count(DISTINCT project_id) > 2), t AS (SELECT unit_id, count(*) AS hit FROM s SEMI JOIN k USING (h) GROUP BY 1)
SELECT u.unit_id, u.project_id, x.template_projects, CASE WHEN len(ws) >= 6 THEN round(coalesce(hit, 0) / (len(ws) - 5), 2) ELSE 0.0 END AS template_share FROM u JOIN x USING (w) LEFT JOIN t USING (unit_id)""",
    "units",
)
def template_share(t):
    return T.template_scores(t["units"].select("unit_id", F.concat(F.lit("P"), (F.col("n") % 9).cast("string")).alias("project_id"), "text"))


@query(", s AS (SELECT 'C' || CAST(conv_id AS VARCHAR) AS paragraph_id, turn AS ordinal, 'C' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS sentence_id, role <> 'user' AS list_item FROM conversations) SELECT *, CASE WHEN list_item THEN (SELECT arg_max(b.sentence_id, b.ordinal) FROM s b WHERE b.paragraph_id = s.paragraph_id AND b.ordinal < s.ordinal AND NOT b.list_item) END AS lead_in FROM s".replace(", s AS", "WITH s AS", 1))
def lead_ins(t):
    c, p = t["conversations"], F.concat(F.lit("C"), F.col("conv_id").cast("string"))
    one = R.first_per_key(c, ["conv_id", "turn"], [F.col("role").asc()])
    return T.lead_ins(one.select(p.alias("paragraph_id"), F.col("turn").alias("ordinal"), F.concat(p, F.lit(":"), F.col("turn").cast("string")).alias("sentence_id"), (F.col("role") != "user").alias("list_item")))


@query(None)
def audit_checks(t):
    return T.audit(t["units"])


@query("SELECT 'status' AS field, status AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, status NULLS LAST) AS rank, (SELECT count(DISTINCT status) FROM packages) AS distinct FROM packages GROUP BY status", "packages")
def value_profile(t):
    return T.value_profile(t["packages"], ["status"])


@query(r"WITH x AS (SELECT DISTINCT text FROM documents), w AS (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM x) SELECT word, count(*) AS n FROM w GROUP BY 1")
def vocabulary(t):
    return T.vocabulary(t["documents"])


# Scalars


@query(r"SELECT doc_id, trim(regexp_replace(upper(regexp_replace(text, '[^ -~]', '_', 'g')), '[^A-Z0-9]+', '-', 'g'), '-') AS ref, lower(regexp_replace(text, '[\s0-9]', '', 'g')) AS line, len(regexp_extract_all(text, '\S+')) AS tokens, regexp_replace(lower(text), '\s+', ' ', 'g') = lower(text) AS squeezed FROM documents")
def scalar_text(t):
    x = F.col("text")
    return t["documents"].select("doc_id", S.norm_ref(F.regexp_replace(x, "[^ -~]", "_")).alias("ref"), S.line_fingerprint(x).alias("line"), S.token_count(x).cast("bigint").alias("tokens"), (S.wording(x) == F.lower(x)).alias("squeezed"))


@query(
    """WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), y AS (SELECT *, strftime(d, '%Y-%m-%d') AS i, CASE WHEN day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d') END AS turned FROM x)
SELECT o_orderkey, i AS iso, i AS with_time, i AS named, CASE WHEN turned IS NULL THEN i ELSE '' END AS plain, i AS dmy, coalesce(turned, i) AS dmy_as_mdy, coalesce(turned, i) AS mdy_as_dmy, i AS mdy, CASE WHEN turned IS NULL THEN '' ELSE i END AS impossible, '20' || substring(i, 3) AS short_year, '' AS bad, CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INT) AS fiscal FROM y"""
)
def scalar_dates(t):
    d = F.col("o_orderdate")
    text = lambda form: F.date_format(d, form)
    impossible = F.concat(text("dd"), F.lit("/"), F.when(F.dayofmonth(d) > 12, F.lit("30")).otherwise(text("MM")), F.lit("/"), text("yyyy"))
    return t["orders"].select(
        "o_orderkey", S.iso_date(text("yyyy-MM-dd")).alias("iso"), S.iso_date(text("yyyy-MM-dd HH:mm:ss")).alias("with_time"), S.iso_date(text("d-MMM-yyyy")).alias("named"), S.iso_date(text("dd/MM/yyyy")).alias("plain"), S.iso_date(text("d.M.yyyy"), "dmy").alias("dmy"), S.iso_date(text("dd/MM/yyyy"), "mdy").alias("dmy_as_mdy"), S.iso_date(text("MM-dd-yyyy"), "dmy").alias("mdy_as_dmy"),
        S.iso_date(text("MM/dd/yyyy"), "mdy").alias("mdy"), S.iso_date(impossible, "dmy").alias("impossible"), S.iso_date(text("dd/MM/yy"), "dmy").alias("short_year"), S.iso_date(F.lit("31-Feb-2020")).alias("bad"), S.fiscal_year(d).alias("fiscal"),
    )


@query("SELECT o_orderkey, round(o_totalprice, 2) AS whole, round(floor(o_totalprice) / 10 * 1000000, 2) AS millions, CASE WHEN o_totalprice >= 10000 THEN floor(o_totalprice) / 1e6 ELSE floor(o_totalprice) END AS in_millions FROM orders")
def scalar_money(t):
    v = F.col("o_totalprice")
    tenth = F.concat(F.floor(v / 10).cast("string"), F.lit("."), (F.floor(v) % 10).cast("string"))
    return t["orders"].select("o_orderkey", S.money_in(F.concat(F.lit("a sum of US$ "), F.format_number(v, 2))).alias("whole"), S.money_in(F.concat(F.lit("USD "), tenth, F.lit(" million"))).alias("millions"), S.to_millions(F.format_number(F.floor(v), 0)).alias("in_millions"))


#: Texts with what is to be read from them, by hand.
FIRMNESS = (
    ("The project will upgrade roads", "activity"), ("Schools will be rehabilitated", "activity"), ("This will enable growth", "outcome"), ("Women are expected to benefit", "outcome"), ("A tower by the sea", "none"), ("(a) towers", "activity"),
    ("Access is to be financed in year two", "activity"), ("It will thereby reduce losses", "outcome"), ("Works supported by the project", "activity"), ("by enabling trade", "outcome"), ("Prices fell in 2019", "none"), ("The component finances vans", "activity"), ("", "none"),
)
PLACEHOLDERS = (
    ("Posterior Individual Open - National", True), ("To be determined.", True), ("N/A", True), ("Civil works", True), ("AB-UNIT-123456-GO-RFB", True), ("Pumps", True), ("Supply of pumps", False), ("", True), ("Recrutement d'un consultant", False), ("Single Stage - One Envelope", True), ("non consulting services", True), ("12 34 56", True),
    ("1.5 2.5 3.5 4.5 5.5 6.5 total", True), ("Works in five towns", False),
)
TABULAR = (("1,200 3,400 5,600 7,800 9,000 12 13 14", True), ("The works cost 12 million in five towns and more", False), ("12 34 56", False), ("Year 2019 2020 2021 2022 2023 2024", True), ("Roads 10% 20% 30% bridges tunnels harbours airports stations", False), ("", False))
LANGUAGES = (("Recrutement d un consultant", "fr"), ("Supply and installation of pumps", "en"), ("Construcción de obras para los servicios", "es"), ("Contratação da construção em obras", "pt"), ("pumps", "en"), ("", "en"), ("de", "en"), ("Travaux dans les villes", "fr"), ("el suministro con la bomba", "es"))


def _by_hand(cases: tuple) -> str:
    """The value of case number o_orderkey modulo their number."""
    return f"CASE o_orderkey % {len(cases)} " + " ".join(f"WHEN {i} THEN " + ("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()) for i, (_, v) in enumerate(cases)) + " END"


def _case_text(cases: tuple):
    return F.element_at(F.array(*[F.lit(x) for x, _ in cases]), (F.col("o_orderkey") % len(cases) + 1).cast("int"))


@query(f"SELECT o_orderkey, {_by_hand(FIRMNESS)} AS firmness, {_by_hand(PLACEHOLDERS)} AS placeholder, {_by_hand(TABULAR)} AS tabular, {_by_hand(LANGUAGES)} AS lang FROM orders")
def scalar_by_hand(t):
    return t["orders"].select("o_orderkey", S.firmness(_case_text(FIRMNESS)).alias("firmness"), S.is_placeholder(_case_text(PLACEHOLDERS)).alias("placeholder"), S.looks_tabular(_case_text(TABULAR)).alias("tabular"), S.detect_lang(_case_text(LANGUAGES)).alias("lang"))


@query(
    """WITH w(lang, word) AS (VALUES
  ('en', 'a and construction for installation of provision services study supply support the to with'),
  ('fr', 'acquisition au aux construction d dans de des du et fourniture l la le les pour prestation recrutement travaux'),
  ('es', 'adquisición con construcción consultoría de del el en la las los obras para servicios suministro y'),
  ('pt', 'a aquisição as com construção contratação da de do e em fornecimento o obras os para serviços')),
m AS (SELECT lang, unnest(string_split(word, ' ')) AS word FROM w), k AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-záàâãéêíóôõúüçñ]+')) AS word FROM documents),
n AS (SELECT doc_id, lang, count(*) AS n FROM k JOIN m USING (word) GROUP BY 1, 2), top AS (SELECT doc_id, max(n) AS n FROM n GROUP BY 1), led AS (SELECT doc_id, min(lang) AS lang FROM n JOIN top USING (doc_id, n) GROUP BY 1 HAVING count(*) = 1)
SELECT doc_id, coalesce(led.lang, 'en') AS lang FROM documents LEFT JOIN led USING (doc_id)"""
)
def scalar_lang(t):
    return t["documents"].select("doc_id", S.detect_lang(F.col("text")).alias("lang"))


@query("SELECT project_id, CASE WHEN country_code IS NULL OR substring(country_code, 1, 1) BETWEEN '0' AND '9' THEN NULL WHEN upper(country_code) = 'ZR' THEN 'CD' ELSE upper(country_code) END AS iso, status IN ('Pending', 'Planned') AS upcoming, coalesce(closing_date, approval_date) AS due, md5(project_id || '|m1|a1|t1') AS commitment_id FROM projects", "projects")
def scalar_codes(t):
    return t["projects"].select("project_id", S.iso_country_code(F.col("country_code")).alias("iso"), S.is_upcoming(F.col("status")).alias("upcoming"), S.due_date(F.col("approval_date"), F.col("closing_date")).alias("due"), S.commitment_id(F.col("project_id"), F.lit("m1"), F.lit("a1"), F.lit("t1")).alias("commitment_id"))


@query("SELECT event_id, try_cast(try_cast(props->>'$.k' AS DOUBLE) AS INT) AS k, CAST(value AS VARCHAR) = '' AS blank FROM events")
def scalar_lenient(t):
    k = F.get_json_object("props", "$.k")
    return t["events"].select("event_id", S.lenient(k, "integer").alias("k"), (F.col("value").cast("string") == "").alias("blank"))


# Procurement cleaning: cells with what is to be read from them, by hand

STATUS_CELLS = (("Pendiente", "Pending"), ("Under Implement ation", "Under Implementation"), ("En cours d'exécut ion", "Under Implementation"), ("En attente d'", "Pending Implementation"), ("Pending", "Pending"), ("Pending Impleme", "Pending Implementation"), ("Cancel", "Canceled"), ("Assinado.", "Signed"), ("", "unknown"), ("Achevé", "Completed"), ("Termin", "Terminated"), ("Rescindido", "Terminated"), ("n/a", "unknown"))
CATEGORY_CELLS = (("Goods", "goods"), ("CW", "works"), ("Consulting Firms", "consultant_services"), ("AB-UNIT-1234-GO-RFB", "goods"), ("non-consulting services.", "non_consulting_services"), ("", "unknown"), ("x-nc-y", "non_consulting_services"), ("vans", "unknown"))
REFERENCES = (("AB-UNIT-123-CS-QCBS", "QCBS"), ("AB-UNIT-123-GO-RFQ2", "RFQ"), ("AB-UNIT-1- CS-CQS", "CQS"), ("AB-1-CS-IC", "INDV"), ("AB-1-CS-ICT", ""), ("AB-1-GO-RF", ""), ("AB-1-CW-RFBREBID", "RFB"), ("AB-1-CS-SFQC", "QCBS"), ("no reference", ""), ("", ""))
METHOD_CELLS = (("Request for Bids", "RFB"), ("Demande de prix", "RFQ"), ("Sélection au moindre coût", "LCS"), ("Direct Selection", "CDS"), ("Consultant Qualification  Selection", "CQS"), ("Quality And Cost-Based Selection", "QCBS"), ("AB-UNIT-123-CS-FBS", "FBS"), ("Request for Ideas", "unknown"), ("", "unknown"))
OTHER_CELLS = (("Post Request for Propo sals Open", "RFP"), ("Prior Consultant Qualifi cation", "CQS"), ("IDA / 1234 Direct Selection Open", "CDS"), ("Appel d'offres ouvert", "RFB"), ("Open - National", "unknown"), ("Entente directe, Demande de prix", "CDS"), ("", "unknown"))
CHAINS = (("BJ-UCP / PADA-43641-GO-RFQ", "PADA-43641-GO-RFQ"), ("PADA-43641-GO-RFQ", "PADA-43641-GO-RFQ"), ("BJ / UCP / X1 / Y2", "BJ / UCP / X1 / Y2"), ("A1 / 2023 / B2", "A1"), ("A1-B / C2-D / E3-F / G4", "E3-F"), ("a1 / B2", "a1 / B2"), ("", ""))
APPROACHES = (("Open-National", "Open - National"), ("Open - Internationa l", "Open - International"), (" Limited /  National ", "Limited - National"), ("", ""))


@query(
    f"SELECT o_orderkey, {_by_hand(STATUS_CELLS)} AS status, {_by_hand(CATEGORY_CELLS)} AS category, {_by_hand(REFERENCES)} AS by_reference, {_by_hand(METHOD_CELLS)} AS method, {_by_hand(OTHER_CELLS)} AS in_cells, {_by_hand(CHAINS)} AS chain, {_by_hand(APPROACHES)} AS approach FROM orders".replace("WHEN 3 THEN 'CDS'", "WHEN 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'CDS' ELSE 'DIR' END").replace("WHEN 2 THEN 'CDS'", "WHEN 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'CDS' ELSE 'DIR' END").replace("WHEN 5 THEN 'CDS'", "WHEN 5 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'CDS' ELSE 'DIR' END")
)
def procurement_values(t):
    category = F.when(F.col("o_orderkey") % 2 == 0, "consultant_services").otherwise("goods")
    return t["orders"].select(
        "o_orderkey", CL.norm_status(_case_text(STATUS_CELLS)).alias("status"), CL.norm_category(_case_text(CATEGORY_CELLS)).alias("category"), CL.reference_method(_case_text(REFERENCES)).alias("by_reference"), CL.norm_method(_case_text(METHOD_CELLS), category).alias("method"), CL.method_in_cells(_case_text(OTHER_CELLS), category).alias("in_cells"),
        CL.chain_ref(_case_text(CHAINS)).alias("chain"), CL.norm_approach(_case_text(APPROACHES)).alias("approach"),
    )


#: Descriptions with what stays of them, their marks, the component and its source, by hand.
DESCRIPTIONS = (
    ("AB-UNIT-123-GO-RFB - Supply of pumps", "Supply of pumps", "", "", ""),
    ("Lot 2 - Supply of five pumps", "Supply of five pumps", "Lot 2", "", ""),
    ("Phase 1 and Phase 2 works on roads", "Phase 1 and Phase 2 works on roads", "Phase 1; Phase 2", "", ""),
    ("Rural IDA / 12345 roads in five towns", "Rural roads in five towns", "", "", ""),
    ("Works on roads IDA / 12345 Component 2.1: Bridges", "Works on roads", "", "2.1", "number_only"),
    ("Supply of vans Post Request for Bids Open - National", "Supply of vans", "", "", ""),
    ("Open - National Supply of chairs", "Supply of chairs", "", "", ""),
    ("Design of water towers Component 1: Rural water supply systems", "Design of water towers", "", "1", "name_match"),
    ("Supply of desks (RE-BID)", "Supply of desks", "", "", ""),
    ("Audit of the accounts for US$ 1.5 million AB-UNIT-77-CS-LCS next", "Audit of the accounts for US$ 1.5 million", "", "", ""),
    ("", "", "", "", ""),
)


def _hand(i: int) -> str:
    return _by_hand(tuple((None, x[i]) for x in DESCRIPTIONS))


@query(f"SELECT o_orderkey, {_hand(1)} AS description_clean, {_hand(2)} AS lot_or_phase, {_hand(3)} AS component_number, {_hand(4)} AS component_source, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 11 = 9 THEN '1500000.00' END AS estimated_amount, CASE WHEN o_orderkey % 2 = 0 THEN 'plan' WHEN o_orderkey % 11 = 9 THEN 'description' ELSE '' END AS amount_source, 'Signed' AS status FROM orders")
def clean_packages(t):
    spark = t["orders"].sparkSession
    key = F.col("o_orderkey")
    plan = t["orders"].select("o_orderkey", F.lit("P1").alias("project_id"), F.lit("AB-OWN-1-GO-RFB").alias("borrower_ref"), _case_text(tuple((x[0], 0) for x in DESCRIPTIONS)).alias("description"), F.lit("Goods").alias("category_raw"), F.lit(None).cast("string").alias("method_raw"), F.lit(None).cast("string").alias("cells_raw"), F.lit("").alias("market_approach"), F.lit("Firmado").alias("status_raw"), F.lit(None).cast("string").alias("planned_date"), F.when(key % 2 == 0, key.cast("string")).alias("estimated_amount"))
    known = spark.createDataFrame([(["P1"], "1", "Component 1: Rural water supply systems", "D1", "2019-01-01"), (["P1"], "9", "Rural water supply systems", "D0", "2018-01-01")], "project_ids array<string>, number string, name string, document_id string, disclosure_date string")
    return CL.clean_packages(plan, CL.component_index(known)).select("o_orderkey", "description_clean", "lot_or_phase", "component_number", "component_source", "estimated_amount", "amount_source", "status")


_AUDITED = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Supply  of pumps' WHEN 1 THEN 'Tlssfrtq' WHEN 2 THEN 'Lot 2 - vans' WHEN 3 THEN 'Works on AB-CD-1234-GO-RFB site' ELSE NULL END AS d, o_orderstatus, o_totalprice, o_orderdate FROM orders"


@query(
    f"""WITH x AS ({_AUDITED}), n AS (SELECT count(*) AS scope, count(*) FILTER (WHERE o_orderkey % 5 = 3) AS c0, 0 AS c1, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS c2, count(*) FILTER (WHERE o_orderkey % 5 = 1) AS c3, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS c4, count(*) FILTER (WHERE o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0) AS c5, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS c6,
  count(*) FILTER (WHERE o_orderkey % 4 = 0) AS c7, count(*) FILTER (WHERE o_orderkey % 4 = 0 AND o_orderkey % 3 = 0) AS c8, count(*) FILTER (WHERE o_orderkey % 5 IN (1, 2, 4)) AS c9, count(*) FILTER (WHERE o_orderkey % 6 = 0) AS c10, count(*) FILTER (WHERE o_orderkey % 4 = 1 AND o_orderkey % 3 <> 1) AS c11, count(*) FILTER (WHERE o_orderkey % 5 = 2) AS c12 FROM x)
SELECT r.k AS "check", r.h AS hits, scope FROM (SELECT scope, unnest([{{'k': 'description carries a second borrower reference', 'h': c0}}, {{'k': 'table header text leaked into a description', 'h': c1}}, {{'k': 'whitespace not collapsed', 'h': c2}}, {{'k': 'description ends mid-word', 'h': c3}}, {{'k': 'borrower reference absent', 'h': c4}}, {{'k': 'borrower reference not normalised', 'h': c5}}, {{'k': 'placeholder description', 'h': c6}},
  {{'k': 'status unmapped', 'h': c7}}, {{'k': 'status raw present but unmapped', 'h': c8}}, {{'k': 'description too short to match on', 'h': c9}}, {{'k': 'planned date after revised date', 'h': c10}}, {{'k': 'signed package with no amount', 'h': c11}}, {{'k': 'lot or phase marker left at the edge of the description', 'h': c12}}, {{'k': 'another cell of the plan row left in the description', 'h': 0}}]) AS r FROM n)"""
)
def audit_procurement(t):
    k = F.col("o_orderkey")
    d = F.element_at(F.array(*[F.lit(x) for x in ("Supply  of pumps", "Tlssfrtq", "Lot 2 - vans", "Works on AB-CD-1234-GO-RFB site", None)]), (k % 5 + 1).cast("int"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = t["orders"].select(d.alias("description"), d.alias("description_clean"), F.when(k % 7 != 0, F.lit("ab 1")).alias("borrower_ref"), F.when(k % 3 == 0, "AB1").otherwise("AB-1").alias("borrower_ref_norm"), (k % 2 == 0).alias("is_placeholder"), F.when(k % 4 == 0, "unknown").when(k % 4 == 1, "Signed").otherwise("Pending").alias("status"), F.when(k % 3 == 0, "odd").alias("status_raw"), F.when(k % 6 == 0, F.lit("9999-01-01")).otherwise(day).alias("planned_date"), day.alias("revised_date"), F.when(k % 3 == 1, "12").otherwise("0").alias("estimated_amount"))
    return CL.audit_procurement(rows).select("check", "hits", "scope")


QUERIES = view_queries.QUERIES
ORACLE_SQL = view_queries.ORACLE_SQL
