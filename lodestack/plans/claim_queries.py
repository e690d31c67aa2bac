"""Queries of claims, nested analyses and reviews. Texts and JSON are made from the tables' own texts and keys, alike for Spark and for DuckDB;
what is computed from them is written twice."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import analysis as A
from ..operators import claims as K
from ..operators import pages as G
from ..operators import repair as W
from ..operators import review as V
from ..operators import validation as N
from ..session import spread
from ..sources import discovery as D
from .catalog import query

#: A turn of a conversation as lines of a claims page: headings, page marks, numbers that skip, repeat or are missing, page breaks inside.
_PIECE = """concat(CASE WHEN turn = conv_id % 3 THEN concat(CASE conv_id % 4 WHEN 0 THEN 'CLAIMS' WHEN 1 THEN 'Amended claims (new)' WHEN 2 THEN 'What is claimed' ELSE ' claim ' END, chr(10)) ELSE '' END,
CASE WHEN (conv_id + turn) % 3 = 0 THEN concat('--- PAGE ', CAST(turn + 2 AS VARCHAR(9)), ' ---', chr(10)) ELSE '' END,
CASE (conv_id * 7 + turn * 3) % 10 WHEN 0 THEN concat(CAST(turn + 2 AS VARCHAR(9)), '. ') WHEN 1 THEN concat(CAST(greatest(turn, 1) AS VARCHAR(9)), ' ) ') WHEN 2 THEN '' WHEN 3 THEN concat('Abstract', chr(10)) WHEN 4 THEN concat('7 / 9', chr(10), '0. ') ELSE concat(' ', CAST(turn + 1 AS VARCHAR(9)), '.') END,
CASE WHEN (conv_id + turn) % 5 = 0 THEN replace(text, chr(10), concat(chr(10), '12', chr(10), '-- --- Page ', CAST(turn + 30 AS VARCHAR(9)), ' ---', chr(10))) WHEN (conv_id + turn) % 5 = 1 THEN 'too short' ELSE text END)"""

_CLAIMS_SQL = rf"""WITH d AS (SELECT conv_id, string_agg({_PIECE}, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
l AS (SELECT conv_id, unnest(range(len(a))) AS i, unnest(a) AS raw FROM (SELECT conv_id, string_split(text, chr(10)) AS a FROM d)),
p AS (SELECT *, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS line, nullif(TRY_CAST(regexp_extract(line, '^([0-9]{{1,3}})\s*[.)]', 1) AS INT), 0) AS number, TRY_CAST(regexp_extract(raw, '(?i)---\s*PAGE\s+([0-9]+)\s*---', 1) AS BIGINT) AS mark,
      regexp_full_match(line, '(?i)(amended\s+)?claims?(\s*\([^)]+\))?') AS heading, regexp_full_match(line, '(?i)(abstract|drawings?|description|references?)') AS after FROM l),
h AS (SELECT conv_id, min(i) AS h FROM p a WHERE heading AND EXISTS (SELECT 1 FROM p b WHERE b.conv_id = a.conv_id AND b.number = 1 AND b.i BETWEEN a.i + 1 AND a.i + 39) GROUP BY conv_id),
f AS (SELECT p.conv_id, CASE WHEN any_value(h) > 0 THEN any_value(h) ELSE coalesce(min(i) FILTER (WHERE number = 1), 0) END AS found FROM p LEFT JOIN h USING (conv_id) GROUP BY p.conv_id),
s AS (SELECT conv_id, coalesce(max(i) FILTER (WHERE mark IS NOT NULL AND i <= found), any_value(found)) AS start FROM p JOIN f USING (conv_id) GROUP BY conv_id),
c AS (SELECT conv_id, any_value(start) AS start, min(i) FILTER (WHERE number IS NOT NULL AND i >= start) AS claim FROM p JOIN s USING (conv_id) GROUP BY conv_id),
e AS (SELECT conv_id, any_value(start) AS start, coalesce(min(i) FILTER (WHERE after AND i > claim), 1000000000) AS stop FROM p JOIN c USING (conv_id) GROUP BY conv_id),
k AS (SELECT conv_id, i, line, number, mark, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY i), 1) AS page,
      line = '' OR heading OR lower(line) IN ('claim', 'claimset') OR regexp_full_match(line, '[0-9]{{1,3}}(\s*(->|→|-|/)\s*[0-9]{{1,3}})?') OR regexp_full_match(line, '(?i)EP\s*[0-9][0-9\s.]{{6,}}') AS noise FROM p JOIN e USING (conv_id) WHERE i >= start AND i < stop),
g AS (SELECT *, count(number) OVER (PARTITION BY conv_id ORDER BY i) AS seg FROM k WHERE mark IS NULL AND NOT noise),
b AS (SELECT conv_id, seg, any_value(number) AS n, coalesce(string_agg(nullif(CASE WHEN number IS NULL THEN line ELSE trim(regexp_replace(line, '^[0-9]{{1,3}}\s*[.)]', '')) END, ''), chr(10) ORDER BY i), '') AS text, list_sort(list_distinct(list(page))) AS pages FROM g GROUP BY conv_id, seg),
m AS (SELECT *, length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS size FROM b),
n AS (SELECT conv_id, max(n) FILTER (WHERE seg = 1) AS first, count(CASE WHEN seg > 0 AND size >= 20 THEN 1 END) AS found FROM m GROUP BY conv_id),
a AS (SELECT conv_id, seg, n, text, pages, size, '' AS notes FROM m WHERE seg > 0 AND size >= 20
      UNION ALL SELECT conv_id, 0, 1, text, pages, size, CASE WHEN first > 1 THEN '{K.BEFORE_NOTE}' ELSE '{K.UNNUMBERED_NOTE}' END FROM m JOIN n USING (conv_id) WHERE seg = 0 AND size >= 80 AND (first > 1 OR found = 0)),
x AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY conv_id, n ORDER BY size DESC, seg) = 1),
z AS (SELECT conv_id, n, text, pages, notes FROM x UNION ALL SELECT conv_id, r, '', [], '{K.PLACEHOLDER_NOTE}' FROM (SELECT conv_id, unnest(range(1, max(n) + 1)) AS r FROM x GROUP BY conv_id HAVING max(n) <= 200) t WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.conv_id = t.conv_id AND x.n = r))
SELECT conv_id, CAST(n AS INTEGER) AS claim_number, text, array_to_string(pages, ',') AS pages, notes FROM z"""


@query(_CLAIMS_SQL)
def split_claims(t):
    """Claims of page-delimited texts: located section, numbered claims, inferred and missing ones."""
    turns = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.expr(_PIECE).alias("piece")))).alias("turns"))
    docs = turns.select("conv_id", F.array_join(F.transform("turns", lambda x: x["piece"]), "\n").alias("text"))
    rows = K.numbered(docs, ["conv_id"])
    return rows.select("conv_id", "claim_number", "text", F.array_join(F.transform("source_pages", lambda p: p.cast("string")), ",").alias("pages"), "notes")


_DIMS = "['novelty', 'inventive_step', 'support', 'clarity', 'eligibility']"
_DIM = "element_at(array('novelty', 'inventive_step', 'support', 'clarity', 'eligibility'), CAST((l_linenumber - 1) % 5 AS INT) + 1)"
#: A model's answer for one dimension, from a line: scores as number, numeral, null or word, discussions as object, text or null, mixed lists. Keys are in order.
_ANSWER = """concat('{"', dim, '_score":', CASE l_partkey % 7 WHEN 0 THEN 'null' WHEN 1 THEN concat('"', CAST(l_suppkey % 90 AS VARCHAR(9)), '"') WHEN 2 THEN '"high"' ELSE CAST(l_partkey % 101 AS VARCHAR(9)) END,
',"', dim, '_disc":', CASE l_suppkey % 6 WHEN 0 THEN '"only text"' WHEN 1 THEN 'null' WHEN 2 THEN concat('{"analysis":"a","original_text":"', CASE WHEN l_partkey % 2 = 0 THEN '' ELSE ' ' END, '"}') ELSE concat('{"analysis":"a","original_text":"passage ', CAST(l_partkey % 4 AS VARCHAR(9)), '","source":"', CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'docs/a.pdf' END, '"}') END,
',"affected_claims":[', CAST(l_partkey % 6 AS VARCHAR(9)), ',"', CAST(l_suppkey % 6 AS VARCHAR(9)), '","x",null]',
',"evidence":[{"issue":"', dim, '","original_text":"e', CAST(l_partkey % 3 AS VARCHAR(9)), '"},"loose",{"location":"p. 3","original_text":"', CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'where' END, '"}]',
',"recommended_action":', CASE WHEN l_partkey % 4 = 0 THEN 'null' ELSE concat('" act ', CAST(l_partkey % 4 AS VARCHAR(9)), '"') END, ',"risk_reason":"', CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE concat('risk ', CAST(l_suppkey % 3 AS VARCHAR(9))) END, '"}')"""
_SCORE_SQL = "coalesce(arg_max(json_extract(j, '$.{d}_score')::VARCHAR, pass) FILTER (WHERE dim = '{d}'), 'null')"
_VALUE_SQL = "TRY_CAST(arg_max(coalesce(json_extract_string(j, '$.{d}_score'), ''), pass) FILTER (WHERE dim = '{d}') AS DOUBLE)"
_WEIGHT_SQL = {"novelty": 0.25, "inventive_step": 0.30, "support": 0.15, "clarity": 0.10, "eligibility": 0.20}

_MERGE_SQL = f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, dim ORDER BY l_linenumber, l_partkey, l_suppkey) AS pass FROM (SELECT l_orderkey, l_linenumber, (l_linenumber - 1) % 5 + 1 AS place, {_DIMS}[(l_linenumber - 1) % 5 + 1] AS dim, l_partkey, l_suppkey FROM lineitem)),
p AS (SELECT l_orderkey, pass, place, dim, CAST({_ANSWER} AS JSON) AS j FROM a),
e AS (SELECT *, list_filter(CAST(json_extract(j, '$.evidence[*]') AS JSON[]), lambda x: json_type(x) = 'OBJECT') AS evidence, json_extract(j, '$.' || dim || '_disc') AS disc FROM p),
s AS (SELECT *, CASE WHEN dim <> 'support' THEN [] ELSE list_concat(CASE WHEN json_type(disc) = 'OBJECT' AND json_extract_string(disc, '$.original_text') <> '' THEN [CAST(json_object('llm_evidence_explanation', '', 'location', coalesce(nullif(json_extract_string(disc, '$.source'), ''), 'support_disc'), 'original_text', json_extract_string(disc, '$.original_text'), 'translation', '') AS VARCHAR)] ELSE [] END,
      list_transform(list_filter(evidence, lambda x: json_extract_string(x, '$.original_text') <> ''), lambda x: CAST(json_object('llm_evidence_explanation', '', 'location', coalesce(json_extract_string(x, '$.location'), 'support evidence'), 'original_text', json_extract_string(x, '$.original_text'), 'translation', '') AS VARCHAR))) END AS support FROM e),
d AS (SELECT l_orderkey, arg_max(CASE WHEN json_type(disc) = 'VARCHAR' THEN '{{"analysis":' || CAST(disc AS VARCHAR) || ',"llm_evidence_explanation":"模型未返回该维度的结构化原文证据，已保留分析结论；请根据审查材料补齐原文和翻译。","original_text":"","translation":""}}' WHEN json_type(disc) = 'NULL' THEN '{{"analysis":"","llm_evidence_explanation":"","original_text":"","translation":""}}' ELSE CAST(disc AS VARCHAR) END, pass) FILTER (WHERE dim = 'support') AS support_disc FROM s GROUP BY 1)
SELECT l_orderkey AS case_id, {', '.join(f"{_SCORE_SQL.format(d=x)} AS {x}_score" for x in _WEIGHT_SQL)}, any_value(support_disc) AS support_disc,
coalesce(CAST(round_even({' + '.join(f"{_VALUE_SQL.format(d=x)} * {w}::DOUBLE" for x, w in _WEIGHT_SQL.items())}, 0) AS INTEGER), 0) AS aggregate_score,
coalesce(array_to_string(list(json_extract_string(j, '$.risk_reason') ORDER BY pass, place) FILTER (WHERE json_extract_string(j, '$.risk_reason') <> '')[1:5], '|'), '') AS risks,
coalesce(array_to_string(list(trim(json_extract_string(j, '$.recommended_action')) ORDER BY pass, place) FILTER (WHERE json_extract_string(j, '$.recommended_action') IS NOT NULL)[1:5], '|'), '') AS actions,
array_to_string(list_sort(list_distinct(flatten(list([CAST(json_extract_string(j, '$.affected_claims[0]') AS BIGINT), CAST(json_extract_string(j, '$.affected_claims[1]') AS BIGINT)])))), ',') AS claims,
coalesce(array_to_string(flatten(list(support ORDER BY pass, place)), '|'), '') AS support, array_to_string(flatten(list(list_transform(evidence, lambda x: CAST(x AS VARCHAR)) ORDER BY pass, place)), '|') AS evidence
FROM s JOIN d USING (l_orderkey) GROUP BY l_orderkey"""


def _answers(t):
    """All lines of an order as answers; lines that fall on the same dimension are its passes."""
    lines = t("lineitem").withColumn("dim", F.expr(_DIM))
    n = F.row_number().over(Window.partitionBy("l_orderkey", "dim").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    return lines.select(F.col("l_orderkey").alias("case_id"), "dim", F.expr(_ANSWER).alias("answer"), n.alias("pass"))


@query(_MERGE_SQL)
def merged_analyses(t):
    """All answers of a case as one analysis; a dimension's last pass gives its score and discussion."""
    m = A.merge(A.partials(_answers(t), "case_id", "dim", "answer", "pass"))
    return m.select("case_id", *[f"{d}_score" for d in A.DIMENSIONS], F.coalesce("support_disc").alias("support_disc"), "aggregate_score", F.array_join("top_risk_reasons", "|").alias("risks"), F.array_join("recommended_actions", "|").alias("actions"), F.array_join("affected_claims", ",").alias("claims"), F.array_join("specification_support", "|").alias("support"), F.array_join("examination_material_evidence", "|").alias("evidence"))


_OPEN = """concat('{"aggregate_score":7,"dimension_scores":{"clarity_disc":{"original_text":"seen"},"clarity_score":', CASE WHEN o_custkey % 3 = 0 THEN 'null' ELSE CAST(o_custkey % 100 AS VARCHAR(9)) END, ',"novelty_disc":', CASE WHEN o_custkey % 2 = 0 THEN '"text"' ELSE '{"original_text":"old"}' END, ',"novelty_score":"', CAST(o_custkey % 77 AS VARCHAR(9)), '"},"evidence_trace":{"affected_claims":[1,"2"]},"top_risk_reasons":["risk 1","own"]}')"""
_COMPLETE_SQL = f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, dim ORDER BY l_linenumber, l_partkey, l_suppkey) AS pass FROM (SELECT l_orderkey, l_linenumber, (l_linenumber - 1) % 5 + 1 AS place, {_DIMS}[(l_linenumber - 1) % 5 + 1] AS dim, l_partkey, l_suppkey FROM lineitem)),
p AS (SELECT l_orderkey, pass, place, dim, CAST({_ANSWER} AS JSON) AS j FROM a),
c AS (SELECT *, json_extract(j, '$.' || dim || '_score')::VARCHAR AS score, json_extract(j, '$.' || dim || '_disc') AS disc FROM p WHERE score <> 'null' AND trim(coalesce(json_extract_string(disc, '$.original_text'), '')) <> ''),
o AS (SELECT o_orderkey, o_custkey FROM orders),
u AS (SELECT c.* FROM c JOIN o ON o_orderkey = l_orderkey WHERE CASE dim WHEN 'clarity' THEN o_custkey % 3 = 0 WHEN 'novelty' THEN o_custkey % 2 = 0 ELSE true END QUALIFY row_number() OVER (PARTITION BY l_orderkey, dim ORDER BY pass) = 1),
g AS (SELECT o_orderkey, any_value(o_custkey) AS k, {', '.join(f"any_value(score) FILTER (WHERE dim = '{x}') AS {x}" for x in _WEIGHT_SQL)}, coalesce(string_agg(dim, ',' ORDER BY pass, place), '') AS repaired,
      coalesce(list(json_extract_string(j, '$.risk_reason') ORDER BY pass, place) FILTER (WHERE json_extract_string(j, '$.risk_reason') <> ''), []) AS new_risks,
      coalesce(flatten(list([json_extract_string(j, '$.affected_claims[0]'), json_extract_string(j, '$.affected_claims[1]'), '"x"', 'null'] ORDER BY pass, place) FILTER (WHERE l_orderkey IS NOT NULL)), []) AS new_claims FROM o LEFT JOIN u ON o_orderkey = l_orderkey GROUP BY o_orderkey),
f AS (SELECT o_orderkey, coalesce(novelty, '"' || (k % 77) || '"') AS novelty, coalesce(inventive_step, 'null') AS inventive_step, coalesce(support, 'null') AS support, coalesce(clarity, CASE WHEN k % 3 = 0 THEN 'null' ELSE CAST(k % 100 AS VARCHAR) END) AS clarity, coalesce(eligibility, 'null') AS eligibility, repaired, new_risks, new_claims FROM g),
n AS (SELECT *, {', '.join(f"TRY_CAST(trim({x}, '\"') AS DOUBLE) AS {x}_n" for x in _WEIGHT_SQL)} FROM f)
SELECT o_orderkey AS case_id, {', '.join(f'{x} AS {x}_score' for x in _WEIGHT_SQL)}, repaired,
coalesce(CAST(round_even(({' + '.join(f'coalesce({x}_n * {w}::DOUBLE, 0)' for x, w in _WEIGHT_SQL.items())}) / nullif({' + '.join(f'(CASE WHEN {x}_n IS NULL THEN 0.0::DOUBLE ELSE {w}::DOUBLE END)' for x, w in _WEIGHT_SQL.items())}, 0), 0) AS INTEGER), 7) AS aggregate_score,
array_to_string(list_concat(['risk 1', 'own'], list_filter(new_risks, lambda x, i: x <> 'risk 1' AND list_position(new_risks, x) = i)), '|') AS risks,
array_to_string(list_concat(['1', '"2"'], list_filter(new_claims, lambda x, i: x NOT IN ('1', '2') AND list_position(new_claims, x) = i)), ',') AS claims FROM n"""


@query(_COMPLETE_SQL)
def completed_analyses(t):
    """Documents with gaps, filled from the answers of two passes."""
    docs = t("orders").select(F.col("o_orderkey").alias("case_id"), F.expr(_OPEN).alias("analysis"))
    c = A.complete(docs, A.partials(_answers(t), "case_id", "dim", "answer", "pass"))
    return c.select("case_id", *[f"{d}_score" for d in A.DIMENSIONS], F.array_join("repaired", ",").alias("repaired"), "aggregate_score", F.array_join("top_risk_reasons", "|").alias("risks"), F.array_join("affected_claims", ",").alias("claims"))


_KEY = "CAST(c_custkey % {} AS VARCHAR(9))"
#: Three documents of a case: lists that are empty, missing or no lists, records with paths at several depths, keys in order.
_REVIEWED = """concat('{"aggregate_score":', CASE c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '""' ELSE CAST(c_custkey % 100 AS VARCHAR(9)) END, ',"dimension_scores":{"clarity_score":"8","novelty_disc":{"original_text":"t","source":"docs/n', CAST(c_custkey % 7 AS VARCHAR(9)), '.pdf"},"novelty_score":', CAST(c_custkey % 90 AS VARCHAR(9)),
'},"evidence_trace":{"affected_claims":[1,"x.txt",null],"examination_material_evidence":[', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '{"path":"b.TXT","source":["a.pdf","no",{"pdf":"a.pdf"}]},"c.html"' END, '],"prior_art_documents":', CASE WHEN c_custkey % 2 = 0 THEN '"D1"' ELSE '[{"citation":"D1","local_pdf":"prior-art/d1.pdf"}]' END,
'},"grant_label":"yes","meta":{"applicant":"', c_name, '","title":"', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'T' END, '"},"top_risk_reasons":[', CASE WHEN c_custkey % 4 = 1 THEN '"r1","r2.pdf"' ELSE '' END, ']}')"""
_REVIEWED_INPUT = """concat('{"benchmark_input":{"claim_text":{"claim_1":"', CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'A compound' END, '"},"drug_structure":{"markush_images":[', CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '{"image_path":"assets/m.png"}' ELSE '{"image_path":""},{"image_path":"p.png"}' END, ']}}}')"""
_REVIEWED_CLAIMS = """CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('{"claims":[{"claim_number":', CAST(c_custkey % 3 AS VARCHAR(9)), ',"source_pdf":"docs/c.pdf"},{"text":"t"}]}') END"""


def _pointer_sql(path: str) -> str:
    return "/" + path.replace(".", "/")


def _single_sql(path: str, doc: str = "a", required: bool = True, auto: bool = False) -> str:
    return f"SELECT k, '{_pointer_sql(path)}' AS id, json_extract({doc}, '$.{path}') AS v, {required} AS required, {auto} AS auto_pass, 'x' AS kind FROM d"


def _list_sql(path: str, doc: str = "a", pointer: str = "", kind: str = "x") -> str:
    at, rows = pointer or _pointer_sql(path), f"coalesce(CAST(CASE WHEN json_type(json_extract({doc}, '$.{path}')) = 'ARRAY' THEN json_extract({doc}, '$.{path}[*]') END AS JSON[]), [])"
    return f"SELECT k, '{at}/' || CAST(i AS VARCHAR), list_extract(r, i + 1), true, false, '{kind}' FROM (SELECT k, {rows} AS r, unnest(range(len(r))) AS i FROM d) UNION ALL SELECT k, '{at}', NULL, true, false, '{kind}' FROM d WHERE len({rows}) = 0"


_ITEMS_SQL = " UNION ALL ".join(
    [_single_sql(f"meta.{x}", auto=True) for x, _ in V.META]
    + [_single_sql("grant_label", auto=True), _list_sql(V.IMAGES, "b", kind="image"), _single_sql("benchmark_input.claim_text.claim_1", "b")]
    + [_single_sql(f"dimension_scores.{x}_{y}", required=y == "score") for x, _ in V.DIMENSIONS for y in ("score", "disc")]
    + [_single_sql("aggregate_score"), _single_sql("evidence_trace.examination_rounds")]
    + [_list_sql(x) for x, _, _ in V.LISTS + V.TRACE_LISTS]
    + [_list_sql("claims", "c", "/claims_verified/claims")]
)
_REVIEW_SQL = f"""WITH d AS (SELECT c_custkey AS k, CAST({_REVIEWED} AS JSON) AS a, CAST({_REVIEWED_INPUT} AS JSON) AS b, CAST({_REVIEWED_CLAIMS} AS JSON) AS c FROM customer), i AS ({_ITEMS_SQL}),
w AS (SELECT k, id, v, required, auto_pass, kind, CASE WHEN v IS NULL THEN [] WHEN kind = 'image' THEN list_filter([json_extract_string(v, '$.image_path')], lambda x: x <> '') WHEN json_type(v) = 'VARCHAR' THEN [json_extract_string(v, '$')]
      WHEN json_type(v) = 'OBJECT' THEN list_distinct(list_filter(list_concat(flatten([CASE WHEN json_type(json_extract(v, '$.source')) = 'ARRAY' THEN [json_extract_string(v, '$.source[0]'), json_extract_string(v, '$.source[1]'), json_extract_string(v, '$.source[2].pdf')] ELSE [json_extract_string(v, '$.source')] END]), [json_extract_string(v, '$.source_pdf'), json_extract_string(v, '$.path'), json_extract_string(v, '$.local_pdf')]), lambda x: x IS NOT NULL)) ELSE [] END AS paths FROM i)
SELECT k AS case_id, id, required AND CASE WHEN kind = 'image' THEN v IS NULL OR json_extract_string(v, '$.image_path') = '' ELSE v IS NULL OR CAST(v AS VARCHAR) IN ('null', '""') END AS missing_required, auto_pass,
CASE WHEN json_type(v) IN ('OBJECT') THEN CAST(v AS VARCHAR) ELSE json_extract_string(v, '$') END AS value, array_to_string(list_sort(list_filter(paths, lambda x: regexp_matches(lower(x), '\\.(pdf|txt|html?|png|jpe?g|webp)$'))), ',') AS paths FROM w"""


def _reviewed(t):
    return spread(t("customer").select("c_custkey", "c_name")).select(F.col("c_custkey").alias("case_id"), F.expr(_REVIEWED).alias("analysis"), F.expr(_REVIEWED_INPUT).alias("benchmark"), F.expr(_REVIEWED_CLAIMS).alias("claims"))


@query(_REVIEW_SQL)
def review_items(t):
    """What a person has to check in every case, with the files that prove it."""
    i = V.review_items(_reviewed(t))
    value = F.when(F.col("value") == "null", None).when(F.col("value").startswith('"'), F.expr("substring(value, 2, length(value) - 2)")).otherwise(F.col("value"))
    return i.select("case_id", "id", "missing_required", "auto_pass", value.alias("value"), F.array_join(F.array_sort("evidence_paths"), ",").alias("paths"))


#: A file's path from a line: cases in groups or not, cases in cases, working folders, loose files.
_TREE = """concat(CASE l_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'group/' WHEN 2 THEN concat('area ', CAST(l_orderkey % 7 AS VARCHAR(9)), '/sub/') ELSE 'outer/' END, CASE WHEN l_orderkey % 9 = 0 THEN 'misc' ELSE concat(CASE WHEN l_orderkey % 2 = 0 THEN 'EP' ELSE 'ep' END, lpad(CAST(l_orderkey AS VARCHAR(20)), 8, '0')) END, '/',
CASE l_partkey % 8 WHEN 0 THEN concat('EP', CAST(l_orderkey AS VARCHAR(20)), '-analysis.json') WHEN 1 THEN 'docs/x-analysis.json' WHEN 2 THEN 'docs/deep/a.pdf' WHEN 3 THEN 'assets/b.png' WHEN 4 THEN 'more/y-analysis.json' WHEN 5 THEN '_state/s.json' WHEN 6 THEN 'register/z-main.html' ELSE 'loose.txt' END)"""
_OWNER_SQL = f"""WITH f AS (SELECT l_suppkey, {_TREE} AS path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM lineitem), r AS (SELECT dir AS root, min(regexp_extract(path, '[^/]*$')) AS marker FROM f WHERE path LIKE '%-analysis.json' GROUP BY dir),
o AS (SELECT dir, arg_max(root, length(root)) AS root FROM (SELECT DISTINCT dir FROM f) JOIN r ON dir = root OR starts_with(dir, root || '/') GROUP BY dir)
SELECT root, any_value(marker) AS marker, count(*) AS files, CAST(sum(l_suppkey) AS BIGINT) AS bytes, count(DISTINCT path[length(root) + 2:]) AS names, CASE WHEN contains(root, '/') THEN regexp_extract(root, '([^/]*)/[^/]*$', 1) ELSE '未分类' END AS category FROM f JOIN o USING (dir) JOIN r USING (root) GROUP BY root"""


@query(_OWNER_SQL)
def case_discovery(t):
    """Case folders by their marker files, and what each owns of a file listing."""
    files = spread(t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey")).select(F.expr(_TREE).alias("path"), "l_suppkey")
    roots = D.roots(files)
    own = D.owned(files, roots).groupBy("root").agg(F.count(F.lit(1)).alias("files"), F.sum("l_suppkey").cast("long").alias("bytes"), F.countDistinct("inside").alias("names"))
    return own.join(roots, "root").select("root", "marker", "files", "bytes", "names", D.category(F.col("root")).alias("category"))


_NAMED_SQL = f"""WITH f AS (SELECT l_suppkey, string_split({_TREE}, '/') AS p, list_position(list_transform(p, lambda x: regexp_full_match(x, '(?i)EP[0-9]{{8,}}')), true) AS n FROM lineitem)
SELECT array_to_string(p[1:n], '/') AS case_dir, upper(p[n]) AS case_id, count(*) AS files, count(CASE WHEN p[n + 1] = 'register' THEN 1 END) AS pages FROM f WHERE n > 0 AND NOT list_has_any(p, ['_state', '_logs', '.git', '__pycache__']) AND NOT list_contains(list_transform(p[n + 1:], lambda x: lower(x)), 'assets') GROUP BY 1, 2"""


@query(_NAMED_SQL)
def case_files_by_name(t):
    """Files below folders that are named like a case."""
    f = D.case_files(t("lineitem").select(F.expr(_TREE).alias("path")))
    return f.groupBy("case_dir", "case_id").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("inside").startswith("register/")).alias("pages"))


@query(None)
def repaired_evidence(t):
    """Passages of conversations with letters and words lost, put right from the conversation's own turns (no SQL: the measure of likeness is a sequence
    matcher's; tested against a plain search)."""
    turns = t("conversations").select(F.col("conv_id").alias("case_id"), F.concat(F.lit("turns/"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(".txt")).alias("file"), "text", "turn")
    worn = F.regexp_replace(F.regexp_replace(F.element_at(F.split("text", "\n"), 1), "e", ""), " (la|und|el) ", " ")
    quote = F.struct(worn.alias("original_text"), F.when(F.col("turn") % 3 == 0, "").otherwise(F.element_at(F.split("file", "/"), -1)).alias("source"))
    docs = turns.filter(F.col("turn") % 2 == 0).groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("turn", quote.alias("q")))).alias("qs"))
    docs = docs.select("case_id", F.to_json(F.struct(F.transform("qs", lambda x: x["q"]).alias("evidence"))).alias("analysis"))
    return W.repair(docs, turns.select("case_id", "file", "text"))


#: A document as pages, one a sentence; some pages name a formula.
_PAGED = "array_join(transform(split(text, '[.] '), (x, i) -> concat('--- PAGE ', i + 1, ' ---\n', x, CASE WHEN (i + doc_id) % 5 = 0 THEN ' wherein Formula (IV) R1 scope' ELSE '' END)), '\n')"
_PAGES_SQL = r"""WITH p AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS x, len(a) AS n FROM (SELECT doc_id, string_split_regex(text, '[.] ') AS a FROM documents)),
g AS (SELECT doc_id, i + 1 AS page, n, x, chr(10) || x || CASE WHEN (i + doc_id) % 5 = 0 THEN ' wherein Formula (IV) R1 scope' ELSE '' END || chr(10) AS text FROM p),
s AS (SELECT doc_id, doc_id % 4 AS place, CASE doc_id % 4 WHEN 0 THEN x WHEN 1 THEN x || ' scope of formula (IV)' WHEN 2 THEN 'chemical formulae ' || x ELSE x || ' formula II wherein' END AS text FROM g WHERE page = doc_id % n + 1),
t AS (SELECT doc_id, place, text, array_slice(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: len(w) > 2), 1, 80) AS own FROM s),
o AS (SELECT g.doc_id, page, place, len(list_distinct(list_intersect(own, string_split(trim(regexp_replace(lower(g.text), '[^a-z0-9]+', ' ', 'g')), ' ')))) AS score, regexp_replace(lower(g.text), '[^a-z0-9]+', ' ', 'g') AS plain,
      (length(lower(g.text)) - length(replace(lower(g.text), 'formula', ''))) // 7 * 3 + (length(lower(g.text)) - length(replace(lower(g.text), 'wherein', ''))) // 7 * 3 + (length(lower(g.text)) - length(replace(lower(g.text), 'markush', ''))) // 7 * 3 + len(regexp_extract_all(regexp_replace(g.text, '[^\x00-\x7F]', '_', 'g'), '(?i)\bR\d*[A-Z]?\b|\bX\d*[A-Z]?\b|\bFormula\s*\(?[IVX0-9]+\)?')) AS formulas
      FROM g JOIN t USING (doc_id)),
c AS (SELECT *, CASE place WHEN 1 THEN score >= 5 AND contains(plain, 'formula iv') AND contains(plain, 'scope') WHEN 3 THEN score >= 5 AND contains(plain, 'formula ii') ELSE false END AS named FROM o),
d AS (SELECT *, bool_or(named) OVER (PARTITION BY doc_id) AS any_named FROM c),
f AS (SELECT doc_id, page FROM d WHERE CASE WHEN any_named THEN named ELSE place <> 2 AND score >= 18 END QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, page) <= 2),
b AS (SELECT doc_id, page FROM d WHERE place <> 2 AND formulas > 0 AND doc_id NOT IN (SELECT doc_id FROM f) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY formulas DESC, page) <= 4)
SELECT doc_id, CAST(page AS BIGINT) AS page, CASE doc_id % 4 WHEN 1 THEN 2900 WHEN 3 THEN 600 ELSE 0 END AS priority FROM (SELECT * FROM f UNION ALL SELECT * FROM b)"""


@query(_PAGES_SQL)
def snippet_page_choice(t):
    """Pages to look at for a passage of every document."""
    d = t("documents").withColumns({"x": F.split("text", "[.] ")})
    x = F.element_at("x", (F.col("doc_id") % F.size("x") + 1).cast("int"))
    kind = F.col("doc_id") % 4
    snippet = F.when(kind == 0, x).when(kind == 1, F.concat(x, F.lit(" scope of formula (IV)"))).when(kind == 2, F.concat(F.lit("chemical formulae "), x)).otherwise(F.concat(x, F.lit(" formula II wherein")))
    name = F.lit("d_ocr.txt").alias("source")
    snippets = d.select(F.col("doc_id").alias("case_id"), kind.alias("place"), name, snippet.alias("text"))
    jobs = G.page_jobs(snippets, d.select(F.col("doc_id").alias("case_id"), name, F.expr(_PAGED).alias("text")), 4)
    return jobs.select(F.col("case_id").alias("doc_id"), "page", "priority")


_APP = "concat('EP', lpad(CAST({} AS VARCHAR(20)), 8, '0'))"
#: A file of a case and a row of its download indexes, from a line.
_HELD = """CASE l_partkey % 14 WHEN 0 THEN concat('register/', app, '-main.html') WHEN 1 THEN concat('register/', app, '-doclist.html') WHEN 2 THEN concat('register/', app, '-doclist.csv') WHEN 3 THEN concat(app, '-benchmark-input.json') WHEN 4 THEN concat(app, '-analysis.json') WHEN 5 THEN concat(app, '-analysis.html')
WHEN 6 THEN 'docs/download-index.csv' WHEN 7 THEN 'original-application/download-index.csv' WHEN 8 THEN 'docs/a.pdf' WHEN 9 THEN 'docs/a.txt' WHEN 10 THEN 'docs/claims.pdf' WHEN 11 THEN 'docs/claims_ocr.txt' WHEN 12 THEN 'docs/claims.txt' ELSE 'original-application/o.pdf' END"""
_LISTED = "CASE l_suppkey % 4 WHEN 0 THEN 'a.pdf' WHEN 1 THEN 'x/claims.pdf' WHEN 2 THEN 'gone.pdf' ELSE 'o.pdf' END"
_SCOPE = "CASE WHEN l_linenumber % 3 = 0 THEN 'original-application' ELSE 'docs' END"
_SIZE = "CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_suppkey END"
_REQUIRED_SQL = ", ".join("'" + p.replace("{app}", "' || app || '") + "'" for p in N.REQUIRED)
_VALID_SQL = f"""WITH l AS (SELECT *, {_APP.format("l_orderkey")} AS app FROM lineitem), f AS (SELECT app, {_HELD} AS path, max({_SIZE}) AS length, arg_max(l_suppkey % 3 <> 0, {_SIZE}) AS pdf FROM l GROUP BY 1, 2),
x AS (SELECT app, scope, file, row_number() OVER (PARTITION BY app, scope ORDER BY l_linenumber, file) AS place FROM (SELECT app, {_SCOPE} AS scope, l_linenumber, regexp_extract({_LISTED}, '[^/]*$') AS file FROM l)), c AS (SELECT {_APP.format("o_orderkey")} AS app FROM orders),
q AS (SELECT app, unnest([{_REQUIRED_SQL}]) AS path, unnest(range({len(N.REQUIRED)})) AS n FROM c),
r AS (SELECT q.app, 0 AS rule, n, '' AS file, 0 AS part, CASE WHEN length IS NULL THEN 'missing ' || path WHEN length = 0 THEN 'empty ' || path END AS issue FROM q LEFT JOIN f USING (app, path)),
s AS (SELECT app, scope, rule FROM c, (VALUES ('docs', 1), ('original-application', 2)) v(scope, rule)),
h AS (SELECT s.*, f.app IS NOT NULL AS has FROM s LEFT JOIN f ON f.app = s.app AND f.path = scope || '/download-index.csv'),
i AS (SELECT h.app, rule, scope, place, file FROM h JOIN x USING (app, scope) WHERE has),
p AS (SELECT i.*, pdf.length AS pdf_size, pdf.pdf AS ok, txt.length AS txt_size, ocr.length AS ocr_size FROM i LEFT JOIN f pdf ON pdf.app = i.app AND pdf.path = scope || '/' || file LEFT JOIN f txt ON txt.app = i.app AND txt.path = scope || '/' || replace(file, '.pdf', '.txt') LEFT JOIN f ocr ON ocr.app = i.app AND ocr.path = scope || '/' || replace(file, '.pdf', '_ocr.txt')),
a AS (SELECT app, rule, issue, n, file, part FROM r WHERE issue IS NOT NULL UNION ALL SELECT app, rule, 'missing ' || scope || '/download-index.csv', 0, '', 0 FROM h WHERE NOT has UNION ALL SELECT app, rule, 'empty ' || scope || '/download-index.csv', 0, '', 0 FROM h WHERE has AND NOT EXISTS (SELECT 1 FROM x WHERE x.app = h.app AND x.scope = h.scope)
      UNION ALL SELECT app, rule, 'missing PDF: ' || scope || '/' || file, place, file, 0 FROM p WHERE pdf_size IS NULL UNION ALL SELECT app, rule, CASE WHEN pdf_size = 0 THEN 'empty PDF: ' ELSE 'bad PDF header: ' END || scope || '/' || file, place, file, 0 FROM p WHERE pdf_size = 0 OR NOT ok
      UNION ALL SELECT app, rule, 'missing TXT: ' || scope || '/' || replace(file, '.pdf', '.txt'), place, file, 1 FROM p WHERE pdf_size IS NOT NULL AND rule = 1 AND coalesce(txt_size, 0) = 0
      UNION ALL SELECT app, rule, 'missing key OCR: ' || scope || '/' || replace(file, '.pdf', '_ocr.txt'), place, file, 2 FROM p WHERE pdf_size IS NOT NULL AND rule = 1 AND file = 'claims.pdf' AND coalesce(ocr_size, 0) <= 80)
SELECT app AS case_id, CASE WHEN count(issue) = 0 THEN 'pass' ELSE 'fail' END AS status, count(issue) AS n, coalesce(string_agg(issue, ';' ORDER BY rule, n, file, part), '') AS issues FROM c LEFT JOIN a USING (app) GROUP BY app"""


@query(_VALID_SQL)
def case_validation(t):
    """Every case's files and download indexes against each other."""
    lines = t("lineitem").withColumn("app", F.expr(_APP.format("l_orderkey")))
    files = lines.select(F.col("app").alias("case_id"), F.expr(_HELD).alias("path"), F.expr(_SIZE).cast("long").alias("length"), (F.col("l_suppkey") % 3 != 0).alias("pdf"), F.lit("").alias("sha256"))
    index = lines.select(F.col("app").alias("case_id"), F.expr(_SCOPE).alias("scope"), F.col("l_linenumber").alias("place"), F.expr(_LISTED).alias("file"))
    none = [F.lit(None).cast("string").alias(c) for c in ("claims", "benchmark", "analysis", "html")]
    v = N.validate(t("orders").select(F.expr(_APP.format("o_orderkey")).alias("case_id"), *none), files, index)
    return v.select("case_id", "status", F.size("issues").cast("long").alias("n"), F.array_join("issues", ";").alias("issues"))


#: An analysis with scores in several shapes, evidence by issue and discussions, from an order.
_BORNE = """concat('{"dimension_scores":{"clarity_disc":{"original_text":"E', CAST(o_custkey % 3 AS VARCHAR(9)), '  here","translation":"t"},"clarity_score":"', CAST(o_custkey % 50 AS VARCHAR(9)), '","novelty_disc":"text","novelty_score":', CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE CAST(o_orderkey % 60 AS VARCHAR(9)) END, ',"support_disc":{"original_text":"s","translation":"', CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'ts' END, '","source":"d.pdf"},"support_score":', CAST(o_custkey % 40 AS VARCHAR(9)),
'},"evidence_trace":{"examination_material_evidence":[{"issue":" Novelty ","original_text":"e', CAST(o_orderkey % 3 AS VARCHAR(9)), ' here","translation":"t1","relevance":"why"},"loose",{"issue":"support","location":"p. 3","original_text":" n ","translation":"t2"},{"issue":"other","original_text":"o","translation":"t"},{"issue":"novelty","original_text":"more","translation":"t3","source":"e.pdf"}]}}')"""
_BORNE_SQL = f"""WITH d AS (SELECT o_orderkey, CAST({_BORNE} AS JSON) AS j FROM orders),
c AS (SELECT o_orderkey, CASE WHEN issue IN ('novelty', 'support') THEN issue END AS dim, n, trim(json_extract_string(x, '$.original_text')) AS text, trim(json_extract_string(x, '$.translation')) AS said, coalesce(json_extract_string(x, '$.source'), json_extract_string(x, '$.location'), 'examination_material_evidence') AS source, coalesce(json_extract_string(x, '$.relevance'), '{A.EXPLANATION}') AS why, j
      FROM (SELECT o_orderkey, j, n, json_extract(j, '$.evidence_trace.examination_material_evidence[' || n || ']') AS x, lower(trim(json_extract_string(x, '$.issue'))) AS issue FROM d, range(0, 5) r(n))
      UNION ALL SELECT o_orderkey, dim, 9, trim(json_extract_string(x, '$.original_text')), trim(json_extract_string(x, '$.translation')), coalesce(json_extract_string(x, '$.source'), dim || '_disc'), '{A.EXPLANATION}', j FROM (SELECT o_orderkey, j, dim, json_extract(j, '$.dimension_scores.' || dim || '_disc') AS x FROM d, (VALUES ('novelty'), ('support'), ('clarity')) v(dim)) WHERE json_type(x) = 'OBJECT'),
s AS (SELECT *, coalesce(TRY_CAST(json_extract_string(j, '$.dimension_scores.' || dim || '_score') AS DOUBLE), 101) AS score, list_position({_DIMS}, dim) AS place FROM c WHERE dim IS NOT NULL AND text <> '' AND said <> ''),
u AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY o_orderkey, lower(regexp_replace(text, '\\s+', ' ', 'g')) ORDER BY score, place, n) = 1),
r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY score, place, n) AS n, dim, source, text, said, why FROM u)
SELECT o_orderkey AS case_id, n AS place, dim AS issue, source, text, said AS translation, why FROM r WHERE n <= 5"""


@query(_BORNE_SQL)
def risk_source_sentences(t):
    """Passages that bear the risks of every analysis out, the weakest dimension's first."""
    d = spread(t("orders").select("o_orderkey", "o_custkey")).select(F.col("o_orderkey").alias("case_id"), A.read(F.expr(_BORNE)).alias("v")).select("case_id", A.source_sentences(F.col("v")).alias("s"))
    rows = d.select("case_id", F.posexplode_outer("s").alias("n", "x")).filter("x IS NOT NULL")
    return rows.select("case_id", (F.col("n") + 1).cast("long").alias("place"), "x.issue", "x.source", F.col("x.original_text").alias("text"), "x.translation", F.col("x.llm_evidence_explanation").alias("why"))
