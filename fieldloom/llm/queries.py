"""Queries of this subpackage for the driver: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm.common import documents


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.pii import digest, personal_data

    return digest(personal_data(documents(spark, sf_dir)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.quality import quality_rules

    return quality_rules(documents(spark, sf_dir))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.html_text import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.line_dedup import line_dedup

    return line_dedup(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.tokencount import token_counts

    return token_counts(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.packing import pack

    return pack(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.mixing import mixed

    return mixed(documents(spark, sf_dir))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.jaccard_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldloom.llm.toxicity import toxicity

    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_quality_rules, op3_html_extraction, op4_line_dedup, op5_token_counts, op6_fingerprints, op7_packing, op8_mixing, op9_jaccard_join, op10_toxicity)}


_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Runs of at most ten lines do: each line holds a word, and a longer repeated run is the union of those in it.
_OP4 = rf"""
WITH lines AS (
  SELECT doc_id, x, line, regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS id, len({_WORDS.format("x")}) AS words
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents)
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS place FROM lines WHERE words > 0),
ahead AS (
  SELECT doc_id, place, list(id) OVER w AS ids, list(words) OVER w AS counts FROM numbered
  WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)
),
runs AS (
  SELECT doc_id, place, size, array_to_string(ids[1:size], chr(10)) AS name
  FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS size FROM ahead) WHERE list_sum(counts[1:size]) >= 10
),
later AS (SELECT doc_id, place, size FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, place) AS k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, place + unnest(range(0, size)) AS place FROM later),
marked AS (
  SELECT l.doc_id, l.line, l.x, n.place IS NOT NULL AS full_line, g.place IS NOT NULL AS gone
  FROM lines l LEFT JOIN numbered n ON l.doc_id = n.doc_id AND l.line = n.line LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.place = g.place
),
summed AS (
  SELECT doc_id, count(*) FILTER (full_line) AS n_lines, count(*) FILTER (gone) AS n_deleted, string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone) AS rest
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN n_deleted = 0 THEN text WHEN n_deleted = n_lines THEN '' ELSE rest END AS text, n_lines, n_deleted FROM documents d JOIN summed s ON d.doc_id = s.doc_id
"""

_OP9 = rf"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM split
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM reach r JOIN edges e ON r.doc_id = e.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express; the others learn, hash or tokenise."""
    return {"op4_line_dedup": _OP4, "op9_jaccard_join": _OP9}
