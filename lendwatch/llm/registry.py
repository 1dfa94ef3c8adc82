"""Registered queries of this subpackage: thin contracts over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendwatch.llm import (
    embedding_dedup,
    license_scan,
    merkle,
    mixing,
    near_dup,
    packing,
    periodic,
    pieces,
    repeats,
    secret_scan,
    top_k,
    toxicity,
    warc,
)
from lendwatch.llm.settings import PACKING, PIECE_MODEL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        return run

    return register


@_query("op1_top_k_search")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k_report(_table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op1_top_k_search"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.toxicity_report(docs, labels).drop("evidence")


@_query("op3_minhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.cluster(_table(spark, sf_dir, "documents"))


ORACLE_SQL["op3_minhash_dedup"] = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
  FROM worded),
numbered AS (SELECT doc_id, md5_number(s) AS h FROM shingled),
sizes AS (SELECT doc_id, count(*) AS n FROM numbered GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM numbered a JOIN numbered b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM both_have c JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS low FROM documents
  UNION SELECT ways.v, reach.low FROM reach JOIN ways ON ways.u = reach.node),
lowest AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN lowest ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@_query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(_table(spark, sf_dir, "documents"))


@_query("op9_source_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


@_query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents")).drop("evidence")


@_query("op6_embedding_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_report(_table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op6_embedding_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION SELECT links.v, reach.low FROM reach JOIN links ON links.u = reach.node),
lowest AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN lowest ON node = e.vec_id LEFT JOIN degree ON u = e.vec_id
"""


@_query("op7_repeat_removal")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(_table(spark, sf_dir, "documents"))


@_query("op8_warc_round_trip")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


ORACLE_SQL["op8_warc_round_trip"] = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
lettered AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY html) AS response
  FROM hashed)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM lettered
"""


@_query("op10_pack_sequences")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), PACKING)


@_query("op12_piece_encoding")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_report(_table(spark, sf_dir, "documents"), PIECE_MODEL)


@_query("op11_merkle_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def _reduced_sql(name: str, levels: int) -> str:
    """CTEs that fold ``<name>_a0`` (ways) over ``<name>_n0`` (nodes) up to ``<name>_a<levels>``, 16 by 16."""
    parts = []
    for k in range(levels):
        parts.append(f"""
{name}_s{k} AS (
  SELECT tree, p, h, count(*) OVER (PARTITION BY tree) AS n,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_n{k}),
{name}_n{k + 1} AS (
  SELECT tree, p // 16 AS p, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
  FROM {name}_s{k} GROUP BY tree, p // 16),
{name}_a{k + 1} AS (
  SELECT a.own, a.doc_id, a.leaf, a.tree, a.p // 16 AS p,
    CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f, CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof
  FROM {name}_a{k} a JOIN {name}_s{k} s ON a.tree = s.tree AND a.p = s.p),""")
    return "".join(parts)


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    encoded = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(encoded)})"


# Six levels for a source and four for the sources: 16 million leaves a source, 65,536 sources.
ORACLE_SQL["op11_merkle_manifest"] = f"""
WITH lowered AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda s, b: list_reduce(list_prepend(xor(s, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {_leaf_sql("low")} ELSE {_leaf_sql("text")} END AS claimed
  FROM lowered),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    row_number() OVER () AS own FROM hashed),
t_n0 AS (SELECT tree, p, leaf AS h FROM placed),
t_a0 AS (SELECT own, doc_id, leaf, tree, p, claimed AS f, '' AS proof FROM placed),
{_reduced_sql("t", 6)}
sources AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS p FROM t_n6),
o_n0 AS (SELECT '' AS tree, p, h FROM sources),
o_a0 AS (SELECT own, doc_id, leaf, '' AS tree, s.p, f, proof FROM t_a6 a JOIN sources s ON a.tree = s.tree),
{_reduced_sql("o", 4)}
ended AS (SELECT a.*, b.h AS root FROM o_a4 a, o_n4 b)
SELECT e.doc_id, e.leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM ended e JOIN placed q ON q.own = e.own JOIN sources s ON s.tree = q.tree
"""


@_query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_report(periodic.with_planted_periods(_table(spark, sf_dir, "documents")))
