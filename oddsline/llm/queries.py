"""The registered queries of the training-data operators, with their contracts' parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.llm import (
    bpe, chat, forest, html_main, merkle, mixing, ngram_join, packing, rans, topk, toxicity, url_rules, whitening,
)
from oddsline.llm.common import written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
CONTROL = "<|im_end|><|im_start|>assistant ok"  # the texts of conversation -1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark, sf_dir):
    return forest.nearest(_table(spark, sf_dir, "embeddings"))


def op2(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(_table(spark, sf_dir, "pages"), rules)


def op3(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op4(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5(spark, sf_dir):
    return rans.encode_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op6(spark, sf_dir):
    sized = written(mixing.sized(_table(spark, sf_dir, "documents")), "sized")
    mix = mixing.mixed(sized, mixing.plan(sized))
    return mix.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op7(spark, sf_dir):
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op8(spark, sf_dir):
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.examples(rows))


def op9(spark, sf_dir):
    return topk.exact_topk(_table(spark, sf_dir, "embeddings"))


def op10(spark, sf_dir):
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op11(spark, sf_dir):
    return merkle.audit(_table(spark, sf_dir, "documents"))


def op12(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"), TOKENIZER)


def op13(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rp_forest_nearest": op1,
    "op2_url_rules": op2,
    "op3_best_fit_packing": op3,
    "op4_toxicity": op4,
    "op5_rans_token_files": op5,
    "op6_source_mixing": op6,
    "op7_main_text": op7,
    "op8_chat_examples": op8,
    "op9_exact_topk": op9,
    "op10_ngram_join": op10,
    "op11_merkle_manifest": op11,
    "op12_bpe_round_trip": op12,
    "op13_whitening": op13,
}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

ORACLES: dict[str, str] = {
    "op2_url_rules": f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES_SQL}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                arg_max(verdict, length(rule_host || rule_path)) AS verdict
         FROM parts JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
         GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
""",
    "op9_exact_topk": """
WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_ngram_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(w)] ELSE
         list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i+4]))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
           FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM sets JOIN component USING (doc_id) LEFT JOIN degree USING (doc_id)
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS i, text AS t, source AS s,
         CAST(n_chars AS VARCHAR) AS n, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR) AS raised FROM documents),
parts AS (
  SELECT doc_id, lang, n, raised,
         CASE WHEN i IS NULL THEN '-' ELSE strlen(i) || ':' || i END || CASE WHEN s IS NULL THEN '-' ELSE strlen(s) || ':' || s END ||
         CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS a,
         CASE WHEN t IS NULL THEN '-' ELSE strlen(t) || ':' || t END AS z,
         -- crc32 of the decimal id, bit by bit
         xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, strlen(i) + 1),
             lambda k: list_transform(range(0, 8), lambda b: CAST((ascii(substr(i, CAST(k AS INTEGER), 1)) >> CAST(b AS INTEGER)) & 1 AS BIGINT))))),
             lambda c, b: xor(c >> 1, CAST(xor(c & 1, b) AS BIGINT) * 3988292384))) AS crc FROM fields),
leaves AS (
  SELECT doc_id, lang, sha256(a || CASE WHEN n IS NULL THEN '-' ELSE strlen(n) || ':' || n END || z) AS leaf,
         CASE WHEN crc % 7 = 0 AND n IS NOT NULL THEN sha256(a || strlen(raised) || ':' || raised || z) END AS changed FROM parts),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS digest, n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2) FROM nodes WHERE n > 1
  GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, level AS high, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree_at,
                    count(*) OVER () AS trees FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, tree_at AS pos, subroot AS digest, trees AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 1) // 2) FROM upper WHERE n > 1
  GROUP BY level, pos // 2),
root AS (SELECT digest AS root, level AS high FROM upper WHERE n = 1),
path AS (  -- of every leaf: its levels up to the root, and its sibling at each
  SELECT p.lang, p.pos, k AS step, (p.pos >> k) & 1 AS side, s.digest AS sibling
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN range(0, 64) AS g(k)
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = k AND s.pos = xor(p.pos >> k, 1) WHERE k < r.high
  UNION ALL
  SELECT p.lang, p.pos, r.high + k, (r.tree_at >> k) & 1, s.digest
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN root t CROSS JOIN range(0, 64) AS g(k)
  LEFT JOIN upper s ON s.level = k AND s.pos = xor(r.tree_at >> k, 1) WHERE k < t.high),
folding AS (
  SELECT lang, pos, 0 AS step, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.lang, f.pos, f.step + 1, sha256(CASE WHEN p.sibling IS NULL THEN f.digest WHEN p.side = 1 THEN p.sibling || f.digest
                                               ELSE f.digest || p.sibling END)
  FROM folding f JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.pos = f.pos AND p.step = f.step),
folded AS (SELECT lang, pos, arg_max(digest, step) AS folded_root FROM folding GROUP BY lang, pos),
proofs AS (SELECT lang, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM path GROUP BY lang, pos)
SELECT p.doc_id, p.leaf, r.subroot, t.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = t.root AS verified
FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN root t
JOIN folded f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
""",
}
