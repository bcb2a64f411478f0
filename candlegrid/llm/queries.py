"""The registered queries over the driver's tables: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegrid.llm import fingerprints, license_scan, merkle, substring_dedup, toxicity
from candlegrid.llm.bpe_codec import digests, encode
from candlegrid.llm.byte_codec import byte_digests, encode_bytes
from candlegrid.llm.conversation_trie import prefix_trie
from candlegrid.llm.decontamination import contamination, contamination_digests
from candlegrid.llm.lm_scoring import lm_scores
from candlegrid.llm.near_dedup import hexadecimal, near_duplicates
from candlegrid.llm.pii import find_pii, span_digests
from candlegrid.llm.token_counts import token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels"), folds=5))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.deduplicated(_table(spark, sf_dir, "documents"), 13))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_pii(_table(spark, sf_dir, "documents")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(_table(spark, sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digests(contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_digests(merkle.manifest(_table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_digests(encode_bytes(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_pii": op5_pii,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_fingerprints": op8_fingerprints,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_byte_bpe": op13_byte_bpe,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
runs AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS run FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
earliest AS (SELECT run, min(doc_id) AS first_doc FROM runs GROUP BY run),
gone AS (SELECT DISTINCT doc_id, p FROM runs JOIN earliest USING (run), unnest(range(i, i + 13)) AS u(p) WHERE first_doc < doc_id),
places AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS u(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_CUT = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP9 = rf"""
WITH w AS (SELECT doc_id, {_CUT} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_CUT} AS ws FROM benchmark WHERE item_id IS NOT NULL),
phrases AS (SELECT DISTINCT item, s, array_to_string(ws[i : i + s - 1], ' ') AS phrase
  FROM (SELECT *, least(10, len(ws)) AS s FROM items WHERE len(ws) > 0), unnest(range(1, len(ws) - s + 2)) AS t(i)),
sizes AS (SELECT DISTINCT s FROM phrases),
runs AS (SELECT doc_id, i, s, array_to_string(ws[i : i + s - 1], ' ') AS phrase FROM w, sizes, unnest(range(1, len(ws) - s + 2)) AS t(i)),
hits AS (SELECT doc_id, i, s, item FROM runs JOIN phrases USING (s, phrase)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + s)) AS u(p) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS told FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(told, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

# CRC-32 of a decimal number, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _fields(n_chars: str) -> str:
    return " || ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text"))


_OP11 = rf"""
WITH RECURSIVE rows AS (SELECT doc_id, lang, sha256({_fields("n_chars")}) AS leaf,
  CASE WHEN n_chars IS NOT NULL AND {_CRC32.format("doc_id")} % 7 = 0 THEN sha256({_fields("n_chars + 1")}) END AS tampered FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM rows),
nodes AS (SELECT lang, 0 AS lvl, i, n, leaf AS d FROM leaves UNION ALL
  SELECT lang, lvl + 1, i // 2, (n + 1) // 2, sha256(d || coalesce(after, '')) FROM (SELECT *, lead(d) OVER (PARTITION BY lang ORDER BY i) AS after FROM nodes) WHERE n > 1 AND i % 2 = 0),
subroots AS (SELECT lang, d, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS lvl, i, n, d FROM subroots UNION ALL
  SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(d || coalesce(after, '')) FROM (SELECT *, lead(d) OVER (ORDER BY i) AS after FROM upper) WHERE n > 1 AND i % 2 = 0),
steps AS (SELECT l.lang, l.i, p.lvl, p.i % 2 AS side, s.d FROM leaves l JOIN nodes p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i >> p.lvl AND p.n > 1
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = p.lvl AND s.i = xor(p.i, 1)
  UNION ALL SELECT l.lang, l.i, 100 + p.lvl, p.i % 2, s.d FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN upper p ON p.i = r.i >> p.lvl AND p.n > 1
    LEFT JOIN upper s ON s.lvl = p.lvl AND s.i = xor(p.i, 1)),
proofs AS (SELECT lang, i, coalesce(string_agg(d, '' ORDER BY lvl), '') AS told, list(struct_pack(side, d) ORDER BY lvl) AS path FROM steps GROUP BY lang, i),
climb AS (SELECT l.lang, l.i, 0 AS done, coalesce(path, []) AS path, coalesce(tampered, leaf) AS d FROM leaves l LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i UNION ALL
  SELECT lang, i, done + 1, path, sha256(CASE WHEN path[done + 1].side = 1 THEN path[done + 1].d || d ELSE d || coalesce(path[done + 1].d, '') END) FROM climb WHERE done < len(path))
SELECT doc_id, leaf, s.d AS subroot, u.d AS root, sha256(coalesce(p.told, '')) AS proof_sha256, c.d AS folded_root, c.d = u.d AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN (SELECT d FROM upper WHERE n = 1) u ON true
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i = l.i
JOIN climb c ON c.lang IS NOT DISTINCT FROM l.lang AND c.i = l.i AND c.done = len(c.path)"""

_OP12 = rf"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(said ORDER BY p) AS said, {_CRC32.format("conv_id")} % 9 AS h FROM turns GROUP BY conv_id),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.said, [])[1 : c.h], c.said[c.h + 1 :]) AS said FROM whole c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 5),
steps AS (SELECT conv_id, d, said[1 : d] AS node, len(said) = d AS here FROM rebuilt, unnest(range(len(said) + 1)) AS u(d)),
nodes AS (SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  string_agg(CASE WHEN here THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM steps GROUP BY node),
kids AS (SELECT node[1 : depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (SELECT a.node[1 : u.d] AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves,
  sum((a.n_convs - 1) * CASE WHEN a.depth > 0 THEN strlen(a.node[a.depth].t) ELSE 0 END) AS saved
  FROM nodes a LEFT JOIN kids k USING (node), unnest(range(a.depth + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes p ON p.node = n.node[1 : n.depth - 1] AND n.depth > 0"""

SQL: dict[str, str] = {"op2_substring_dedup": _OP2, "op9_decontamination": _OP9, "op11_merkle_manifest": _OP11, "op12_prefix_trie": _OP12}
