"""The registered queries of the operators, with the same in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    bpe,
    caps,
    dac,
    decontaminate,
    merkle,
    pii,
    quality,
    secret_scan,
    similarity,
    token_counts,
    toxicity,
    trie,
    warc,
)
from sluice.llm.rows import read_table

Run = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def held_out(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.hits(documents, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ensemble = quality.train(documents, read_table(spark, sf_dir, "labels"))
    return quality.score(documents, ensemble).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, read_table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.join(read_table(spark, sf_dir, "documents"))


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.link(read_table(spark, sf_dir, "embeddings"))


def attributed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(documents, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.scan(documents, pii.train(documents))


def merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))


def conversation_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Run] = {
    "op1_secret_scan": secrets,
    "op2_decontamination": contamination,
    "op3_token_files": token_files,
    "op4_quality": quality_scores,
    "op5_toxicity": toxicity_scores,
    "op6_bpe": bpe_round_trip,
    "op7_warc": warc_round_trip,
    "op8_jaccard_join": jaccard_join,
    "op9_embedding_dedup": embedding_links,
    "op10_token_counts": attributed_tokens,
    "op11_personal_data": personal_data,
    "op12_merkle": merkle_proofs,
    "op13_prefix_trie": conversation_nodes,
}

_LOWERED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWERED + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_CONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS ws FROM documents),
words AS (SELECT r, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
items AS (SELECT row_number() OVER () AS r, item_id, {_WORDS.format("text")} AS ws FROM benchmark),
item_words AS (
  SELECT r, item_id, least(len(ws), 13) AS size, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM items
),
wanted AS (
  SELECT DISTINCT item_id, size, run FROM (
    SELECT item_id, size, n, pos, string_agg(word, ' ') OVER (
      PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS run
    FROM item_words) WHERE pos + size - 1 <= n
),
runs AS (
  SELECT r, n, pos, size, string_agg(word, ' ') OVER (
    PARTITION BY r, size ORDER BY pos ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS run
  FROM words, (SELECT DISTINCT size FROM wanted)
),
found AS (
  SELECT r, pos, size, item_id FROM runs JOIN wanted USING (size, run) WHERE pos + size - 1 <= n
),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (
  SELECT r, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_LETTERS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS32}', ((('0x' || substr(digest, {5 * i + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)
_WARC = f"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads
"""

_VALUE = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(map(_VALUE.format, ("doc_id", "source", "lang", "n_chars"))) + " || {0})"
_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The checksum of gzip and zip, a bit at a time, over a list of at most 20 characters.
_CRC = """xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""


def _tree(name: str, leaves: str) -> str:
    """Nodes of 16-ary trees: ``tree, level, idx, digest, n``, from rows of level 0; ``n`` nodes are on a level."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, idx, digest, n FROM ({leaves})
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 16
),
{name}_runs AS (
  SELECT tree, level, idx,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, idx // 16 ORDER BY idx)
)"""


_SUBROOTS = """SELECT 0 AS tree, (row_number() OVER (ORDER BY tree) - 1)::BIGINT AS idx, digest,
  count(*) OVER () AS n, tree AS below FROM rows_up WHERE n = 1"""
_MERKLE = f"""
WITH RECURSIVE digested AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_LEAF.format(_VALUE.format("text"))} AS digest,
    CASE WHEN {_CRC.format("doc_id")} % 5 = 0 THEN {_LEAF.format(_VALUE.format(_TAMPERED))} END AS presented
  FROM documents
),
leaves AS (
  SELECT *, (row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1)::BIGINT AS idx,
    count(*) OVER (PARTITION BY tree) AS n
  FROM digested
),
{_tree("rows_up", "SELECT tree, idx, digest, n FROM leaves")},
subroots AS ({_SUBROOTS}),
{_tree("tops_up", "SELECT tree, idx, digest, n FROM subroots")},
steps AS (
  SELECT l.tree AS leaf_tree, l.idx AS leaf_idx, r.level AS step, before, after
  FROM leaves l JOIN rows_up_runs r ON r.tree = l.tree AND r.idx = l.idx // (16 ** r.level)::BIGINT
  UNION ALL
  SELECT l.tree, l.idx, 100 + r.level, before, after
  FROM leaves l JOIN subroots s ON s.below = l.tree JOIN tops_up_runs r ON r.idx = s.idx // (16 ** r.level)::BIGINT
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY leaf_tree, leaf_idx ORDER BY step) AS nth FROM steps
),
folds AS (
  SELECT tree, idx, 0::BIGINT AS nth, coalesce(presented, digest) AS digest FROM leaves
  UNION ALL
  SELECT tree, idx, f.nth + 1, sha256(before || digest || after)
  FROM folds f JOIN numbered s ON s.leaf_tree = tree AND s.leaf_idx = idx AND s.nth = f.nth + 1
),
ends AS (SELECT tree, idx, arg_max(digest, nth) AS folded_root FROM folds GROUP BY tree, idx),
proofs AS (
  SELECT leaf_tree AS tree, leaf_idx AS idx, string_agg(before || after, '' ORDER BY nth) AS proof
  FROM numbered GROUP BY leaf_tree, leaf_idx
)
SELECT doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  (octet_length(encode(coalesce(proof, ''))) // 64)::BIGINT AS n_siblings, folded_root, folded_root = t.digest AS verified
FROM leaves l JOIN subroots s ON s.below = l.tree JOIN ends e ON e.tree = l.tree AND e.idx = l.idx
  LEFT JOIN proofs p ON p.tree = l.tree AND p.idx = l.idx CROSS JOIN (SELECT digest FROM tops_up WHERE n = 1) t
"""

_TRIE = f"""
WITH own AS (
  SELECT conv_id, list({{'h': h, 'chars': length(t)}} ORDER BY turn NULLS FIRST, h) AS ts FROM (
    SELECT conv_id, turn, coalesce(text, '') AS t,
      md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
    FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
),
sized AS (SELECT *, {_CRC.format("conv_id")} % 6 AS n FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(list_slice(b.ts, 1, o.n), []), list_slice(o.ts, o.n + 1, len(o.ts))) AS ts
  FROM sized o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
),
paths AS (
  SELECT conv_id, ts, array_to_string(list_transform(ts, lambda x: x.h), '') AS path, len(ts) AS n,
    unnest(range(0, len(ts) + 1)) AS depth FROM rebuilt
),
members AS (
  SELECT conv_id, depth, left(path, 32 * depth) AS key, CASE WHEN depth > 0 THEN ts[depth].chars ELSE 0 END AS chars,
    n = depth AS ends FROM paths
),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY depth, key
),
kids AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
spread AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted),
subtrees AS (
  SELECT up AS depth, left(key, 32 * up) AS key, count(*) FILTER (n_children = 0) AS n_leaves,
    sum((n_convs - 1) * chars) AS saved_tokens
  FROM spread GROUP BY 1, 2
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.depth = c.depth AND s.key = c.key
  LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.key = left(c.key, 32 * (c.depth - 1))
"""

SQL: dict[str, str] = {
    "op2_decontamination": _CONTAMINATION,
    "op7_warc": _WARC,
    "op12_merkle": _MERKLE,
    "op13_prefix_trie": _TRIE,
}
