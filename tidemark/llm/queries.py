"""The registered ``opN_*`` queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, chat, language, lexical, manifest, neighbours, packing, quality, recompression, simhash,
                          substrings, token_counts)
from tidemark.llm import exact_dedup as exact
from tidemark.llm.common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_encode(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), texts=False)


@query
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality.held_out(F.col("doc_id"), 4, 2)
    found = language.identify(docs, docs.filter(~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


@query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLE["op8_exact_dedup"] = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""


@query
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op6_neighbours"] = """
WITH good AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
              WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
all_pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
              FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM all_pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLE["op9_chat"] = """
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (SELECT conv_id, role, text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS pos FROM said),
seen AS (SELECT p.conv_id, w.speaker, (p.pos // 64)::INT AS piece, p.pos, p.role = w.speaker AS mine, p.text,
           CASE WHEN p.role = w.speaker THEN '<|assistant|>' ELSE '<|user:' || p.role || '|>' END || chr(10) AS head
         FROM placed p JOIN (SELECT DISTINCT conv_id, role AS speaker FROM said) w
           ON p.conv_id IS NOT DISTINCT FROM w.conv_id),
sized AS (SELECT *, coalesce(sum(length(head) + length(text) + 8) OVER (
             PARTITION BY conv_id, speaker, piece ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
          FROM seen)
SELECT conv_id, speaker, piece, count(*)::INT AS n_turns,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered,
       coalesce(string_agg(CASE WHEN mine THEN (begun + length(head))::VARCHAR || ':' || (length(text) + 7)::VARCHAR END, ','
                           ORDER BY pos), '') AS mask,
       coalesce(sum(CASE WHEN mine THEN length(text) + 7 END), 0)::INT AS n_masked
FROM sized GROUP BY conv_id, speaker, piece
"""


# -- op11: the tree folded level by level, proofs by the siblings' places ---------

def _field(e: str) -> str:
    return f"CASE WHEN {e} IS NULL THEN '-' ELSE strlen(({e})::VARCHAR) || ':' || ({e})::VARCHAR END"


def _leaf(count: str) -> str:
    return "sha256(" + " || ".join(_field(e) for e in ("doc_id", "source", "lang", count, "text")) + ")"


_CRC32 = """xor(4294967295, list_reduce(
    list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT))"""


def _folding(out: str, nodes: str, tree: str) -> str:
    """Every leaf of ``nodes`` (r, tree, idx, node) folded with its siblings in ``tree``."""
    return f"""{out} AS (
  SELECT r, tree, idx, 0 AS lvl, node FROM {nodes}
  UNION ALL
  SELECT f.r, f.tree, f.idx, f.lvl + 1,
         sha256(CASE WHEN s.digest IS NULL THEN f.node WHEN (f.idx >> f.lvl) & 1 = 1 THEN s.digest || f.node ELSE f.node || s.digest END)
  FROM {out} f JOIN (SELECT tree, max(lvl) AS height FROM {tree} GROUP BY tree) h ON h.tree IS NOT DISTINCT FROM f.tree AND f.lvl < h.height
  LEFT JOIN {tree} s ON s.tree IS NOT DISTINCT FROM f.tree AND s.lvl = f.lvl AND s.idx = xor(f.idx >> f.lvl, 1))"""


def _tree(out: str, leaves: str) -> str:
    return f"""{out} AS (
  SELECT tree, 0 AS lvl, idx, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2
  FROM {out} WHERE n > 1 GROUP BY tree, lvl, idx // 2, n)"""


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


ORACLE["op11_manifest"] = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_CRC32} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS node
  FROM documents),
leaves AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                  count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_tree('up', 'leaves')},
subroots AS (SELECT 0 AS tree, tree AS lang, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
             FROM up WHERE n = 1),
{_tree('over', 'subroots')},
{_folding('folded', 'leaves', 'up')},
upper AS (SELECT f.r, 0 AS tree, g.idx, f.node FROM folded f JOIN subroots g ON g.lang IS NOT DISTINCT FROM f.tree
          JOIN (SELECT tree, max(lvl) AS height FROM up GROUP BY tree) h ON h.tree IS NOT DISTINCT FROM f.tree AND f.lvl = h.height),
{_folding('refolded', 'upper', 'over')},
siblings AS (
  SELECT l.r, 0 AS part, s.lvl, s.digest FROM leaves l JOIN up s
    ON s.tree IS NOT DISTINCT FROM l.tree AND s.idx = xor(l.idx >> s.lvl, 1)
  UNION ALL
  SELECT l.r, 1, s.lvl, s.digest FROM leaves l JOIN subroots g ON g.lang IS NOT DISTINCT FROM l.tree
    JOIN over s ON s.idx = xor(g.idx >> s.lvl, 1)),
proofs AS (SELECT r, string_agg(digest, '' ORDER BY part, lvl) AS proof FROM siblings GROUP BY r),
roots AS (SELECT digest AS root, lvl AS height FROM over WHERE n = 1)
SELECT l.doc_id, l.leaf, g.digest AS subroot, t.root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.node AS folded_root,
       f.node = t.root AS verified
FROM leaves l JOIN subroots g ON g.lang IS NOT DISTINCT FROM l.tree CROSS JOIN roots t
JOIN refolded f ON f.r = l.r AND f.lvl = t.height LEFT JOIN proofs p ON p.r = l.r
"""


@query
def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_earlier(table(spark, sf_dir, "documents"))


ORACLE["op12_passages"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k
            FROM (SELECT *, unnest(range(1, len(w) - 48)) AS p FROM d)),
firsts AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS i FROM windows JOIN firsts USING (k) WHERE least < doc_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256, coalesce(text, '') AS text
FROM d LEFT JOIN kept USING (r)
"""


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

ORACLE["op13_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
counts AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {_TERMS.format('text')} AS term FROM d) GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM counts GROUP BY r),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts CROSS JOIN whole GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS.format('text')} AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, r, doc_id,
                  sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (r) CROSS JOIN whole GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
           FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""
