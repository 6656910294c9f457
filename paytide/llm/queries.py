"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from paytide.llm import bpe, chat, decontam, jaccard, langid, lm, mixing, pii, repair, sharding, spelling, topk, toxicity
from paytide.llm.common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.preferences(turns, chat.neighbouring_pairs(turns))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_documents(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit_conversations(table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run} | {
    f.__name__: f
    for f in (op1_langid, op2_suffix_tree, op3_decontaminate, op4_sharding, op5_mixing, op6_preferences, op7_toxicity, op8_jaccard, op9_pii, op10_topk, op11_repair, op12_spelling, op13_bpe)
}
ORACLE: dict[str, str] = {
    "op6_preferences": """
WITH t AS (
  SELECT *, conv_id // 2 AS pair_id, conv_id % 2 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), m AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.i, b.i) AS i,
         a.conv_id IS NOT NULL AND b.conv_id IS NOT NULL
           AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b
    ON a.pair_id = b.pair_id AND a.i = b.i
), p AS (
  SELECT pair_id, CAST(coalesce(min(i) FILTER (NOT same), max(i) + 1) AS INT) AS prefix_turns FROM m GROUP BY 1
), w AS (
  SELECT t.pair_id, side, conv_id, i, prefix_turns, role,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS piece,
         length(coalesce(role, '')) + 5 AS head
  FROM t JOIN p USING (pair_id)
), o AS (
  SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY pair_id, side, i >= prefix_turns ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM w
), s AS (
  SELECT pair_id, side, max(conv_id) AS conv_id, max(prefix_turns) AS prefix_turns,
         coalesce(string_agg(piece, '' ORDER BY i) FILTER (i < prefix_turns), '') AS prompt,
         coalesce(string_agg(piece, '' ORDER BY i) FILTER (i >= prefix_turns), '') AS completion,
         coalesce(string_agg((place + head) || '-' || (place + length(piece)), ',' ORDER BY i)
           FILTER (i >= prefix_turns AND role = 'assistant'), '') AS mask
  FROM o GROUP BY 1, 2
)
SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, c.conv_id AS chosen, r.conv_id AS rejected,
       coalesce(c.prefix_turns, r.prefix_turns) AS prefix_turns, coalesce(c.prompt, '') AS prompt,
       c.completion AS chosen_completion, r.completion AS rejected_completion, c.mask AS chosen_mask, r.mask AS rejected_mask
FROM (SELECT * FROM s WHERE side = 0) c FULL JOIN (SELECT * FROM s WHERE side = 1) r ON c.pair_id = r.pair_id
""",
    # crc32 byte by byte; neighbours meet by what is left without one letter
    "op12_spelling": r"""
WITH r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), d AS (
  SELECT id, run, count(*) AS n,
         flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
           ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes
  FROM r GROUP BY 1, 2
), h AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(bytes, lambda b: CAST(b AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))) AS h
  FROM d
), w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3
), c AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM v)
), p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM c a JOIN c b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM c a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM c a JOIN v b ON a.rest = b.word
), g AS (
  SELECT word, count(*) AS n_near, min(struct_pack(x := -near_n, near := near)) AS best FROM p GROUP BY 1
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.x >= 2 * n THEN best.near END AS form, CASE WHEN -best.x >= 2 * n THEN -best.x END AS form_n
  FROM v LEFT JOIN g ON v.word = g.word
), t AS (
  WITH RECURSIVE s AS (
    SELECT word, word AS root, form FROM f
    UNION ALL SELECT s.word, f.word, f.form FROM s JOIN f ON s.form = f.word
  ) SELECT word, root FROM s WHERE form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN t ON f.word = t.word
""",
    "op10_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
}
