"""The corpus operators as registered queries, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import conversation_trie, html_extraction, lm_scoring, near_duplicates, packing, pii, quality, sentencepiece_bpe, token_output, topk, toxicity, url_filters, whitening
from quern.llm.common import table


def held_out() -> Column:
    """Rows of the third that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """A model of the rows of docs and labels that are not held out."""
    return toxicity.train(docs.select("doc_id", "text").where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e, true), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.find(table(spark, sf_dir, "documents").select("doc_id", "text"), near_duplicates.Params(words=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return entries.withColumn("base_failed", entries.failures.bitwiseAND(quality.mask(quality.POLICIES[1])) != 0)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS l FROM d),
g AS (SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
p AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY 1),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
  length(regexp_replace(t, '[^a-z]', '', 'g'))::BIGINT AS n_lower, length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_marks
  FROM w LEFT JOIN p USING (doc_id)),
f AS (SELECT *, CASE WHEN n_words = 0 THEN 1 ELSE (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
  + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT + 16 * (n_upper > n_lower)::BIGINT
  + 32 * (word_chars < 3 * n_words OR word_chars > 12 * n_words)::BIGINT + 64 * (2 * n_marks > n_words)::BIGINT END::BIGINT AS failures FROM m)
SELECT *, failures & 3 <> 0 AS base_failed, failures & 127 = 0 AS kept FROM f
"""


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


#: CRC-32 is folded over the digits' codes, eight shifts each; every node passes its sums to all its beginnings.
OP11_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, x) AS ts FROM t GROUP BY 1),
h AS (SELECT *, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: unicode(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 6)::INTEGER AS h FROM own),
reb AS (SELECT h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1))::INTEGER AS depth, ts FROM reb),
p AS (SELECT ts[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY 1),
n AS (SELECT p.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * (CASE WHEN depth = 0 THEN 0 ELSE length(path[depth].x) END) AS saved FROM p LEFT JOIN k USING (path)),
s AS (SELECT path[1:a] AS path, sum(saved)::BIGINT AS saved_tokens, count_if(n_children = 0)::BIGINT AS n_leaves FROM (SELECT *, unnest(range(0, depth + 1))::INTEGER AS a FROM n) GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM n JOIN s USING (path) LEFT JOIN p u ON n.depth > 0 AND u.path = n.path[1:n.depth - 1]
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ablation(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


ABLATION_SQL = f"""WITH e AS ({OP10_SQL}), r(rule, bit) AS (VALUES {", ".join(f"('{r.name}', {1 << i}::BIGINT)" for i, r in enumerate(quality.RULES) if r.name in quality.POLICIES[quality.CURRENT])})
SELECT rule, bit, count_if(failures & bit <> 0)::BIGINT AS n_failed, count_if(failures & 127 = bit)::BIGINT AS n_failed_alone, count_if(failures & 127 & ~bit = 0)::BIGINT AS n_kept_without,
  count_if(failures & 127 = 0)::BIGINT AS n_kept FROM e CROSS JOIN r GROUP BY 1, 2"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it builds on this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_token_output": op3_token_output,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_html_extraction": op5_html_extraction,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_exact_topk": op7_exact_topk,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_personal_data": op9_personal_data,
        "op10_quality_ledger": op10_quality_ledger,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_url_filters": op13_url_filters,
        "quality_ablation": quality_ablation,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_exact_topk": OP7_SQL,
        "op10_quality_ledger": OP10_SQL,
        "op11_conversation_trie": OP11_SQL,
        "quality_ablation": ABLATION_SQL,
    }
