"""Registered queries of the text operators: thin calls over the whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import (
    alignment, credentials, jaccard_join, language_id, licenses, mixing, passages, pieces, prefix_trie, quality, repeats, topk, winnowing,
)
from daybook.llm.common import id_remainder, read

# Rows may be learned from unless the crc32 of the id's text leaves this remainder.
LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2
QUALITY_FOLDS, QUALITY_HELD = 5, 0


def op1_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held = id_remainder(LANGUAGE_FOLDS) == LANGUAGE_HELD
    model = language_id.fit_sample(docs.where(~held))
    return language_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_words")


def op2_quality(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = id_remainder(QUALITY_FOLDS) == QUALITY_HELD
    model = quality.fit_sample(docs, labels.where(~held))
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_pieces(spark, sf_dir):
    return pieces.round_trip(read(spark, sf_dir, "documents"), pieces.Pieces.load(pieces.MODEL))


def op4_topk(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op5_mixing(spark, sf_dir):
    return mixing.mixed_sizes(read(spark, sf_dir, "documents"))


def op6_licenses(spark, sf_dir):
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
        "license", F.array_join("licenses", ";").alias("licenses"),
    )


def op7_passages(spark, sf_dir):
    return passages.fuzzy_passages(read(spark, sf_dir, "documents"))


def op8_winnowing(spark, sf_dir):
    return winnowing.edited_fingerprints(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


def op10_repeated_bytes(spark, sf_dir):
    return repeats.without_repeated_bytes(read(spark, sf_dir, "documents")).drop("kept")


def op11_credentials(spark, sf_dir):
    return credentials.span_digests(credentials.scan_credentials(read(spark, sf_dir, "documents")))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_alignment(spark, sf_dir):
    return alignment.alignment_scores(read(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_pieces": op3_pieces,
    "op4_topk": op4_topk,
    "op5_mixing": op5_mixing,
    "op6_licenses": op6_licenses,
    "op7_passages": op7_passages,
    "op8_winnowing": op8_winnowing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_repeated_bytes": op10_repeated_bytes,
    "op11_credentials": op11_credentials,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_alignment": op13_alignment,
}

_WORD = r"[^\x20\x09-\x0D]+"

LLM_ORACLES = {
    "op4_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op5_mixing": f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s
), r AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / w AS r, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS all_w FROM w
), l AS (
  SELECT *, CAST(total - CAST(coalesce(sum(3 * source_size) OVER b, 0) AS BIGINT) AS DOUBLE) / CAST(all_w - CAST(coalesce(sum(w) OVER b, 0) AS BIGINT) AS DOUBLE) AS level
  FROM r WINDOW b AS (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, coalesce(least(CAST(3 * source_size AS DOUBLE),
    (SELECT level FROM l WHERE r > level ORDER BY r, source NULLS LAST LIMIT 1) * w), 0) AS target FROM l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), q AS (
  SELECT *, target - whole * source_size AS rest,
    CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS prob FROM p
), j AS (
  SELECT d.doc_id, d.size, q.*, CASE WHEN prob > 0 THEN (u / (1 - u)) / (prob / (1 - prob)) END AS odds
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), o AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(size * (whole + CASE WHEN prob > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
""",
    "op6_licenses": licenses.scan_sql(),
    "op12_prefix_trie": """
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(concat(CAST(length(coalesce(role, '')) AS VARCHAR), ':', coalesce(role, ''), coalesce(text, ''))) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(id, 1, 30)) - 1 AS pos FROM t
), k AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM p)
), b AS (
  SELECT k.*, least(h, coalesce(n, 0)) AS taken FROM k LEFT JOIN (SELECT c AS base, count(*) AS n FROM p GROUP BY c) USING (base)
), r AS (
  SELECT b.c, p.pos, p.id, length(p.text) AS chars FROM b JOIN p ON p.c = b.base AND p.pos < b.taken
  UNION ALL
  SELECT b.c, p.pos - b.h + b.taken, p.id, length(p.text) FROM b JOIN p ON p.c = b.c AND p.pos >= b.h
), n AS (
  SELECT c, pos + 1 AS depth, chars, string_agg(id, '') OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM r
  UNION ALL
  SELECT c, 0, 0, '' FROM k
), l AS (
  SELECT c, max(depth) AS len FROM n GROUP BY c
), g AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    coalesce(string_agg(CASE WHEN len = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends
  FROM n JOIN l USING (c) GROUP BY path, depth
), e AS (
  SELECT g.*, up.conv_id AS parent_conv_id, up.path AS up FROM g
  LEFT JOIN g AS up ON g.depth = up.depth + 1 AND substr(g.path, 1, 64 * (g.depth - 1)) = up.path
), q AS (
  SELECT e.*, (SELECT count(*) FROM e AS x WHERE x.up = e.path AND x.depth = e.depth + 1) AS n_children FROM e
)
SELECT q.conv_id, CAST(q.depth AS BIGINT) AS depth, q.parent_conv_id, q.n_convs, q.n_children,
  CAST(sum(CASE WHEN d.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
  CAST(sum((d.n_convs - 1) * d.chars) AS BIGINT) AS saved_tokens, sha256(q.ends) AS ends_sha256
FROM q JOIN n ON n.c = q.conv_id AND n.depth = q.depth
JOIN (SELECT q.*, m.path AS prefix FROM q JOIN n AS m ON m.c = q.conv_id AND m.depth <= q.depth) AS d ON d.prefix = q.path
GROUP BY q.conv_id, q.depth, q.parent_conv_id, q.n_convs, q.n_children, q.ends
""",
}
