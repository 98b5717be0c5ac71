"""The queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chunk_dedup, langid, lexical, lm_score, mixing, near_dup, packing, repair, secrets, token_counts, topk, toxicity
from .common import shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKED = public_tokenizers.path("word_bpe_49k.json")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_byte_bpe(spark, sf):
    return bpe.digests(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN)


@query
def op2_toxicity(spark, sf):
    return toxicity.scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_topk(spark, sf):
    return topk.nearest(table(spark, sf, "embeddings"))


@query
def op4_token_counts(spark, sf):
    """Against a cache of its own, so every distinct text is a miss."""
    cache = f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    return token_counts.token_counts(table(spark, sf, "documents"), COUNTED, cache)


@query
def op5_lm_score(spark, sf):
    return lm_score.scores(table(spark, sf, "documents"))


@query
def op6_secrets(spark, sf):
    return secrets.secret_spans(table(spark, sf, "documents"))


@query
def op7_mixing(spark, sf):
    taken, _, _ = mixing.mix(table(spark, sf, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_near_dup(spark, sf):
    found = near_dup.near_classes(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "class_size", "exact_size")


@query
def op9_exact_dedup(spark, sf):
    return chunk_dedup.exact_groups(table(spark, sf, "documents"))


@query
def op10_langid(spark, sf):
    return langid.languages_of(table(spark, sf, "documents"))


@query
def op11_packing(spark, sf):
    return packing.placed(table(spark, sf, "documents"), PACKED)


@query
def op12_lexical(spark, sf):
    return lexical.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_repair(spark, sf):
    told = table(spark, sf, "conversations")
    return repair.audits(repair.damaged(told), told)


ORACLES = {
    "op3_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND NOT list_contains(list_transform(
                    embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
        s AS (
            SELECT q.r, q.vec_id AS query_id, v.vec_id,
                   CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.r <> v.r AND len(q.x) = len(v.x)
            WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op9_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
            FROM documents),
        r AS (
            SELECT doc_id, n,
                   first_value(doc_id) OVER g AS keep_id,
                   row_number() OVER g AS place,
                   count(*) OVER (PARTITION BY n) AS group_size
            FROM d
            WINDOW g AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(n) AS text_sha256 FROM r
    """,
    "op12_lexical": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents),
        e AS (SELECT r, doc_id, unnest(t) AS term, len(t) AS n FROM d),
        tf AS (SELECT r, doc_id, term, n, count(*) AS tf FROM e GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        a AS (SELECT count_if(len(t) > 0) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d),
        i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        w AS (
            SELECT item_id, term, CAST(floor(1000 * ln(
                CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM i JOIN df USING (term) CROSS JOIN a),
        s AS (
            SELECT item_id, r, doc_id, CAST(sum(
                w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll)))))
                AS BIGINT) AS score
            FROM w JOIN tf USING (term) CROSS JOIN a GROUP BY ALL),
        k AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
    """,
}
