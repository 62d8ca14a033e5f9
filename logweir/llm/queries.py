"""The registered queries of the operators: each over its whole table, with production settings."""

import public_tokenizers
from pyspark.sql import functions as F

from logweir.llm.common import table
from logweir.llm.exact_dedup import exact_duplicates
from logweir.llm.hard_negatives import mine_negatives, usable_rows
from logweir.llm.html_extract import extract_main_text
from logweir.llm.language_id import identify_languages
from logweir.llm.licenses import scan_licenses
from logweir.llm.mixing import mix
from logweir.llm.packing import pack
from logweir.llm.pii import KINDS, pseudonymise
from logweir.llm.quality import score_quality
from logweir.llm.resampling import importance_resample
from logweir.llm.secret_scan import scan_secrets
from logweir.llm.simhash import hex_fingerprint, simhash_components
from logweir.llm.topk import quantised, top_k

TOKENIZER = "word_bpe_49k.json"
#: A key of the tests; a deployment passes its own.
PII_KEY = "example-key"


def op1_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_exact_topk(spark, sf_dir):
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op4_main_text(spark, sf_dir):
    pages = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def _is(kind):
    return lambda found: found == kind


def op6_pii(spark, sf_dir):
    docs = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    kinds = F.transform("pii", lambda m: m["kind"])
    counts = [
        F.size(F.filter(kinds, _is(kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return docs.select("doc_id", "text", *counts, F.to_json("pii").alias("pseudonyms"))


def op7_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark, sf_dir):
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("word")).alias("fingerprint"), "component_id")


def op10_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    rows = usable_rows(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return mine_negatives(rows, rows.where("vec_id % 100 = 0"))


def op12_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))


def op13_resample(spark, sf_dir):
    drawn = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    query.__name__: query
    for query in (
        op1_exact_dedup, op2_mix_sources, op3_exact_topk, op4_main_text, op5_best_fit_packing,
        op6_pii, op7_license_scan, op8_quality, op9_simhash, op10_secrets,
        op11_hard_negatives, op12_language_id, op13_resample,
    )
}

SQL = {
    "op1_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY norm)""",
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS terms
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.terms, c.terms), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS terms
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.terms, c.terms), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
            FROM scored WHERE same
        ), ranked AS (
            SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
            FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND p.place <= 5
             AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 5""",
}
