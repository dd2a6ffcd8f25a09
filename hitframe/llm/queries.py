"""Registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ball_search,
    bpe,
    centroids,
    exact_dedup,
    hamming_search,
    licenses,
    line_dedup,
    ngram_join,
    packing,
    quotations,
    suffix_levels,
    toxicity,
    warc,
)
from .common import table, tokenizer_path

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(
        table(spark, sf_dir, "documents"), licenses.known_licenses(spark)
    )


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.nearest_codes(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.link_quotations(table(spark, sf_dir, "conversations"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path(WORD_VOCABULARY))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_path(BYTE_VOCABULARY)
    )


def op11_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_levels.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_topk_search": op2_topk_search,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quotations": op4_quotations,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_ball_search": op11_ball_search,
    "op12_centroids": op12_centroids,
    "op13_suffix_dedup": op13_suffix_dedup,
}

# Terms and the four passes of the clustering are spelled out once.
_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)


def _clustering_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    apart = f"CAST(list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) FOR i IN range(1, {dims + 1})]) AS BIGINT)"
    parts = [
        f"""kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r,
          [CAST(floor({dims} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
          WHERE len(embedding) = {dims} AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
          WHERE vec_id IS NOT NULL ORDER BY sha256('1:' || vec_id), v LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, v, c, distance FROM (
              SELECT k.r, k.vec_id, k.v, c.c, {apart} AS distance,
                row_number() OVER (PARTITION BY k.r ORDER BY {apart}, c.c) AS n FROM kept k CROSS JOIN c{i} c) WHERE n = 1)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
                    SELECT c, i, sum(x) AS s, count(*) AS n FROM (
                      SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)
                  GROUP BY c) m ON m.c = c.c)"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
        SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.distance,
          CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
          CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"""
    )


ORACLE_SQL = {
    "op11_ball_search": f"""
        WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
        n AS (SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0),
        s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
        q AS (SELECT item_id, term, count(*) AS qtf FROM (
          SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
        score AS (
          SELECT q.item_id, tf.doc_id,
            CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
          FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (doc_id), s GROUP BY ALL),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
    """,
    "op12_centroids": _clustering_sql(),
    # bytes as pairs of hex digits; pieces of a text keep the reading of windows local
    "op13_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        b AS (SELECT doc_id, c, substr(h, 200 * c + 1, 298) AS part FROM (
          SELECT doc_id, h, unnest(range((len(h) // 2 + 50) // 100)) AS c FROM d)),
        w AS (SELECT doc_id, 100 * c + o AS p, substr(part, 2 * o + 1, 100) AS g FROM (
          SELECT doc_id, c, part, unnest(range(least(100, len(part) // 2 - 49))) AS o FROM b)),
        m AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
        f AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
          FROM w JOIN m USING (g) WHERE first < doc_id),
        i AS (SELECT doc_id, p, count(CASE WHEN before IS NULL OR p - before > 50 THEN 1 END)
          OVER (PARTITION BY doc_id ORDER BY p) AS run FROM f),
        r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, run),
        c AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM r),
        k AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, max(b) AS last,
            string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS kept
          FROM c JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
          sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op1_license_scan": licenses.oracle_sql(),
    "op2_topk_search": """
        WITH c AS (
          SELECT vec_id, array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '') AS code
          FROM embeddings),
        d AS (
          SELECT q.vec_id, n.vec_id AS neighbor_id, hamming(q.code, n.code) AS distance
          FROM c q JOIN c n ON q.vec_id % 20 = 0 AND q.vec_id != n.vec_id),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d)
        SELECT vec_id, rank, neighbor_id, distance FROM r WHERE rank <= 10
    """,
    "op3_exact_dedup": """
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
}
