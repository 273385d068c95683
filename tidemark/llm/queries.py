"""The queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, exact_dedup, language_id, license_scan, lm_score, mixing, near_dedup, packing, pii, quality_rules, source_audit, toxicity
from .common import held_out, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    profiles = language_id.learn_profiles(docs.where(~out))
    return language_id.identify(docs.select("doc_id", out.alias("held_out"), "text"), profiles).drop("text")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup_report(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out("doc_id", 5, 0))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup_report(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2), held_out("doc_id", 7, 3))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_rules.quality_report(table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mix_sources": op2_mix_sources,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_pii": op8_pii,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_lm_score": op10_lm_score,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_quality_rules": op12_quality_rules,
    "op13_source_divergence": op13_source_divergence,
}


def _windows(name: str, words: int) -> str:
    """SQL of the windows of so many words (r, i) that stand twice or more in a text, over d(r, w)."""
    return f"""{name} AS (
            SELECT r, unnest(places) AS i FROM (
                SELECT r, list(i) AS places FROM (SELECT r, i, w[i:i + {words - 1}] AS x FROM (SELECT r, w, unnest(range(1, len(w) - {words - 2})) AS i FROM d))
                GROUP BY r, md5(array_to_string(x, ' ')) HAVING count(*) > 1
            )
        )"""


def _centroid_rounds(rounds: int) -> str:
    """SQL of the centroids c0, c1, ... and the assignments a0, a1, ... to them, over v(r, vec_id, v)."""
    out = ""
    for r in range(rounds + 1):
        out += f"""a{r} AS (
            SELECT r, any_value(v) AS v, any_value(vec_id) AS vec_id, min(near) AS near FROM (
                SELECT r, v, vec_id, {{'distance': list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, 65)]), 'cluster': cluster}} AS near FROM v, c{r}
            ) GROUP BY r
        ), """
        if r < rounds:
            out += f"""m{r} AS (
                SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n
                FROM (SELECT near.cluster AS cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY ALL
            ), c{r + 1} AS (
                SELECT c.cluster, coalesce(any_value(m.c), any_value(c.c)) AS c FROM c{r} AS c
                LEFT JOIN (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{r} GROUP BY cluster) AS m USING (cluster) GROUP BY c.cluster
            ), """
    return out

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), r AS (
            SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
    """,
    "op11_centroid_clusters": f"""
        WITH v AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) AS r, vec_id, v FROM (
                SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
                WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x::DOUBLE)]) = 64
            )
        ), c0 AS (SELECT (r - 1)::INTEGER AS cluster, v AS c FROM v WHERE r <= 16), {_centroid_rounds(3)} d AS (
            SELECT vec_id, near.cluster AS cluster, near.distance::BIGINT AS distance FROM a3
        )
        SELECT d.vec_id, d.cluster, d.distance, (sum(d.distance) OVER (PARTITION BY d.cluster))::BIGINT AS cluster_inertia,
            (sum(d.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.c, ',')) AS centroid_sha256
        FROM d JOIN c3 USING (cluster)
    """,
    "op12_quality_rules": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents
        ), {_windows("w8", quality_rules.LEAST_WORDS)}, {_windows("far", quality_rules.LONGEST_REPEAT + 1)}, spans AS (
            SELECT r, count(DISTINCT i) AS n_repeat_words, sum(length(word)) AS covered FROM (
                SELECT DISTINCT d.r, k.i + j.j AS i, d.w[k.i + j.j] AS word FROM w8 k JOIN d ON d.r = k.r, range({quality_rules.LEAST_WORDS}) j(j)
            ) GROUP BY r
        ), c AS (
            SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                coalesce(covered, 0) AS covered, d.r IN (SELECT r FROM far) AS far
            FROM d LEFT JOIN spans USING (r)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < {quality_rules.FEWEST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed,
            NOT (n_words < {quality_rules.FEWEST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words
                OR 100 * covered > {quality_rules.MOST_COVERED} * word_chars OR far) AS kept
        FROM c
    """,
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), t AS (SELECT r, lang, source, unnest(terms) AS term FROM d
        ), k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3
        ), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang
        ), g AS (SELECT DISTINCT lang, source FROM d
        ), c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL
        ), n AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (n.total + v.v) AS p
            FROM g JOIN k USING (lang) JOIN n USING (lang, source) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
        ), q AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(t.total) + any_value(v.v)) AS q
            FROM p JOIN (SELECT lang, sum(total) AS total FROM n GROUP BY lang) t USING (lang) JOIN v USING (lang) GROUP BY lang, term
        ), f AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (p x JOIN p y ON x.lang = y.lang AND x.term = y.term) ON x.lang = a.lang AND x.source = a.source AND y.source = b.source
            GROUP BY ALL
            UNION ALL
            SELECT p.lang, p.source, 'term', p.term, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
        ), r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM f)
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
    """,
}
