"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_gam import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .risk_rules import apply_rules

    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .recompression import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .content_sort import content_sort_groups

    return content_sort_groups(table(spark, sf_dir, "documents"))


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hash_tree import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_components

    return ngram_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_plan

    return mix_plan(table(spark, sf_dir, "documents")).drop("copies", "source")


def op8_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linked_secrets import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .length_histogram import length_histogram

    return length_histogram(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import collapse_runs

    return collapse_runs(table(spark, sf_dir, "documents"), plant=True)


def op13_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .edit_fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_gam": op1_quality_gam,
    "op5_risk_rules": op5_risk_rules,
    "op2_hash_tree": op2_hash_tree,
    "op3_ngram_join": op3_ngram_join,
    "op4_mixing": op4_mixing,
    "op6_recompression": op6_recompression,
    "op7_content_sort": op7_content_sort,
    "op8_linked_secrets": op8_linked_secrets,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_edit_fingerprints": op13_edit_fingerprints,
}

ORACLES = {
    "op11_filter_audit": r"""
        WITH d AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), q AS (
          SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
        ), f AS (
          SELECT part, quality, toxic,
                 (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                 + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
                 + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), min(d.doc_id) OVER (PARTITION BY t) IS NOT NULL)::INT AS fails
          FROM d LEFT JOIN q ON d.doc_id = q.doc_id
        ), c AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f GROUP BY part, fails
        ), l(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
        ), o AS (
          SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bs
          FROM l v, l w, l x, l y, l z WHERE bit_count(v.b | w.b | x.b | y.b | z.b) = 5
        ), s AS (
          SELECT filter_order, k::INT AS step, bs[k] AS own, coalesce(list_sum(bs[1 : k - 1]), 0)::INT AS earlier FROM o, range(1, 6) t(k)
        )
        SELECT part, filter_order, step,
               coalesce(sum(n) FILTER (fails & (own | earlier) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (fails & own <> 0 AND fails & earlier = 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (fails & own <> 0 AND fails & earlier <> 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (fails & own <> 0 AND fails & earlier = 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (fails & own <> 0 AND fails & earlier = 0), 0)::BIGINT AS toxic_lost,
               coalesce(sum(sum(n) FILTER (fails & own <> 0 AND fails & earlier = 0)) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
        FROM c, s GROUP BY part, filter_order, step, own
    """,
    "op3_ngram_join": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
          FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS h FROM d, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) WHERE len(ws) > 0
        ), n AS (
          SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), e AS (
          SELECT a.doc_id AS a, b.doc_id AS b
          FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
          GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
        ), r AS (
          SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(r.b) FROM r WHERE r.a = d.doc_id) AS component_id
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id
    """,
    "op6_recompression": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), w AS (
          SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h FROM d, unnest(range(1, len(ws) - 33)) t(i)
        ), c AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)
        ), k AS (
          SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS kept, count(*) AS n
          FROM (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS word FROM d) x ANTI JOIN c ON x.doc_id = c.doc_id AND x.p = c.p
          GROUP BY x.doc_id
        )
        SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op7_content_sort": r"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM n
    """,
    "op4_mixing": r"""
        WITH RECURSIVE d AS (
          SELECT *, length(bin(size)) AS class, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT >> 40 AS cell
          FROM (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents)
        ), s AS (
          SELECT source, sum(size)::BIGINT AS source_size,
                 ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
                 (3 * sum(size))::DOUBLE AS ceiling
          FROM d GROUP BY source
        ), l AS (
          SELECT *, (sum(source_size) OVER ()::DOUBLE
                     - coalesce(sum(ceiling) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                 row_number() OVER w AS place
          FROM s WINDOW w AS (ORDER BY ceiling / weight, source NULLS LAST)
        ), t AS (
          SELECT source, source_size,
                 least(ceiling, (SELECT level FROM l WHERE level * weight <= ceiling ORDER BY place LIMIT 1) * weight) AS target
          FROM l
        ), r AS (
          SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t
        ), h AS (
          SELECT source, class, cell, sum(size) AS words FROM d WHERE size > 0 GROUP BY ALL
        ), u AS (
          SELECT source, class, cell, (sum(words) OVER w)::BIGINT AS upto, (sum(words) OVER w - words)::BIGINT AS before,
                 (sum(words) OVER (PARTITION BY source, class))::BIGINT AS total
          FROM h WINDOW w AS (PARTITION BY source, class ORDER BY cell)
        ), k AS (
          SELECT source, class, any_value(total) AS total, row_number() OVER (PARTITION BY source ORDER BY class DESC) AS place,
                 ('0x' || substr(md5('17:' || class || ':' || coalesce(source, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS draw
          FROM u GROUP BY source, class
        ), cuts AS (
          SELECT source, 0::BIGINT AS place, 0 AS class, 0.0::DOUBLE AS carry, NULL::BIGINT AS cut, rate - floor(rate) AS part FROM r
          UNION ALL
          SELECT x.source, x.place, x.class,
                 want - CASE WHEN want < 0 THEN 0 WHEN u.cell IS NULL THEN x.total WHEN draw < (want - u.before) / (u.upto - u.before) THEN u.upto ELSE u.before END,
                 CASE WHEN want < 0 THEN 0 WHEN u.cell IS NULL THEN 4096 WHEN draw < (want - u.before) / (u.upto - u.before) THEN u.cell + 1 ELSE u.cell END,
                 part
          FROM (SELECT k.*, c.part, c.part * k.total + c.carry AS want
                FROM cuts c JOIN k ON k.source IS NOT DISTINCT FROM c.source AND k.place = c.place + 1) x
          LEFT JOIN u ON u.source IS NOT DISTINCT FROM x.source AND u.class = x.class AND u.before <= x.want AND x.want < u.upto
        )
        SELECT d.doc_id, d.size, r.source_size, r.target,
               (d.size * (floor(rate) + CASE WHEN d.cell < cut THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
        LEFT JOIN cuts ON cuts.source IS NOT DISTINCT FROM d.source AND cuts.class = d.class
    """,
}
