"""One query for each training-data operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floeframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from floeframe.llm.byte_bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.top_k import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.near_copies import classes

    return classes(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.weak_labels import classified

    return classified(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.html_text import extracted

    return extracted(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.quality_rules import rules

    return rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from floeframe.llm.common import new_path
    from floeframe.llm.token_store import checks, write

    path = new_path(spark, "tokens")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return checks(spark, path)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.personal import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.licenses import scanned

    return scanned(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from floeframe.llm.packing import packed_sequences

    return packed_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.whitening import whitened

    # 38 digits to a long; null where they don't fit
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from floeframe.llm.piece_bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floeframe.llm.filter_audit import audited

    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_top_k": op1_top_k,
        "op2_near_copies": op2_near_copies,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_html_text": op5_html_text,
        "op6_quality_rules": op6_quality_rules,
        "op7_token_store": op7_token_store,
        "op8_personal_data": op8_personal_data,
        "op9_license_scan": op9_license_scan,
        "op10_packing": op10_packing,
        "op11_whitening": op11_whitening,
        "op12_piece_bpe": op12_piece_bpe,
        "op13_filter_audit": op13_filter_audit,
    }


#: Brute force: every query against every row.
TOP_K = """
WITH v AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(p.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v p ON q.vec_id % 20 = 0 AND p.vec_id <> q.vec_id
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


#: Shingles as text; components by repeated reachability.
NEAR_COPIES = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS g FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""


#: Masks by document, then every order's first failure of every mask.
FILTER_AUDIT = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), k AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), m AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
        len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
        regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
    FROM t LEFT JOIN k USING (doc_id)
), sorts AS (
    SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL
), f AS (
    SELECT unnest([1, 2, 3, 4, 5]) AS f
), orders AS (
    SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), met AS (
    SELECT part, good, toxic, fails, n, fs, coalesce(list_position([fails[f] FOR f IN fs], true), 6) AS gone FROM sorts, orders
), grid AS (
    SELECT part, fs, f AS step,
        sum(n) FILTER (gone > f) AS kept, sum(n) FILTER (gone = f) AS removed,
        sum(n) FILTER (fails[fs[f]] AND gone < f) AS redundant,
        sum(n) FILTER (fails[fs[f]] AND len([x FOR x IN fails IF x]) = 1) AS unique_fails,
        sum(n) FILTER (gone = f AND good) AS good_lost, sum(n) FILTER (gone = f AND toxic) AS toxic_lost
    FROM met, f GROUP BY part, fs, f
)
SELECT part, array_to_string(['ABCDE'[f] FOR f IN fs], '') AS filter_order, CAST(step AS INTEGER) AS step,
    coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
    coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, fs[step]), 0)::BIGINT AS shapley
FROM grid
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": TOP_K, "op2_near_copies": NEAR_COPIES, "op13_filter_audit": FILTER_AUDIT}
