"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.catalogue.common import Catalogue
from strata.llm import (
    divergence,
    fingerprints,
    jaccard_join,
    merge_dropout,
    metric_search,
    packing,
    quality,
    ranked_search,
    repeats,
    sharding,
    signature_join,
    token_files,
    url_filter,
)
from strata.llm.common import table
from strata.session import scratch_dir

llm = Catalogue()

RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@llm.query("op1_rendezvous_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 16)


@llm.query(
    "op2_url_filter",
    r"""
    WITH parts AS (
        SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
        FROM pages
    ), ruled AS (
        SELECT *, CASE
            WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
        FROM parts
    )
    SELECT *, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


@llm.query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@llm.query("op4_winnowed_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        fingerprints.digest(F.col("marks")).alias("fingerprint"),
        fingerprints.digest(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@llm.query("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path)


@llm.query("op6_metric_top_k")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@llm.query("op7_hierarchical_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


@llm.query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


@llm.query("op9_merge_dropout")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_dropout(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


@llm.query("op9_merge_dropout_turns")
def op9_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_dropout(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id", "turn"], ["role"])


def _merge_dropout(rows: DataFrame, keys: list[str], others: list[str] | None = None) -> DataFrame:
    passed = merge_dropout.round_trip(rows, keys, dropout=0.1, seed=1)
    return passed.select(
        *keys,
        *(others or []),
        "n_pieces",
        "ids_crc32",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@llm.query("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"), 50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@llm.query(
    "op11_ranked_search",
    r"""
    WITH words AS (
        SELECT row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (
            SELECT row_number() OVER () AS row, doc_id,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
    ), asked AS (
        SELECT item_id, term, count(*) AS times FROM (
            SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
        GROUP BY item_id, term
    ), lengths AS (
        SELECT row, doc_id, count(*) AS n FROM words GROUP BY row, doc_id
    ), sums AS (
        SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
    ), postings AS (
        SELECT row, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY row, term
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM postings, sums GROUP BY term, docs
    ), scores AS (
        SELECT a.item_id, l.doc_id, p.row,
            sum(a.times * w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * l.n * docs // total))))::BIGINT AS score
        FROM asked a JOIN postings p ON a.term = p.term JOIN weights v ON v.term = p.term JOIN lengths l ON l.row = p.row, sums
        GROUP BY a.item_id, l.doc_id, p.row
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@llm.query(
    "op12_source_divergence",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), words AS (
        SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), kept AS (
        SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30
    ), groups AS (
        SELECT DISTINCT lang, source FROM d
    ), counts AS (
        SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term
    ), cells AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n::HUGEINT AS lang_n,
            sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total,
            sum(k.n) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS lang_total,
            count(*) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS v
        FROM groups g JOIN kept k ON g.lang = k.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), shares AS (
        SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (total + 5 * v) AS p,
            1 + 1000000000 * (lang_n + 5) // (lang_total + 5 * v) AS q
        FROM cells
    ), distances AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ), found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN distances x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


@llm.query(
    "op13_signature_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT row, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END) AS shingle
        FROM words
    ), sizes AS (
        SELECT row, count(*) AS n FROM shingles GROUP BY row
    ), shared AS (
        SELECT a.row AS a, b.row AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row < b.row GROUP BY a.row, b.row
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * m >= 85 * (x.n + y.n - m)
    ), edges AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reached AS (
        SELECT row AS a, row AS b FROM words UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a
    ), components AS (
        SELECT r.a AS row, min(w.doc_id) AS component_id FROM reached r JOIN words w ON w.row = r.b GROUP BY r.a
    )
    SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
    FROM words w JOIN components c ON c.row = w.row LEFT JOIN sizes s ON s.row = w.row
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


@llm.query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
