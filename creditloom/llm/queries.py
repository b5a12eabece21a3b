"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    collocations,
    decontamination,
    html_extraction,
    language_model,
    lexical_search,
    license_scan,
    line_dedup,
    minhash_dedup,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the url query.
URL_RULES = (
    url_filter.Rule("allow", "org"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


@_query("op1_minhash_dedup")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, share=(85, 100))


@_query("op2_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


@_query("op3_token_counts")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_counts.unigram_scores(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_counts.counted(_table(spark, sf_dir, "documents"), scores, public_tokenizers.PATTERN)


@_query("op4_url_filter")
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(_table(spark, sf_dir, "pages"), URL_RULES)


SQL["op4_url_filter"] = """
WITH rests AS (
    SELECT row_number() OVER () AS k, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT k, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), parts AS (
    SELECT k, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts
), rules (verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
)
SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
    arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY k
"""


@_query("op5_decontamination")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op6_quality_rules")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_table(spark, sf_dir, "documents"))


@_query("op7_substring_dedup")
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


@_query("op8_lm_scoring")
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return language_model.scored(_table(spark, sf_dir, "documents"), held_out, order=3)


@_query("op9_byte_bpe")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoded("ids", path), 256).alias("decoded_sha256"),
    )


@_query("op10_html_extraction")
def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(_table(spark, sf_dir, "pages"))

@_query("op12_line_dedup")
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduped(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op12_line_dedup"] = """
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), rows AS (
    SELECT d, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs
), keyed AS (
    SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM rows
), frequent AS (
    SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT d) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.k = f.k
GROUP BY d
"""


@_query("op13_lexical_search")
def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


SQL["op13_lexical_search"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), tf AS (
    SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
    FROM (SELECT d, doc_id, len(words) AS n, unnest(words) AS term FROM docs) GROUP BY d, term
), total AS (
    SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM docs WHERE len(words) > 0
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs)::DOUBLE + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term
), asked AS (
    SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), wanted AS (
    SELECT i, any_value(item_id) AS item_id, term, count(*) AS q
    FROM (SELECT i, item_id, unnest(words) AS term FROM asked) GROUP BY i, term
), scored AS (
    SELECT i, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
        CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_words)))) AS BIGINT) AS score
    FROM wanted JOIN tf USING (term) JOIN weights USING (term), total GROUP BY i, d
), placed AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


@_query("op11_collocations")
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=30, top=2000, covered=80)


SQL["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
    SELECT lang, size, words[i : i + size - 1] AS words
    FROM (SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM worded, (VALUES (1), (2), (3), (4)) AS s (size))
), counted AS MATERIALIZED (
    SELECT lang, words, any_value(size) AS size, count(*) AS f FROM grams GROUP BY lang, words
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT lang, words, size, f AS a FROM counted WHERE size > 1 AND f >= 30
), halves AS MATERIALIZED (
    SELECT c.*, h.f AS l, c.words[cut + 1 : c.size] AS tail
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS cut FROM candidates) c
    JOIN counted h ON h.lang = c.lang AND h.words = c.words[1 : cut]
), cuts AS MATERIALIZED (
    SELECT c.lang, c.words, a, cut, l, t.f AS r, CAST(2000000::HUGEINT * a // (l + t.f) AS BIGINT) AS score
    FROM halves c JOIN counted t ON t.lang = c.lang AND t.words = c.tail
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1
), inside AS (
    SELECT lang, words[i : i + m - 1] AS words, max(a) AS most
    FROM (SELECT *, unnest(generate_series(1, size - m + 1)) AS i
        FROM (SELECT *, unnest(generate_series(2, size - 1)) AS m FROM candidates WHERE size > 2))
    GROUP BY 1, 2
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank,
        array_to_string(words, ' ') AS phrase, a, l, r, score
    FROM lowest LEFT JOIN inside USING (lang, words) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
