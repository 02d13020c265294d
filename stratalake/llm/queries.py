"""The operators bound to the given tables, and SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import alignment, bpe, conversation_trie, html_extract, language, mixing, near_duplicates, token_counts, top_k, url_filter
from stratalake.llm import toxicity, vector_duplicates, warc
from stratalake.session import configure

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
# The rules of the url query.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Texts are long: batches for Python stay in a few MB.
_BATCH_ROWS, _BATCH_BYTES = "500", "8m"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators assume."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    return spark


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    counted = token_counts.count_tokens(spark, docs, public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    return top_k.top_k(rows.where("vec_id % 100 = 0"), rows)


def round_trip_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded texts."""
    coded = bpe.round_trip(spark, docs, public_tokenizers.path(VOCABULARY))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(spark, _table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.size") * F.col("_mix.copies")).alias("taken")
    )


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(_table(spark, folder, "pages"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"), url_filter.rule_table(spark, URL_RULES))


def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_duplicates.vector_duplicates(_table(spark, folder, "embeddings"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(_table(spark, folder, "pages"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.detect(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.conversation_trie(_table(spark, folder, "conversations"))


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.measures(_table(spark, folder, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_top_k_search,
        op3_bpe_round_trip,
        op4_language_id,
        op5_mix_sources,
        op6_minhash_near_dedup,
        op7_warc,
        op8_url_filter,
        op9_embedding_near_dedup,
        op10_html_extraction,
        op11_toxicity,
        op12_conversation_trie,
        op13_tokenizer_alignment,
    )
}

_USABLE = """embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

ORACLES: dict[str, str] = {
    "op2_top_k_search": f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w
    FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}
), met AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.w, b.w) AS BIGINT) AS score
    FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM met
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10""",
    "op5_mix_sources": r"""
WITH d AS (
    SELECT doc_id, source, text,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
    SELECT source, source_size, 2.0 * CAST(source_size AS DOUBLE) AS cap,
        CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
    FROM s
), held AS (
    SELECT *, coalesce(sum(cap) OVER before, 0) AS capped, sum(weight) OVER onward AS open_weight,
        1.5 * sum(source_size) OVER () AS whole
    FROM r
    WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        onward AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
    SELECT arg_min((whole - capped) / open_weight, cap / weight) AS share_at FROM held WHERE (whole - capped) / open_weight <= cap / weight
), t AS (
    SELECT source, source_size, least(cap, weight * (SELECT share_at FROM level)) AS target FROM r
), m AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST(CAST('0x' || left(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), md5(d.text), '')), 13) AS BIGINT) AS DOUBLE)
            / 4503599627370496.0 AS draw
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM m""",
    "op6_minhash_near_dedup": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), g AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS shingle
    FROM d
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
met AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM g AS x JOIN g AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), linked AS (
    SELECT a, b FROM met JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
    WHERE 100 * common >= 75 * (na.n + nb.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, documents.doc_id = c.component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)""",
    "op7_warc": """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""",
    "op8_url_filter": """
WITH u AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u
), rules(verdict, h, p) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fit AS (
    SELECT host, path, arg_max(rules.h || rules.p, len(rules.h || rules.p)) AS rule, arg_max(verdict, len(rules.h || rules.p)) AS verdict
    FROM (SELECT DISTINCT host, path FROM h) AS x
    JOIN rules ON (x.host = rules.h OR ends_with(x.host, '.' || rules.h)) AND starts_with(x.path, rules.p)
    GROUP BY host, path
)
SELECT page_id, h.host, h.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM h LEFT JOIN fit ON h.host = fit.host AND h.path = fit.path""",
    "op9_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.w) = len(b.w)
    WHERE list_inner_product(a.w, b.w) / sqrt(list_inner_product(a.w, a.w) * list_inner_product(b.w, b.w)) >= 0.93
), n AS (SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY a),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT embeddings.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, embeddings.vec_id = c.component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) JOIN c USING (vec_id)""",
    "op12_conversation_trie": r"""
WITH o AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), said AS (
    SELECT r, x, row_number() OVER () AS id, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words FROM (SELECT DISTINCT r, x FROM o)
), s AS (SELECT c, list(id ORDER BY i) AS t FROM o JOIN said USING (r, x) GROUP BY c),
k AS (
    SELECT c, t, c - c % 20 AS base, xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda q: CAST(ascii(q) AS BIGINT))),
        lambda crc, q: list_reduce([xor(crc, q), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
    FROM s
), rebuilt AS (
    SELECT k.c, list_concat(coalesce(b.t[1:h], CAST([] AS BIGINT[])), k.t[h + 1:]) AS t FROM k LEFT JOIN s AS b ON b.c = k.base
), p AS (SELECT c, len(t) = d AS ends, t[1:d] AS prefix FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
n AS (
    SELECT prefix, min(c) AS conv_id, len(prefix) AS depth, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM p GROUP BY prefix
), kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
own AS (
    SELECT n.prefix, depth, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * coalesce(words, 0) AS saved
    FROM n LEFT JOIN kids ON kids.prefix = n.prefix LEFT JOIN said ON said.id = n.prefix[depth]
), sub AS (
    SELECT prefix[1:d] AS prefix, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sub ON sub.prefix = n.prefix LEFT JOIN kids ON kids.prefix = n.prefix
LEFT JOIN n AS up ON n.depth > 0 AND up.prefix = n.prefix[1:n.depth - 1]""",
}
