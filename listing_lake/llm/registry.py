"""The queries of this subpackage, each over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.llm import (
    alignment, embeddings, exact_dedup, language, lexical, mixing, near_dup, packing, personal, quality, sharding, substrings, urls,
)
from listing_lake.llm.tables import FILE, ROW, WHOLE, load


def site_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The source stands for the host, and the source's part in one language for the path."""
    docs = load(spark, folder, "documents")
    return quality.judge(docs, load(spark, folder, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))


def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.classes(load(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


EXACT_COPIES_SQL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY body)
"""


def histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    placed = sharding.shard(docs, ["doc_id", "text"], shards=8)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    return placed.select(
        "doc_id", "size", crc, F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken are counted in the rows that the mix returns; documents that it does not hold have 0."""
    docs = load(spark, folder, "documents")
    copied = mixing.drawn(docs).select(FILE, ROW, mixing.n_words(f"{WHOLE}.text").alias("words")).groupBy(FILE, ROW).agg(F.sum("words").alias("words"))
    return mixing.copies(docs).join(copied, [FILE, ROW], "left").select(
        f"{WHOLE}.doc_id", F.col("_llm_size").alias("size"), F.col("_llm_source_size").alias("source_size"),
        F.col("_llm_target").alias("target"), F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
    )


def repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(load(spark, folder, "documents"), length=35)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in RULES], "verdict string, host string, path string")
    return urls.judge(load(spark, folder, "pages"), rules)


URL_RULES_SQL = """
    WITH rules(verdict, host, path) AS (VALUES %s),
    p AS (
        SELECT page_id, row_number() OVER () AS n,
               coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
        FROM pages
    ),
    best AS (
        SELECT n, arg_max(r, length(r.host || r.path)) AS r
        FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY n
    )
    SELECT page_id, host, path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
    FROM p LEFT JOIN best USING (n)
""" % ", ".join(str((r.verdict, r.host, r.path)) for r in RULES)


def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.links(load(spark, folder, "embeddings"), threshold=0.98)


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return language.predict(docs, language.train(docs))


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.classes(load(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "group_size", "kept")


#: The tokenizer of the packing query; the file stays where it is installed.
TOKENIZER = "word_bpe_49k.json"


def packed(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(load(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(load(spark, folder, "documents"), load(spark, folder, "benchmark"), top=10)


RANKED_SQL = r"""
    WITH low(kind, id, n, body) AS (
        SELECT 'd', doc_id, row_number() OVER (), text FROM documents UNION ALL SELECT 'i', item_id, row_number() OVER (), text FROM benchmark
    ),
    words AS (
        SELECT kind, id, n, unnest(regexp_extract_all(
            translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM low
    ),
    tf AS (SELECT id, n, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL),
    size AS (SELECT n, sum(tf)::BIGINT AS terms FROM tf GROUP BY n),
    total AS (SELECT count(*) AS docs, sum(terms)::BIGINT AS terms FROM size),
    m AS (SELECT n, 10 + (90 * size.terms * docs) // total.terms AS m FROM size, total),
    weight AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs
    ),
    items AS (SELECT DISTINCT id, n, term FROM words WHERE kind = 'i'),
    scores AS (
        SELECT items.id AS item_id, items.n AS item, tf.id AS doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM items JOIN weight USING (term) JOIN tf USING (term) JOIN m ON m.n = tf.n
        GROUP BY items.id, items.n, tf.id, tf.n
    ),
    placed AS (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
        FROM scores WHERE score > 0
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
"""


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find(load(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(personal.written_out(base), 256).alias("base_sha256"),
        personal.written_out(F.col("spans")).alias("spans"),
    )


PERSONAL_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents),
    kinds(o, kind, pattern) AS (VALUES
        (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
        (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
        (2, 'card', '[0-9]([\x20-]?[0-9])+'),
        (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'),
        (4, 'iban', '[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?'),
        (5, 'ssn', '[0-9]{3}-[0-9]{2}-[0-9]{4}')
    ),
    cut AS (
        SELECT n, o, kind, string_split_regex(body, pattern) AS gaps, regexp_extract_all(body, pattern) AS hits FROM d, kinds
    ),
    one AS (SELECT n, o, kind, i, gaps[i] AS gap, hits[i] AS hit FROM cut, LATERAL (SELECT unnest(range(1, len(hits) + 1)) AS i)),
    placed AS (
        SELECT n, o, kind, gap, hit, regexp_replace(hit, '[^0-9]', '', 'g') AS digits, replace(hit, ' ', '') AS plain,
               (sum(length(gap) + length(hit)) OVER (PARTITION BY n, o ORDER BY i))::BIGINT AS stop
        FROM one
    ),
    span AS (
        SELECT n, o, kind, stop - length(hit) AS start, stop FROM placed
        WHERE CASE kind
            WHEN 'ip' THEN regexp_full_match(hit, '(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.|$)){4}')
            WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(0, length(digits)),
                lambda i: CASE WHEN i % 2 = 0 THEN digits[length(digits) - i]::INT
                               ELSE digits[length(digits) - i]::INT * 2 // 10 + digits[length(digits) - i]::INT * 2 % 10 END)) % 10 = 0
            WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
            WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(string_split(plain[5:] || plain[:4], ''),
                lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
                lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
            WHEN 'ssn' THEN regexp_matches(lower(right(gap, 40)), 'ssn|social security|taxpayer')
            ELSE true END
    )
    SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
           sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 4), '')) AS base_sha256,
           coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o), '') AS spans
    FROM d LEFT JOIN span USING (n) GROUP BY n, doc_id
"""

#: A byte-level BPE and a piece model.
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(load(spark, folder, "documents"), *map(public_tokenizers.path, ALIGNED))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


QUERIES = {
    "op1_site_quality": site_quality,
    "op2_exact_copies": exact_copies,
    "op3_histogram_shards": histogram_shards,
    "op4_source_mix": source_mix,
    "op5_repeated_windows": repeated_windows,
    "op6_near_copies": near_copies,
    "op7_url_rules": url_rules,
    "op8_near_vectors": near_vectors,
    "op9_packed": packed,
    "op10_languages": languages,
    "op11_ranked": ranked,
    "op12_personal_data": personal_data,
    "op13_aligned_tokens": aligned_tokens,
}

ORACLES = {
    "op2_exact_copies": EXACT_COPIES_SQL,
    "op7_url_rules": URL_RULES_SQL,
    "op11_ranked": RANKED_SQL,
    "op12_personal_data": PERSONAL_SQL,
}
