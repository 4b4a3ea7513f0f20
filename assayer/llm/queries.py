"""The registered queries of this subpackage, with production parameters, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import (
    bpe,
    embedding_links,
    exact_dedup,
    hard_negatives,
    lm_scoring,
    ngram_join,
    packing,
    quality,
    resampling,
    sharding,
    token_counts,
    top_k_search,
    url_rules,
)
from assayer.llm.lm_scoring import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE_TOKENS = 2048
SHARDS = 24
MODEL_ORDER = 3  # words of the longest n-gram
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_REACH = """reach AS (SELECT a AS id, least(a, b) AS r FROM links UNION SELECT b, least(a, b) FROM links UNION
        SELECT n.id, least(r.r, n.id) FROM reach r JOIN (SELECT a AS at, b AS id FROM links UNION ALL SELECT b, a FROM links) n
        ON n.at = r.id),
    named AS (SELECT id, min(r) AS c FROM reach GROUP BY id)"""


@query(
    "op1_embedding_links",
    f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
        AND list_cosine_similarity(x.e, y.e) >= 0.98),
    degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id),
    {_REACH}
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
    FROM v LEFT JOIN degree d ON d.id = vec_id LEFT JOIN named m ON m.id = vec_id""",
)
def op1_embedding_links(spark, folder):
    return embedding_links.linked(table(spark, folder, "embeddings"))


_HOST = "translate(regexp_extract(after, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FITS = "(host = '{0}' OR host LIKE '%.{0}') AND starts_with(path, '{1}')"


@query(
    "op2_url_rules",
    f"""WITH cut AS (SELECT page_id, CASE WHEN position('://' IN url) > 0
        THEN substr(url, position('://' IN url) + 3) ELSE '' END AS after FROM pages),
    parts AS (SELECT page_id, {_HOST} AS host, regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
    SELECT page_id, host, path,
        CASE WHEN {_FITS.format("www.example.com", "/en/")} THEN 'www.example.com/en/'
             WHEN {_FITS.format("example.com", "/en/")} THEN 'example.com/en/'
             WHEN {_FITS.format("net", "/es/")} THEN 'net/es/' WHEN {_FITS.format("net", "/fr/")} THEN 'net/fr/'
             WHEN {_FITS.format("com", "/")} THEN 'com/' END AS rule,
        CASE WHEN {_FITS.format("www.example.com", "/en/")} THEN 'allow'
             WHEN {_FITS.format("example.com", "/en/")} THEN 'block'
             WHEN {_FITS.format("net", "/es/")} OR {_FITS.format("net", "/fr/")} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts""",
)
def op2_url_rules(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judged(table(spark, folder, "pages"), rules)


@query(
    "op3_ngram_join",
    f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
    links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id
        AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
        GROUP BY ALL HAVING 100 * count(*) >= 90 * (min(x.n) + min(y.n) - count(*))),
    {_REACH}
    SELECT doc_id, len(s) AS n_shingles, coalesce(c, doc_id) AS component_id FROM sets LEFT JOIN named ON id = doc_id""",
)
def op3_ngram_join(spark, folder):
    return ngram_join.joined(table(spark, folder, "documents"))


@query(
    "op3_ngram_links",
    f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
    links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id
        AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
        GROUP BY ALL HAVING 100 * count(*) >= 90 * (min(x.n) + min(y.n) - count(*))),
    degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id),
    {_REACH}
    SELECT doc_id, len(s) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(d.n, 0) AS n_links
    FROM sets LEFT JOIN named m ON m.id = doc_id LEFT JOIN degree d ON d.id = doc_id""",
)
def op3_ngram_links(spark, folder):
    return ngram_join.linked(table(spark, folder, "documents"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, folder):
    return packing.best_fit(table(spark, folder, "documents"), BYTE_BPE, SEQUENCE_TOKENS)


@query("op5_token_counts")
def op5_token_counts(spark, folder):
    return token_counts.counted(table(spark, folder, "documents"), WORD_BPE, SEQUENCE_TOKENS)


@query(
    "op6_exact_dedup",
    """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        AS plain FROM documents),
    g AS (SELECT plain, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY plain)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(plain) AS text_sha256
    FROM d JOIN g USING (plain)""",
)
def op6_exact_dedup(spark, folder):
    return exact_dedup.deduplicated(table(spark, folder, "documents"), exact_dedup.DigestIndex(spark))


@query("op7_sharding")
def op7_sharding(spark, folder):
    rows = sharding.sharded(table(spark, folder, "documents"), SHARDS)
    return rows.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query("op8_lm_scoring")
def op8_lm_scoring(spark, folder):
    fold = remainder(F.col("doc_id"), 5)
    rows = lm_scoring.scored(table(spark, folder, "documents"), fold != 1, MODEL_ORDER)
    return rows.withColumn("held_out", F.coalesce(fold == 1, F.lit(False))).drop("learned")


@query("op9_quality_classifier")
def op9_quality_classifier(spark, folder):
    fold = remainder(F.col("doc_id"), 3)
    labels = table(spark, folder, "labels").where(fold != 1)
    rows = quality.scored(table(spark, folder, "documents"), labels)
    return rows.withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))


@query("op10_bpe_round_trip")
def op10_bpe_round_trip(spark, folder):
    return bpe.round_trip(table(spark, folder, "documents"), BYTE_BPE)


_USABLE = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _integers(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT))"


def _product(a: str, b: str) -> str:
    """In doubles, which are exact for whole numbers of this size."""
    return f"CAST(list_inner_product({a}::DOUBLE[], {b}::DOUBLE[]) AS BIGINT)"


@query(
    "op11_top_k_search",
    f"""WITH v AS (SELECT vec_id, row_number() OVER () AS r, {_integers(64)} AS e FROM embeddings WHERE {_USABLE}),
    pairs AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, {_product("q.e", "v.e")} AS score
        FROM v q JOIN v ON q.r <> v.r AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM pairs QUALIFY rank <= 20""",
)
def op11_top_k_search(spark, folder):
    return top_k_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


# crc32 in steps of one byte over a table that follows from the polynomial; words are taken by a pattern.
_CRC_TABLE = """(SELECT list(c ORDER BY n) AS crc FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(n)))"""
_WORDS = """SELECT {id}, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS word FROM {table}"""


@query(
    "op12_importance_resampling",
    f"""WITH table_ AS MATERIALIZED {_CRC_TABLE},
    own AS MATERIALIZED ({_WORDS.format(id="doc_id", table="documents")}),
    wanted AS MATERIALIZED ({_WORDS.format(id="item_id", table="benchmark")}),
    bytes AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM own UNION SELECT word FROM wanted)),
    hashed AS MATERIALIZED (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
        lambda c, b: xor(crc[1 + (xor(c, b) & 255)], c >> 8))) % 10000 AS bucket FROM bytes, table_),
    s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (word) GROUP BY bucket),
    gain AS MATERIALIZED (SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM own) + 10000)
        / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
        FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
    weight AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
        FROM own JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
    scored AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296)))
        AS BIGINT) AS score FROM documents d LEFT JOIN weight w ON w.doc_id = d.doc_id),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
    SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
    FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id""",
)
def op12_importance_resampling(spark, folder):
    documents, target = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return resampling.resampled(documents, target, width=1, buckets=10_000, percent=10, least_words=20, seed=2024)


@query(
    "op13_hard_negatives",
    f"""WITH v AS (SELECT vec_id, row_number() OVER () AS r, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        {_integers(256)} AS e FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
    pairs AS MATERIALIZED (SELECT a.r, a.vec_id AS anchor_id, v.r AS other, v.vec_id, a.label = v.label AS same,
        {_product("a.e", "v.e")} AS score FROM v a JOIN v ON a.r <> v.r AND len(a.e) = len(v.e) WHERE a.vec_id % 100 = 0),
    near AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id)
        AS INTEGER) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM near p JOIN pairs n ON n.r = p.r AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10""",
)
def op13_hard_negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(
        table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, positives=5, negatives=10, band=(30, 90), scale=256, label=label
    )
