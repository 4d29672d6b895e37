"""One query for each operator, over whole tables, and DuckDB SQL where that can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, lm_score, media, oracles, packing, quality, secret_scan, simhash, tokens, toxicity, turn_repair, url_filter, vector_codes


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    digests = {"n_tokens": F.expr("cast(octet_length(ids) div 4 as long)"), "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    return out.select("doc_id", *(c.alias(n) for n, c in digests.items()))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_classes(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op5_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored files go along: ``media``, and the resampled ``pcm``."""
    return media.text_media(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths are the token counts of op 1."""
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, length=tokens.token_length(docs, tokenizer_file("byte_bpe_50k.json")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the sites of ``pages`` whose own label is one of ``LISTED_LABELS``."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    site = F.regexp_extract(url_filter.host_of(F.coalesce("url", F.lit(""))), r"([^.]+)\.[^.]+\.[^.]+$", 0)
    listed = pages.select(site.alias("site")).where(F.substring_index("site", ".", 1).isin(*url_filter.LISTED_LABELS)).distinct()
    return url_filter.url_filter(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in secret_scan.BASE]
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(read(spark, sf_dir, "conversations"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_exact_dedup, op3_bpe_round_trip, op4_simhash, op5_telephony, op6_packing, op7_url_filter,
        op8_lm_score, op9_toxicity, op10_secret_scan, op11_turn_repair, op12_quality, op13_vector_codes,
    )
}

ORACLE_SQL = {
    "op11_turn_repair": oracles.repair_sql(),
    "op13_vector_codes": oracles.codes_sql(),
    "op2_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
    """,
    "op7_url_filter": r"""
        WITH r AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
             h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
             v AS (SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                                  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                                  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                                  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN regexp_extract(host, '([^.]+)\.[^.]+\.[^.]+$', 1) IN ('casino-win', 'free-bets', 'ads-track', 'cheap-pills', 'adult-x', 'spam-farm') THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM v
    """,
}
