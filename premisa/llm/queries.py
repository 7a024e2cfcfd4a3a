"""One query per corpus operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from premisa.llm import (
    decontamination,
    html_text,
    language_id,
    merkle,
    near_duplicates,
    packing,
    quality_rules,
    repeated_spans,
    secret_scan,
    sharding,
    token_prefixes,
    warc,
    whitening,
)
from premisa.llm.merkle_sql import MANIFEST
from premisa.llm.quality_sql import QUALITY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@query("op3_minhash_near_duplicates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = 24


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query(
    "op5_warc",
    """
    with p as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
        from pages
    ),
    m as (select *, max(page_id) over (partition by payload_digest) as latest from p)
    select page_id, payload_bytes, payload_digest,
        case when payload_bytes < 1000 or page_id = latest then 'response' else 'revisit' end as record_type,
        case when payload_bytes < 1000 or page_id = latest then null else latest end as refers_to
    from m
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.deduplicated(table(spark, sf_dir, "documents")).drop("removed")


@query("op9_quality_rules", QUALITY)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op12_token_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefixes.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=512)


@query("op13_merkle_manifest", MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))
