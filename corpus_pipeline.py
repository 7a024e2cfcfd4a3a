"""From raw documents to packed training sequences: five stages, each a corpus operator over the table before it.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and
read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from premisa.llm import decontamination, near_duplicates, packing, quality_rules, secret_scan
from premisa.llm.common import written
from premisa.llm.queries import table, tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_duplicates.deduplicated(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in token sequences."""
    return packing.packed_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: Signatures, edit search, forests and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
