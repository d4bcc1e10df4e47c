"""The corpus operators as queries over a folder of test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    embeddings,
    filter_audit,
    line_quality,
    mixing,
    packing,
    quality,
    sharding,
    shingles,
    spelling,
    substrings,
    token_files,
    toxicity,
    urls,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op3_rendezvous_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sharded_documents(_table(spark, sf, "documents"))


def op4_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.digests(_table(spark, sf, "documents"))


def op5_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return shingles.near_copies(_table(spark, sf, "documents"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed_amounts(_table(spark, sf, "documents"))


#: The list of blocked URLs is drawn by this beginning of a canonical URL's MD5.
LISTED = "0"


def op1_url_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """No table holds a list: a sixteenth of the URLs of all hosts, in another spelling, is one."""
    pages = _table(spark, sf, "pages")
    canon = urls.canonical(F.col("url"))
    tail = F.when(canon.contains("?"), "&utm_source=list#top").otherwise("?ref=list")
    listed = pages.filter(F.md5(canon).startswith(LISTED))
    return urls.judged(pages, listed.select(F.concat(F.lit("HTTPS://M."), canon, tail).alias("url")))


def op2_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    return line_quality.quality_verdicts(_table(spark, sf, "documents"))


def op8_embedding_links(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.embedding_links(_table(spark, sf, "embeddings"))


def op9_length_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(_table(spark, sf, "documents"))


def op10_quality_grades(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_grades(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.filter_audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf, "documents"))


def op13_token_planes(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_digests(spark, _table(spark, sf, "documents"), tokenizer)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_url_verdicts,
        op2_line_quality,
        op3_rendezvous_shards,
        op4_repeated_passages,
        op5_near_copies,
        op6_toxicity,
        op7_source_mix,
        op8_embedding_links,
        op9_length_buckets,
        op10_quality_grades,
        op11_filter_audit,
        op12_spelling_variants,
        op13_token_planes,
    )
}

LLM_ORACLE = {
    "op1_url_verdicts": urls.oracle_sql(f"md5(canon) LIKE '{LISTED}%' AND host <> ''"),
    "op2_line_quality": line_quality.ORACLE_SQL,
    "op4_repeated_passages": substrings.ORACLE_SQL,
    "op5_near_copies": shingles.ORACLE_SQL,
    "op8_embedding_links": embeddings.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_spelling_variants": spelling.ORACLE_SQL,
}
