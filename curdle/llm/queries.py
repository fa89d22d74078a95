"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from curdle.llm import bpe, chosenpath, lexical, licenses, linededup, mixing, outliers, quality, records, spelling, suffix, topk, urlrules
from curdle.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_spans(table(spark, sf_dir, "documents"))


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.classify(docs, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "epoch", "block", "order")


def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.jaccard_classes(table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"curdle/records-{uuid.uuid4().hex}")
    spec = bpe.read_spec(public_tokenizers.path(TOKENIZER))
    records.write_records(table(spark, sf_dir, "documents"), spec, f"{folder}/shards")
    index = records.build_index(spark, f"{folder}/shards", f"{folder}/index")
    return records.with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_table(table(spark, sf_dir, "documents"), bpe.read_spec(public_tokenizers.path(TOKENIZER)))


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op10_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.decisions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_QUERIES = (
    op1_exact_topk, op2_suffix_dedup, op3_quality_votes, op4_temperature_mix, op5_chosen_path_join,
    op6_token_records, op7_bpe_transducer, op8_robust_outliers, op9_url_rules, op10_line_join,
    op11_license_scan, op12_spelling_variants, op13_ranked_search,
)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def all_oracles() -> dict[str, str]:
    return {
        "op1_exact_topk": topk.ORACLE_SQL, "op9_url_rules": urlrules.oracle_sql(), "op12_spelling_variants": spelling.ORACLE_SQL, "op13_ranked_search": lexical.ORACLE_SQL,
    }
