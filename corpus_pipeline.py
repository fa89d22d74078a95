"""The corpus pipeline: raw documents to token statistics, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of ``documents``. ``sf_dir`` is only read for ``labels``.

Null texts fail the quality stage's vote only if the labelled documents' majority does
(see ``curdle.llm.quality``); rows without an id pass the join stage; an empty table
passes through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.llm import bpe, chosenpath, linededup, mixing, quality
from curdle.operators.materialize import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours vote to be of good quality."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.classify(docs, model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line of the corpus."""
    kept = linededup.deduplicate(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that the n-gram join connects, the one with the smallest id (then text hash)."""
    found = chosenpath.jaccard_classes(docs)
    heads = found.where("n_grams > 0").groupBy("class_key").agg(F.min(F.struct("doc_id", "th")).alias("head")).select("head.*")
    wordless = found.where("n_grams = 0 AND doc_id IS NOT NULL").select("doc_id", "th").distinct()
    first = materialize(heads.unionByName(wordless), "class-heads").select(F.col("doc_id").alias("head_id"), F.col("th").alias("head_th"))
    same = (F.col("doc_id") == F.col("head_id")) & (F.xxhash64("text") == F.col("head_th"))
    named = docs.where("doc_id IS NOT NULL").join(first, same, "left_semi")
    named = named.withColumn("_th", F.xxhash64("text")).dropDuplicates(["doc_id", "_th"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents once, and those of rarer sources again, by temperature."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every drawn document, encoded and decoded."""
    return bpe.encode_table(docs, bpe.read_spec(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_each_class),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The votes, the randomised join and the encoder have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{uuid.uuid4().hex[:8]}")
    return STAGES[-1][1](spark, docs, sf_dir)
