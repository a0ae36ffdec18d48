"""The corpus pipeline: documents in, packed training sequences out.

Stages, in order: quality rules (rejected documents go), SimHash near-dedup (one document of each
group stays), removal of personal data, mixing of sources to target weights (documents leave or
repeat as the mix takes them), packing. Each stage's result is written as Parquet to the cluster's
checkpoint folder, read again as the next one's input, and removed once that is written. All but the last return the columns of
documents; the last returns one row per piece with its ids.

A stage works on whatever its predecessor kept: null and empty texts fail the quality rules; an
empty table stays empty through all stages; columns beside those of documents are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, packing, pii, quality, simhash
from ledgerlake.llm.common import table
from ledgerlake.llm.queries import tokenizer_file
from ledgerlake.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitise(docs)
    if "n_chars" in docs.columns:  # the text's length, as in documents
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.stream(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Hashed shingles, disclosure statistics and tokens are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:  # what the stage has read is not needed any more
            done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{i - 1}")
            done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
    return docs
