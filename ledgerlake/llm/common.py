"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import cut_lineage, ensure_checkpoint_dir, own_shuffles_dropped

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; batches it answers with None are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out

    return map_partitions(df, run, schema)


def map_partitions(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose Python workers can import this package."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    return df.mapInArrow(fn, schema)


def landed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the cluster's checkpoint folder, read back with its columns prunable."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with own_shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The strings of a column, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the documents no model may learn from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
