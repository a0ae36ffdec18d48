"""Keyed, resumable incremental ingest with Structured Streaming.

The replication bookmark is the stream checkpoint: a file source read with
``trigger(availableNow=True)`` processes every file not yet seen, then stops;
running it again picks up only new files. Nothing is dropped in the stream:
every landed row, late or repeated, is written to its micro-batch's own
``batch_id=<n>`` folder (a retried batch overwrites itself). The current table
is the newest version of each key over the last snapshot and the batches after
it, so an extract that lands a key again with corrected values wins, and a row
older than everything seen is still taken. ``compact`` folds the batches into a
new snapshot, which bounds what a read has to reduce.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.keyed import latest_per_key


def incremental_ingest(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    file_glob: str | None = None,
) -> None:
    """Run the stream until all available input is processed (``availableNow``).

    ``source`` is a directory of landed files; ``file_glob`` restricts which
    file names in it belong to this table.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    query = (
        reader.load(source).writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"ingest stream failed: {exc}")


def current_table(spark: SparkSession, sink: str, keys: Sequence[str], ts: str, snapshot: str | None = None) -> DataFrame:
    """Newest row per key: greatest ``ts``, then latest batch, then the greatest remaining columns.

    ``snapshot`` is a folder written by ``compact``; only batches after it are read besides.
    Rows without ``ts`` count as older than any other version of their key.
    """
    rows = spark.read.parquet(sink)
    if snapshot is not None:
        base = spark.read.parquet(snapshot)
        upto = base.agg(F.max("batch_id")).first()[0]
        rows = rows.where(F.col("batch_id") > upto).unionByName(base)
    rest = [c for c in rows.columns if c not in {*keys, ts, "batch_id"}]
    return latest_per_key(rows, keys, [ts, "batch_id", *rest]).drop("batch_id")


def compact(spark: SparkSession, sink: str, keys: Sequence[str], ts: str, target: str, snapshot: str | None = None) -> str:
    """Write the current table to the new folder ``target`` as of the last batch; returns ``target``.

    ``snapshot`` is the previous one, if any. Versions that lost are left behind, so later
    reads reduce one row per key plus the batches that landed since.
    """
    last = spark.read.parquet(sink).agg(F.max("batch_id")).first()[0]
    table = current_table(spark, sink, keys, ts, snapshot)
    table.withColumn("batch_id", F.lit(last)).write.mode("overwrite").parquet(target)
    return target
