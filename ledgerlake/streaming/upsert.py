"""T1 with kept state: a streaming aggregation holds the newest version of every key.

The state store has one row a key, with no watermark: nothing is dropped, however late, and a
version older than the one held changes nothing. A micro-batch gives the keys that rows arrived
for; those whose newest version really changed replace theirs in a table bucketed by key, and only
buckets with such a key are rewritten. The current table is read as it stands: no run reduces
earlier batches again.

Stream checkpoint and table survive a restart: a batch that is repeated replaces rows by
themselves. At many keys, give the session the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), which keeps state on disk. The number of state
partitions is the session's shuffle setting at the first run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.sources.sinks import replace_rows
from ledgerlake.sources.tables import path_exists

BUCKET = "key_bucket"


def newest_versions(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The newest version per key: greatest ``ts`` (none counts as oldest), then greatest other columns."""
    rest = [c for c in rows.columns if c not in {*keys, ts}]
    order = F.struct(ts, *rest)
    picked = rows.groupBy(*keys).agg(F.max(order).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def upsert_stream(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    buckets: int = 64,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    on_batch: Callable[[int, list], None] | None = None,
) -> None:
    """Take in all files of ``source`` not yet seen, then stop; ``table`` holds the newest row per key.

    Rows without a key column's value are versions of that key too. ``on_batch`` is told the number
    of each batch and the buckets it rewrote. Columns of ``schema`` must be orderable.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    newest = newest_versions(reader.load(source), keys, ts)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        rows = rows.persist()  # read for its buckets and its rows; the batch is not computed again
        try:
            here = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            changed = rows
            if path_exists(spark, table):
                old = spark.read.schema(rows.schema).parquet(table).where(F.col(BUCKET).isin(here)).select(*rows.columns)
                same = [rows[c].eqNullSafe(old[c]) for c in rows.columns]
                changed = rows.join(old, same, "left_anti")
            scratch = f"{checkpoint}-merge/{batch_id}"
            written = replace_rows(spark, table, changed, changed.limit(0), [*keys], BUCKET, scratch)
        finally:
            rows.unpersist()
        if on_batch:
            on_batch(batch_id, written)

    query = (
        newest.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"ingest stream failed: {exc}")


def upserted(spark: SparkSession, table: str, schema: StructType | str) -> DataFrame:
    """The table as it stands."""
    return spark.read.schema(schema).parquet(table).drop(BUCKET)
