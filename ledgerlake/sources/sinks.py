"""Incremental slices, keyed upserts, table writes and full refreshes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.columns import check_columns
from ledgerlake.operators.keyed import latest_per_key
from ledgerlake.operators.setops import union_all
from ledgerlake.session import own_shuffles_dropped
from ledgerlake.sources.tables import drop_path, path_exists

DEFAULT_SCHEMA = "marts"


def schema_for(node_schema: str | None, custom_schema: str | None, default: str = DEFAULT_SCHEMA) -> str:
    """Target schema rule: node metadata first, else the custom name, else the default."""
    return node_schema or custom_schema or default


def incremental_slice(df: DataFrame, key: str, since, floor=None) -> DataFrame:
    """Rows at or after the replication bookmark ``since`` (and the ``floor`` start date).

    The comparison is a plain filter on the replication column, so it is pushed
    into the scan and, for date-partitioned data, prunes partitions.
    """
    if isinstance(since, Column):
        cond = F.col(key) >= since
        return df.where(cond if floor is None else cond & (F.col(key) >= F.lit(floor)))
    bound = since if floor is None else (floor if since is None else max(since, floor))
    return df if bound is None else df.where(F.col(key) >= F.lit(bound))


def next_bookmark(df: DataFrame, key: str) -> DataFrame:
    """The next bookmark: ``max(key)`` as a one-row frame (read it where it is needed)."""
    return df.agg(F.max(key).alias("bookmark"))


def upsert_by_key(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Merge ``batch`` into ``existing`` on ``keys``; the row with the greatest ``order`` wins.

    Only rows whose key is in the batch are picked from again: the rest of ``existing``
    passes through an anti-join (no shuffle of it while the batch's keys can be
    broadcast, which the planner decides by size). The pick is ``max_by`` with partial
    aggregation, so a hot key does not land in one task. ``order`` should end in a
    unique tie-break; when the batch must win ties, put a batch flag first in
    ``order``. NULL keys match NULL keys.
    """
    check_columns(existing, keys)
    check_columns(batch, keys)
    touched = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    old = existing.join(touched, same, "left_semi")
    return existing.join(touched, same, "left_anti").unionByName(latest_per_key(old.unionByName(batch), keys, order))


def merge_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    partition_by: Sequence[str],
    scratch: str,
) -> None:
    """Merge ``batch`` into the partitioned table at ``path``, rewriting only the partitions it touches.

    A key's partition must not change (the partition columns follow from the key). The
    merged partitions are staged at ``scratch`` first, since a table can't be
    overwritten while it is read; then they replace the old ones (dynamic overwrite).
    """
    table = spark.read.parquet(path)
    touched = batch.select(*partition_by).distinct()
    old = table.join(touched, list(partition_by), "left_semi").select(*batch.columns)
    merged = staged(latest_per_key(old.unionByName(batch), keys, order), scratch)
    write_table(merged, "", path=path, partition_by=partition_by)


def replace_rows(
    spark: SparkSession, path: str, rows: DataFrame, gone: DataFrame, key: str | Sequence[str], partition: str, scratch: str
) -> list:
    """In the table at ``path``, partitioned by ``partition``: rows of the keys in ``gone`` or ``rows``
    leave (NULL is a key value too), then ``rows`` come in. Returns the partitions it read and rewrote.

    Only the partitions that ``gone`` or ``rows`` name are read, with a literal partition filter, and
    written once: a dynamic overwrite puts its files beside the table and swaps them in when all are
    done, so it may read the partitions it replaces. The keys are staged at ``scratch``, so that the
    frames are not computed again for each use of them. A partition that has no rows left is removed.
    A repeat with the same arguments changes nothing. The first call creates the table.
    """
    on = [key] if isinstance(key, str) else list(key)
    if not path_exists(spark, path):
        write_table(rows.hint("rebalance", partition), "", path=path, partition_by=[partition])
        return [r[0] for r in spark.read.schema(rows.schema).parquet(path).select(partition).distinct().collect()]
    names = [f"_k{i}" for i in range(len(on))]

    def keys_of(df: DataFrame, new: bool) -> DataFrame:
        return df.select(*[F.col(k).alias(n) for k, n in zip(on, names, strict=True)], F.col(partition).alias("_p"), F.lit(new).alias("_new"))

    keys = staged(keys_of(gone, False).unionByName(keys_of(rows, True)).groupBy(*names, "_p").agg(F.max("_new").alias("_new")), scratch)
    filled = {r[0]: r[1] for r in keys.groupBy("_p").agg(F.max("_new")).collect()}  # a row a partition
    if not filled:
        return []
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(on, names, strict=True)]

    def staying(parts: list) -> DataFrame:
        old = spark.read.schema(rows.schema).parquet(path).where(F.col(partition).isin(parts))
        return old.join(keys.select(*names), same, "left_anti").select(*rows.columns)

    lost = [p for p, new in filled.items() if not new]  # only these can be left without rows
    left = {r[0] for r in staying(lost).select(partition).distinct().collect()} if lost else set()
    merged = staying(list(filled)).unionByName(rows)
    write_table(merged.hint("rebalance", partition), "", path=path, partition_by=[partition])
    for value in lost:
        if value not in left:
            drop_path(spark, f"{path}/{partition}={value}")
    return list(filled)


def deleted_rows(existing: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` whose keys are absent from a full ``snapshot`` (hard deletes at source)."""
    return existing.join(snapshot.select(*keys), on=list(keys), how="left_anti")


def full_refresh(existing: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Drop-and-reload: the new table is the snapshot; also return what vanished."""
    return snapshot, deleted_rows(existing, snapshot, keys)


def write_table(
    df: DataFrame,
    name: str,
    schema: str | None = None,
    mode: str = "overwrite",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Materialise a result as a table (catalog name) or as files at ``path``.

    With ``partition_by`` and ``mode='overwrite'`` only the partitions present in
    ``df`` are replaced (dynamic partition overwrite).
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    with own_shuffles_dropped(df.sparkSession):
        if path is not None:
            writer.save(path)
        else:
            target = f"{schema}.{name}" if schema else name
            writer.saveAsTable(target)


def staged(df: DataFrame, path: str) -> DataFrame:
    """A stage of a chain, written as a table at ``path`` and read back.

    Consumers of the result read the columns they need from files instead of running
    the stage again, and a lost executor repeats at most the current stage.
    """
    write_table(df, "", path=path)
    return df.sparkSession.read.parquet(path)


def kept_or_staged(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What an earlier attempt of this run finished writing at ``path``, else ``make()`` staged there."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    return staged(make(), path)


def staged_by_key(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A stage of a chain, written as the catalog table ``name`` at ``path``, bucketed and sorted by ``key``.

    Stages bucketed alike join, and are aggregated, on ``key`` without a shuffle. One file a bucket
    is written (the rows are shuffled once, here), so ``buckets`` should grow with the data: some
    hundred MB each. All rows of a key share a bucket; for a key that can hold much of the data
    use ``staged`` instead.
    """
    laid_out = df.repartition(buckets, F.col(key))
    laid_out.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str | None = None, path: str | None = None, fmt: str = "parquet") -> None:
    """Create-if-absent, then append."""
    write_table(df, name or "", mode="append", path=path, fmt=fmt)


def full_snapshot(df: DataFrame, name: str | None = None, path: str | None = None, fmt: str = "parquet") -> None:
    """Non-incremental reload of a dimension: overwrite the whole table."""
    write_table(df, name or "", mode="overwrite", path=path, fmt=fmt)


def inline_relation(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small constant table (lookup rates, status maps). Only for bounded constant data."""
    return spark.createDataFrame(list(rows), schema)


def merge_batches(
    existing: DataFrame,
    batches: Sequence[DataFrame],
    keys: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Apply keyed batches, newest row per key winning.

    The greatest row of a union is the same in whatever order its parts arrive, so
    batches that are all present are merged at once: one upsert of their union.
    """
    if not batches:
        return existing
    return upsert_by_key(existing, union_all(list(batches)), keys, order)
