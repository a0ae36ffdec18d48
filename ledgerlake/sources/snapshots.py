"""What a full reload changed, read from differing buckets only.

A snapshot is stored in buckets by key, with a checksum a bucket beside it: the number of rows and
two order-free sums of row hashes. Two snapshots are compared by their checksums first, so a reload
that changed little is found out from a few buckets of either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.sinks import staged, write_table

BUCKET = "snapshot_bucket"


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """Store the full snapshot ``df`` under ``path`` with its checksums. ``keys`` should be unique."""
    dealt = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    write_table(dealt.hint("rebalance", BUCKET), "", path=f"{path}/rows", partition_by=[BUCKET])
    row = F.xxhash64(*sorted(df.columns))
    sums = df.sparkSession.read.schema(dealt.schema).parquet(f"{path}/rows").groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(row).alias("mixed")
    )
    staged(sums, f"{path}/sums")


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose checksums differ (a row a bucket is read)."""
    a, b = (spark.read.parquet(f"{p}/sums") for p in (old, new))
    same = [a[c].eqNullSafe(b[c]) for c in (BUCKET, "n", "total", "mixed")]
    odd = a.join(b, same, "left_anti").select(BUCKET).union(b.join(a, same, "left_anti").select(BUCKET))
    return sorted(r[0] for r in odd.distinct().collect())


def snapshot_changes(spark: SparkSession, old: str, new: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The keys that differ between two snapshots written by ``write_snapshot`` with as many buckets:
    ``keys``, ``change`` (inserted, updated, deleted), ``changed`` (names of the updated columns) and
    the rows ``before`` and ``after``. Only differing buckets are read. ``schema`` is the table's."""
    keys = list(keys)
    buckets = differing_buckets(spark, old, new)

    def side(path: str, name: str) -> DataFrame:
        rows = spark.read.schema(f"{schema}, {BUCKET} int").parquet(f"{path}/rows").where(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        return rows.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*rows.columns).alias(name))

    a, b = side(old, "before"), side(new, "after")
    columns = [c for c in a.schema["before"].dataType.names if c not in keys]
    both = a.join(b, [F.col(f"before_{k}").eqNullSafe(F.col(f"after_{k}")) for k in keys], "full")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in columns]))
    out = both.withColumn("changed", F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), changed))
    change = F.when(F.col("before").isNull(), "inserted").when(F.col("after").isNull(), "deleted").when(F.size("changed") > 0, "updated")
    key = [F.when(F.col("after").isNull(), F.col(f"before_{k}")).otherwise(F.col(f"after_{k}")).alias(k) for k in keys]
    return out.select(*key, change.alias("change"), "changed", "before", "after").where(F.col("change").isNotNull())
