"""Scans of landed tables, file drops and external relational sources."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_source(
    spark: SparkSession,
    root: str,
    table: str,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Scan one landed table ``{root}/{table}.{fmt}`` (or a catalog table when ``root`` is None).

    Projection is left to Catalyst: selecting ``columns`` (or selecting later)
    prunes the parquet read schema, and filters applied downstream are pushed
    into the scan.
    """
    if root is None:
        df = spark.table(table)
    else:
        path = os.path.join(root, f"{table}.{fmt}")
        df = spark.read.format(fmt).load(path)
    if columns:
        df = df.select(*columns)
    return df


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """File drop source (CSV with header by default; JSON / parquet the same way).

    An explicit ``schema`` avoids an inference pass over the files.
    """
    reader = spark.read.format(fmt)
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    reader = reader.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


_RECORD = "_damaged_record"


def read_files_checked(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv", options: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows with the types of ``schema``, damaged rows) of a file drop; together they are all rows.

    Damaged rows are ``(file, reason, record)``: cut or overlong records and broken JSON are
    ``malformed``; otherwise the reason names the first column whose text is not of its type, such as
    ``qty is no int``. Fields are read as text first, so one bad value spoils no other column, and
    a missing or empty field is NULL, not damaged. The files are parsed once for each of the two frames.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = StructType([*(StructField(f.name, StringType()) for f in wanted), StructField(_RECORD, StringType())])
    rows = read_files(spark, path, fmt, raw, {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD})
    reason = F.when(F.col(_RECORD).isNotNull(), "malformed")
    values = []
    for f in wanted:
        text = F.col(f"`{f.name}`")
        value = text if isinstance(f.dataType, StringType) else F.nullif(F.trim(text), F.lit("")).try_cast(f.dataType)
        values.append(value.alias(f.name))
        if not isinstance(f.dataType, StringType):
            reason = reason.when((F.trim(text) != "") & value.isNull(), f"{f.name} is no {f.dataType.simpleString()}")
    fields = F.struct(*[F.col(f"`{f.name}`") for f in wanted])
    record = F.coalesce(F.col(_RECORD), F.to_json(fields) if fmt == "json" else F.to_csv(fields))
    damaged = rows.select(F.col("_metadata.file_path").alias("file"), reason.alias("reason"), record.alias("record")).where(F.col("reason").isNotNull())
    return rows.where(reason.isNull()).select(*values), damaged


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for reading a relation out of another database over JDBC.

    Exactly one of ``query`` / ``table``. A partitioned read (column + bounds +
    partitions) splits the scan into parallel range queries; Spark does not
    allow it together with ``query``, so partitioned reads need ``table``
    (which may be a parenthesised sub-select).
    """
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query / table")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if query is not None:
        if partition_column:
            raise ValueError("partitioned JDBC reads need `table`, not `query`")
        opts["query"] = query
    else:
        opts["dbtable"] = table
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update(extra or {})
    return opts


def read_query(spark: SparkSession, options: Mapping[str, str], fmt: str = "jdbc") -> DataFrame:
    """Read a relation from an external store through a Spark data source (JDBC by default).

    Vendor drivers / connector jars are not shipped; the caller puts them on
    the classpath.
    """
    return spark.read.format(fmt).options(**options).load()


def column_catalog(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs of a frame: schema metadata only, no data is read."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, asked of the file system it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a job's own file or folder at ``path``, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
