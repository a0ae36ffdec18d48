"""Embedding whitening with Spark MLlib's BlockMatrix.

Vectors become whole numbers first, so their sums are exact and centring loses nothing: a row less
the mean is (n x - S) / n, an exact numerator divided once. Centred rows are indexed into blocks of
a BlockMatrix; its transpose times itself is the scatter, whose eigenvectors are found locally (a
matrix of dimensions, not of rows); the blocks times the whitening matrix are the result, and that
times its own transpose tells how far its covariance is from the identity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_batches, map_partitions, written

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_ROWS, BLOCK_COLS = 2048, 256
MAX_DIMENSIONS = 8192  # the scatter of so many dimensions, 512 MB, is the most the driver takes
_SPLIT_BLOCKS = 8  # row blocks a task multiplies with their like
_WHOLE = float(1 << 53)


def _whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x, dims) of the usable rows, x as little-endian int64 bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        column = batch.column(1)
        sizes = np.diff(column.offsets.to_numpy())
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        flat = column.flatten()  # without what null rows may hide
        sizes = np.where(valid, sizes, 0)
        bad = flat.is_null().to_numpy(zero_copy_only=False)
        x = np.floor(flat.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False) * SCALE)
        bad |= ~(np.abs(x) < _WHOLE)
        end = np.cumsum(sizes)
        wrong = np.r_[0, np.cumsum(bad)]
        keep = np.flatnonzero(valid & (sizes > 0) & (wrong[end] == wrong[end - sizes]))
        if not len(keep):
            return None
        x = np.where(bad, 0, x).astype(np.int64) + SHIFT
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep)), pa.array([x[end[i] - sizes[i] : end[i]].tobytes() for i in keep], pa.binary()), pa.array(sizes[keep], pa.int32())],
            ["vec_id", "x", "dims"],
        )

    kind = vectors.schema[id_col].dataType.simpleString()
    return map_batches(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")), run, f"vec_id {kind}, x binary, dims int")


def _rows(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.int64) for x in column.to_pylist()])


def _sums(rows: DataFrame, dims: int) -> list[int]:
    """The exact sum of every dimension."""

    def run(batches):
        total = np.zeros(dims, object)
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch.column("x"))
                small = int(np.abs(x).max()) * len(x) < 1 << 62
                total += x.sum(0).astype(object) if small else x.astype(object).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([str(s) for s in total])], ["dim", "s"])

    sums = map_partitions(rows.select("x"), run, "dim int, s string").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["dim"]: int(r["s"]) for r in sums.collect()}  # a row a dimension
    return [found[d] for d in range(dims)]


def _blocks(rows: DataFrame, dims: int, n: int, sums: list[int]) -> DataFrame:
    """(task, turn, ids, deviations, centred): centred rows in blocks of ``BLOCK_ROWS``, the last of
    a task filled up with zero rows."""
    kind = rows.schema["vec_id"].dataType

    def run(batches):
        total, most = np.array(sums, object), max(abs(s) for s in sums)
        held, size, task, turn = [], 0, TaskContext.get().partitionId(), 0

        def out(part):
            x = _rows(part.column("x"))
            if n * int(np.abs(x).max()) + most < 1 << 62:
                off = n * x - total.astype(np.int64)
            else:
                off = n * x.astype(object) - total
            m = max(abs(int(off.max())), abs(int(off.min())))
            squares = (off * off if m * m * dims < 1 << 63 else off.astype(object) ** 2).sum(1).tolist()
            centred = np.zeros((BLOCK_ROWS, dims))
            centred[: len(x)] = off.astype(np.float64) / n
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task], pa.int32()), pa.array([turn], pa.int32()), pa.array([part.column("vec_id").to_pylist()], pa.list_(part.column("vec_id").type)),
                    pa.array([[s if s < 1 << 63 else None for s in squares]], pa.list_(pa.int64())), pa.array([centred.tobytes()], pa.binary()),
                ],
                ["task", "turn", "ids", "deviations", "centred"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, BLOCK_ROWS - size))
                at, size = at + held[-1].num_rows, size + held[-1].num_rows
                if size == BLOCK_ROWS:
                    yield out(pa.Table.from_batches(held))
                    held, size, turn = [], 0, turn + 1
        if held:
            yield out(pa.Table.from_batches(held))

    return map_partitions(rows.select("vec_id", "x"), run, f"task int, turn int, ids array<{kind.simpleString()}>, deviations array<bigint>, centred binary")


def _times(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product, its inner dimension cut into ``splits`` tasks (BlockMatrix.multiply of the JVM)."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, eigenvectors as columns, trace) of the covariance, largest first; directions
    without variance beyond rounding are none. The largest entry of a vector is positive."""
    v = (scatter + scatter.T) / (2 * n)
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1], vectors[:, ::-1]
    keep = min(most, int((e > max(e[0], 0) * len(e) * 1e-15).sum()))
    e, vectors = e[:keep], vectors[:, :keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(keep)])
    return e, vectors, float(np.trace(v))


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per usable
    vector and component (from 1, by falling eigenvalue, at most ``most``).

    A vector's entries c become x = floor(64 c) + 1,000,000. The mean and covariance (divisor n) are
    those of all usable vectors. ``deviation`` is the sum of (n x - S)^2, exact; null beyond a long.
    ``whitened`` is x less the mean along the component over the root of its eigenvalue, and
    ``explained`` that eigenvalue's share of all. ``identity_error`` is the largest entry, without
    sign, of the covariance of what is returned less the identity.

    Dropped are null and empty vectors, those with a null, infinite or NaN entry or one of 2^47 and
    more, and those of another length than most have (of equally common lengths the longest stays).
    Directions without variance are no components: one vector, or only equal ones, give no rows, as
    does an empty table. Repeated ids or rows are each a row. Other columns aren't read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = written(_whole_numbers(vectors, id_col, vector_col))
    usual = rows.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    dims, n = usual["dims"], usual["n"]
    if dims > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {dims} dimensions; at most {MAX_DIMENSIONS} can be decomposed on the driver")
    rows = rows.where(F.col("dims") == dims)
    sums = _sums(rows, dims)
    blocks = written(_blocks(rows, dims, n, sums))
    per_task = sorted((r["task"], r["n"]) for r in blocks.groupBy("task").agg(F.count("*").alias("n")).collect())  # a row a task
    before, n_blocks = {}, 0
    for task, count in per_task:
        before[task], n_blocks = n_blocks, n_blocks + count
    height, width = BLOCK_ROWS, min(dims, BLOCK_COLS)

    def matrices(r):
        centred = np.frombuffer(r["centred"]).reshape(height, dims)
        for j, at in enumerate(range(0, dims, width)):
            part = centred[:, at : at + width]
            yield (before[r["task"]] + r["turn"], j), DenseMatrix(*part.shape, part.ravel(order="F"))

    centred = BlockMatrix(blocks.select("task", "turn", "centred").rdd.flatMap(matrices), height, width, n_blocks * height, dims)
    splits = -(-n_blocks // _SPLIT_BLOCKS)
    scatter = _times(centred.transpose(), centred, splits).toLocalMatrix().toArray()  # dims x dims
    e, directions, trace = components(scatter, n, most)
    if not len(e):
        return spark.createDataFrame([], schema)
    w = directions / np.sqrt(e)
    parts = [((j, 0), DenseMatrix(len(p), len(e), p.ravel(order="F"))) for j, p in enumerate(w[at : at + width] for at in range(0, dims, width))]
    projected = _times(centred, BlockMatrix(spark.sparkContext.parallelize(parts, 1), width, len(e), dims, len(e)))
    landed = written(projected.blocks.map(lambda b: (b[0][0], b[1].toArray().tobytes())).toDF("block int, projected binary"))
    again = BlockMatrix(landed.rdd.map(lambda r: ((r["block"], 0), _dense(r["projected"], len(e)))), height, len(e), n_blocks * height, len(e))
    covariance = _times(again.transpose(), again, splits).toLocalMatrix().toArray() / n
    error = float(np.abs(covariance - np.eye(len(e))).max())
    starts = spark.createDataFrame(list(before.items()), "task int, earlier int")
    ids = blocks.join(starts, "task").select((F.col("earlier") + F.col("turn")).alias("block"), "ids", "deviations")
    share = (e / trace).tolist()

    def out(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row, k = batch.slice(at, 1), len(share)
                who, deviation = row.column("ids").flatten(), row.column("deviations").flatten()
                m = len(who)
                values = np.frombuffer(row.column("projected")[0].as_py()).reshape(height, k)[:m]
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        who.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)), deviation.take(each),
                        pa.array(values.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return map_partitions(landed.join(ids, "block"), out, schema)


def _dense(data: bytes, width: int) -> DenseMatrix:
    values = np.frombuffer(data).reshape(-1, width)
    return DenseMatrix(*values.shape, values.ravel(order="F"))
