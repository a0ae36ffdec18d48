"""Per-key row selection and per-key totals, written to survive hot keys.

A row-number window puts every row of a key into one task. The operators here
use aggregates with map-side partial aggregation instead, so a key holding a
third of the table is pre-reduced in every input task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import cut_lineage


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    ascending: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row with the greatest (or least) ``order`` tuple.

    Equivalent to ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1``.
    ``order`` must end with a unique tie-break (trap G2) so the result is deterministic.
    Runs as ``max_by`` / ``min_by`` in an aggregate with partial (map-side)
    aggregation: one candidate per key per task is shuffled. Because the
    buffers are structs, Spark plans it sort-based (spills gracefully) rather
    than hash-based. Columns come back in the input order.

    ``columns`` names the columns wanted besides the keys. The optimizer can't
    prune through the packed row, so without it every input column is read,
    sorted and shuffled.
    """
    keys = list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not in frame: {missing}")
    wanted = set(df.columns if columns is None else columns)
    rest = [c for c in df.columns if c not in keys and c in wanted]
    ordering = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None)
    pick = F.min_by if ascending else F.max_by
    picked = df.groupBy(*keys).agg(pick(payload, ordering).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns if c in keys or c in rest])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``keys``: the earliest by ``order`` (``ROW_NUMBER() ... ASC = 1``)."""
    return latest_per_key(df, keys, order, ascending=True, columns=columns)


def key_totals_beside_rows(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, Column],
) -> DataFrame:
    """Attach per-key aggregates to every row (``SUM(x) OVER (PARTITION BY keys)``).

    Computed as a partial-aggregated ``groupBy`` joined back on the keys rather
    than a window, so a hot key is summed across many tasks. The totals are written to the
    checkpoint folder first: then the join reads two plain shuffles, and adaptive execution
    can split a skewed key, which it can't while one side is an aggregate by the key.
    """
    keys = list(keys)
    totals = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])
    renamed = cut_lineage(totals).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *aggs.keys())
    # NULL keys form one group in a window partition, so match them null-safely.
    cond = [df[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = df.join(renamed, on=cond, how="left")
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])
