"""Neighbour-row operators (LEAD / LAG within a key) that stay balanced under skew.

``lead(x) OVER (PARTITION BY key ORDER BY t)`` sends all rows of a key to one
task. Here the frame is range-partitioned on ``(key, t)`` instead: Spark
samples the data and cuts it into balanced, ordered ranges, so a hot key is
spread over many partitions. Each range is sorted, its first row is found from
``monotonically_increasing_id`` (row number 0 of the partition) and copied into
the previous range as a sentinel that sorts after every row there. One window
per range then sees each row's true successor, including across range
boundaries, in a single lineage: no join, no second pass over the ranges, so
the result does not depend on the sampled bounds being reproduced.

Middle ranges are never empty (every range bound is a sampled key of the data,
which falls into its own range, and adaptive execution only merges adjacent
ranges), so "the next range" is always the one after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id = partition id << 33 | row number in partition


def neighbour_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    direction: str = "next",
    num_ranges: int | None = None,
) -> DataFrame:
    """Add ``out`` = ``value`` of the next (``direction='next'``) or previous row of the same key.

    Ordering is ascending on ``order`` (which should be unique within a key);
    ``'prev'`` walks the same sequence backwards. With no ``keys`` the whole
    frame is one sequence, still without a single-task window.

    ``num_ranges`` fixes the range count; by default the session's shuffle
    partition setting is used and adaptive execution may merge neighbouring
    small ranges (a merged range is still a contiguous, non-empty range).
    """
    if direction not in ("next", "prev"):
        raise ValueError("direction must be 'next' or 'prev'")
    keys, order = list(keys), list(order)
    cols = df.columns

    def ordering(c: str) -> Column:
        # 'prev' is 'next' over the reversed order (ASC NULLS FIRST reversed is DESC NULLS LAST)
        return F.col(c).desc_nulls_last() if direction == "prev" else F.col(c).asc_nulls_first()

    sort_exprs = [ordering(c) for c in keys + order]
    spread = df.repartitionByRange(num_ranges, *sort_exprs) if num_ranges else df.repartitionByRange(*sort_exprs)
    ranged = (
        spread.sortWithinPartitions(*sort_exprs)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    rid = F.shiftright(F.col("_mid"), _ROW_BITS)
    first_in_range = (F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))) == 0
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    copies = F.array(
        F.struct(rid.alias("_g"), F.lit(0).alias("_tag"), row.alias("_r")),
        F.when(first_in_range, F.struct((rid - 1).alias("_g"), F.lit(1).alias("_tag"), row.alias("_r"))),
    )
    expanded = ranged.select(F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("_c")).select(
        "_c._g", "_c._tag", "_c._r.*"
    )
    within = Window.partitionBy("_g").orderBy(*[ordering(c) for c in keys + order], F.col("_tag"))
    key_struct = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    nb = (
        expanded.withColumn("_k", key_struct)
        .withColumn("_nk", F.lead("_k").over(within))
        .withColumn("_nv", F.lead(value).over(within))
    )
    own = nb.where(F.col("_tag") == 0)
    return own.select(
        *[F.col(f"`{c}`") for c in cols],
        F.when(F.col("_nk").eqNullSafe(F.col("_k")), F.col("_nv")).alias(out),
    )
