"""Joins on keys of which a few hold much of the data.

Adaptive execution splits a skewed partition only where the join reads plain shuffles; a full outer
join, or a side that is aggregated by the join key, keeps a hot key in one task. Here the hot keys
are found first, by a sketch of bounded size, and their rows dealt over salts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_ITEMS = 4096


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float = 0.01, most: int = 100) -> list[int]:
    """Hashes of the keys that hold about ``share`` of the rows or more: at most ``most`` of them.

    A frequent-items sketch with ``SKETCH_ITEMS`` counters a task finds all keys above 1 / ``SKETCH_ITEMS``
    of the rows. Rows with a NULL key are left out, as they join nothing.
    """
    known = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    row = known.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {most}, {SKETCH_ITEMS})").alias("top")).first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= max(2, share * row["n"])]


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hot: Sequence[int] | None = None, salts: int = 32) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` inner, left or full, with hot keys of ``left`` spread out.

    Rows of a hot key are dealt over ``salts`` by a hash of all their columns, and the key's rows of
    ``right`` are repeated for each; other keys have one salt. So a task gets a hot key's share of
    one salt, and ``right`` should be small for each key. ``hot`` are hashes from
    ``heavy_hitters`` (default: those of ``left``). A full join is the left join and the rows of
    ``right`` whose key ``left`` lacks, so no copy of a repeated row is left over.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"how is {how!r}; inner, left and full can be salted")
    keys = list(keys)
    hot = heavy_hitters(left, keys) if hot is None else list(hot)
    if not hot:
        return left.join(right, keys, how)
    salt = "_salt"
    while salt in left.columns or salt in right.columns:
        salt += "_"
    is_hot = _hash(keys).isin(hot)
    dealt = left.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    repeated = right.withColumn(salt, F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("long")))))
    joined = dealt.join(repeated, [*keys, salt], "inner" if how == "inner" else "left").drop(salt)
    if how == "full":
        rest = right.join(left.select(*keys).distinct(), keys, "left_anti")
        joined = joined.unionByName(rest, allowMissingColumns=True)
    return joined
