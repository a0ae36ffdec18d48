"""Join helpers with SQL subquery semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_in(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """``WHERE lkey IN (SELECT rkey ...)``: a left-semi join (NULL keys never match)."""
    r = right.select(F.col(rkey).alias("_in_k"))
    return left.join(r, left[lkey] == r["_in_k"], "left_semi")


def not_in(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """``WHERE lkey NOT IN (SELECT rkey ...)`` with SQL's NULL rules (trap G11).

    A NULL anywhere in the subquery makes every comparison unknown, so nothing
    is returned; a NULL left key only survives an empty subquery. Spark's own
    null-aware anti join requires broadcasting the subquery side; this version
    is an ordinary (shuffle or broadcast, as the planner picks) left-anti join
    plus two scalar subqueries over the right side, so it scales with both sides.
    """
    stats = right.agg(F.count_if(F.col(rkey).isNull()).alias("_nulls"), F.count(F.lit(1)).alias("_rows"))
    nulls = stats.select("_nulls").scalar()
    rows = stats.select("_rows").scalar()
    r = right.select(F.col(rkey).alias("_nin_k")).where(F.col("_nin_k").isNotNull())
    anti = left.join(r, left[lkey] == r["_nin_k"], "left_anti")
    return anti.where((nulls == 0) & (F.col(lkey).isNotNull() | (rows == 0)))
