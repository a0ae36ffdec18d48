"""A8, A12, C22 from kept sketches: distinct counts and top values of any period without its rows.

A state a day (or other part) and key is written once; a week, a month or a customer's lifetime is
the union of states. A part that changes is replaced by writing its partition again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.sinks import write_table

LG_K = 12


def distinct_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Relative error of an estimate that holds at ``sigmas`` standard deviations (4.9% at 12 and 3)."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def write_distinct_states(df: DataFrame, path: str, part: str, item: str, keys: Sequence[str] = (), lg_k: int = LG_K) -> None:
    """Per ``part`` (a day, say) and ``keys``, an HLL sketch of the different ``item`` values; the parts
    in ``df`` replace theirs at ``path``. A sketch has at most 2^``lg_k`` bytes, and is aggregated map-side."""
    state = df.groupBy(part, *keys).agg(F.hll_sketch_agg(item, lg_k).alias("state"))
    write_table(state, "", path=path, partition_by=[part])


def distinct_over(states: DataFrame, period: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``(period, keys, estimate)``: the different items of each period, by the union of its parts' states."""
    return states.groupBy(period.alias("period"), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("estimate"))


def write_top_states(df: DataFrame, path: str, part: str, item: str, keys: Sequence[str], tracked: int = 1000) -> None:
    """Per ``part`` and ``keys``, a frequent-items sketch of ``item``; parts replace theirs at ``path``."""
    state = df.groupBy(part, *keys).agg(F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("state"), F.count(F.lit(1)).alias("n_rows"))
    write_table(state, "", path=path, partition_by=[part])


def top_over(states: DataFrame, keys: Sequence[str], tracked: int = 1000) -> DataFrame:
    """``(keys, top, top_count, n_rows)``: the most frequent item over all parts' states.

    Counts are exact while a key has fewer than ``tracked`` different items, else they are at most
    n_rows / (0.75 * ``tracked``) / 3.5 too high. Of equally frequent items the smallest is given.
    """
    both = states.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"), F.sum("n_rows").alias("n_rows"))
    top = both.withColumn("items", F.expr("approx_top_k_estimate(state, 20)"))
    best = F.array_max(F.col("items")["count"])
    item = F.array_min(F.transform(F.filter("items", lambda x: x["count"] == best), lambda x: x["item"]))
    return top.select(*keys, item.alias("top"), best.alias("top_count"), "n_rows")


def read_states(spark: SparkSession, path: str, first=None, last=None, part: str = "day") -> DataFrame:
    """The states from part ``first`` to ``last``, read from their partitions only."""
    states = spark.read.parquet(path)
    if first is not None:
        states = states.where(F.col(part) >= F.lit(first))
    return states if last is None else states.where(F.col(part) <= F.lit(last))
