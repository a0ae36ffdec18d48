"""Set operations over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``UNION ALL`` over any number of frames, matched by column name."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION`` (distinct rows)."""
    return union_all(frames).distinct()


def tag_union(tagged: Mapping[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """Union frames adding a constant column that names where each row came from."""
    return union_all([df.withColumn(tag_col, F.lit(tag)) for tag, df in tagged.items()])
