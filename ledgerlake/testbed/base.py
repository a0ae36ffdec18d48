"""Shared conventions for the stand-in queries."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources.tables import read_source

# Fixed conventions of the stand-in mapping.
AS_OF = dt.date(2001, 8, 2)  # day after the last order date
CAL_START = dt.date(1995, 1, 1)  # a Sunday; calendar of 8 retail years
CAL_YEARS = 8
ZONE = "Europe/London"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table."""
    return read_source(spark, sf_dir, name)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a job's own tables, in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "ledgerlake-scratch", f"{name}-{uuid.uuid4().hex}")


def registry():
    """Decorator pair: ``@q(key, sql)`` registers a Spark builder and its oracle SQL."""
    queries: dict = {}
    oracle: dict = {}

    def q(key: str, sql: str | None = None):
        def deco(fn):
            queries[key] = fn
            if sql is not None:
                oracle[key] = sql.strip()
            return fn

        return deco

    return queries, oracle, q
