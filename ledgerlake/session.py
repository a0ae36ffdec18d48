"""Session construction and lineage helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Runtime SQL settings only; cluster sizing
# (executors, memory) belongs to whoever submits the job.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's SQL defaults.

    ``master`` is only for local runs and tests; on a cluster leave it unset so
    the submitter's settings apply. The Spark UI is kept off.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only when unset.

    The fallback (a fresh temporary folder, removed when Python exits) is only taken
    with a ``local`` master, for tests; on a cluster an unset ``spark.checkpoint.dir`` is an error, since it
    must name a shared filesystem.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(a machine-local folder does not survive executor loss)"
            )
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and return the re-read frame.

    Used between incremental merge rounds so plans do not grow without bound and
    a lost executor does not force recomputation from the first batch.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: dict[SparkSession, tuple[int, str | None]] = {}
_writing_lock = threading.Lock()


@contextmanager
def own_shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write in here removes the files of its own shuffles when it is done, not when the driver happens to
    collect its garbage. May be open several times side by side; the last one puts the setting back."""
    with _writing_lock:
        users, before = _writing.get(spark, (0, None))
        if not users:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writing[spark] = (users + 1, before)
    try:
        yield
    finally:
        with _writing_lock:
            users, before = _writing.pop(spark)
            if users > 1:
                _writing[spark] = (users - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    try:
        return int(spark.conf.get(key, str(default)))
    except (TypeError, ValueError):
        return default


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the session (falls back to the shuffle partition setting)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext access in this session
        return conf_int(spark, "spark.sql.shuffle.partitions", 8)
