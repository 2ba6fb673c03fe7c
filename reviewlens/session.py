"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. A cluster sets its own sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "reviewlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``DEFAULTS``; keyword ``spark_sql_x`` sets ``spark.sql.x``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings_of(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` of the session for as long as the block runs."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if root is None:
        root = sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reviewlens-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder. Every executor can reach it."""
    return f"{_shared_root(spark)}/reviewlens/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so later uses neither recompute nor reorder it."""
    _shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out to all cores: the checked queries read tables of one row group, which is one task otherwise."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def send_by_value(module: str) -> None:
    """Let the functions of ``module`` travel with a task, so workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
