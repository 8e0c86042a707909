"""Session and scratch-location helpers.

Durable intermediate data (stream checkpoints, landed files, upsert tables)
lives under the shared folder the cluster names in ``spark.checkpoint.dir``.
We only pick our own folder when the session leaves that setting unset, which
happens in local tests.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tickerlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names. A local session
    without one gets a folder of this machine; a cluster has to name it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder under the shared checkpoint root, as the
    session names it; what writes there makes it, through its file system."""
    root = checkpoint_root(spark)
    return f"{root}/tickerlens/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Set session settings for the duration of a block, then restore them.

    A streaming query clones the session when it starts, so settings in force
    at ``start()`` (for example the number of state partitions, which the
    checkpoint then keeps) apply to that query only."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            if v is not None:
                spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_stream(writer, spark: SparkSession, state_partitions: int | None, conf: dict | None = None):
    """``writer.start()`` with the stream's shuffle/state partition count, and
    further settings of this query alone."""
    with session_conf(spark, {"spark.sql.shuffle.partitions": state_partitions, **(conf or {})}):
        return writer.start()
