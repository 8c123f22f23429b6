"""Limits that decide when a key is split and when a side may be broadcast.

All are session settings, so a job can change them with ``spark.conf.set``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: rows of one key that a single task may hold before the key is cut into blocks
BLOCK_ROWS = ("quern.block.rows", 2_000_000)
#: rows and bytes of a dimension that may be broadcast
BROADCAST_ROWS = ("quern.broadcast.rows", 500_000)
BROADCAST_BYTES = ("quern.broadcast.bytes", 128 * 1024 * 1024)


def limit(spark: SparkSession, setting: tuple[str, int]) -> int:
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="quern-checkpoint-")
    context.setCheckpointDir(shared)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
