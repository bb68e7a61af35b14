"""Shared scratch space for lineage cuts and intermediate tables.

On a cluster the shared folder is whatever `spark.checkpoint.dir` names; it is
read from the session and never replaced. Only when it is unset (local runs,
tests) is a private folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a local-mode session (tests, a laptop) may get a fresh temporary
    folder when none is configured; on a cluster a machine-local folder would
    be invisible to the other executors, so that is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        # The conf is fixed once the context runs; the context's own
        # checkpoint folder can still be set, and is what later calls read.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logsieve-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the checkpoint root."""
    return f"{checkpoint_root(spark)}/logsieve/{name}-{uuid.uuid4().hex[:12]}"
