"""Session and scratch-space helpers.

Library code never builds a session itself: every operator receives
DataFrames.  ``local_session`` exists for tests, the bench and the entry
module; ``scratch_dir`` resolves the shared folder used for intermediate
tables (CSV landings, checkpoints).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every paylake session wants: UTC wall clock, AQE with skew-join
# splitting and partition coalescing, no web UI.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "paylake") -> SparkSession:
    """A local-mode session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("PAYLAKE_DRIVER_MEMORY", "16g")))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would not be
    visible to other executors).  In local mode, when it is unset, a fresh
    temporary folder is created and registered.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; paylake needs a shared "
                               "folder for intermediate tables on a cluster")
        root = tempfile.mkdtemp(prefix="paylake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one write."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/paylake/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
