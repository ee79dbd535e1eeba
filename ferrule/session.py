"""Session construction and the shared scratch location.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``.  A private folder is only created when the setting
is absent and the master is local (tests, laptops).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults that matter for correctness (UTC dates) and for scale
# (AQE coalescing, skew-join splitting, runtime broadcast conversion).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ferrule", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir``; when it is unset and the master is local,
    a private folder is created and registered (tests only).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="ferrule-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}ferrule/{name}-{uuid.uuid4().hex[:12]}"
