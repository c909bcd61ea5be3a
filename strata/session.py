"""Session construction and the shared scratch location.

Intermediate tables and lineage cuts go under the shared folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent (local
tests) is a private temporary folder chosen and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "strata", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a private one only if unset and all is local."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    if not base:
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for one run's intermediate tables."""
    return f"{shared_dir(spark)}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(root: str, layer: str, name: str) -> str:
    return os.path.join(root, layer, name) if "://" not in root else f"{root.rstrip('/')}/{layer}/{name}"
