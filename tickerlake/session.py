"""Session construction and the shared scratch folder.

Scratch tables (intermediate results whose lineage must be cut, test tables
written by registered queries) live under the cluster's shared checkpoint
folder, read from ``spark.checkpoint.dir``. Only when that setting is absent
on a local master (tests) is a local folder chosen and set.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Landings and date-partitioned tables hold a folder a day. Spark lists many
    # folders in a job of up to 10,000 tasks, one a folder; fewer tasks list a batch each.
    LISTING_PARALLELISM: "64",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tickerlake",
    shuffle_partitions: int | None = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on, UTC clock, no UI. For tests, bench and scripts."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if master.startswith("local"):
        # Local disk only: Hadoop's checksummed local filesystem writes a .crc
        # twin per file and, without native libraries, forks a chmod per file
        # and folder. Skipping the twins and spawning with vfork cuts the cost
        # of writing thousands of date partitions by about a third. Cluster
        # filesystems (HDFS, object stores) are not affected.
        conf["spark.hadoop.fs.file.impl"] = "org.apache.hadoop.fs.RawLocalFileSystem"
        conf["spark.driver.extraJavaOptions"] = "-Djdk.lang.Process.launchMechanism=VFORK"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, from ``spark.checkpoint.dir``.

    Only a local master, whose tasks share the driver's disk, gets a folder
    of its own when none is named; on a cluster that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickerlake-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        # DataFrame.checkpoint() must land in the same shared folder.
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique (not yet existing) folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tickerlake/{name}-{uuid.uuid4().hex[:12]}"
