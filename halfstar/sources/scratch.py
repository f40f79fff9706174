"""Folders for intermediate tables that every executor can reach."""

import os
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A session on one machine (tests) that names neither works below its warehouse folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if not shared and spark.conf.get("spark.master", "").startswith("local["):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        shared = "file://" + os.path.join(os.path.abspath(warehouse), "scratch")
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return shared.rstrip("/")


def new_scratch_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """Name an unused folder below ``root`` or the session's shared folder.

    All folders of an application lie in one named after it; that application owns
    them, and whoever runs it removes ``halfstar-<application id>`` once it has ended.
    """
    owner = f"halfstar-{spark.sparkContext.applicationId}"
    return f"{(root or scratch_root(spark)).rstrip('/')}/{owner}/{label}-{uuid.uuid4().hex}"
