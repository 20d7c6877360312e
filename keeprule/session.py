"""Session settings and the shared folder for files written between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "keeprule", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the jobs are written for.

    The number of shuffle partitions is left to the cluster; adaptive execution
    joins small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; on a
    cluster that would be a different disk on every machine, so it is refused.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="keeprule-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/keeprule/{name}-{uuid.uuid4().hex}"
