"""Session settings the jobs rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Only settings that change results or plans; sizes stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put the settings on a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``.  Without the
    setting a local session gets a temporary folder of its own; on a cluster
    that would be another folder on each machine, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tallyrisk-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
