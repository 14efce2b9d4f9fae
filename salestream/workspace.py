"""Where intermediate tables and stream checkpoints may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    path of one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.conf.get("spark.app.id")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="salestream-")
    return _local_folders[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
