"""Where jobs keep state that several executors must see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Where the session names no such folder a temporary one is made, but only for a local
    master: on a cluster a machine-local folder would be invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clusterkit-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
