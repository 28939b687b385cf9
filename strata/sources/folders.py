"""Where jobs may put files, and how."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_KEY = "spark.checkpoint.dir"

# Digests are half a row's bytes as text; this codec takes each digit's spare half away.
CODEC = {"compression": "zstd"}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a session that runs in one local process may do without that setting.
    """
    base = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"
