"""Where queries that must write something put it: the cluster's shared folder."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can see, private to this application.

    It lies below ``spark.checkpoint.dir``, or the session's warehouse where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/pairloom/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, scope: str) -> tuple[str, str]:
    """``(database name, folder)`` for one scope, such as one input directory."""
    tag = hashlib.md5(scope.encode()).hexdigest()[:8]
    app = re.sub(r"\W", "_", spark.sparkContext.applicationId)
    return f"pairloom_{app}_{tag}", f"{shared_dir(spark)}/{tag}"
