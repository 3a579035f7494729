"""Session defaults and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

# Semantics the operators rely on, plus adaptive execution. Sizing settings
# (cores, memory, partition counts) belong to the cluster and are not set here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "quayside", master: str | None = None, **conf: str
) -> SparkSession:
    """Create or get a session; keys in `conf` use `__` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that `spark.checkpoint.dir` names.

    On a cluster that folder is shared by all executors. Where the setting is absent a local
    folder is made, but only under a `local` master: elsewhere each executor would write to
    a disk of its own, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder under master {master}")
        root = tempfile.mkdtemp(prefix="quayside-")
    return f"{root.rstrip('/')}/{label}-{uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch copy that nothing reads any more, on whichever store holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
