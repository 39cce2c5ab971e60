"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tablesync", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` adds to or replaces them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Call-site capture costs several JVM round trips for every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and working tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder. A cluster
    without it is an error, because a machine-local folder would lose the data
    together with the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if context.getCheckpointDir() is not None:
            return context.getCheckpointDir()
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tablesync-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the working folder."""
    return f"{work_dir(spark).rstrip('/')}/tablesync/{label}-{uuid.uuid4().hex}"
