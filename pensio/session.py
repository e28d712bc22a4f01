"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def session(app: str = "pensio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for.

    Partition counts are left to adaptive execution; the only sizes set are the ones that keep a task
    within executor memory. Anything passed in ``conf`` wins.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{k: str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _context_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder set on the context, if there is one."""
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    All folders of one application lie under its id, so they can be removed together once it has ended. There is no
    default: a folder of the driver's machine would not be seen by executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_dir(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{root.rstrip('/')}/pensio-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
