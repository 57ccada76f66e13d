"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import SparkSession


#: Names the shared folder for sessions that were started without ``spark.checkpoint.dir``.
SCRATCH = "mixlens.scratch.dir"


def build_session(
    app_name: str = "mixlens", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` adds to them or overrides them.

    Skewed joins are split and small shuffle partitions merged by adaptive
    execution. No broadcast threshold is raised: Spark compares every join side
    with ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge
    join beyond it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint directory.

    Every executor has to reach it, so there is no fallback to a local folder:
    the session names one in ``spark.checkpoint.dir``. Its owner clears it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
    return f"{root.rstrip('/')}/mixlens-{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now; it does so when its driver collects garbage.

    The first round frees what Python still held of them on the driver, the
    second one finds it gone.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
