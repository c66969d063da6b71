"""Session settings and the shared folder used for checkpoints and written scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    app: str = "slicewise", cores: str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own session."""
    return (
        SparkSession.builder.config(map=settings or {})
        .master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a fresh temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    already = context.getCheckpointDir()
    if already:
        return already
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="slicewise-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; two calls never return the same one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
