"""Session, shared folder and table helpers used by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on and the zone pinned to UTC."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would be lost with
    its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return named or sc.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new, empty path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    A lost executor then loses nothing, and the planner knows the real size of the result, so
    that a small one is broadcast and a large one is not.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast only if the planner's estimate of ``df`` is at most ``max_bytes``.

    The estimate comes from file sizes, so no job runs. A larger side, or one of unknown size, is
    returned without the hint; adaptive execution then joins it by its real size.
    """
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(estimate)) <= max_bytes else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
