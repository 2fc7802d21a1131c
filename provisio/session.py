"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "provisio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # HotSpot interprets methods above 8000 bytes; Spark then generates smaller ones.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session that names none gets a temporary folder of this process.
    """
    global _fallback
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="provisio-")
    return _fallback


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call returned."""
    return f"{shared_folder(spark)}/provisio/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Rows that come from a join or costly expressions and that several passes read: computed once, then read back."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints (iterative learners cut lineage there) at the shared folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(os.path.join(shared_folder(spark), "provisio-checkpoints"))
