"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and Spark runs in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_dirs[app] = tempfile.mkdtemp(prefix="oslogs-")
    return _local_dirs[app]


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage through a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str, by: str) -> DataFrame:
    """``df`` as a table in the shared folder, in directories by one column; lost executors read it again."""
    path = f"{shared_dir(df.sparkSession)}/oslogs/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
