"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; fall back to a local one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="duskwatch-checkpoint-")
    sc.setCheckpointDir(named)


# Folders of ``checkpointed`` tables, in order of their making.
_made: list[str] = []


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder: it survives lost executors, is read by column,
    and its size is known to the plans that join it.
    """
    path = shared_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    _made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stages_made() -> int:
    return len(_made)


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_stages(spark: SparkSession, since: int) -> None:
    """Remove the tables of ``checkpointed`` made since ``stages_made`` told so many; nothing may read them any more."""
    for path in _made[since:]:
        remove_folder(spark, path)
    del _made[since:]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"
