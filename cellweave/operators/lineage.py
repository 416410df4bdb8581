"""Cutting lineage through tables written to the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders of a running application, by its id.
_OWNED: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named for checkpoints; there is no other place all executors are known to share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named


def owned_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder; drop_stages removes it."""
    app = spark.sparkContext.applicationId
    if app not in _OWNED:
        _OWNED[app] = f"{shared_folder(spark).rstrip('/')}/cellweave-{uuid.uuid4().hex}"
    return _OWNED[app]


def drop_stages(spark: SparkSession) -> None:
    """Remove every table stored so far; results that still read one have to be written before."""
    folder = _OWNED.pop(spark.sparkContext.applicationId, None)
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute the table once, write it, and go on from the files.

    Losing executors loses nothing that was written, later passes read only the columns
    they need, and the files' size tells the planner which side of a join is small.
    """
    path = f"{owned_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.is_stage = True
    return stored


def stage(df: DataFrame) -> DataFrame:
    """The table itself if it is a stored one, else stored now."""
    return df if getattr(df, "is_stage", False) else materialize(df)
