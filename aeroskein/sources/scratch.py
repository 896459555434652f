"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders by application, for sessions that name no shared folder.
_OWN: dict[str, str] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path under spark.checkpoint.dir; only where a local session has none, in a temporary folder of this machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        name = spark.sparkContext.applicationId
        root = _OWN[name] = _OWN.get(name) or "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """`df` written to the shared folder and read back: what uses it more than once doesn't make it again."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
