"""Cutting lineage through the shared checkpoint folder of the session."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Without that setting a single-machine session gets a fresh local folder; any other master is refused, because its
    executors would not see one another's files.
    """
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return configured or current
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="varloom-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a columnar table in the shared folder: a lineage cut that later reads can prune."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/varloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
