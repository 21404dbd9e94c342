"""Reading named tables and writing intermediates into the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input; Python workers find this package where the driver did, unless they have it installed."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder of this machine where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="sigloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again, so that later plans start from files."""
    path = f"{shared_dir(df.sparkSession)}/sigloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
