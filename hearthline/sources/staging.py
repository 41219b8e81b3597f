"""Rows written once to the shared folder, so that what reads them twice does not make them twice."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where that is unset and the driver is also the only executor."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not getattr(shared_dir, "own", None):
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="hearthline-")
    return shared_dir.own


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/hearthline/{label}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back: cuts the lineage and survives lost executors. The write's
    shuffle files, which nothing reads after it, are freed at its end, not when the driver next collects garbage."""
    path = new_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
