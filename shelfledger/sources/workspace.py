"""Shared working folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Whoever runs the jobs removes what lies there after a run; nothing is read from it again.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several others build on, and go on from the written table.

    It is computed once, its lineage ends there, and Spark knows its true size.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
