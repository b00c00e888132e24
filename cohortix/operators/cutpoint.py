"""Cut points: a result is written to the cluster's checkpoint folder as Parquet and its lineage ends there.

What is read back is a columnar scan that knows its size, so later joins are planned on what is there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a single machine without that setting has one of its own."""
    sc = spark.sparkContext
    said = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if said is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        said = "file://" + tempfile.mkdtemp(prefix="spark-cohortix-")
        sc.setCheckpointDir(said)
    return said


def cut(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/cohortix-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
