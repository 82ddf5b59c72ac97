"""Tables between jobs, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_dir(spark) -> str:
    """``spark.checkpoint.dir``, or a new folder of this machine where it is unset and Spark runs on this machine alone."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not given:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        given = tempfile.mkdtemp(prefix="tessera-")
        sc.setCheckpointDir(given)
    return given.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, so that its lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
