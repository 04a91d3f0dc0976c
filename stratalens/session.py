"""Cutting lineage through the shared checkpoint folder, and the limit for broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BROADCAST_ROW_LIMIT = 200_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, as
    in tests, gets a folder of its own when nothing is configured.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stratalens-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table in the checkpoint folder and read it from there.

    Used where a result is read by several later passes that must see the very
    same values (a repeated floating-point sum may differ in its last digit), and
    where a lost executor must not force the whole lineage to run again.  Passes
    read only the columns they need, and Spark knows the size of the table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
