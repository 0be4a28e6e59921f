"""Reliable lineage cuts for iterative jobs."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that all executors share; only a local session may do without the setting and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="spanquarry-ckpt-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder named by ``spark.checkpoint.dir``.

    The files outlive any executor, so a lost one costs a re-read, not a recomputation of every
    earlier round. A temporary folder is used only when neither the setting nor
    ``setCheckpointDir`` names one, as in local tests.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(spark))
    return df.checkpoint(eager=True)
