"""Tables that ``foreachBatch`` writes, one folder per epoch.

Every epoch is written whole and over itself, so a batch that is run again leaves the same files. A *version* table holds everything in each
epoch and is read from the latest; a *log* table holds what the epoch brought and is read from all. ``compact`` joins the old epochs of a
log into one and ``vacuum`` removes versions that a later one replaces; both may stop half-way and be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def epochs(spark: SparkSession, folder: str) -> list[int]:
    """Complete epochs, ascending: a folder whose job has not committed has no ``_SUCCESS``."""
    path, there = _files(spark, folder)
    if not there.exists(path):
        return []
    found = [x.getPath() for x in there.listStatus(path) if x.getPath().getName().startswith("epoch=")]
    done = [p for p in found if there.exists(p.suffix("/_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("epoch=")) for p in done)


def read(spark: SparkSession, folder: str, some: list[int]) -> DataFrame:
    """The rows of some epochs with their ``epoch``."""
    return spark.read.option("basePath", folder).parquet(*[f"{folder}/epoch={e}" for e in some]).withColumn("epoch", F.col("epoch").cast("bigint"))


def earlier(spark: SparkSession, folder: str, epoch: int) -> DataFrame | None:
    """All epochs before this one, or None."""
    before = [e for e in epochs(spark, folder) if e < epoch]
    return read(spark, folder, before) if before else None


def version_before(spark: SparkSession, folder: str, epoch: int) -> DataFrame | None:
    before = [e for e in epochs(spark, folder) if e < epoch]
    return read(spark, folder, before[-1:]).drop("epoch") if before else None


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, epochs(spark, folder)[-1:]).drop("epoch")


def _remove(spark: SparkSession, folder: str, some: list[int]) -> None:
    path, there = _files(spark, folder)
    for e in some:
        there.delete(path.suffix(f"/epoch={e}"), True)


def vacuum(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Remove versions but for the last ``keep``; two at least, as a batch that is run again builds on the one before it."""
    if keep < 2:
        raise ValueError("a stream that is run again needs the version before its last")
    gone = epochs(spark, folder)[:-keep]
    _remove(spark, folder, gone)
    return gone


def compact(spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame], keep: int = 2) -> int | None:
    """Join the epochs of a log but for the last ``keep`` into one, ``merge`` applied; returns its number.

    The joined epoch is built beside the others and takes the place of the newest of them. Between the two renames a reader may miss
    it; run it while no job reads the table, as with any rewrite of plain files.
    """
    if keep < 1:
        raise ValueError("the last epoch may be written again and has to stay")
    old = epochs(spark, folder)[:-keep]
    if len(old) < 2:
        return None
    path, there = _files(spark, folder)
    joined = path.suffix(f"/.joined-{old[-1]}")
    merge(read(spark, folder, old)).drop("epoch").write.mode("overwrite").parquet(str(joined.toString()))
    _remove(spark, folder, old)
    there.rename(joined, path.suffix(f"/epoch={old[-1]}"))
    return old[-1]
