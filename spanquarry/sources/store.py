"""A table of rows by UTC day: days are written, replaced, pruned and dropped as whole partitions.

The ``day`` folder is derived from the row's own time, so a row that is delivered again meets its earlier copy in the same day. A row
without a time is kept in a day of its own (null). Every writer may be run again: replaced days are staged and swapped at the job's
commit, appended rows are recognised by their key.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.lineage import cut_lineage
from spanquarry.sources.tables import append_results

DAY = "day"
#: Folder of the rows without a time.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
DAY_MICROS = 86_400_000_000


def day_of(ts: Column) -> Column:
    """UTC date of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / DAY_MICROS).cast("int"))


def _folder(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _by_day(df: DataFrame):
    # files of a day get a common size: small days are merged, a hot day is split
    return df.hint("rebalance", DAY).write.partitionBy(DAY)


def replace_days(df: DataFrame, folder: str, ts: str) -> None:
    """Write rows so that they are all of their days; other days stay as they are."""
    _by_day(df.withColumn(DAY, day_of(F.col(ts)))).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


def read_days(spark: SparkSession, folder: str, ts: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of ``[since, until)`` with their day; days outside are not listed as input files at all.

    Without bounds every row is read, those without a time too.
    """
    df = spark.read.option("basePath", folder).parquet(folder)
    for bound, after in ((since, True), (until, False)):
        if bound is not None:
            at = F.lit(bound).cast("timestamp")
            df = df.where((F.col(DAY) >= day_of(at)) & (F.col(ts) >= at) if after else (F.col(DAY) <= day_of(at)) & (F.col(ts) < at))
    return df


def retained(spark: SparkSession, folder: str, ts: str, now: str, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` times 24 hours, exact to the instant whether or not :func:`expire` has run."""
    oldest = F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    return read_days(spark, folder, ts).where((F.col(DAY) >= day_of(oldest)) & (F.col(ts) >= oldest))


def stored_days(spark: SparkSession, folder: str) -> list[str]:
    """Days that the table has, ascending, from folder names alone."""
    path, there = _folder(spark, folder)
    if not there.exists(path):
        return []
    names = [x.getPath().getName() for x in there.listStatus(path)]
    return sorted(n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}=") and n != f"{DAY}={NO_DAY}")


def expire(spark: SparkSession, folder: str, now: str, days: int = 30) -> list[str]:
    """Drop the days that end before the retention begins and return them.

    No file is read or rewritten. The day in which the retention begins stays until it is over, and so do rows without a time.
    """
    first = (datetime.fromisoformat(now) - timedelta(days=days)).date().isoformat()
    gone = [d for d in stored_days(spark, folder) if d < first]
    path, there = _folder(spark, folder)
    for d in gone:
        there.delete(path.suffix(f"/{DAY}={d}"), True)
    return gone


def append_batch(spark: SparkSession, batch: DataFrame, folder: str, ts: str) -> dict[str, int]:
    """Append the accepted rows of a batch of results and count ``accepted``, ``duplicate`` and ``invalid``.

    ``batch`` has ``idempotency_key``, ``arrival``, ``output``, ``error`` and the time; see :func:`append_results`. Only the keys of the batch's
    own days are read: a result keeps its time when it is delivered again.
    """
    rows = batch.withColumn(DAY, day_of(F.col(ts)))
    path, there = _folder(spark, folder)
    if stored_days(spark, folder) or there.exists(path.suffix(f"/{DAY}={NO_DAY}")):
        old = read_days(spark, folder, ts).select(DAY, "idempotency_key")
        days = rows.select(F.col(DAY).alias("touched")).distinct()
        known = old.join(days, F.equal_null(DAY, "touched"), "left_semi").select("idempotency_key")
    else:
        known = rows.select("idempotency_key").where("false")
    # labelled once: the counts and the appended rows are read from the same checkpoint
    labelled = cut_lineage(append_results(known, rows))
    _by_day(labelled.where("outcome = 'accepted'").drop("outcome")).mode("append").parquet(folder)
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in ("accepted", "duplicate", "invalid")]
    return labelled.agg(*counts).first().asDict()
