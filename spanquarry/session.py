"""Session settings the jobs are written for. Library code never creates a session itself."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE splits a hot probe-side partition even when the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of one session merge within each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Processors with state and timers need it.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A union whose sides were dealt by one key is dealt again: adaptive reads may have regrouped one side alone.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python end at so many bytes as well as at 10,000 rows, so a worker's memory does not grow with the length of the texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # Telemetry timestamps are UTC instants, so un-annotated Parquet times are read as TIMESTAMP.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}


def build_session(master: str | None = None, name: str = "spanquarry", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
