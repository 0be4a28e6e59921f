"""Table-level rules: tenant scope, incremental pulls, retention, append-once writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each entity's own change-time column.
CHANGE_COLUMN = {"traces": "createdAt", "signals": "lastSeenAt"}


def tenant_scope(df: DataFrame, project_id: str) -> DataFrame:
    """Every read is limited to one project; tables are partitioned by it first."""
    return df.where(F.col("project_id") == project_id)


def incremental_since(df: DataFrame, ts_column: str, since: str) -> DataFrame:
    return df.where(F.col(ts_column) >= F.lit(since).cast("timestamp"))


def half_open_window(df: DataFrame, ts_column: str, since: str, until: str, keep_null: bool = False) -> DataFrame:
    """``[since, until)``; one source lets rows without a time pass."""
    ts = F.col(ts_column)
    inside = (ts >= F.lit(since).cast("timestamp")) & (ts < F.lit(until).cast("timestamp"))
    return df.where(inside | ts.isNull()) if keep_null else df.where(inside)


def retention(df: DataFrame, ts_column: str, now: str, days: int = 30) -> DataFrame:
    return df.where(F.col(ts_column) >= F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(days)))


def export_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """``entity, n_rows, path`` with one metadata-light count per table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("entity"), "n_rows", F.lit(f"{name}.ndjson").alias("path")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ingest_dedupe(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows with a ``deduped`` flag: already stored, or a repeat within the batch.

    The first of a batch's repeats by ``arrival`` is the one stored. ``min_by`` style reduction is not
    needed: the winner is the minimum arrival per key, found by a map-side combined aggregate, so a
    key repeated a million times does not gather in one task.
    """
    first = incoming.groupBy(*keys).agg(F.min("arrival").alias("__first"))
    known = existing.select(*keys).distinct().withColumn("__known", F.lit(True))
    flagged = incoming.join(first, keys).join(known, keys, "left")
    repeat = F.col("__known").isNotNull() | (F.col("arrival") > F.col("__first"))
    return flagged.select(*incoming.columns, repeat.alias("deduped"))


def append_results(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Label each row of a result batch ``accepted``, ``duplicate`` or ``invalid``.

    Duplicate: its idempotency key is stored, or a row of the batch with a lower ``arrival`` has it.
    Invalid: blank output without an error.
    """
    invalid = (F.trim(F.coalesce("output", F.lit(""))) == "") & F.col("error").isNull()
    first = batch.where(~invalid).groupBy("idempotency_key").agg(F.min("arrival").alias("__first"))
    known = stored.select("idempotency_key").distinct().withColumn("__known", F.lit(True))
    joined = batch.join(known, "idempotency_key", "left").join(first, "idempotency_key", "left")
    outcome = (
        F.when(F.col("__known").isNotNull(), "duplicate")
        .when(invalid, "invalid")
        .when(F.col("arrival") > F.col("__first"), "duplicate")
        .otherwise("accepted")
    )
    return joined.select(*batch.columns, outcome.alias("outcome"))


def valid_split(df: DataFrame, is_valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the check and rows that do not (null counts as not)."""
    ok = F.coalesce(is_valid, F.lit(False))
    return df.where(ok), df.where(~ok)
