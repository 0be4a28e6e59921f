"""Newline-delimited JSON: scans with a fixed schema, dumps with counts, wire payloads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WIRE = (
    "name STRING, input STRING, output STRING, latency_ms BIGINT, error STRING, framework STRING, model STRING, "
    "tool_calls ARRAY<STRUCT<name: STRING, input: STRING, output: STRING, latency_ms: BIGINT, success: BOOLEAN, error: STRING, served: BOOLEAN, used: BOOLEAN>>, "
    "metadata STRING, session_id STRING, input_tokens BIGINT, output_tokens BIGINT, cache_read_tokens BIGINT, cache_write_tokens BIGINT, "
    "monitor BOOLEAN, pattern_ids ARRAY<STRING>, span_id STRING, parent_span_id STRING, started_at_unix_nano STRING, agent_id STRING, "
    "source STRING, span_kind STRING, performance_summary STRUCT<retrieval_steps: ARRAY<STRUCT<name: STRING, query: STRING, output: STRING, doc_count: BIGINT>>>"
)


def scan_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of one entity; blank lines are skipped, unreadable ones land in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record STRING").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def dump_ndjson(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write each table as NDJSON and a manifest with the rows written, counted while writing."""
    counts: dict[str, int] = {}
    spark = None
    for name, df in tables.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{folder}/{name}")
        counts[name] = seen.get["n"]
        spark = df.sparkSession
    if spark is not None:
        manifest = [json.dumps({"entity": n, "rows": c, "path": f"{n}"}) for n, c in counts.items()]
        spark.createDataFrame([(m,) for m in manifest], "value STRING").coalesce(1).write.mode("overwrite").text(f"{folder}/manifest")
    return counts


def wire_project(payload: Column) -> Column:
    """JSON payload to typed span columns; absent keys are null and a zero token count is absent."""
    return F.from_json(payload, WIRE)


def wire_spans(raw: DataFrame, payload: str = "value") -> DataFrame:
    spans = raw.select(wire_project(F.col(payload)).alias("w")).select("w.*")
    for c in ("input_tokens", "output_tokens", "cache_read_tokens", "cache_write_tokens"):
        spans = spans.withColumn(c, F.nullif(F.col(c), F.lit(0)))
    nanos = F.col("started_at_unix_nano").try_cast("bigint")
    return spans.withColumn("started_at", F.timestamp_micros(F.floor(nanos / 1000).cast("bigint")))


DATASET_FIELDS = (
    "description", "questions", "number_of_requests", "acceptance_criteria", "judge_prompt", "judge_model",
    "jaccard", "bleu", "rouge", "cosine", "models", "models_enabled",
)


def dataset_copy(source: DataFrame, new_id: Column, name: str | None = None) -> DataFrame:
    """Copy of an exported dataset: allow-listed fields under a fresh id, renamed if asked."""
    kept = [F.col(c) for c in DATASET_FIELDS if c in source.columns]
    return source.select(new_id.alias("dataset_id"), (F.lit(name) if name else F.col("name")).alias("name"), *kept)
