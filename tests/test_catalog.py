"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from catalog.base import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query(spark, duck, key):
    message, ok = check.compare(spark, duck, key, FOLDER)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert {"agent", "failure_rate", "tool_failure_rate", "p95_latency_ms"} <= set(df.columns)
    assert df.count() > 0


def test_batches_for_python_end_at_a_size(spark, tmp_path):
    import pandas as pd
    from pyspark.sql import functions as F

    from catalog.base import Tables

    spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4000).alias("text")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))

    def count(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)], "chars": [batch["text"].str.len().sum()]})

    sizes = Tables(spark, str(tmp_path)).documents.mapInPandas(count, "n BIGINT, chars BIGINT").toPandas()
    assert sizes["n"].sum() == 3000 and sizes["chars"].max() < 8 << 20
