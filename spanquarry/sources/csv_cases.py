"""Evaluation cases from CSV files and data frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.functions.normalize import nullish_text, split_semi
from spanquarry.operators.registry import missing_columns

LISTS = ("expected_capabilities", "expected_knowledge_base", "expected_delegations")


def _clean(df: DataFrame, nan_is_blank: bool) -> DataFrame:
    missing = missing_columns(df, {"query"})
    if missing:
        raise ValueError(f"missing required column(s): {missing}")
    query = F.trim(F.coalesce("query", F.lit("")))
    blank = (query == "") | (query == "nan") if nan_is_blank else query == ""
    has = set(df.columns)
    expected = F.col("expected_results") if "expected_results" in has else F.lit(None).cast("string")
    expected = nullish_text(expected) if nan_is_blank else F.nullif(F.trim(expected), F.lit(""))
    lists = [(split_semi(F.col(c)) if c in has else F.lit(None).cast("array<string>")).alias(c) for c in LISTS]
    rest = [c for c in df.columns if c not in ("query", "expected_results", *LISTS)]
    return df.select(*rest, query.alias("query"), expected.alias("expected_results"), *lists, blank.alias("rejected"))


def import_cases_df(df: DataFrame) -> DataFrame:
    """Cases of a data frame with a ``rejected`` flag; the text ``nan`` counts as a blank query."""
    return _clean(df, nan_is_blank=True)


def import_cases_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cases of CSV files with ``rejected`` and the record's line number, data starting at line 2.

    A multi-line file is read by one task in order, so a record's distance from the first id of its
    file is its position; the per-file minimum is one row per file.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    cases = _clean(raw.select("*", F.monotonically_increasing_id().alias("__id"), F.col("_metadata.file_path").alias("__file")), nan_is_blank=False)
    first = cases.groupBy("__file").agg(F.min("__id").alias("__first"))
    return cases.join(first, "__file").withColumn("line", F.col("__id") - F.col("__first") + 2).drop("__id", "__first", "__file")
