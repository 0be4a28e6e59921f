"""Registration of queries and the derived telemetry views they read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanquarry.session import SETTINGS

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

VIEWS: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    """Declare a derived table in SQL both engines read; ``{name}`` refers to tables and views."""
    VIEWS[name] = sql


def _references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Lazy access to the Parquet tables of one folder and to the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._made = spark, folder, {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
        spark.conf.set(BATCH_BYTES, SETTINGS[BATCH_BYTES])

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in VIEWS:
                self._made[name] = self.sql(VIEWS[name])
            elif name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{r: getattr(self, r) for r in _references(text)})


def duck_sql(text: str) -> str:
    """The query text with the views it needs put in front as common table expressions."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in _references(sql):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                ordered.append(name)

    need(text)
    plain = {name: name for name in (*TABLES, *VIEWS)}
    heads = [f"{n} AS MATERIALIZED ({VIEWS[n].format(**plain)})" for n in ordered]
    body = text.format(**plain)
    if not heads:
        return body
    recursive = body.lstrip().upper().startswith("WITH RECURSIVE")
    rest = re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", "", body, flags=re.I)
    joined = ", ".join(heads)
    lead = "WITH RECURSIVE " if recursive else "WITH "
    return f"{lead}{joined}, {rest}" if rest != body else f"{lead}{joined} {body}"


def query(key: str, sql: str | None = None) -> Callable:
    def register(job: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[key] = lambda spark, folder: job(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return job

    return register
