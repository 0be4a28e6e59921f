"""From raw documents to packed training sequences: five stages, each over everything that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.llm import languages
from spanquarry.llm.decontaminate import drop_contaminated
from spanquarry.llm.near_dups import near_duplicates
from spanquarry.llm.packing import best_fit_pack
from spanquarry.llm.substrings import drop_repeats
from spanquarry.llm.tables import stored

#: Share of a document's letters that its language must have.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those in which no language holds half of the letters.

    The model is fitted on the labelled documents that are not held out; without any only the letters count.
    """
    model = languages.fit(docs.where(~languages.held_out()).select("text", "lang"))
    if not model.languages:
        return docs.where(F.rlike(F.coalesce("text", F.lit("")), F.lit(r"\p{L}")))
    found = languages.predict(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id in each class; a null doc_id stays."""
    leave = near_duplicates(docs).where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(leave.hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)


def drop_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove windows of 20 words that also start earlier, and documents of which nothing is left."""
    out = drop_repeats(docs).where("n_removed < n_words OR n_words = 0")
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_items=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_substrings),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenising, sampling and packing cannot be said in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
