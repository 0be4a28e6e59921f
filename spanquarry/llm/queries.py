"""Registered queries of the operators, each with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.llm import languages
from spanquarry.llm.decontaminate import contaminated_pairs
from spanquarry.llm.decontaminate import oracle as decontaminate_oracle
from spanquarry.llm.licenses import license_scan
from spanquarry.llm.near_dups import near_duplicates
from spanquarry.llm.neighbours import nearest
from spanquarry.llm.packing import best_fit_pack
from spanquarry.llm.pages import extract_text
from spanquarry.llm.prefix_trie import oracle as trie_oracle
from spanquarry.llm.prefix_trie import trie_report
from spanquarry.llm.simhash import simhash_classes
from spanquarry.llm.structure import oracle as repair_oracle
from spanquarry.llm.structure import repair_report
from spanquarry.llm.substrings import drop_repeats
from spanquarry.llm.tables import shared_folder
from spanquarry.llm.token_counts import token_counts
from spanquarry.llm.token_files import read_token_files, token_digest, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[job.__name__] = job
    return job


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op2_best_fit_packing(spark, sf_dir):
    return best_fit_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_token_files(spark, sf_dir):
    path = shared_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_digest(read_token_files(spark, path))


@query
def op10_substring_dedup(spark, sf_dir):
    out = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op1_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_decontaminate(spark, sf_dir):
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


ORACLES["op5_decontaminate"] = decontaminate_oracle()


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", languages.held_out().alias("held_out"))
    model = languages.fit(docs.where("NOT held_out").select("text", "lang"))
    return languages.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op3_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op7_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_license_scan(spark, sf_dir):
    """Documents as files of their source: two levels of directories, every twentieth document a licence file of the upper one."""
    docs = table(spark, sf_dir, "documents")
    upper = F.concat(F.lit("d"), (F.col("doc_id") % 7).cast("string"))
    name = F.when(F.col("doc_id") % 20 == 0, F.concat(F.lit("LICENSE."), "doc_id")).otherwise(
        F.concat(F.lit("e"), (F.col("doc_id") % 13).cast("string"), F.lit("/"), "doc_id", F.lit(".txt"))
    )
    return license_scan(docs.select("doc_id", F.concat_ws("/", "source", upper, name).alias("path"), "text"))


@query
def op6_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op11_simhash_dedup(spark, sf_dir):
    return simhash_classes(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark, sf_dir):
    return trie_report(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = trie_oracle()


@query
def op13_structure_repair(spark, sf_dir):
    return repair_report(table(spark, sf_dir, "conversations"))


ORACLES["op13_structure_repair"] = repair_oracle()
