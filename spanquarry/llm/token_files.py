"""Token-id files: ORC with integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanquarry.llm.encoding import encoded
from spanquarry.llm.tables import batch_of

#: Layout of a token file: ``start`` counts ids from the first document of the file's ``part``.
LAYOUT = "doc_id bigint, part int, start bigint, ids array<int>"

#: Files whose bases are broadcast.
MOST_FILES = 1_000_000


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, stripe_mb: int = 16) -> None:
    """Encode every whole text, append ``end_id`` and write ORC files in ascending doc_id order.

    Documents are dealt by ranges of doc_id, so file n holds smaller ids than file n + 1 and each file is
    sorted. ORC stores the ids as run-length encoded integers; stripes and row indexes hold the range of
    doc_id, and Bloom filters on it let a look-up skip stripes and row groups. A stripe is the unit of a parallel read.

    Null text counts as empty; a null doc_id sorts first; rows of one doc_id stay in one file, in no fixed order.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches):
        part, done = TaskContext.get().partitionId(), 0
        for keys, values, ends in encoded(batches, tokenizer, end_id):
            starts = np.concatenate([[0], ends[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), pa.array(values.view(np.int32)))
            yield batch_of(schema, keys, [part] * len(keys), starts + done, lists)
            done += int(ends[-1])

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    dealt.mapInArrow(encode, LAYOUT).write.options(
        **{
            "compression": "zstd",
            "orc.stripe.size": str(stripe_mb << 20),
            "orc.row.index.stride": "10000",
            "orc.create.index": "true",
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": "0.01",
        }
    ).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents with their ids; ``start`` counts all ids of the documents before.

    One row per written file is summed in order (broadcast: a few bytes a file, at most ``MOST_FILES`` of them, else
    joined); each document adds its file's base to its own start.
    """
    files = spark.read.schema(LAYOUT).orc(path)
    sizes = files.groupBy("part").agg(F.sum(F.size("ids")).alias("held"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("held").over(order), F.lit(0)).alias("base"))
    if len(files.inputFiles()) <= MOST_FILES:
        base = F.broadcast(base)
    return files.join(base, "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "ids")


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), np.uint32)).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield batch_of(schema, batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)), crc)

    return tokens.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
