"""Folds over rows that Spark has sorted by key: one key after another streams through a task, none is held whole."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def joined_sha256(rows: DataFrame, key: str, order: list[str], value: str, separator: str) -> DataFrame:
    """``key`` and sha256: lowercase digest of the key's values (strings, not null) in ``order``, joined by ``separator``.

    The key may be null; keys without rows are absent (their digest is EMPTY_SHA256). Rows equal in ``order`` come in any order.
    """
    kind = rows.schema[key].dataType.simpleString()
    between = separator.encode()

    def fold(batches):
        held, digest = None, None
        for batch in batches:
            keys, out = batch.column(key), []
            schema = pa.schema([(key, keys.type), ("sha256", pa.string())])
            for k, v in zip(keys.to_pylist(), batch.column(value).to_pylist()):
                if digest is None or k != held:
                    if digest:
                        out.append((held, digest.hexdigest()))
                    held, digest = k, hashlib.sha256()
                else:
                    digest.update(between)
                digest.update(v.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema=schema)
        if digest:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (held, digest.hexdigest())))], schema=schema)

    ordered = rows.select(key, *order, value).repartition(key).sortWithinPartitions(key, *order)
    return ordered.select(key, value).mapInArrow(fold, f"{key} {kind}, sha256 string")


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string in DuckDB: each character is one step of its code and eight of -1, a shift by one bit."""
    return (
        f"(xor(list_reduce(flatten(list_transform(range(1, length({text}) + 1), "
        f"lambda i: [ascii(({text})[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), "
        "lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END, 4294967295::BIGINT), 4294967295))"
    )
