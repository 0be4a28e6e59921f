"""SimHash classes by anchor-point covering.

Bits 0 to 22 and 23 to 45 of a fingerprint are each covered by the perfect binary code of 23 bits, 12 of them free: every word
lies within RADIUS of exactly one codeword. A pair of codewords is an *anchor*; that nearest to both parts
is a fingerprint's home. Every fingerprint is sent to its home and, as a visitor, to each anchor that lies within the radius
plus its share of the threshold in both parts. Two fingerprints that differ in at most the threshold therefore meet at
the home of either, and only homes are compared with visitors there, on all 64 bits.

Equal fingerprints are one row before they are sent. An anchor at home for more than ``BLOCK`` fingerprints is dealt into blocks
of homes and of visitors, and each cell gives one link from a member to the first member of its local component,
not its pairs.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.near_dups import components
from spanquarry.llm.tables import batch_of, stored
from spanquarry.llm.words import mix, parts

SHINGLE, SEED = 3, 42
#: Fixed values of the perfect code: bits, check bits, covering radius, generator polynomial.
BITS, CHECKS, RADIUS, GENERATOR = 23, 11, 3, 0xC75
#: Homes of one anchor before it is dealt into blocks, and slots of the table (at most so many rows) that says into how many.
BLOCK, SLOTS = 4096, 1 << 16
#: Comparisons held at once.
STEP = 1 << 22
#: Bytes of a text beyond which its words are read in portions.
LONG = 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_U = np.uint64


def shingle_hashes(text: bytes):
    """Arrays of the hashes of a text's shingles, in portions."""
    text = text.translate(_LOWER)
    words = iter(text.split()) if len(text) <= LONG else (m[0] for m in _WORD.finditer(text))
    held = list(islice(words, SHINGLE - 1))
    digest = xxhash.xxh64_intdigest
    begun = False
    while some := list(islice(words, LONG)):
        held += some
        yield np.array([digest(b" ".join(t), SEED) for t in zip(held, held[1:], held[2:])], _U)
        held, begun = held[1 - SHINGLE :], True
    if held and not begun:
        yield np.array([digest(b" ".join(held), SEED)], _U)


def bit_counts(hashes: list[np.ndarray]) -> np.ndarray:
    """How often each bit is set in each array of hashes (none empty)."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    blocks = -(-sizes // 255)  # a byte lane counts so far
    rows = np.cumsum(blocks) - blocks
    within = np.arange(int(blocks.sum())) - np.repeat(rows, blocks)
    begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + 255 * within
    out, every = np.empty((len(sizes), 8, 8), np.int64), np.concatenate(hashes)
    for j in range(8):
        lanes = np.add.reduceat((every >> _U(j)) & _U(0x0101010101010101), begin).view(np.uint8).reshape(-1, 8)
        out[:, :, j] = np.add.reduceat(lanes, rows, axis=0, dtype=np.int64)
    return out.reshape(-1, 64)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """Bits set in over half of the hashes of each (binary) text; zero for one without words."""
    counts, n = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    owner, held = [], []

    def settle():
        if held:
            np.add.at(counts, owner, bit_counts(held))
            np.add.at(n, owner, [len(h) for h in held])
            owner.clear(), held.clear()

    size = 0
    for row, text in enumerate(texts):
        for hashes in shingle_hashes(text.as_py()):
            owner.append(row)
            held.append(hashes)
            size += len(hashes)
            if size > LONG:
                settle()
                size = 0
    settle()
    set_bits = 2 * counts > n[:, None]
    return np.bitwise_or.reduce(set_bits.astype(_U) << np.arange(64, dtype=_U), axis=1)


def _fingerprints():
    def find(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            for begin, size in parts(texts):
                found = fingerprints(texts.slice(begin, size))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, size), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return find


@lru_cache(1)
def covering() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Check bits of each 12-bit word; and for 0, 1 and 2 bits beyond the radius the error patterns by syndrome: (first, count, pattern)."""
    rest = np.arange(1 << (BITS - CHECKS), dtype=np.int64) << CHECKS
    for bit in range(BITS - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    tables = []
    for weights in (range(RADIUS + 1), [RADIUS + 1], [RADIUS + 2]):
        errors = np.concatenate([(1 << np.array(list(combinations(range(BITS), w)), np.int64).reshape(comb(BITS, w), w)).sum(axis=1) for w in weights])
        syndrome = (errors & ((1 << CHECKS) - 1)) ^ rest[errors >> CHECKS]
        order = np.argsort(syndrome, kind="stable")
        count = np.bincount(syndrome, minlength=1 << CHECKS)
        tables.append((np.cumsum(count) - count, count, errors[order]))
    return rest, tables


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): the places first..first + count of every row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of every anchor that a fingerprint is sent to."""
    rest, tables = covering()
    part = [(fp >> _U(BITS * k)).astype(np.int64) & ((1 << BITS) - 1) for k in (0, 1)]
    syndrome = [(p & ((1 << CHECKS) - 1)) ^ rest[p >> CHECKS] for p in part]
    out = []
    for beyond in range(threshold + 1):
        for other in range(threshold + 1 - beyond):
            first, count, errors = tables[beyond]
            row, place = _expand(first[syndrome[0]], count[syndrome[0]])
            left = (part[0][row] ^ errors[place]) >> CHECKS
            first, count, errors = tables[other]
            again, place = _expand(first[syndrome[1][row]], count[syndrome[1][row]])
            row, left = row[again], left[again]
            right = (part[1][row] ^ errors[place]) >> CHECKS
            out.append((row, left << (BITS - CHECKS) | right, np.full(len(row), beyond + other == 0)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sent(threshold: int, blocks: np.ndarray | None):
    """Rows (anchor, cell, fp, home); ``blocks``: into how many an anchor of each slot is dealt (None: one)."""
    schema = pa.schema([("anchor", pa.int32()), ("cell", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])

    def send(batches):
        for batch in batches:
            all_fp = batch.column("fp").to_numpy().view(_U)
            for begin in range(0, len(all_fp), 4096):
                fp = all_fp[begin : begin + 4096]
                row, anchor, home = anchors(fp, threshold)
                if blocks is None:
                    yield batch_of(schema, anchor.astype(np.int32), np.zeros(len(row), np.int32), fp[row].view(np.int64), home)
                    continue
                n = blocks[slots(anchor)]
                # a visitor goes to its own column of cells; a home also goes, as a home, to its own row of cells
                for as_home in (False, True):
                    mine = np.flatnonzero(home) if as_home else np.arange(len(row))
                    own = (mix(fp[row[mine]]) % n[mine].astype(_U)).astype(np.int64)
                    at, other = _expand(np.zeros(len(mine), np.int64), n[mine])
                    cell = (own[at] * n[mine][at] + other) if as_home else (other * n[mine][at] + own[at])
                    to = mine[at]
                    yield batch_of(schema, anchor[to].astype(np.int32), cell.astype(np.int32), fp[row[to]].view(np.int64), np.full(len(to), as_home))

    return send, "anchor int, cell int, fp bigint, home boolean"


def slots(anchor: np.ndarray) -> np.ndarray:
    return (mix(anchor.astype(_U)) % _U(SLOTS)).astype(np.int64)


def _home_anchors():
    schema = pa.schema([("anchor", pa.int32()), ("slot", pa.int32())])

    def home(batches):
        for batch in batches:
            anchor = anchors(batch.column("fp").to_numpy().view(_U), 0)[1]
            yield batch_of(schema, anchor.astype(np.int32), slots(anchor).astype(np.int32))

    return home, "anchor int, slot int"


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member linked to each of 0..n - 1."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def cell_links(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member of its component) within each cell; rows of a cell are neighbours."""
    n = len(cell)
    new = np.ones(n, bool)
    new[1:] = cell[1:] != cell[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    of = np.cumsum(new) - 1
    homes = np.flatnonzero(home)
    todo = size[of[homes]]  # comparisons of each home
    label, a, b, held = np.arange(n), [], [], 0

    def settle():
        nonlocal label, a, b, held
        at = np.flatnonzero(label != np.arange(n))
        label = local_components(n, np.concatenate([*a, at]).astype(np.int64), np.concatenate([*b, label[at]]).astype(np.int64))
        a, b, held = [], [], 0

    done = np.cumsum(todo)
    begin = 0
    while begin < len(homes):
        end = max(begin + 1, int(np.searchsorted(done, (done[begin - 1] if begin else 0) + STEP, "right")))
        some = homes[begin:end]
        row, mate = _expand(first[of[some]], todo[begin:end])
        mine = some[row]
        near = np.flatnonzero(np.bitwise_count(fp[mine] ^ fp[mate]) <= threshold)
        a.append(mine[near])
        b.append(mate[near])
        held += len(near)
        if held > STEP:
            settle()
        begin = end
    settle()
    at = np.flatnonzero(fp != fp[label])
    return fp[at], fp[label[at]]


def _links(threshold: int):
    """Links of cells that follow each other in a partition."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, bool)]
        for batch in batches:
            cell = batch.column("anchor").to_numpy().astype(np.int64) << 32 | batch.column("cell").to_numpy()
            rows = [cell, batch.column("fp").to_numpy().view(_U), batch.column("home").to_numpy(zero_copy_only=False)]
            held = [np.concatenate(x) for x in zip(held, rows)]
            if not len(held[0]) or held[0][0] == held[0][-1]:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            a, b = cell_links(*(x[:cut] for x in held), threshold)
            held = [x[cut:] for x in held]
            yield batch_of(schema, a.view(np.int64), b.view(np.int64))
        a, b = cell_links(*held, threshold)
        yield batch_of(schema, a.view(np.int64), b.view(np.int64))

    return links, "a bigint, b bigint"


def simhash_classes(docs: DataFrame, threshold: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id that links of at most ``threshold``, 0 to 2, bits reach).

    Words are what lies between ASCII white space, A-Z in lower case; shingles of three words count as often
    as they occur; a shorter text is one shingle, and a null text or one without words has fingerprint zero.
    One row per row of ``docs``, also where doc_id is null or repeated: rows are linked by fingerprint alone, and a
    component of null doc_ids only has a null component_id. Empty tables give no rows; other columns are ignored.
    """
    if not 0 <= threshold <= 2:
        raise ValueError("threshold is 0, 1 or 2")
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = stored(docs.select("doc_id", "text").mapInArrow(_fingerprints(), f"doc_id {kind}, fp bigint"), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    home, ddl = _home_anchors()
    crowded = distinct.select("fp").mapInArrow(home, ddl).groupBy("anchor", "slot").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    table = crowded.groupBy("slot").agg(F.max(F.ceil(F.col("n") / BLOCK)).alias("blocks")).toArrow()
    blocks = None
    if table.num_rows:
        blocks = np.ones(SLOTS, np.int64)
        blocks[table.column("slot").to_numpy()] = table.column("blocks").to_numpy()
    send, ddl = _sent(threshold, blocks)
    sent = distinct.select("fp").mapInArrow(send, ddl).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    link, ddl = _links(threshold)
    links = stored(sent.mapInArrow(link, ddl).distinct(), "anchor-links")
    labels = components(links, "anchors").withColumnRenamed("rep", "fp")
    low = distinct.join(labels, "fp").groupBy("label").agg(F.min("low").alias("component_id"))
    linked = labels.join(low, "label").select("fp", "component_id")
    known = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(known, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
