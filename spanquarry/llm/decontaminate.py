"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask is a word pattern of ones and zeros; words under a zero are ignored. The words under the ones are hashed at every place of the
benchmark and of the documents and the hashes are joined, which proposes an alignment; around every hit the document is laid over the
item and words are compared place by place. The masks are complete: :func:`escape` shows that no choice of replaced words within
the tolerance touches every place of every mask, so an overlap within the tolerance is always proposed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Five words each; together complete for stretches of 8 to 20 words of which four fifths, rounded up, are equal.
MASKS = ("111011", "1101011", "1110000101")
#: Items of fewer words are short.
SHORT = 8
#: Words compared around a hit, and how many of them must be equal.
OVERLAP, EQUAL = 20, 16
#: Bytes of seeds, of their bits, or of the items' words that are broadcast; beyond it seeds and words are shuffled.
MOST_BYTES = 64 << 20
#: Bytes that a broadcast seed takes in an executor.
SEED_BYTES = 100
#: The table that tells which seeds the benchmark may have: lanes of 64 bits in a block, and bytes that a broadcast block takes.
LANES, BLOCK_BYTES = 16, 168

WORD_BREAK = r"[^\p{L}\p{N}]+"


def escape(masks: tuple[str, ...], width: int, spare: int) -> tuple[int, ...] | None:
    """At most ``spare`` places of a stretch of ``width`` words that touch all masks wherever they lie, or None if there are none."""
    lain = [{at + i for i, bit in enumerate(m) if bit == "1"} for m in masks for at in range(width - len(m) + 1)]

    def touch(chosen: tuple[int, ...]) -> tuple[int, ...] | None:
        free = next((places for places in lain if not places & set(chosen)), None)
        if free is None:
            return chosen
        if len(chosen) == spare:
            return None
        # one of the places of a mask that is not touched yet has to be chosen
        return next((found for place in sorted(free) if (found := touch((*chosen, place))) is not None), None)

    return touch(())


def check_masks(masks: tuple[str, ...], overlap: int, equal: int) -> None:
    """Refuse masks that some overlap within the tolerance escapes."""
    for width in range(SHORT, overlap + 1):
        missed = escape(masks, width, width - math.ceil(width * equal / overlap))
        if missed is not None:
            raise ValueError(f"{width} words with places {missed} replaced escape the masks")


def _hashes(text: str) -> Column:
    """One hash per word; a text that begins or ends with a break has an empty word there."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK)
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(at: Column, masks: tuple[str, ...], number: int) -> Column:
    """Hash of the mask's number and the words under its ones that begin at ``at``; null where it runs over the end."""
    under = [F.get(F.col("words"), at + i) for i, bit in enumerate(masks[number]) if bit == "1"]
    return F.when(at + len(masks[number]) <= F.size("words"), F.xxhash64(F.lit(number), *under))


def _placed(words: DataFrame, masks: tuple[str, ...], numbers: list[int], *columns: str) -> DataFrame:
    """``columns``, place, which one of these masks and seed at every place of every row."""
    placed = words.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    seeds = F.array(*[_seed(F.col("at"), masks, n) for n in numbers])
    return placed.select(*columns, "at", F.posexplode(seeds).alias("mask", "seed")).where("seed IS NOT NULL")


def _items(benchmark: DataFrame, overlap: int, equal: int, short_items: bool) -> DataFrame:
    """item_id, words, width compared, words of it that must be equal, whether short."""
    table = benchmark.where("item_id IS NOT NULL").select("item_id", _hashes("text").alias("words"))
    short = F.size("words") < SHORT
    table = table.withColumn("short", short).where(F.lit(short_items) | ~short)
    # a short item has no words to spare for a break at its begin or end
    table = table.withColumn("words", F.when(F.col("short"), F.array_remove("words", F.xxhash64(F.lit("")))).otherwise(F.col("words")))
    table = table.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(overlap)))
    need = F.when(F.col("short"), F.col("width")).otherwise(F.ceil(F.col("width") * equal / overlap).cast("int"))
    return table.withColumn("need", need)


def _bits() -> Column:
    """The bits that stand for a seed in its lane."""
    return F.expr(" | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(seed, {at}) & 63 AS INT))" for at in (34, 40, 46, 52)))


def _likely(placed: DataFrame, seeds: DataFrame, n_seeds: int) -> DataFrame:
    """The rows of ``placed`` whose seed may be among ``seeds``; of the others about one in 500 stays as well.

    Every seed sets four bits of one lane of its block, and the blocks are broadcast: 24 bits a seed, fewer if that is beyond the bound.
    """
    blocks = max(1, min(-(-n_seeds * 24 // (LANES * 64)), MOST_BYTES // BLOCK_BYTES))
    block, lane = F.pmod("seed", F.lit(blocks).cast("bigint")), F.shiftrightunsigned("seed", 60).cast("int")
    lanes = seeds.groupBy(block.alias("block"), lane.alias("lane")).agg(F.bit_or(_bits()).alias("bits"))
    table = lanes.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("lane", "bits"))).alias("set"))
    full = F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: F.coalesce(F.try_element_at("set", i), F.lit(0).cast("bigint")))
    table = table.select("block", full.alias("lanes"))
    return placed.join(F.broadcast(table), block == F.col("block")).where(F.get("lanes", lane).bitwiseAND(_bits()) == _bits()).select(placed.columns)


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, equal: int = EQUAL, short_items: bool = False, masks: tuple[str, ...] = MASKS
) -> DataFrame:
    """(doc_id, item_id, n_equal, n_compared): the best overlap of every document that holds part of an item.

    A pair is reported if in some alignment some ``overlap`` consecutive words of the item (all of them, if it is
    shorter) have at least ``equal`` (in proportion, if shorter) equal words; ``n_equal`` is the most equal words in such a
    stretch of ``n_compared``. Case and punctuation do not count. Items of fewer than eight words give nothing, or with
    ``short_items`` only whole exact copies. Masks that are not complete for another tolerance are refused.

    Null and empty texts and null item_ids give nothing; repeated rows of one id count as one document; other columns are ignored; empty
    tables give no rows. Items of the same words are compared once.
    """
    check_masks(masks, overlap, equal)
    items = _items(benchmark, overlap, equal, short_items).withColumn("kind", F.xxhash64("words"))
    known = items.select("kind", "words", "width", "need").distinct()
    size = F.size("words")
    # the lengths of short items, at most SHORT - 1 of them, are masks of ones
    whole = F.sort_array(F.collect_set(F.when(size < SHORT, F.col("width"))))
    n_words, n_kinds, sizes = known.agg(F.sum(size), F.count("*"), whole).first()
    every = (*masks, *("1" * n for n in sizes))
    parts = [(size >= SHORT, list(range(len(masks)))), *(((size < SHORT) & (F.col("width") == n), [len(masks) + i]) for i, n in enumerate(sizes))]
    seeds = reduce(DataFrame.unionByName, (_placed(known.where(which), every, numbers, "kind") for which, numbers in parts))
    seeds = seeds.select("seed", "kind", F.col("at").alias("item_at"))
    n_seeds = (n_words or 0) * len(masks)
    placed = _placed(docs.select("doc_id", _hashes("text").alias("words")), every, list(range(len(every))), "doc_id", "words")
    # the words that any stretch over the place may need; a short item's stretch begins there
    spaced = F.col("mask") < len(masks)
    before = F.when(spaced, F.least(F.col("at"), F.lit(overlap - 1))).otherwise(0)
    around = F.slice("words", F.col("at") - before + 1, before + F.when(spaced, overlap).otherwise(SHORT - 1))
    if n_seeds * SEED_BYTES <= MOST_BYTES:
        hits = placed.join(F.broadcast(seeds), "seed").select("doc_id", around.alias("around"), before.alias("before"), "kind", "item_at")
    else:
        # only places that likely hit are shuffled, each with the words around it
        likely = _likely(placed, seeds, n_seeds).select("doc_id", "seed", around.alias("around"), before.alias("before"))
        hits = likely.join(seeds, "seed").drop("seed")
    laid = known.withColumnRenamed("words", "item_words")
    few = (n_words or 0) * 8 + n_kinds * 64 <= MOST_BYTES
    laid = hits.join(F.broadcast(laid) if few else laid, "kind")
    # stretches of the item over the place; a stretch within the tolerance has a seed of its own, so no other is looked at here
    at, width = F.col("item_at"), F.col("width")
    starts = F.sequence(F.greatest(at - width + 1, F.lit(0)), F.least(at, F.size("item_words") - width))
    shift = F.col("before") - at
    # places before the begin or after the end of the document hold null
    same = lambda i: F.get("item_words", i) == F.get("around", i + shift)
    sums = F.transform(starts, lambda s: F.size(F.filter(F.sequence(s, s + width - 1), same)))
    best = laid.select("doc_id", "kind", F.array_max(sums).alias("n_equal"), width.alias("n_compared"), "need").where("n_equal >= need")
    best = best.groupBy("doc_id", "kind", "n_compared").agg(F.max("n_equal").alias("n_equal"))
    return (
        best.join(items.select("kind", "item_id").distinct(), "kind")
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("n_equal", "n_compared")).alias("best"))
        .select("doc_id", "item_id", "best.n_equal", "best.n_compared")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, short_items: bool = False) -> DataFrame:
    """The documents that hold no part of a benchmark item; a null doc_id is never held against another row."""
    return docs.join(contaminated_pairs(docs, benchmark, short_items=short_items).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def oracle() -> str:
    """The same pairs in DuckDB SQL without seeds: every alignment in which any word is equal is counted."""
    split = r"regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
b AS (SELECT item_id, CASE WHEN len(w) < {SHORT} THEN list_filter(w, lambda x: x <> '') ELSE w END AS w, len(w) < {SHORT} AS short FROM (SELECT item_id, {split} AS w FROM benchmark)),
items AS (SELECT item_id, w, least(len(w), {OVERLAP}) AS n, CASE WHEN short THEN len(w) ELSE CAST(ceil(least(len(w), {OVERLAP}) * {EQUAL} / {OVERLAP}) AS BIGINT) END AS need FROM b WHERE len(w) > 0),
words AS (SELECT r, doc_id, unnest(w) AS x, unnest(range(len(w))) AS pos FROM d), asked AS (SELECT item_id, n, need, unnest(w) AS x, unnest(range(len(w))) AS item_pos FROM items),
same AS (SELECT r, doc_id, item_id, n, need, pos - item_pos AS shift, item_pos FROM words JOIN asked USING (x)),
likely AS (SELECT * FROM same QUALIFY count(*) OVER (PARTITION BY r, item_id, shift) >= need),
runs AS (SELECT doc_id, item_id, n, need, count(*) OVER (PARTITION BY r, item_id, shift ORDER BY item_pos RANGE BETWEEN CURRENT ROW AND n - 1 FOLLOWING) AS s FROM likely)
SELECT doc_id, item_id, CAST(max(s) AS INTEGER) AS n_equal, CAST(max(n) AS INTEGER) AS n_compared FROM runs WHERE s >= need GROUP BY doc_id, item_id"""
