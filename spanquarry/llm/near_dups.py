"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A shingle is five consecutive words (lower case, letters and digits; a shorter text is one shingle). Its weight is its
count in the text times one plus half the mean inverse document frequency of its words, the latter scaled to 0..1. Document frequencies are
exact counts over all documents of hashed words, so the table has a fixed size whatever the corpus.

Texts that are equal form one class first; the rest works on one representative of each. In every band bucket
the members are verified against the bucket's leader only, so a bucket of n gives n - 1 pairs. The leader is the member with the
most bucket mates over all bands: of an original and its copies that is the original. Members that do not match the
leader are compared by their signatures, block by block, with the bucket's members of other classes: mates that five standard errors
of the banded samples leave open by further 512 samples, drawn for these members alone. The most similar few are verified as pairs. Of members that have more such mates the texts
themselves go to squares of a bucket's members, where all their mates behind those few are verified, each pair in the first bucket that it shares. A square gives only the links
that join classes, so the rows that leave it grow with its members and not with its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.encoding import forget
from spanquarry.llm.tables import batch_of, stored
from spanquarry.llm.words import Words, mix, parts

SHINGLE = 5
#: Sampled elements and how many make a band: at similarity 0.8 a pair shares a band with probability 0.9998.
SAMPLES, ROWS = 64, 4
#: Hashed words in the document-frequency table (4 MB whatever the corpus).
FREQUENCIES = 1 << 20
#: Members in a block when a bucket is compared by signatures, and how many partners each tries in the first round.
BLOCK, TRIES = 512, 4
#: Members that a block is compared with in one task when their texts come along.
SQUARE = 1024
#: Further samples of the members of buckets in which some do not match the leader; a byte of each is kept.
MORE = 512
#: Standard errors below the threshold down to which an estimate by signatures still leads to verification.
SIGMAS = 5

SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_U = np.uint64


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def word_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hashed word occurs, and the number of documents."""
    schema = pa.schema([("word", pa.int32()), ("n", pa.int64())])

    def count(batches):
        forget()
        seen, n = np.zeros(FREQUENCIES, np.int64), 0
        for batch in batches:
            texts = batch.column(0)
            n += len(texts)
            for begin, size in parts(texts):
                words = Words(_lower(texts.slice(begin, size)), SEPARATORS)
                key = (words.doc.astype(np.int64) << 20) | (words.hash % _U(FREQUENCIES)).astype(np.int64)
                seen += np.bincount(np.unique(key) & (FREQUENCIES - 1), minlength=FREQUENCIES)
        at = np.flatnonzero(seen)
        yield batch_of(schema, np.append(at, -1).astype(np.int32), np.append(seen[at], n))

    rows = docs.select("text").mapInArrow(count, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    pairs = rows.toArrow()
    word, n = pairs.column("word").to_numpy(), pairs.column("n").to_numpy()
    out = np.zeros(FREQUENCIES, np.int64)
    out[word[word >= 0]] = n[word >= 0]
    return out, int(n[word < 0].sum())


def idf_levels(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequency in 0..1 (1: in no document)."""
    return (np.log((1 + documents) / (1 + frequencies)) / np.log(2 + documents)).astype(np.float32)


def shingles(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, weight) of every distinct shingle of every text, by row."""
    words = Words(_lower(texts), SEPARATORS)
    level = idf[(words.hash % _U(FREQUENCIES)).astype(np.int64)]
    total = np.concatenate([[0], np.cumsum(level, dtype=np.float64)])
    size = np.diff(words.of_doc)
    long = words.whole(SHINGLE)
    at = np.flatnonzero(long)
    doc, grams, n = words.doc[at], words.grams(SHINGLE)[at], np.full(len(at), SHINGLE)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        begin = words.of_doc[short]
        doc = np.concatenate([doc, short.astype(np.int32)])
        grams = np.concatenate([grams, words.span_hashes(begin, begin + size[short])])
        at, n = np.concatenate([at, begin]), np.concatenate([n, size[short]])
    mean = (total[at + n] - total[at]) / n
    # row, 36 bits of the hash and the weight's level in one number, so that one plain sort finds the distinct ones
    key = (doc.astype(_U) << _U(44)) | ((grams >> _U(28)) << _U(8)) | np.clip(np.rint(mean * 255), 0, 255).astype(_U)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    weight = count.astype(np.float32) * (1 + (key & _U(255)).astype(np.float32) / np.float32(510))
    return (key >> _U(44)).astype(np.int64), (key >> _U(8)) & _U((1 << 36) - 1), weight


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """65,536 quantiles each of Gamma(2, 1), of its logarithm and of the uniform law, in a fixed random order."""
    n = 1 << 16
    x = np.linspace(0, 40, 400_001)
    cdf = 1 - (1 + x) * np.exp(-x)
    gamma = np.interp((np.arange(n) + 0.5) / n, cdf, x)
    order = [np.argsort(mix(np.arange(n, dtype=_U) + _U(k << 20))) for k in (1, 2, 3)]
    uniform = (np.arange(n) + 0.5) / n
    return tuple(a[o].astype(np.float32) for a, o in zip((gamma, np.log(gamma), uniform), order))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, samples: int = SAMPLES, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and for each the smallest sample of every hash function.

    For shingle k with weight S: t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r with r, c ~ Gamma(2, 1) and
    b uniform, all drawn by hashing k. The shingle of the smallest a, with its t, is the sample; a itself is the
    same number in two texts exactly when both are, so it stands for the pair. ``skip`` leaves out the first hash functions.
    """
    gamma, log_gamma, uniform = _tables()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    rows = doc[first]
    out = np.empty((len(rows), samples), np.float32)
    seeds = mix(np.arange(1 + skip, samples + skip + 1, dtype=_U)) | _U(1)
    cuts = [0]
    while cuts[-1] < len(first):  # whole rows, about 60,000 shingles at once
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(first, first[cuts[-1]] + 60_000))))
    for a, b in zip(cuts, cuts[1:]):
        b = min(b, len(first))
        end = first[b] if b < len(first) else len(doc)
        h, log_s, begin = mix(shingle[first[a] : end] + _U(1)), np.log(weight[first[a] : end]), first[a:b] - first[a]
        for j in range(samples):
            x = h * seeds[j]
            r = gamma[(x >> _U(48)).astype(np.intp)]
            u = uniform[((x >> _U(32)) & _U(0xFFFF)).astype(np.intp)]
            c = log_gamma[((x >> _U(16)) & _U(0xFFFF)).astype(np.intp)]
            t = np.floor(log_s / r + u)
            t -= u
            t += 1
            t *= r
            np.subtract(c, t, out=c)
            out[a:b, j] = np.minimum.reduceat(c, begin)
    return rows, out


def band_keys(samples: np.ndarray) -> np.ndarray:
    bits = samples.view(np.uint32).astype(_U)
    key = np.zeros((len(bits), SAMPLES // ROWS), _U)
    for i in range(ROWS):
        key = mix(key * _U(31) + bits[:, i::ROWS] + _U(1))
    return mix(key + np.arange(key.shape[1], dtype=_U))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones; shingles ascend in both."""
    (x, p), (y, q) = a, b
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    low = float(np.minimum(p[both], q[at[both]]).sum(dtype=np.float64))
    return low / (float(p.sum(dtype=np.float64)) + float(q.sum(dtype=np.float64)) - low)


def _sketch(idf):
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("samples", pa.binary())])

    def sketch(batches):
        for batch in batches:
            texts = batch.column("text")
            for begin, size in parts(texts):
                rows, found = signatures(*shingles(texts.slice(begin, size), idf))
                samples = [None] * size
                for row, s in zip(rows.tolist(), found):
                    samples[row] = s.tobytes()
                cut = batch.slice(begin, size)
                yield batch_of(schema, cut.column("doc_id"), cut.column("h1"), cut.column("h2"), samples)

    return sketch


def _more(idf):
    """One byte of each of ``MORE`` further samples: equal samples have equal bytes, others one time in 256."""
    schema = pa.schema([("rep", pa.int64()), ("more", pa.binary())])

    def more(batches):
        for batch in batches:
            texts = batch.column("text")
            for begin, size in parts(texts):
                rows, found = signatures(*shingles(texts.slice(begin, size), idf), MORE, SAMPLES)
                short = (mix(found.view(np.uint32).astype(_U)) >> _U(56)).astype(np.uint8)
                yield batch_of(schema, batch.column("doc_id").slice(begin, size).take(pa.array(rows)), [s.tobytes() for s in short])

    return more


def _bands():
    schema = pa.schema([("rep", pa.int64()), ("band", pa.int64())])

    def bands(batches):
        for batch in batches:
            if batch.num_rows:
                raw = b"".join(batch.column("samples").to_pylist())
                keys = band_keys(np.frombuffer(raw, np.float32).reshape(-1, SAMPLES))
                rep = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
                yield batch_of(schema, rep, keys.ravel().view(np.int64))

    return bands


def vectors(texts: pa.Array, idf) -> list[tuple[np.ndarray, np.ndarray]]:
    doc, shingle, weight = shingles(texts, idf)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(shingle[x:y], weight[x:y]) for x, y in zip(edge, edge[1:])]


def _verify(idf, threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def verify(batches):
        held = {}
        for batch in batches:
            for begin, size in parts(batch.column("text_b")):
                cut = batch.slice(begin, size)
                a, b = cut.column("a").to_pylist(), cut.column("b").to_pylist()
                new = {key: i for i, key in enumerate(a) if key not in held}
                held = {key: held[key] for key in set(a) if key in held}
                if new:
                    held |= dict(zip(new, vectors(cut.column("text_a").take(pa.array(list(new.values()))), idf)))
                score = [weighted_jaccard(held[x], y) for x, y in zip(a, vectors(cut.column("text_b"), idf))]
                ok = [i for i, s in enumerate(score) if s >= threshold]
                yield batch_of(schema, [a[i] for i in ok], [b[i] for i in ok], [score[i] for i in ok])

    return verify


def components(edges: DataFrame, name: str) -> DataFrame:
    """(rep, label): the smallest node linked to each node of ``edges`` (a, b), by min-label rounds with pointer jumping."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("rep"), F.least("a", "b").alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels, both.b == labels.rep).groupBy("a").agg(F.min("label").alias("seen"))
        low = labels.join(near, labels.rep == near.a).select("rep", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        to = labels.select(F.col("rep").alias("label"), F.col("label").alias("next"))
        step = stored(low.join(to, "label").select("rep", "old", F.least("label", "next").alias("label")), f"{name}-labels")
        labels = step.select("rep", "label")
        if step.where("label <> old").isEmpty():
            return labels


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Class labels after more links: components of the classes, not of their members."""
    of = labels.select(F.col("rep").alias("x"), F.col("label").alias("to"))
    pairs = links.select("a", "b").join(of, F.col("a") == F.col("x")).select(F.col("to").alias("a"), "b")
    pairs = pairs.join(of, F.col("b") == F.col("x")).select("a", F.col("to").alias("b")).where("a <> b").distinct()
    new = components(pairs, "classes").select(F.col("rep").alias("label"), F.col("label").alias("low"))
    return stored(labels.join(new, "label", "left").select("rep", F.coalesce("low", "label").alias("label")), "classes")


def _arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = b"".join(t.column("samples").to_pylist())
    further = np.frombuffer(b"".join(t.column("more").to_pylist()), np.uint8).reshape(-1, MORE)
    return t.column("rep").to_numpy(), t.column("label").to_numpy(), np.frombuffer(raw, np.uint32).reshape(-1, SAMPLES), further


def _closest(margin: float, sure: float, tries: int):
    """For each unmatched member of one block its next members of other classes in the bucket: most equal samples first, then
    by doc_id, behind the mate of (``seen``, ``last``). Mates below ``margin`` by the samples or below ``sure`` by the further samples are
    not looked at. ``more`` marks the last one taken where others follow."""
    schema = pa.schema([("band", pa.int64()), ("rep", pa.int64()), ("mate", pa.int64()), ("same", pa.int32()), ("more", pa.bool_())])

    def closest(mine: pa.Table, others: pa.Table) -> pa.Table:
        if not mine.num_rows or not others.num_rows:
            return schema.empty_table()
        rep, label, samples, further = _arrays(mine)
        other, other_label, other_samples, other_further = _arrays(others)
        columns = np.ascontiguousarray(other_samples.T)
        found = []
        for x, own, s, m, seen, last in zip(rep.tolist(), label.tolist(), samples, further, mine.column("seen").to_pylist(), mine.column("last").to_pylist()):
            same = (columns == s[:, None]).sum(axis=0, dtype=np.int32)
            at = np.flatnonzero((same >= margin * SAMPLES) & (other_label != own) & ((same < seen) | ((same == seen) & (other > last))))
            at = at[(other_further[at] == m).sum(axis=1, dtype=np.int32) >= sure * MORE]
            best = at[np.lexsort((other[at], -same[at]))[:tries]]
            more = len(at) > tries
            found += [(x, y, n, more and k == tries - 1) for k, (y, n) in enumerate(zip(other[best].tolist(), same[best].tolist()))]
        band = pa.repeat(mine.column("band")[0], len(found))
        return pa.table([band, *[pa.array([f[i] for f in found], schema.types[i + 1]) for i in range(4)]], schema=schema)

    return closest


def _joining(idf, threshold: float, margin: float, sure: float):
    """Links that join classes, between the members of one block and those of one part of the bucket: all mates that :func:`_closest`
    would come to behind (``seen``, ``last``) are verified, the most similar first, but for pairs that links of this square join already and
    for pairs that share an earlier band: there one of the two has the other among its mates as well."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def joining(mine: pa.Table, others: pa.Table) -> pa.Table:
        if not mine.num_rows or not others.num_rows:
            return schema.empty_table()
        rep, label, samples, further = _arrays(mine)
        other, other_label, other_samples, other_further = _arrays(others)
        columns = np.ascontiguousarray(other_samples.T)
        band = int(np.argmax(band_keys(samples[:1].view(np.float32))[0].view(np.int64) == mine.column("band")[0].as_py()))
        tries = []
        for x, (seen, last) in enumerate(zip(mine.column("seen").to_pylist(), mine.column("last").to_pylist())):
            equal = columns == samples[x][:, None]
            same = equal.sum(axis=0, dtype=np.int32)
            at = np.flatnonzero((same >= margin * SAMPLES) & (other_label != label[x]) & ((same < seen) | ((same == seen) & (other > last))))
            at = at[(other_further[at] == further[x]).sum(axis=1, dtype=np.int32) >= sure * MORE]
            at = at[~equal[: band * ROWS, at].reshape(band, ROWS, len(at)).all(axis=1).any(axis=0)]
            tries.append(np.stack([np.full(len(at), x), at, same[at]]))
        x, y, same = np.concatenate(tries, axis=1)
        order = np.lexsort((other[y], rep[x], -same))
        x, y = x[order], y[order]

        def read(t: pa.Table, rows: np.ndarray) -> dict:
            rows, texts = np.unique(rows), t.column("text").combine_chunks()
            texts, out = texts.take(pa.array(rows)), []
            for begin, size in parts(texts):
                out += vectors(texts.slice(begin, size), idf)
            return dict(zip(rows.tolist(), out))

        left, right = read(mine, x), read(others, y)
        top: dict[int, int] = {}

        def find(k: int) -> int:
            while (up := top.get(k, k)) != k:
                top[k] = top.get(up, up)
                k = up
            return k

        found = []
        for i, j in zip(x.tolist(), y.tolist()):
            p, q = find(int(label[i])), find(int(other_label[j]))
            if p != q and (score := weighted_jaccard(left[i], right[j])) >= threshold:
                top[p] = q
                found.append((*sorted((int(rep[i]), int(other[j]))), score))
        return pa.table([pa.array([f[k] for f in found], schema.types[k]) for k in range(3)], schema=schema)

    return joining


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), rep (smallest doc_id with the same text), n_links (other
    texts that the text's representative was verified against with success).

    Two texts are linked when they share a band and their weighted Jaccard similarity reaches ``threshold``;
    classes are the connected components. Null texts and texts without letters or digits match equal texts at
    most (null: nothing). doc_ids are expected to be distinct; rows that share one are one document.
    An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    keyed = docs.withColumns(
        {"h1": F.when(F.col("text").isNull(), F.col("doc_id")).otherwise(F.xxhash64("text")), "h2": F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(1), "text")).otherwise(0)}
    )
    idf = spark.sparkContext.broadcast(idf_levels(*word_frequencies(docs)))

    class Late:
        """The broadcast table, fetched in the task."""

        def __getitem__(self, at):
            return idf.value[at]

    table = Late()
    sketches = stored(keyed.mapInArrow(_sketch(table), "doc_id bigint, h1 bigint, h2 bigint, samples binary"), "sketches")
    texts = stored(sketches.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.min_by("samples", "doc_id").alias("samples")), "texts")
    bands = stored(texts.where("samples IS NOT NULL").select("rep", "samples").mapInArrow(_bands(), "rep bigint, band bigint"), "bands")
    shared = stored(bands.join(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "band"), "shared")
    mates = stored(shared.groupBy("rep").agg(F.sum("n").alias("mates")), "mates")
    ranked = shared.select("band", "rep").join(mates, "rep")
    leaders = ranked.groupBy("band").agg((-F.max(F.struct("mates", (-F.col("rep")).alias("low")))["low"]).alias("leader"))
    buckets = stored(shared.select("band", "rep").join(leaders, "band"), "buckets")
    # texts of documents that share a band: all that verification reads
    some = stored(docs.join(mates.select(F.col("rep").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "candidates")

    def verified(pairs: DataFrame) -> DataFrame:
        left = some.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = some.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        both = right.join(pairs, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        return stored(both.mapInArrow(_verify(table, threshold), "a bigint, b bigint, similarity double"), "links")

    to_leader = buckets.where("rep <> leader").select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b"))
    tried = stored(to_leader.distinct(), "pairs")
    links = verified(tried)
    labels = joined_classes(texts.select("rep", F.col("rep").alias("label")), links)
    margin, sure = (threshold - SIGMAS * (threshold * (1 - threshold) / n) ** 0.5 for n in (SAMPLES, MORE))
    cols = ["band", "block", "rep", "label", "samples", "more"]

    def placed(labels: DataFrame) -> DataFrame:
        return buckets.join(labels, "rep").join(labels.select(F.col("rep").alias("leader"), F.col("label").alias("lead")), "leader")

    def dealt(members: DataFrame) -> DataFrame:
        return members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    def steps(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    first = placed(labels).withColumn("apart", F.col("label") != F.col("lead"))
    blocks = stored(first.where("apart").groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    # classes only merge, so what follows is about these buckets
    open_ = first.join(blocks, "band").select(F.col("rep").alias("doc_id")).distinct()
    further = stored(some.join(open_, "doc_id").mapInArrow(_more(table), "rep bigint, more binary"), "further")
    members = stored(first.join(blocks, "band").join(texts.select("rep", "samples"), "rep").join(further, "rep"), "open")
    mine = dealt(members.where("apart")).select(*cols, F.lit(SAMPLES + 1).alias("seen"), F.lit(0).cast("bigint").alias("last"))
    others = members.withColumn("block", steps("blocks")).select(cols)
    near = mine.groupBy("band", "block").cogroup(others.groupBy("band", "block"))
    found = stored(near.applyInArrow(_closest(margin, sure, TRIES), "band bigint, rep bigint, mate bigint, same int, more boolean"), "found")
    pairs = found.select(F.least("rep", "mate").alias("a"), F.greatest("rep", "mate").alias("b")).distinct()
    more = verified(stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs"))
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = joined_classes(labels, more)
    left = found.where("more").select("band", "rep", F.col("same").alias("seen"), F.col("mate").alias("last"))
    if not left.isEmpty():
        rest = placed(labels).join(left, ["band", "rep"], "left").withColumn("apart", (F.col("label") != F.col("lead")) & F.col("seen").isNotNull())
        sizes = rest.groupBy("band").agg(
            F.ceil(F.count_if("apart") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / SQUARE).cast("int").alias("squares")
        )
        members = rest.join(stored(sizes.where("blocks > 0"), "blocks"), "band").join(texts.select("rep", "samples"), "rep").join(further, "rep")
        members = stored(members.join(some.select(F.col("doc_id").alias("rep"), "text"), "rep"), "open")
        mine = dealt(members.where("apart")).withColumn("square", steps("squares")).select("square", *cols, "seen", "last", "text")
        others = members.withColumn("square", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("squares")).cast("int")).withColumn("block", steps("blocks"))
        near = mine.groupBy("band", "block", "square").cogroup(others.select("square", *cols, "text").groupBy("band", "block", "square"))
        more = near.applyInArrow(_joining(table, threshold, margin, sure), "a bigint, b bigint, similarity double")
        more = stored(more.dropDuplicates(["a", "b"]), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = joined_classes(labels, more)
    idf.destroy()  # everything that reads it is stored
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    known = texts.select("h1", "h2", "rep").join(labels, "rep").join(ends, "rep", "left")
    return sketches.join(known, ["h1", "h2"]).select(
        "doc_id", F.col("label").alias("class_id"), "rep", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
