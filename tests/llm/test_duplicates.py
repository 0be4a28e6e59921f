"""Near-duplicates, repeated substrings and decontamination against brute force."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, prose
from pyspark.sql import functions as F

from spanquarry.llm import decontaminate as D
from spanquarry.llm import near_dups as N
from spanquarry.llm import substrings as S
from spanquarry.llm.decontaminate import contaminated_pairs, drop_contaminated


def edited(text, seed, share):
    r, words = random.Random(seed), text.split(" ")
    for at in r.sample(range(len(words)), max(1, int(len(words) * share))):
        words[at] = f"x{r.randrange(10**6)}"
    return " ".join(words)


# near-duplicates


def plain_jaccard(a, b):
    def shingles(t):
        w = re.findall(r"[a-z0-9]+", t.lower())
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter({tuple(w): 1} if w else {})

    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_weighted_jaccard_without_idf_is_multiset_jaccard():
    texts = [prose(1, 200, 50), edited(prose(1, 200, 50), 2, 0.02), prose(1, 200, 50)[:400], "A b", "a B!", ""]
    flat = np.zeros(N.FREQUENCIES, np.float32)
    doc, shingle, weight = N.shingles(pa.array(texts), flat)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    vectors = [(shingle[a:b], weight[a:b]) for a, b in zip(edge, edge[1:])]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert N.weighted_jaccard(vectors[i], vectors[j]) == pytest.approx(plain_jaccard(texts[i], texts[j]), abs=1e-6)


def test_frequencies_are_exact(spark):
    texts = ["the cat the dog", "The owl", None, "", "cat"]
    table, n = N.word_frequencies(docs(spark, list(enumerate(texts))))
    assert n == 5
    at = lambda w: int((N.Words(pa.array([w]), N.SEPARATORS).hash % np.uint64(N.FREQUENCIES))[0])
    assert [int(table[at(w)]) for w in ("the", "cat", "owl", "dog")] == [2, 2, 1, 1]
    assert N.idf_levels(table, n)[at("owl")] > N.idf_levels(table, n)[at("the")]


def test_samples_agree_as_often_as_texts_are_similar():
    flat, rates, truth = np.zeros(N.FREQUENCIES, np.float32), [], []
    for seed in range(40):
        a = prose(seed, 400)
        pair = pa.array([a, edited(a, seed, 0.02)])
        doc, shingle, weight = N.shingles(pair, flat)
        _, s = N.signatures(doc, shingle, weight)
        rates.append((s[0] == s[1]).mean())
        truth.append(plain_jaccard(*pair.to_pylist()))
    assert abs(np.mean(rates) - np.mean(truth)) < 0.02


@pytest.fixture(scope="module")
def family():
    rows, groups = [], defaultdict(list)
    for g in range(12):
        base = prose(100 + g, 300)
        for k in range(6 if g else 40):
            groups[g].append(len(rows))
            rows.append((len(rows), base if k % 3 == 0 else edited(base, 50 * g + k, 0.006)))
    rows += [(len(rows) + i, prose(900 + i, 250)) for i in range(40)]
    return rows, groups


def test_near_duplicate_classes(spark, family):
    rows, groups = family
    extra = [(2000, None), (2001, None), (2002, ""), (2003, ""), (2004, "Two words"), (2005, "two, words"), (2006, "!?")]
    table = docs(spark, rows + extra).withColumn("rep", F.lit(1)).withColumn("label", F.lit("x"))
    got = {r.doc_id: r for r in N.near_duplicates(table).collect()}
    assert len(got) == len(rows) + len(extra)
    for members in groups.values():
        assert {got[m].class_id for m in members} == {members[0]}
    grouped = {m for ms in groups.values() for m in ms}
    assert all(got[i].class_id == i and got[i].n_links == 0 for i, _ in rows if i not in grouped)
    classes = {i: got[i].class_id for i, _ in extra}
    assert classes == {2000: 2000, 2001: 2001, 2002: 2002, 2003: 2002, 2004: 2004, 2005: 2004, 2006: 2006}
    assert N.near_duplicates(docs(spark, [])).count() == 0


def test_members_that_miss_the_first_document_are_still_linked(spark):
    """Copies of one original differ too much from each other, and the first document is a copy."""
    base = prose(5, 400)
    copies = [edited(base, k, 0.0175) for k in range(12)]
    rows = [(i, t) for i, t in enumerate(copies)] + [(50, base)]
    near = [plain_jaccard(base, c) for c in copies]
    assert min(near) > 0.83 and max(plain_jaccard(copies[0], c) for c in copies[1:]) < 0.78
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs(spark, rows)).collect()}
    assert set(got.values()) == {0}


def test_partner_behind_many_similar_mates_is_found(spark):
    """A family in which only some pairs reach the threshold, each member with dozens of mates just below it."""
    base = prose(7, 1600).split(" ")
    r, rows, held = random.Random(8), [], []

    def add(key, shared=()):
        """A copy with 24 edits; no two copies edit more than nine same places unless they share them."""
        while True:
            at = {8 * k + 4 for k in r.sample(range(198), 24 - len(shared))}
            if all(len((at | set(shared)) & (other - set(shared))) < 10 for other in held) and not at & set(shared):
                break
        held.append(at | set(shared))
        new = {i: f"x{r.randrange(10**9)}" for i in sorted(at)} | dict(shared)
        rows.append((key, " ".join(new.get(i, w) for i, w in enumerate(base))))

    for k in range(8):
        shared = {8 * at + 4: f"y{r.randrange(10**9)}" for at in r.sample(range(198), 10)}
        add(2 * k, shared)
        add(2 * k + 1, shared)
    for i in range(80):
        add(100 + i)
    assert all(plain_jaccard(rows[2 * k][1], rows[2 * k + 1][1]) > 0.82 for k in range(8))
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: i - i % 2 if i < 16 else i for i, _ in rows}


def test_rows_follow_the_members_of_a_family_below_the_threshold(spark, monkeypatch):
    """Members just below the threshold with two pairs above it, in blocks and squares smaller than a bucket."""
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "SQUARE", 24)
    written, store = Counter(), N.stored

    def counted(df, name):
        out = store(df, name)
        written[name] += out.count() if name in ("found", "links") else 0
        return out

    monkeypatch.setattr(N, "stored", counted)
    base, sizes = prose(7, 1600).split(" "), []
    for n in (40, 120):
        r, rows = random.Random(8), []
        for i in range(n):
            at = {8 * k + 4 for k in r.sample(range(198), 24)}
            rows.append((100 + i, " ".join(f"x{i}-{j}" if j in at else w for j, w in enumerate(base))))
        for k in (0, 1):  # a text of its own family and one edit of it
            rows.append((k, edited(rows[k][1], k, 0.001)))
        got = {x.doc_id: x.class_id for x in N.near_duplicates(docs(spark, rows)).collect()}
        assert got == {key: key - 100 if key in (100, 101) else key for key, _ in rows}
        sizes.append(written["found"] + written["links"])
        written.clear()
    assert sizes[1] < 5 * sizes[0]


def test_closest_goes_on_behind_the_last_mate():
    samples = np.arange(N.SAMPLES, dtype=np.uint32)
    others = [np.where(np.arange(N.SAMPLES) < k, 10**6, samples).astype(np.uint32).tobytes() for k in (5, 3, 3, 9, 30, 2)]
    # the last has the most equal samples but too few equal further ones
    more = [b"x" * N.MORE] * 5 + [b"x" * 300 + b"y" * (N.MORE - 300)]
    others = pa.table({"band": [7] * 6, "block": [0] * 6, "rep": [1, 3, 2, 4, 5, 6], "label": [1, 3, 2, 0, 5, 6], "samples": others, "more": more})
    mine = {"band": [7], "block": [0], "rep": [0], "label": [0], "samples": [samples.tobytes()], "more": more[:1]}
    seen, last, taken = N.SAMPLES + 1, 0, []
    for _ in range(3):
        out = N._closest(0.55, 0.7, 1)(pa.table(mine | {"seen": [seen], "last": [last]}), others).to_pylist()
        taken += [(o["mate"], o["more"]) for o in out]
        seen, last = out[-1]["same"], out[-1]["mate"]
    assert taken == [(2, True), (3, True), (1, False)]


def test_classes_are_the_components_of_all_pairs(spark):
    """Given documents, and a family whose pairs lie on both sides of the threshold."""
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("text IS NOT NULL")
    base = prose(40, 300)
    rows = [(r.doc_id, r.text) for r in given.collect()] + [(10**6 + k, edited(base, k, share)) for k, share in enumerate([0.02, 0.025, 0.03, 0.035] * 10)]
    table = docs(spark, rows)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(table).collect()}
    doc, shingle, weight = N.shingles(pa.array([t for _, t in rows]), N.idf_levels(*N.word_frequencies(table)))
    edge = np.searchsorted(doc, np.arange(len(rows) + 1))
    vectors = [(shingle[a:b], weight[a:b]) for a, b in zip(edge, edge[1:])]
    holders, above = defaultdict(list), {i: i for i in range(len(rows))}
    for i, (mine, _) in enumerate(vectors):
        for k in mine.tolist():
            holders[k].append(i)

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, j in {(i, j) for some in holders.values() for i, j in itertools.combinations(some, 2)}:
        if N.weighted_jaccard(vectors[i], vectors[j]) >= 0.8:
            above[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(lambda: 10**9)
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least[top(i)], key)
    assert got == {key: least[top(i)] for i, (key, _) in enumerate(rows)}


# repeated substrings


def brute_repeats(rows, length):
    places, seen = {}, {}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for key, text in ordered:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(w) - length + 1):
            window, at = tuple(w[i : i + length]), ((key is not None, key or 0), i)
            seen[window] = min(seen.get(window, at), at)
    for n, (key, text) in enumerate(ordered):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] < ((key is not None, key or 0), i):
                gone.update(range(i, i + length))
        places[n] = (key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return sorted(places.values(), key=str)


def cleaned(spark, rows, length=20):
    out = S.drop_repeats(docs(spark, rows), length).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in out], key=str)


def substring_rows(seed):
    r = random.Random(seed)
    passages = [prose(seed * 50 + i, r.randint(18, 90), 300) for i in range(6)]
    rows = []
    for i in range(40):
        parts = [r.choice(passages) if r.random() < 0.5 else prose(seed * 1000 + i * 10 + k, r.randint(1, 60), 300) for k in range(4)]
        rows.append((i, r.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(100, "a b " * 60), (101, "a b " * 30), (102, None), (103, ""), (104, "one"), (None, rows[3][1]), (-5, rows[4][1]), (105, "é\xa0ü " * 25)]
    return rows


@pytest.mark.parametrize("seed, fine", [(1, 256), (2, 2), (3, 1)])
def test_repeats_equal_brute_force(spark, monkeypatch, seed, fine):
    monkeypatch.setattr(S, "FINE", fine)
    monkeypatch.setattr(S, "SHARD_WORDS", 200)
    rows = substring_rows(seed)
    assert cleaned(spark, rows) == brute_repeats(rows, 20)


def test_repeats_of_one_id_and_extra_columns(spark):
    text = prose(1, 50)
    rows = [(1, text), (1, text), (2, text)]
    assert cleaned(spark, rows) == brute_repeats(rows, 20)
    table = docs(spark, rows).withColumns({"doc": F.lit(1), "n_words": F.lit(2), "asked": F.lit("x"), "start": F.lit(3)})
    out = S.drop_repeats(table)
    assert out.count() == 3
    assert cleaned(spark, []) == []


def test_automaton_matches_every_earlier_place():
    r = random.Random(4)
    spans = [(d, 0, [r.choice("abc") for _ in range(r.randint(1, 30))]) for d in range(25)]
    auto, seen = S.Automaton(), {}
    for d, s, words in spans:
        auto.add(words, d, s)
        for i in range(len(words) - 3):
            seen.setdefault(tuple(words[i : i + 4]), (d, i))
    for d, s, words in spans:
        want = [i for i in range(len(words) - 3) if seen[tuple(words[i : i + 4])] < (d, i)]
        assert list(auto.repeats(words, d, s, 4)) == want


# decontamination

ITEMS = "item_id bigint, text string, doc_id string"


def test_contaminated_pairs(spark):
    items = [(i, prose(300 + i, n, 500)) for i, n in enumerate((40, 25, 12, 9, 7))] + [(8, None), (9, "")]
    rows = [(i, prose(i, 80, 500)) for i in range(12)]
    quote = lambda k: items[k][1]
    rows += [
        (20, prose(50, 30) + " " + quote(0) + " " + prose(51, 20)),
        (21, prose(52, 30) + ". " + edited(quote(0), 1, 0.08).upper() + "! " + prose(53, 20)),
        (22, " ".join(quote(0).split()[10:34]) + " " + prose(54, 30)),
        (23, " ".join(quote(0).split()[:9]) + " " + prose(55, 30)),
        (24, quote(1)), (24, quote(1)), (25, quote(2) + " end"), (26, quote(3)), (27, quote(4)), (28, None), (29, ""), (30, edited(quote(1), 3, 0.5)),
    ]
    table = docs(spark, rows).withColumns({"at": F.lit(1), "words": F.lit("x"), "seed": F.lit(2)})
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    got = {tuple(r) for r in contaminated_pairs(table, bench).collect()}
    assert got == every_pair(rows, items)
    assert {(k, i) for k, i, *_ in got} >= {(20, 0), (21, 0), (22, 0), (24, 1), (25, 2), (26, 3)}
    kept = {r.doc_id for r in drop_contaminated(table, bench).collect()}
    assert kept == {k for k, _ in rows} - {k for k, *_ in got}
    assert contaminated_pairs(docs(spark, []), bench).count() == 0
    assert contaminated_pairs(table, bench.where("false")).count() == 0


def every_pair(rows, items):
    """Overlaps of every alignment, without seeds."""
    words = lambda t: re.split(r"[^\w]+|_", (t or "").lower())
    out = set()
    for key, text in rows:
        d = words(text)
        for item, passage in items:
            b = words(passage)
            if len(b) < 8:
                continue
            n, best = min(20, len(b)), 0
            for s in range(1 - len(b), len(d)):
                same = [int(0 <= j + s < len(d) and d[j + s] == b[j]) for j in range(len(b))]
                best = max(best, max(sum(same[i : i + n]) for i in range(len(same) - n + 1)))
            if best * 20 >= n * 16:
                out.add((key, item, best, n))
    return out


def test_no_substitution_within_the_tolerance_hides_an_item(spark):
    """Patterns that masks of eight words miss, among them every fourth word replaced."""
    items, rows, r = [], [], random.Random(5)
    for item, (n, k) in enumerate([(20, 4), (18, 3), (16, 3), (15, 3), (12, 2), (10, 2), (9, 1), (8, 1), (26, 5)]):
        words = prose(700 + item, n, 10**6).split(" ")
        items.append((item, " ".join(words)))
        for at in [tuple(range(3, 4 * k, 4)), *(r.sample(range(n), k) for _ in range(12))]:
            rows.append((len(rows), " ".join([prose(len(rows), 9), *("zz" if i in at else w for i, w in enumerate(words)), "end"])))
    rows.append((999, " ".join(items[7][1].split(" ")[:7])))
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    got = {tuple(x) for x in contaminated_pairs(docs(spark, rows), bench).collect()}
    assert got == every_pair(rows, items)
    assert {(13 * i + k, i) for i in range(8) for k in range(13)} | {(999, 7)} <= {x[:2] for x in got}


def test_short_items_match_as_whole_exact_copies(spark):
    items = [(1, "What is it?"), (2, "one two three four five six seven"), (3, ""), (4, None), (5, "!")]
    rows = [(1, "So what is it then"), (2, "what was it"), (3, "zero One two, three four five six seven"), (4, "one two three four five six eight"), (5, ""), (6, None)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    assert {tuple(x) for x in contaminated_pairs(docs(spark, rows), bench, short_items=True).collect()} == {(1, 1, 3, 3), (3, 2, 7, 7)}
    assert contaminated_pairs(docs(spark, rows), bench).count() == 0


def test_no_pattern_within_the_tolerance_escapes_the_masks():
    for width in range(8, 21):
        spare = width - math.ceil(width * 16 / 20)
        lain = [{at + i for i, bit in enumerate(m) if bit == "1"} for m in D.MASKS for at in range(width - len(m) + 1)]
        assert all(any(not places & set(gone) for places in lain) for gone in itertools.combinations(range(width), spare)), width
        assert D.escape(D.MASKS, width, spare) is None
    assert D.escape(("11111111",), 20, 4) is not None
    with pytest.raises(ValueError, match="escape the masks"):
        D.check_masks(D.MASKS, 20, 12)


def test_shuffled_seeds_give_the_same_pairs(spark, monkeypatch):
    items = [(i, prose(300 + i, n, 500)) for i, n in enumerate((40, 25, 12, 9, 5))]
    rows = [(i, prose(i, 60, 500) + " " + items[i % 5][1]) for i in range(20)] + [(None, items[0][1]), (3, None), (19, prose(19, 60, 500) + " " + items[4][1])]
    bench, table = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS), docs(spark, rows)
    near = sorted(map(tuple, contaminated_pairs(table, bench, short_items=True).collect()), key=str)
    monkeypatch.setattr(D, "MOST_BYTES", 0)
    assert sorted(map(tuple, contaminated_pairs(table, bench, short_items=True).collect()), key=str) == near
    assert {(i, i % 5) for i in range(20)} | {(None, 0)} <= {x[:2] for x in near}


def test_places_that_cannot_hit_are_not_shuffled(spark):
    held = spark.range(20_000).select(F.xxhash64("id").alias("seed"))
    rows = held.union(spark.range(20_000, 120_000).select(F.xxhash64("id")))
    left = D._likely(rows, held, 20_000)
    assert left.columns == ["seed"] and held.exceptAll(left).count() == 0
    assert left.count() < 20_000 + 100_000 / 100
    assert D._likely(rows, held.limit(0), 0).count() == 0


def test_large_benchmarks_give_every_pair(spark, monkeypatch):
    """Equal items under many ids, one id of two texts, rows without an id, one id twice, and short items that begin or end a document."""
    items = [(i, prose(300 + i % 5, (60, 25, 12, 9, 8)[i % 5], 500)) for i in range(40)] + [(3, prose(300, 60, 500)), (50, "Yes"), (51, "yes!"), (52, "to be or not")]
    rows = [(i, prose(i, 30, 500) + " " + edited(items[i % 5][1], i, 0.15) + " " + prose(90 + i, 30, 500)) for i in range(20)]
    rows += [(20, " ".join(items[0][1].split(" ")[33:])), (21, items[0][1][:120]), (7, items[0][1]), (22, "yes"), (23, "To be or not, yes")]
    rows += [(None, items[1][1]), (None, items[2][1]), (None, "no")]
    bench = spark.createDataFrame([(i, t, "z") for i, t in [*items, (None, items[1][1])]], ITEMS)
    best = {}
    for key, item, n, width in every_pair(rows, items):
        best[key, item] = max(best.get((key, item), (0, 0)), (n, width))
    whole = {(22, 50): (1, 1), (22, 51): (1, 1), (23, 50): (1, 1), (23, 51): (1, 1), (23, 52): (4, 4)}
    for most in (D.MOST_BYTES, 2000, 0):
        monkeypatch.setattr(D, "MOST_BYTES", most)
        got = contaminated_pairs(docs(spark, rows), bench, short_items=True).collect()
        assert len(got) == len(best | whole) and {(r.doc_id, r.item_id): (r.n_equal, r.n_compared) for r in got} == best | whole


def test_runs_of_a_part_do_not_hold_the_words(spark):
    import tracemalloc

    from spanquarry.llm import substrings

    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 60_000))) for _ in range(20)]
    batch = pa.record_batch({"text": texts, "doc": pa.array(range(20), pa.int64()), "twin": pa.array(range(20), pa.int32())})
    held, peak = [], 0
    tracemalloc.start()
    try:
        for _ in substrings._runs(20, 4)(iter([batch])):
            held.append(tracemalloc.get_traced_memory()[0])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(held) >= 2 and max(held) < peak / 6
