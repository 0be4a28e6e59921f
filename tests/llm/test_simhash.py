"""SimHash classes against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import docs, prose

from spanquarry.llm import simhash as S


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(x >> bit & 1 for x in h) > len(h))


def plain_components(prints, threshold):
    """Smallest index linked to each, over all pairs."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                x, y = sorted((find(i), find(j)))
                label[y] = x
    return [find(i) for i in range(len(prints))]


def texts():
    rows = [None, "", " \t\n", "One", "one", "ONE two", "a b c", "A\tb\x0bc", "É é e", "a b c d", prose(1, 5000, 9)]
    for g in range(25):
        base = prose(g, 120).split(" ")
        rows.append(" ".join(base))
        for k in range(6):
            r, cut = random.Random(100 * g + k), list(base)
            for _ in range(k % 3 + 1):
                cut[r.randrange(len(cut))] = f"x{r.randrange(10**6)}"
            rows.append(" ".join(cut))
    return rows


def test_classes_equal_components_of_all_pairs(spark):
    rows = texts()
    prints = [plain_fingerprint(t) for t in rows]
    table = docs(spark, list(enumerate(rows)))
    for threshold in (0, 1, 2):
        want = plain_components(prints, threshold)
        got = {r.doc_id: r for r in S.simhash_classes(table, threshold).collect()}
        assert [got[i].fingerprint for i in range(len(rows))] == [f"{p:016x}" for p in prints]
        assert [got[i].component_id for i in range(len(rows))] == want
    assert len(set(want)) < len(set(prints))
    with pytest.raises(ValueError):
        S.simhash_classes(table, 3)


def test_null_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d"), (None, "q r s"), (7, "a b c d"), (3, "q q q"), (3, "a b c d"), (9, None), (8, "")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, fp int, component_id string")
    got = sorted(S.simhash_classes(table).collect(), key=str)
    assert len(got) == len(rows)
    same = f"{plain_fingerprint('a b c d'):016x}"
    assert {r.component_id for r in got if r.fingerprint == same} == {3}
    assert [r.component_id for r in got if r.fingerprint == f"{plain_fingerprint('q r s'):016x}"] == [None]
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {8}
    assert S.simhash_classes(docs(spark, [])).count() == 0


def test_every_pair_within_the_threshold_meets_at_a_home():
    r = random.Random(3)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for bit in r.sample(range(64), r.randrange(3)):
            y ^= 1 << bit
        row, anchor, home = S.anchors(np.array([x, y], np.uint64), 2)
        sent = [set(anchor[row == i].tolist()) for i in (0, 1)]
        at = [int(anchor[(row == i) & home][0]) for i in (0, 1)]
        assert at[0] in sent[1] and at[1] in sent[0]
        assert len(sent[0]) == (row == 0).sum()


def test_long_texts_and_hot_anchors(spark, monkeypatch):
    text = prose(5, 3000)
    whole = np.concatenate(list(S.shingle_hashes(text.encode())))
    monkeypatch.setattr(S, "LONG", 500)
    portions = list(S.shingle_hashes(text.encode()))
    assert len(portions) > 1 and np.array_equal(np.concatenate(portions), whole)
    r = random.Random(9)
    fp = [r.getrandbits(64)]
    while len(fp) < 400:
        fp.append(fp[r.randrange(len(fp))] ^ 1 << r.randrange(64) ^ (1 << r.randrange(64) if r.random() < 0.3 else 0))
    fp = np.array(sorted(set(fp)), np.uint64)
    blocks = np.full(S.SLOTS, 3, np.int64)
    table = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    monkeypatch.setattr(S, "STEP", 50)
    for deal in (None, blocks):
        send, ddl = S._sent(2, deal)
        link, link_ddl = S._links(2)
        links = table.mapInArrow(send, ddl).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell").mapInArrow(link, link_ddl)
        place = {int(x): i for i, x in enumerate(fp.view(np.int64))}
        pairs = [(place[x.a], place[x.b]) for x in links.collect()]
        got = S.local_components(len(fp), np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        assert got.tolist() == plain_components([int(x) for x in fp], 2)
