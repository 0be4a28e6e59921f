"""The trie of conversation prefixes against a dictionary of all prefixes."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from spanquarry.llm import prefix_trie as P

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(role, text) for *_, role, text in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        whole = turns.get(c - c % 100, [])[:h] + turns[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        return [node] + [x for child in children[node] for x in below(child)]

    out = []
    for node, convs in members.items():
        tree = below(node)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in tree if x)
        parent = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        out.append((convs[0], len(node), parent, len(convs), len(children[node]), sum(not children[x] for x in tree), saved, digest))
    return sorted(out, key=str)


def example():
    r, rows = random.Random(4), []
    for c in list(range(40)) + [100, 101, 102, 230, 231, 5000]:
        for turn in range(r.randrange(1, 6)):
            text = "hello 😀" if turn == 0 and r.random() < 0.5 else f"t{r.randrange(3)}" * r.randrange(1, 4)
            rows.append((c, turn, r.choice(["user", "assistant"]), text))
    rows += [(300, None, None, None), (300, 0, "", ""), (300, 0, "", ""), (301, 7, "user", "x" * 100_000), (None, 1, "user", "lost")]
    return rows + [(400, i, "user", f"deep {i}") for i in range(400)] + [(407, i, "user", f"deep {i}") for i in range(300)]


@pytest.mark.parametrize("limit, held", [(P.LIMIT, P.HELD), (3, 2)])
def test_nodes_equal_those_of_a_dictionary(spark, monkeypatch, limit, held):
    rows = example()
    monkeypatch.setattr(P, "CHUNK", 7)
    monkeypatch.setattr(P.prefix_trie, "__defaults__", (limit, held))
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS node", "'x' AS depth", "2 AS at")
    assert sorted((tuple(r) for r in P.trie_report(table).collect()), key=str) == plain_trie(rows)


def test_turnless_conversations_and_empty_tables(spark):
    rows = [(c, 0, "user", "a") for c in range(101, 130)]  # their family's first conversation is missing
    got = sorted((tuple(r) for r in P.trie_report(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == plain_trie(rows)
    assert P.trie_report(spark.createDataFrame([], TURNS)).count() == 0


def test_queue_spills_and_keeps_the_order():
    r = random.Random(2)
    queue, plain = P.SpillingQueue(5), []
    for time in range(60):
        for k in range(r.randrange(6)):
            message = ((time + 1 + r.randrange(3), b"n"), k, time, k)
            queue.push(message)
            heapq.heappush(plain, message)
        got = list(queue.pop_at((time, b"n")))
        want = []
        while plain and plain[0][0] == (time, b"n"):
            want.append(heapq.heappop(plain))
        assert sorted(got) == want  # messages of one time come in any order
    assert queue.runs
