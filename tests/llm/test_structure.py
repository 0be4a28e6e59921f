"""Repair of conversation structure against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

from spanquarry.llm import structure as R

TURNS = "conv_id bigint, turn bigint, role string, text string"
INITIALS = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out[conv] += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """(cost, audit, repaired rows): cheapest first, then the least audit."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, initials, kept = heapq.heappop(queue)
        if (at, initials) in done:
            continue
        done.add((at, initials))
        if at == len(rows) and INITIALS.fullmatch(initials):
            return cost, audit, kept
        if not any(INITIALS.fullmatch(initials + end) for end in ("", "a", "ua")):
            continue
        for role in ("user", "assistant"):
            if len(initials) < 2 * len(rows) + 3:
                heapq.heappush(queue, (cost + 3, audit + "I", at, initials + role[0], kept + ((role, ""),)))
        if at < len(rows):
            _, own, text = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, initials, kept))
            if faults[at] in ("", "truncated"):
                stay = 3 * (faults[at] == "truncated")
                if own[:1]:
                    heapq.heappush(queue, (cost + stay, audit + "K", at + 1, initials + own[:1], kept + ((own, text),)))
                for role in ("user", "assistant"):
                    heapq.heappush(queue, (cost + stay + 3, audit + "R", at + 1, initials + role[0], kept + ((role, text),)))
    raise AssertionError


def plain_report(rows):
    out = []
    for conv, own in plain_damage(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = plain_faults(own)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, kept = plain_repair(own, faults)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def example():
    r, rows = random.Random(6), []
    texts = ["Fine.", "Fine.", "Why?", "cut off", "Ok! \n", "", " \t", " ", "Ends 😀", None, "a.b"]
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "system", "tool", "", None, "User"]
    for conv in range(300):
        turn = r.randrange(3)
        for _ in range(r.randrange(1, 9)):
            rows.append((conv, None if r.random() < 0.05 else turn, r.choice(roles), r.choice(texts)))
            turn += r.choice([0, 1, 1, 1, 2, 40])
    rows += [(None, 1, "user", "Lost."), (None, 2, "assistant", "Found."), (900, None, None, None), (901, 1, "user", "x" * 200_000 + ".")]
    return rows + [(902, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(12)]


def test_reports_equal_a_search_over_all_edits(spark):
    rows = example()
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS audit", "1 AS gone", "2 AS how", "3 AS conv")
    got = sorted((tuple(r) for r in R.repair_report(table).collect()), key=str)
    want = plain_report(rows)
    assert got == want
    assert any(r[7] == "" for r in want) and {"K", "R", "D", "I"} <= set("".join(r[7] for r in want))


def test_conversations_without_rows_and_empty_tables(spark):
    assert R.repair_report(spark.createDataFrame([], TURNS)).count() == 0
    lost = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = R.repair_report(spark.createDataFrame(lost, TURNS)).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(got) == len(lost)


def test_audits_of_all_short_signatures():
    """Every signature of up to four rows, against the search; long ones stay few nodes."""
    roles = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(5):
        signatures = ["".join(x) for x in itertools.product("sSuUaAoOx" if n < 4 else "suUax", repeat=n)]
        back = sorted(s[::-1] for s in signatures)
        batch = R.pa.record_batch({"signature": [b[::-1] for b in back], "back": back})
        for made in R._audits()(iter([batch])):
            for signature, cost, audit in zip(*(c.to_pylist() for c in made.columns)):
                rows = [(0, roles.get(x.lower(), "user"), "") for x in signature]
                faults = ["blank" if x == "x" else "truncated" if x.isupper() else "" for x in signature]
                assert (cost, audit) == plain_repair(rows, faults)[:2], signature
    r = random.Random(1)
    list(R._audits()(iter([R.pa.record_batch({"signature": ["?"], "back": ["".join(r.choice("sSuUaAoOx") for _ in range(100_000))]})])))
    assert R.extended.cache_info().currsize < 500
