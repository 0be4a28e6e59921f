"""Cheapest repair of the turn structure of conversations, by a suffix-shared DAWG of their signatures.

A conversation's *signature* has one letter per row: the initial of the role where the grammar knows it, in capitals
where the row is truncated, and ``x`` where the row has to go. Distinct signatures are sorted by their reversal, so those that share an
ending follow each other and each ending is walked once. Endings with the same steps and relative costs are one automaton node, made
once: it holds, for each grammar state, the cost to go and the first step of the best audit; the rest of the audit is
that of the node and state the step leads to.
"""

from __future__ import annotations

from functools import cache
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.ordered import EMPTY_SHA256, crc32_sql, joined_sha256
from spanquarry.llm.tables import batch_of, stored

#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
#: Costs of an edit, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar `(s?(ua)+)?` of role initials: states begin, after s, after u, after a. Where a kept row leads, and an inserted or reroled one.
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
GIVEN = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}

_LEGAL = {"su", "ua", "au"}


class Node(NamedTuple):
    """Equivalent endings: costs to go by state, less the smallest; what that adds to the next node; first steps and where they lead."""

    costs: tuple[int, ...]
    more: int
    steps: tuple[str, ...]
    states: tuple[int, ...]


END = Node((0, 6, 3, 0), 0, ("", "II", "I", ""), (0, 3, 3, 3))


@cache  # relative costs are bounded by those of a few edits, so there are few nodes, however many endings
def extended(letter: str, costs: tuple[int, ...]) -> Node:
    """The node of the endings of a node of ``costs`` with ``letter`` before them. A step is the letters up to and including the row's."""
    taken = []
    for state in range(4):
        ways = [(DELETE + costs[state], "D", state)]
        if letter != "x":
            stay = TRUNCATED if letter.isupper() else 0
            to = KEPT.get(letter.lower(), {}).get(state)
            if to is not None:
                ways.append((stay + costs[to], "K", to))
            ways.append((REROLE + stay + costs[GIVEN[state]], "R", GIVEN[state]))
        taken.append(min(ways))

    def inserted(state: int, best: list) -> tuple:
        cost, step, to = best[GIVEN[state]]
        return min(taken[state], (INSERT + cost, "I" + step, to))

    # a second insertion pays only where the first one leads to a state that cannot take the row
    late = [taken[0], taken[1], inserted(2, taken), inserted(3, taken)]
    totals, steps, states = zip(inserted(0, late), inserted(1, late), late[2], late[3])
    least = min(totals)
    return Node(tuple(t - least for t in totals), least, steps, states)


def _audits():
    """Signatures sorted by their reversal, with the cost and the letters of the best edits."""
    schema = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def audits(batches):
        path, total, before = [END], 0, ""  # nodes of the endings of the last signature, shortest first
        for batch in batches:
            out = []
            for signature, back in zip(*(batch.column(c).to_pylist() for c in ("signature", "back"))):
                same = len(commonprefix([back, before]))
                while len(path) > same + 1:
                    total -= path.pop().more
                for letter in back[same:]:
                    path.append(extended(letter, path[-1].costs))
                    total += path[-1].more
                before, state, letters = back, 0, []
                for node in reversed(path):
                    letters.append(node.steps[state])
                    state = node.states[state]
                out.append((signature, total + path[-1].costs[0], "".join(letters)))
            yield batch_of(schema, *(zip(*out) if out else [[]] * 3))

    return audits


def best_audits(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit of every distinct signature."""
    distinct = signatures.select("signature").distinct().withColumn("back", F.reverse("signature"))
    return distinct.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(_audits(), "signature string, cost bigint, audit string")


def _profiles():
    """One row per conversation from its sorted, counted rows."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal"]

    def profiles(batches):
        held, letters = None, []
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *((n, pa.int64()) for n in names), ("signature", pa.string())])
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "again", "n"))
            for conv, turn, initial, fault, again, n in zip(*columns):
                if held is None or held["conv"] != conv:
                    if held is not None:
                        out.append(told(held, letters))
                    held, letters = {"conv": conv, "low": None, "high": None, "turns": 0, "before": None, **dict.fromkeys(names, 0)}, []
                if fault == "gone":
                    continue
                if turn is not None and turn != held["high"]:
                    held["low"] = turn if held["low"] is None else held["low"]
                    held["high"] = turn
                    held["turns"] += 1
                if held["before"] is not None:
                    held["illegal"] += held["before"] + initial not in _LEGAL
                held["illegal"] += n - 1  # copies follow each other with one initial
                held["before"] = initial
                letter = initial if initial in KEPT else "o"
                if fault == "blank" or again:
                    held["blank" if fault == "blank" else "duplicate"] += n
                    letters.append("x" * n)
                else:
                    held["duplicate"] += n - 1
                    held["truncated"] += fault == "truncated"
                    letters.append((letter.upper() if fault == "truncated" else letter) + "x" * (n - 1))
            yield batch_of(schema, *(zip(*out) if out else [[]] * len(schema)))
        if held is not None:
            yield batch_of(schema, *zip(told(held, letters)))

    def told(held, letters):
        if held["turns"]:
            held["gaps"] = held["high"] - held["low"] + 1 - held["turns"]
        return (held["conv"], *(held[n] for n in names), "".join(letters))

    return profiles


def _repaired():
    """Rows of the repaired conversation; each conversation's audit comes before its rows."""
    names = ["conv_id", "place", "edit", "role", "text"]

    def repaired(batches):
        schema, held, letters, state, place, at = None, None, "", 0, 0, 0
        out = []

        def put(edit, role, text):
            nonlocal place
            out.append((held, place, edit, role, text))
            place += 1

        def insert():
            nonlocal state, at
            while at < len(letters) and letters[at] == "I":
                state = GIVEN[state]
                put("I", ROLES[state], "")
                at += 1

        for batch in batches:
            schema = pa.schema(list(zip(names, [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()])))
            for conv, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
                if audit is not None:
                    insert()
                    held, letters, state, place, at = conv, audit, 0, 0, 0
                    continue
                insert()
                edit = letters[at]
                at += 1
                if edit == "K":
                    state = KEPT[role[0]][state]
                    put(edit, role, text)
                elif edit == "R":
                    state = GIVEN[state]
                    put(edit, ROLES[state], text)
                if len(out) > 10_000:
                    yield batch_of(schema, *zip(*out))
                    out.clear()
            if out:
                yield batch_of(schema, *zip(*out))
                out.clear()
        insert()
        if out:
            yield batch_of(schema, *zip(*out))

    return repaired


def repair(turns: DataFrame, gone: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Report and repaired rows of conversations (conv_id, turn, role, text).

    Rows go by turn (null first); those of one turn by role and a digest of the text, so equal rows follow each other. Rows where ``gone`` holds
    only say that the conversation exists. Null role or text is empty. A null conv_id is a conversation of its own.

    Report, per conversation: gaps (turns missing between the smallest and the largest), blank, duplicate and truncated (first fault
    of each row: without a character that is no ASCII white space; same role and text seen earlier; last such character not one of ``.!?``), illegal
    (neighbours whose role initials are not su, ua or au), cost and audit (letters of the cheapest edits, the ASCII-least
    of equal ones) of repair to `(s?(ua)+)?`: Keep 0, Rerole to user or assistant 3, Delete 4 (blank and duplicate rows must go), Insert 3; truncated rows that stay
    cost 3 more. A role without a first character, or with another one, can only be reroled or deleted.

    Repaired rows: conv_id, place (from 0), edit (K, R or I), role, text; inserted ones have an empty text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    gone = F.lit(False) if gone is None else gone
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), gone.alias("gone"))
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = F.when(F.col("gone"), "gone").when(F.ltrim("text", F.lit(SPACES)) == "", "blank").when(~last.isin(*".!?"), "truncated").otherwise("")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = stored(rows.select("*", fault.alias("fault"), digest.alias("digest")), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    counted = rows.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.count("*").cast("bigint").alias("n"))
    first = F.struct(F.col("turn").isNotNull().alias("timed"), "turn")
    firsts = rows.where("NOT gone").groupBy("conv_id", "digest").agg(F.min(first).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    seen = counted.join(firsts.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"), same, "left")
    seen = seen.withColumns({"again": F.coalesce(F.col("first") < first, F.lit(False)), "initial": F.substring("role", 1, 1)})
    kind = turns.schema["conv_id"].dataType.simpleString()
    profiles = stored(
        seen.select("conv_id", "turn", "role", "digest", "initial", "fault", "again", "n").repartition("conv_id").sortWithinPartitions("conv_id", *order)
        .mapInArrow(_profiles(), f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, signature string"),
        "profiles",
    )
    report = stored(profiles.join(best_audits(profiles), "signature").drop("signature"), "repairs")
    nothing = {"audit": F.lit(None).cast("string"), "rank": F.lit(1)}
    audits = report.where("audit <> ''").select(
        "conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("digest"), "audit", F.lit(0).alias("rank"),
    )
    both = rows.where("NOT gone").select("conv_id", "turn", "role", "text", "digest").withColumns(nothing).unionByName(audits)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "rank", *order)
    repaired = ordered.select("conv_id", "audit", "role", "text").mapInArrow(
        _repaired(), f"conv_id {kind}, place bigint, edit string, role string, text string"
    )
    return report, repaired


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by crc32 of `conv_id:turn` modulo 20; nulls (but for conv_id and turn themselves) become one space.

    0 drops the row (``gone``), 1 empties its text, 2 removes `[.!?]` from it, 3 repeats the row, 4 sets its role to user.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"))
    how = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = rows.withColumn("how", how)
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("how") == 0).alias("gone"),
        F.explode(F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The report on damaged conversations with the digest of their repaired rows."""
    report, repaired = repair(damaged(conversations), F.col("gone"))
    lines = repaired.select(F.col("conv_id").alias("conv"), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = joined_sha256(lines, "conv", ["place"], "line", "\n")
    out = report.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return out.drop("conv").withColumns({"repaired_sha256": F.coalesce("sha256", F.lit(EMPTY_SHA256))}).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def oracle() -> str:
    """DuckDB: cheapest (cost, audit) of each ending and state by recursion from the last row."""
    key = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
    moved = lambda s, cost, letter: f"{{'c': ({s}).c + {cost}, 'a': '{letter}' || ({s}).a}}"

    def taken(state: int) -> str:
        kept = [f"CASE WHEN f.letter = '{x}' THEN {moved(f's{to[state]}', 'f.stay', 'K')} END" for x, to in KEPT.items() if state in to]
        rerole = f"CASE WHEN f.letter <> 'x' THEN {moved(f's{GIVEN[state]}', f'f.stay + {REROLE}', 'R')} END"
        return f"least({', '.join([moved(f's{state}', DELETE, 'D'), *kept, rerole])}) AS t{state}"

    best = {2: "t3", 3: "t2", 0: "l2", 1: "l2"}
    late = [f"least(t{s}, {moved(best[s], INSERT, 'I')}) AS l{s}" for s in (2, 3, 0, 1)]
    return f"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS how FROM conversations),
e AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM d WHERE how <> 0),
o AS (
  SELECT *, coalesce(conv_id::VARCHAR, '-') AS ck, left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role)::VARCHAR || ':' || role || text), copy) AS pos
  FROM e),
q AS (
  SELECT *, cut = '' AS blank, cut <> '' AND row_number() OVER (PARTITION BY ck, role, text ORDER BY pos) > 1 AS again,
    lag(ini) OVER (PARTITION BY ck ORDER BY pos) || ini NOT IN ('su', 'ua', 'au') AS odd
  FROM o),
f AS (
  SELECT *, CASE WHEN blank OR again THEN 'x' WHEN ini IN ('s', 'u', 'a') THEN ini ELSE 'o' END AS letter,
    CASE WHEN NOT blank AND NOT again AND right(cut, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS stay
  FROM q),
k AS (
  SELECT ck, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again) AS duplicate, count(*) FILTER (stay > 0) AS truncated, count(*) FILTER (odd) AS illegal
  FROM f GROUP BY ck),
g AS (
  SELECT ck, n + 1 AS pos, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS s2, {{'c': 0, 'a': ''}} AS s3 FROM k
  UNION ALL
  SELECT ck, pos, l0, l1, l2, l3 FROM (
    SELECT f.ck, f.pos, {', '.join(taken(s) for s in range(4))}, {', '.join(late)}
    FROM g JOIN f ON f.ck = g.ck AND f.pos = g.pos - 1)),
w AS (SELECT ck, s0.c AS cost, s0.a AS audit FROM g WHERE pos = 1),
x AS (SELECT ck, unnest(range(1, length(audit) + 1)) AS i, audit[i] AS edit, i - length(replace(audit[1:i], 'I', '')) AS ins FROM w),
y AS (
  SELECT x.ck, x.i, x.edit, f.ini, f.role, f.text, row_number() OVER (PARTITION BY x.ck ORDER BY i) AS j
  FROM x LEFT JOIN f ON f.ck = x.ck AND f.pos = x.i - x.ins AND x.edit <> 'I' WHERE x.edit <> 'D'),
z AS (
  SELECT y.ck, y.i, CASE WHEN y.edit = 'K' THEN y.role WHEN (y.j - (h.ck IS NOT NULL)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role,
    CASE WHEN y.edit = 'I' THEN '' ELSE y.text END AS text
  FROM y LEFT JOIN (SELECT ck FROM y WHERE j = 1 AND edit = 'K' AND ini = 's') h USING (ck)),
r AS (SELECT ck, sha256(string_agg(role || ':' || text, chr(10) ORDER BY i)) AS digest FROM z GROUP BY ck)
SELECT c.conv_id, coalesce(k.gaps, 0)::BIGINT AS gaps, coalesce(k.blank, 0)::BIGINT AS blank, coalesce(k.duplicate, 0)::BIGINT AS duplicate,
  coalesce(k.truncated, 0)::BIGINT AS truncated, coalesce(k.illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost,
  coalesce(w.audit, '') AS audit, coalesce(r.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '-') AS ck FROM conversations) c
LEFT JOIN k USING (ck) LEFT JOIN w USING (ck) LEFT JOIN r USING (ck)"""
