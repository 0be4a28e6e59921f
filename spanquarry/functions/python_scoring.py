"""Arrow-batched helpers for the few rules that column expressions cannot state."""

from __future__ import annotations

import json
import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _shortened(text: str, levels: int | None, chars: int | None, items: int | None) -> tuple[str, bool]:
    """A JSON text within the limits, and whether anything was shortened. Works on the parsed tree in place."""
    try:
        tree = [json.loads(text)]
    except ValueError:
        return text[:chars], len(text[:chars]) < len(text)
    cut, open_places = False, [(tree, 0, 0)]
    while open_places:
        holder, place, level = open_places.pop()
        value = holder[place]
        if levels is not None and level > levels:
            short = str(value)[:chars]
            cut |= not isinstance(value, str) or len(short) < len(value)
            holder[place] = short
        elif isinstance(value, (dict, list)):
            places = list(value) if isinstance(value, dict) else list(range(len(value)))
            for extra in reversed(places[items:] if items is not None else []):
                del value[extra]
                cut = True
            open_places += [(value, kept, level + 1) for kept in places[:items]]
    return json.dumps(tree[0], ensure_ascii=False), cut


def payload_bound(payload: Column, depth_limit: int | None = None, text_limit: int | None = None, item_limit: int | None = None) -> Column:
    """A JSON column as struct (original, bounded, truncated).

    In ``bounded`` values nested deeper than ``depth_limit`` are strings of at most ``text_limit`` characters, objects and lists
    keep their first ``item_limit`` items, and text that is not JSON keeps its first characters. A limit of None, the
    default, leaves everything; ``truncated`` tells whether something was shortened.
    """

    @F.pandas_udf("struct<bounded: string, truncated: boolean>")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = [(None, False) if t is None else _shortened(t, depth_limit, text_limit, item_limit) for t in column]
        return pd.DataFrame(rows, columns=["bounded", "truncated"])

    out = run(payload)
    return F.struct(payload.alias("original"), out["bounded"].alias("bounded"), out["truncated"].alias("truncated"))


def bleu4(candidate: Column, reference: Column) -> Column:
    """Sentence BLEU-4 with brevity penalty, no smoothing; takes token arrays."""

    def one(cand, ref):
        if cand is None or ref is None:
            return None
        cand, ref = list(cand), list(ref)
        if len(cand) < 4 or not ref:
            return 0.0
        log_sum = 0.0
        for n in (1, 2, 3, 4):
            ours = Counter(zip(*(cand[i:] for i in range(n))))
            theirs = Counter(zip(*(ref[i:] for i in range(n))))
            matched = sum(min(count, theirs[gram]) for gram, count in ours.items())
            if matched == 0:
                return 0.0
            log_sum += math.log(matched / (len(cand) - n + 1))
        penalty = 1.0 if len(cand) >= len(ref) else math.exp(1 - len(ref) / len(cand))
        return penalty * math.exp(log_sum / 4)

    @F.pandas_udf("double")
    def run(cand: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([one(c, r) for c, r in zip(cand, ref)], dtype="float64")

    return run(candidate, reference)


def lcs_length(a, b) -> int:
    """Longest common in-order subsequence; one big-integer step per token of ``a``.

    Bit i of the state is 0 where the best match of the prefix grows at ``b[i]``, so whole machine
    words advance at once and texts of many thousand tokens stay cheap.
    """
    where: dict = {}
    for i, token in enumerate(b):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(b)) - 1
    state = full
    for token in a:
        match = where.get(token)
        if match:
            taken = state & match
            state = ((state + taken) | (state - taken)) & full
    return len(b) - state.bit_count()


def rouge_l(candidate: Column, reference: Column) -> Column:
    """ROUGE-L F1 of two token arrays; 0 when nothing is common."""

    def one(cand, ref):
        if cand is None or ref is None:
            return None
        if len(cand) == 0 or len(ref) == 0:
            return 0.0
        common = lcs_length(cand, ref)
        if common == 0:
            return 0.0
        precision, recall = common / len(cand), common / len(ref)
        return 2 * precision * recall / (precision + recall)

    @F.pandas_udf("double")
    def run(cand: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([one(c, r) for c, r in zip(cand, ref)], dtype="float64")

    return run(candidate, reference)
