"""Language identification: script ranges, character n-gram scores per word, Viterbi over the words of a text.

A word's score for a language is the mean log probability of its character n-grams under that language. Languages
seldom written in the word's script are ruled out first. Viterbi then labels every word with the language that
maximises the sum of scores less a penalty per switch, so a mixed text falls into spans; the text's language
is the one with the most letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.encoding import slices
from spanquarry.llm.tables import batch_of, rows_of

#: Labelled documents a model is fitted on at most, per language.
MOST_LABELLED = 2_000
#: Characters read of all labelled documents of one language at most.
MOST_CHARS = 4_000_000
#: Distinct n-grams kept per language, the most frequent first.
MOST_GRAMS = 60_000
#: Lengths of the character n-grams of a word with its edges marked.
GRAMS = (1, 2, 3)
#: Log-probability lost by a change of language between neighbouring words.
SWITCH = 4.0
#: Share of a language's letters below which it is ruled out for a script.
SCRIPT_SHARE = 0.01
#: Words whose scores a task remembers.
MOST_WORDS = 300_000

# fixed values: first code points of script ranges, by Unicode block
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Indic"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"),
    (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"),
    (0xFB00, "Other"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"),
)
_STARTS = [s for s, _ in SCRIPTS]
_NAMES = [n for _, n in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")


def script(word: str) -> str:
    """The script of a word's first letter."""
    return _NAMES[max(0, bisect_right(_STARTS, ord(word[0])) - 1)]


def _grams(word: str):
    marked = f"<{word}>"
    for n in GRAMS:
        for i in range(len(marked) - n + 1):
            yield marked[i : i + n]


@dataclass
class Model:
    languages: list[str]
    grams: dict[str, int]  # row of each n-gram
    table: np.ndarray  # log probabilities by n-gram and language; row 0 is for unseen n-grams
    scripts: dict[str, np.ndarray]  # script -> which languages may be written in it

    def score(self, words: list[str]) -> np.ndarray:
        """One row of scores per word."""
        get, rows, sizes = self.grams.get, [], []
        for word in words:
            m, before = f"<{word}>", len(rows)
            for n in GRAMS:
                rows += [get(m[i : i + n], 0) for i in range(len(m) - n + 1)]
            sizes.append(len(rows) - before)
        first = np.cumsum(sizes) - sizes
        out = np.add.reduceat(self.table[rows], first, axis=0) / np.float32(len(GRAMS))
        by_script = defaultdict(list)
        for n, word in enumerate(words):
            by_script[script(word)].append(n)
        for name, at in by_script.items():
            may = self.scripts.get(name)
            if may is not None and not may.all():
                out[np.ix_(at, ~may)] = out[at].min(axis=1, keepdims=True) - np.float32(20)
        return out


def fit(labelled: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Fit on labelled rows (text, lang): of each language at most ``most`` documents, those of the smallest hash.

    Documents of a language are cut at ``MOST_CHARS`` characters together. n-gram counts are smoothed by one.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    count = rows.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(2.0 * most) / F.col("count"))
    some = rows.join(F.broadcast(count), "lang").where((F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)))
    kept, chars = defaultdict(list), Counter()
    for row in some.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("text").alias("h"), "text"))), 1, most).alias("rows")).toLocalIterator():
        for r in row["rows"]:
            if chars[row["lang"]] < MOST_CHARS:
                kept[row["lang"]].append(r["text"])
                chars[row["lang"]] += len(r["text"])
    languages = sorted(kept)
    counts, letters = [], []
    for lang in languages:
        words: Counter = Counter()
        for text in kept[lang]:
            words.update(_LETTERS.findall(text.lower()))
        grams, scripts = Counter(), Counter()
        for word, n in words.items():
            scripts[script(word)] += n * len(word)
            for g in _grams(word):
                grams[g] += n
        counts.append(dict(grams.most_common(MOST_GRAMS)))
        letters.append(scripts)
    vocabulary = sorted(set().union(*counts)) if counts else []
    totals = np.array([sum(c.values()) + len(vocabulary) + 1 for c in counts] or [1], np.float64)
    table = np.log(np.array([[1] * max(1, len(counts)), *([c.get(g, 0) + 1 for c in counts] for g in vocabulary)]).reshape(-1, max(1, len(counts))) / totals)
    scripts = {}
    for name in set().union(*letters) if letters else ():
        may = np.array([s[name] >= SCRIPT_SHARE * max(1, sum(s.values())) for s in letters])
        if may.any():
            scripts[name] = may
    return Model(languages, {g: n + 1 for n, g in enumerate(vocabulary)}, table.astype(np.float32), scripts)


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best label of every word of several texts at once; a text's scores are (words, languages)."""
    if not scores:
        return []
    order = np.argsort([-len(s) for s in scores], kind="stable")
    sizes = np.array([len(scores[i]) for i in order])
    steps, states = int(sizes[0]), scores[order[0]].shape[1]
    alive = np.searchsorted(-sizes, -np.arange(steps), "left")  # texts longer than each step
    flat = np.concatenate([scores[i] for i in order])
    base = np.cumsum(sizes) - sizes
    value = np.zeros((len(scores), states), np.float32)
    back = np.empty((int(alive.sum()), states), np.int16)
    at = np.concatenate([[0], np.cumsum(alive)])
    own = np.arange(states, dtype=np.int16)
    for t in range(steps):
        n = alive[t]
        held = value[:n]
        best = held.argmax(axis=1)
        top = held[np.arange(n), best] - np.float32(switch)
        move = top[:, None] > held
        back[at[t] : at[t + 1]] = np.where(move, best[:, None].astype(np.int16), own)
        value[:n] = np.where(move, top[:, None], held) + flat[base[:n] + t]
    state = value.argmax(axis=1)
    path = np.empty(len(flat), np.int16)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        path[base[:n] + t] = state[:n]
        state[:n] = back[at[t] : at[t + 1]][np.arange(n), state[:n]]
    out: list = [None] * len(scores)
    for k, i in enumerate(order):
        out[i] = path[base[k] : base[k] + sizes[k]]
    return out


class Labeller:
    """Labels texts; remembers the scores of words it has met."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.table = np.empty((1024, len(model.languages)), np.float32)

    def _rows(self, words: set[str]) -> None:
        if len(self.index) + len(words) > MOST_WORDS:
            self.index.clear()
        new = list(words.difference(self.index))
        held = len(self.index)
        while held + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        for n in range(0, len(new), 20_000):
            part = new[n : n + 20_000]
            self.table[held + n : held + n + len(part)] = self.model.score(part)
        self.index.update(zip(new, range(held, held + len(new))))

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """(language, share of the letters in it, spans (language, words)) of each text."""
        names, cut = self.model.languages, [_LETTERS.findall(t.lower()) for t in texts]
        if not names:
            return [("und", 0.0, [])] * len(texts)
        self._rows(set().union(*cut))
        get = self.index.__getitem__
        at = [np.fromiter(map(get, words), np.int32, len(words)) for words in cut]
        full = [i for i, words in enumerate(cut) if words]
        paths = dict(zip(full, viterbi([self.table[at[i]] for i in full])))
        out = []
        for i, words in enumerate(cut):
            if not words:
                out.append(("und", 0.0, []))
                continue
            path = paths[i]
            size = np.fromiter(map(len, words), np.int64, len(words))
            letters = np.bincount(path, size, len(names))
            best = int(letters.argmax())
            edge = np.flatnonzero(np.diff(path, prepend=-1))
            spans = list(zip([names[k] for k in path[edge].tolist()], np.diff(np.append(edge, len(path))).tolist()))
            out.append((names[best], float(letters[best] / letters.sum()), spans))
        return out


def predict(docs: DataFrame, model: Model, keep_spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred (`und` if the text is null or has no letter) and score, the share of the letters that
    Viterbi gives to that language; with ``keep_spans`` also the labelled spans of words.

    Only the text is used. Ties go to the language that sorts first; empty tables give no rows; columns of ``docs`` that are
    named like one of these are replaced.
    """
    # the state alone: executors may not be able to import the class
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    docs = docs.drop(*["lang_pred", "score", "spans"][: 2 + keep_spans])
    columns = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    made = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())])))])

    def label(batches):
        known = Model.__new__(Model)
        known.__dict__.update(held.value)
        labeller = Labeller(known)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices([len(t) for t in texts], 1_000_000):
                lang, score, spans = zip(*labeller.label(texts[a:b]))
                spans = [[{"lang": n, "words": k} for n, k in s] for s in spans] if keep_spans else [None] * (b - a)
                extra = batch_of(made, lang, score, spans)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in columns), *extra.columns[: 2 + keep_spans]],
                    names=[*columns, *made.names[: 2 + keep_spans]],
                )

    return docs.mapInArrow(label, f"{kinds}, lang_pred string, score double" + ", spans array<struct<lang:string,words:int>>" * keep_spans)


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
