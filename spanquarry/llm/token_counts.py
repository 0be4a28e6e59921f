"""Token counts under a unigram model, by dynamic programming shared along a trie of pre-tokens.

The model takes the pieces of a public vocabulary and Zipf's law over their ranks: log p = -ln(rank + 1) - ln(normaliser).
A pre-token's best segmentation has the largest sum of log p (then the fewest pieces). The best score of a prefix does not depend on what
follows, so in a trie of the distinct pre-tokens each prefix is scored once. The trie is walked depth first, which is the sorted order
of the pre-tokens: the scores along the current path are a stack, and what two neighbours share stays on it.
"""

from __future__ import annotations

import math
import sys
import types

import pyarrow as pa
from pyspark.sql import DataFrame

from spanquarry.llm.encoding import slices
from spanquarry.llm.tables import batch_of, rows_of

#: Put before every pre-token, as the vocabulary's pieces have it.
WORD_START = "▁"
#: Characters of pre-tokens whose counts are remembered before the memo is emptied.
MEMO_CHARS = 9_000_000


class Unigram:
    """Log probabilities of the pieces of a sentencepiece vocabulary.

    A character outside it costs its UTF-8 bytes, each as dear as the rarest piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        rank = {model.id_to_piece(i): n for n, i in enumerate(ids)}
        norm = math.log(sum(1 / (n + 1) for n in range(len(ids))))
        self.pieces = {piece: -math.log(n + 1) - norm for piece, n in rank.items()}
        self.byte = min(self.pieces.values())
        self.longest = max(map(len, self.pieces))


class Counter:
    """Piece counts of pre-tokens; remembers what it has met."""

    def __init__(self, model: Unigram):
        self.model, self.memo, self.held = model, {}, 0

    def _walk(self, words: list[str]) -> None:
        """Score sorted new pre-tokens; ``path[i]`` is (score, -pieces) of the best segmentation of i characters."""
        get, longest, byte = self.model.pieces.get, self.model.longest, self.model.byte
        path, before = [(0.0, 0)], ""
        for word in words:
            full = WORD_START + word
            shared, most = 0, min(len(full), len(before))
            while shared < most and full[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(full) + 1):
                raw = len(full[end - 1].encode("utf-8", "replace"))
                score, pieces = path[end - 1]
                best = None if full[end - 1] in self.model.pieces else (score + raw * byte, pieces - raw)
                for begin in range(max(0, end - longest), end):
                    p = get(full[begin:end])
                    if p is not None:
                        score, pieces = path[begin]
                        if best is None or (score + p, pieces - 1) > best:
                            best = (score + p, pieces - 1)
                path.append(best)
            self.memo[word], before = -path[-1][1], full

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, pieces) of each text."""
        if self.held > MEMO_CHARS:
            self.memo.clear()
            self.held = 0
        cut = [text.split() for text in texts]
        new = sorted(set().union(*cut).difference(self.memo))
        self._walk(new)
        self.held += sum(map(len, new))
        get = self.memo.__getitem__
        return [(len(words), sum(map(get, words))) for words in cut]


def counter(path: str) -> Counter:
    """The counter of this Python worker, which later tasks of the worker find warm."""
    held = sys.modules.setdefault("spanquarry_worker_memo", types.ModuleType("spanquarry_worker_memo")).__dict__
    if ("counts", path) not in held:
        held["counts", path] = Counter(Unigram(path))
    return held["counts", path]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every whole text; pre-tokens are what white space separates.

    Nothing is shuffled: each task scores the pre-tokens of its own documents. Null and empty texts count 0; every row gives one row;
    other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches):
        memo = counter(vocabulary)
        for keys, texts in rows_of(batches, "doc_id", "text"):
            texts = [t or "" for t in texts]
            for a, b in slices([len(t) for t in texts]):
                yield batch_of(schema, keys[a:b], *zip(*memo.count(texts[a:b])))

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
