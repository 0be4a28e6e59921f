"""Whole-text encoding with the tokenizers library and a bounded memo of words.

Both public vocabularies cut a text before every single space that stands between two non-space
characters, so the ids of a text are those of its words (each with the space before it) one after the
other. A word is encoded once per task. New words are encoded together, many to a line, because a call per word
costs more than the encoding itself. Where their ids begin is told by the vocabulary's mark of a space (byte-level) or of a
word's end (words of letters only); others get a separator between them.

The words of many texts are numbered by Arrow, so the memo is asked once for each different word of a batch, and
the ids of all its texts are one gathering by number. Where a vocabulary knows neither spaces, line ends nor capitals,
these and the punctuation behind words are taken apart before, so that fewer different words are left to be encoded.
"""

from __future__ import annotations

import os
import re
import string
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of words held in a memo before it becomes the old one and the old one goes.
MEMO_CHARS = 5_000_000
#: Characters of text worked on at once.
BATCH_CHARS = 4_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: ASCII punctuation but for ' and _: after a letter or digit, also as normalized, its ids do not depend on the word before.
_TAIL = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'_")
_BEFORE_TAIL = f"([a-zA-Z0-9])([{re.escape(_TAIL)}])"
#: A mark may compose with the small letter but not with the capital, so these stay.
_MARKED = r"[A-Z]\p{M}"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False)``.

    Special-token strings inside a text are ordinary text. ``SEPARATOR`` is one token in both
    vocabularies; words that hold it or, where spaces count, unusual white space are encoded apart.
    """

    SEPARATOR = "^"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.model._resize_cache(0)  # the memo below does its work
        self.memo: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.firsts: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.held = 0
        between = self._ids(f"a {self.SEPARATOR} a")[1:-1]
        if len(between) != 1:
            raise ValueError("the separator must be one token")
        self.mark = between[0]
        vocabulary = self.model.get_vocab()
        #: Tokens that hold the space before a word; or, where spaces leave no trace, those that end a word.
        self.spaced = any(token.startswith("Ġ") for token in vocabulary) and not any(token.endswith("</w>") for token in vocabulary)
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for token, i in vocabulary.items() if (token.startswith("Ġ") if self.spaced else token.endswith("</w>"))]] = True
        #: Neither white space, ASCII capitals nor a space before punctuation leave a trace.
        probe = "\t".join(string.ascii_uppercase) + "".join(f"\r\n1{c}\na{c}" for c in _TAIL)
        self.loose = not self.spaced and self._ids(probe) == self._ids(re.sub(_BEFORE_TAIL, r"\1 \2", re.sub(r"\s", " ", probe)).lower())

    def _ids(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def _raw(self, text: str) -> bytes:
        return np.array(self._ids(text), np.uint32).tobytes()

    def _lines(self, words: list[str], between: str, end: str):
        """Some words and the ids of the line "a" and these words; a few lines are encoded at once."""
        parts = [words[n : n + 2_000] for n in range(0, len(words), 2_000)]
        for n in range(0, len(parts), 16):
            some = parts[n : n + 16]
            lines = self.model.encode_batch_fast([f"a{between}{between.join(part)}{end}" for part in some], add_special_tokens=False)
            for part, line in zip(some, lines):
                yield part, np.array(line.ids, np.uint32)

    def _learn(self, words: list[str]) -> None:
        memo = self.memo
        plain = words if self.spaced else [word for word in words if word.isalpha()]
        apart = [] if self.spaced else [word for word in words if not word.isalpha()]
        for part, ids in self._lines(plain, " ", ""):
            at = np.flatnonzero(self.edge[ids])
            at = np.append(at, len(ids)) if self.spaced else at + 1
            if len(at) == len(part) + 1:
                at, raw = (at * 4).tolist(), ids.tobytes()
                memo.update(zip(part, [raw[a:b] for a, b in zip(at, at[1:])]))
            else:  # a letter that the vocabulary's normalizer takes apart
                apart += part
        glue = f" {self.SEPARATOR} "
        for part, ids in self._lines(apart, glue, glue[:-1]):
            at = (np.flatnonzero(ids == self.mark) * 4).tolist()
            if len(at) != len(part) + 1:
                raise ValueError("separators were lost")
            raw = ids.tobytes()
            memo.update(zip(part, [raw[a + 4 : b] for a, b in zip(at, at[1:])]))

    def _meet(self, new: set[str]) -> None:
        """Fill the memo with new words; a word whose ids depend on its neighbours gets None."""
        memo, tails, split, plain = self.memo, self.tails, [], set()
        known = new.intersection(self.old)
        memo.update((word, self.old[word]) for word in known)
        self.held += sum(map(len, known))
        new = new.difference(known)
        for word in new:
            if word.isalpha():
                plain.add(word)
            elif not word or self.SEPARATOR in word or not self.loose and (word[0].isspace() or word[-1].isspace()):
                memo[word] = self._raw(word) if self.loose else None
            elif (head := word.rstrip(_TAIL)) != word and head and unicodedata.normalize("NFC", head[-1]).lower()[-1].isalnum():
                tail = word[len(head) :]
                split.append((word, head, tail))
                if head not in memo:
                    if head in self.old:
                        memo[head] = self.old[head]
                    else:
                        plain.add(head)
                if tail not in tails:
                    tails[tail] = np.array(self._ids("a" + tail)[1:], np.uint32).tobytes()
            else:
                plain.add(word)
        self._learn(list(plain))
        for word, head, tail in split:
            memo[word] = memo[head] + tails[tail]
        self.held += sum(map(len, new)) + sum(map(len, plain))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids end; null counts as empty."""
        if self.held > MEMO_CHARS:
            self.old, self.memo, self.held = self.memo, {}, 0
            self.firsts.clear()
            self.tails.clear()
        texts = pc.fill_null(texts, "")
        if self.loose:
            texts = self._loosened(texts)
        cut = pc.split_pattern(texts, " ")
        edge = cut.offsets.to_numpy().astype(np.int64)
        edge -= edge[0]
        coded = cut.flatten().dictionary_encode()
        at, words = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        del cut, coded
        self._meet(set(words).difference(self.memo))
        pieces = [*map(self.memo.__getitem__, words)]
        if not self.loose:
            self._corrected(texts, words, edge, at, pieces)
        _, offsets, data = pa.array(pieces, pa.large_binary()).take(pa.array(at)).buffers()
        ends = np.frombuffer(offsets, np.int64)[edge[1:]] // 4
        return np.frombuffer(data or b"", np.uint32, int(ends[-1])), ends

    def _loosened(self, texts: pa.Array) -> pa.Array:
        """The texts with fewer different words and the same ids, for a vocabulary in which spaces and capitals leave no trace."""
        for space in "\n\r\t":
            texts = pc.replace_substring(texts, space, " ")
        texts = pc.if_else(pc.match_substring_regex(texts, _MARKED), texts, pc.ascii_lower(texts))
        return pc.replace_substring_regex(texts, _BEFORE_TAIL, r"\1 \2")

    def _corrected(self, texts: pa.Array, words: list[str], edge: np.ndarray, at: np.ndarray, pieces: list[bytes | None]) -> None:
        """Where spaces count: the first word of a text has none before it, and some words depend on their neighbours."""
        odd = np.fromiter((piece is None for piece in pieces), bool, len(pieces))
        uneven = np.flatnonzero(np.logical_or.reduceat(odd[at], edge[:-1])) if odd.any() else ()
        begin, firsts = edge[:-1], self.firsts
        which, first = np.unique(at[begin], return_inverse=True)
        for word in map(words.__getitem__, which.tolist()):
            if word not in firsts:
                firsts[word] = self._raw(word)
                self.held += len(word)
        at[begin] = len(pieces) + first
        pieces += [firsts[words[i]] for i in which.tolist()]
        nothing = len(pieces)
        pieces.append(b"")
        for i in uneven:
            at[edge[i] : edge[i + 1]] = nothing
            at[edge[i]] = len(pieces)
            pieces.append(self._uneven(texts[int(i)].as_py()))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        values, ends = self.encode_array(pa.array(texts, pa.string()))
        raw, ends = values.tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _uneven(self, text: str) -> bytes:
        """A text with runs of white space or the separator: only what lies between sure cuts is taken from the memo."""
        memo, out, pending, begin = self.memo, [], [], 0
        for at in [*(m.start() for m in _CUT.finditer(text)), len(text)]:
            piece, begin = text[begin:at], at
            known = memo.get(piece[1:]) if piece[:1] == " " else None
            if known is None:
                pending.append(piece)
            else:
                if pending:
                    out.append(self._raw("".join(pending)))
                    pending.clear()
                out.append(known)
        return b"".join([*out, self._raw("".join(pending))])


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which later tasks of the worker find warm."""
    held = sys.modules.setdefault("spanquarry_worker_memo", types.ModuleType("spanquarry_worker_memo")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def forget() -> None:
    """Let the encoders of this Python worker go: other work that needs its memory begins."""
    sys.modules.pop("spanquarry_worker_memo", None)


def encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """doc_ids, the ids of their texts one after the other, each with ``end_id`` behind it, and where each one ends."""
    memo = encoder(tokenizer)
    for batch in batches:
        keys, texts = batch.column("doc_id"), batch.column("text")
        for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
            values, ends = memo.encode_array(texts.slice(a, b - a))
            yield keys.slice(a, b - a).to_pylist(), np.insert(values, ends, end_id), ends + np.arange(1, len(ends) + 1)


def slices(lengths: list[int], most: int = BATCH_CHARS):
    """Ranges of rows of about so many characters; a longer text is a range of its own."""
    begin = held = 0
    for n, length in enumerate(lengths):
        held += length
        if held >= most:
            yield begin, n + 1
            begin, held = n + 1, 0
    if begin < len(lengths):
        yield begin, len(lengths)
