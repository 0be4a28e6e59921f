"""Encoding, packing, token files and unigram counts against whole-text encoding and brute force."""

import math
import random
import zlib
from collections import Counter as Counts

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanquarry.llm.encoding import Encoder, encoder, forget
from spanquarry.llm.packing import Capacities, best_fit_pack, pack_lengths
from spanquarry.llm.tables import shared_folder
from spanquarry.llm.token_counts import Counter, Unigram, token_counts
from spanquarry.llm.token_files import read_token_files, token_digest, write_token_files

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ODD = ["", " ", "  a  b", "a ^ b ^c", "x\n\n y\t z  ", "don't 'tis I'll  go's", "<|endoftext|> a <|endoftext|>", "é x  y \x1c z", "1,2 3 45.", "日本 語 の", "é ́a á.", " \xa0 a\xa0b c", "a_. _b_ c"]


def plain(name):
    model = Tokenizer.from_file(public_tokenizers.path(name))
    model.encode_special_tokens = True
    return lambda text: model.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_encoder_equals_whole_text(name):
    encode, memo = plain(name), Encoder(public_tokenizers.path(name))

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet=" \n\t.,'^aAbé1_$", max_size=60)), min_size=1, max_size=4))
    def check(texts):
        got = memo.encode_many(texts)
        assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [encode(t) for t in texts]

    check()
    for text in ODD:
        assert np.frombuffer(memo.encode_many([text])[0], np.uint32).tolist() == encode(text), text


def test_encoder_forgets_without_changing_results(monkeypatch):
    monkeypatch.setattr("spanquarry.llm.encoding.MEMO_CHARS", 300)
    encode, memo = plain(NAMES[0]), Encoder(public_tokenizers.path(NAMES[0]))
    for n in range(8):
        text = prose(n, 60, 90)
        assert np.frombuffer(memo.encode_many([text])[0], np.uint32).tolist() == encode(text)


def test_words_of_a_batch_are_looked_up_once_and_letters_need_no_separator(monkeypatch):
    text, looked = prose(1, 500, 60) + " ǰ J̌ Straße İx " + prose(2, 500, 60), []

    class Memo(dict):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    for name in NAMES:
        encode, memo, lines = plain(name), Encoder(public_tokenizers.path(name)), []
        memo.memo, inner = Memo(), memo._lines
        monkeypatch.setattr(memo, "_lines", lambda words, *glue: lines.append((glue[0], len(words))) or inner(words, *glue))
        values, ends = memo.encode_array(pa.array([text, None, "", text + "  a"]))
        both = encode(text) + encode(text + "  a")
        assert values.tolist() == both and ends.tolist() == [len(encode(text))] * 3 + [len(both)]
        assert max(Counts(looked).values()) <= 2
        assert dict(lines)[" "] > 0
        looked.clear()


def test_capitals_line_ends_and_punctuation_make_no_new_words(monkeypatch):
    text = "The end.\nThe End, the\r\nEND! (the end)\tthe  end.\n\nEnd; a J̌ a T̈, Ḱ."
    encode, memo, seen = plain(NAMES[1]), Encoder(public_tokenizers.path(NAMES[1])), []
    inner = memo._lines
    monkeypatch.setattr(memo, "_lines", lambda words, *glue: seen.extend(words) or inner(words, *glue))
    plain_text = text[: text.index(" a J")]
    for some in ([plain_text, None, "", "THE\nEND"], [text, "The ^ x^{2} a^B"]):
        values, ends = memo.encode_array(pa.array(some))
        assert values.tolist() == [i for t in some for i in encode(t or "")]
        assert ends.tolist() == np.cumsum([len(encode(t or "")) for t in some]).tolist()
        if some[0] is plain_text:
            assert {w for w in seen if w[-1].isalpha()} == {"the", "end", "(the"} and len(seen) == len(set(seen))


@pytest.mark.parametrize("name", NAMES)
def test_punctuation_behind_letters_that_are_taken_apart(name):
    encode, memo = plain(name), Encoder(public_tokenizers.path(name))
    texts = ["a \u0130! a\u0130. b", "a \u0958, \u0958!", "a é! É.", "a \u0a33.\n\u095c;"]
    assert [np.frombuffer(g, np.uint32).tolist() for g in memo.encode_many(texts)] == [encode(t) for t in texts]


def test_encoders_are_let_go():
    first = encoder(public_tokenizers.path(NAMES[0]))
    assert encoder(public_tokenizers.path(NAMES[0])) is first
    forget()
    assert encoder(public_tokenizers.path(NAMES[0])) is not first


def best_fit(lengths, capacity):
    """Best-fit decreasing, one item after the other."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room[room.index(min(fits))] -= length
        else:
            room.append(capacity - length)
    return sorted(room)


@pytest.mark.parametrize("seed", range(8))
def test_layout_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [r.choice([r.randint(1, 64), 5, 30]) for _ in range(r.randint(1, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, spans = {}, {}
    for length, first_rank, n, first_bin, per, offset in pack_lengths(counts, 64):
        for i in range(n):
            b, at = first_bin + i // per, offset + i % per * length
            spans.setdefault(b, []).append((at, at + length))
            used[length] = used.get(length, 0) + 1
    assert used == counts
    for places in spans.values():
        places.sort()
        assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:])) and places[-1][1] <= 64
    assert sorted(64 - max(p[1] for p in s) for s in spans.values()) == best_fit(lengths, 64)


def test_capacities_find_the_tightest():
    r, tree, held = random.Random(3), Capacities(100), set()
    for _ in range(2000):
        x = r.randint(0, 100)
        (held.add if r.random() < 0.4 else held.discard)(x)
        tree.set(x, x in held)
        need = r.randint(0, 100)
        assert tree.tightest(need) == min((h for h in held if h >= need), default=None)


def test_packing(spark):
    encode = plain(NAMES[0])
    rows = [(1, prose(1, 900)), (2, None), (3, ""), (4, prose(4, 30)), (4, prose(4, 30)), (None, "a b"), (7, prose(7, 40))]
    got = [r.asDict() for r in best_fit_pack(docs(spark, rows).withColumn("length", F.lit(1)), public_tokenizers.path(NAMES[0]), capacity=256).collect()]
    want = []
    for key, text in rows:
        ids = encode(text or "") + [2]
        cut = list(range(len(ids) % 256 or 256, len(ids) + 1, 256))
        for piece, (a, b) in enumerate(zip([0, *cut], cut)):
            want.append((key, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got], key=order) == sorted(want, key=order)
    spans = {}
    for g in got:
        spans.setdefault(g["sequence_id"], []).append((g["offset"], g["offset"] + g["length"]))
    for places in spans.values():
        places.sort()
        assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:])) and places[-1][1] <= 256
    assert len(spans) == len(best_fit([w[3] for w in want], 256))
    assert best_fit_pack(docs(spark, []), public_tokenizers.path(NAMES[0])).count() == 0


def test_token_files(spark):
    encode = plain(NAMES[1])
    rows = [(9, prose(9, 300)), (3, None), (5, "The end. "), (4, ""), (100, prose(2, 2000))]
    path = shared_folder(spark, "files")
    write_token_files(docs(spark, rows).withColumn("ids", F.lit("x")), path, public_tokenizers.path(NAMES[1]))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_digest(read_token_files(spark, path)).collect()}
    want, start = {}, 0
    for key, text in sorted(rows):
        ids = encode(text or "") + [1]
        want[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    assert {r.doc_id: r.ids for r in read_token_files(spark, path).where("doc_id = 5").collect()} == {5: encode("The end. ") + [1]}
    empty = shared_folder(spark, "files")
    write_token_files(docs(spark, []), empty, public_tokenizers.path(NAMES[1]))
    assert token_digest(read_token_files(spark, empty)).count() == 0


def brute_pieces(model, word):
    """Best (score, pieces) by recursion over the first piece."""
    best = {len(word): (0.0, 0)}
    for begin in range(len(word) - 1, -1, -1):
        tries = []
        for end in range(begin + 1, min(len(word), begin + model.longest) + 1):
            p = model.pieces.get(word[begin:end])
            if p is None and end == begin + 1:
                n = len(word[begin].encode())
                tries.append((best[end][0] + n * model.byte, best[end][1] - n))
            elif p is not None:
                tries.append((best[end][0] + p, best[end][1] - 1))
        best[begin] = max(tries, key=lambda x: (round(x[0], 9), x[1]))
    return -best[0][1]


def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = Unigram(path)
    assert math.isclose(sum(math.exp(p) for p in model.pieces.values()), 1, rel_tol=1e-9)
    words = ["the", "there", "thereby", "élan", "日本語", "a" * 40, "international", "internal", "x😀y", "zqxj"]
    assert Counter(model).count([" ".join(words)]) == [(len(words), sum(brute_pieces(model, "▁" + w) for w in words))]
    rows = [(1, "the cat\n sat "), (2, None), (3, ""), (1, "the cat\n sat "), (None, "x")]
    got = sorted(map(tuple, token_counts(docs(spark, rows), path).collect()), key=str)
    n = sum(brute_pieces(model, "▁" + w) for w in ("the", "cat", "sat"))
    assert got == sorted([(1, 3, n), (2, 0, 0), (3, 0, 0), (1, 3, n), (None, 1, brute_pieces(model, "▁x"))], key=str)
    assert token_counts(docs(spark, []), path).count() == 0
