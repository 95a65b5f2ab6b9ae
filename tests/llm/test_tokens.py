"""Byte-level BPE and packing against the public tokenizers."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrace.llm import bytepair, packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    with open(public.path(bytepair.VOCABULARY), "rb") as file:
        return bytepair.codec(file.read(), public.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="aeinrst '\n1", max_size=200))
def test_bpe_agrees_with_tiktoken(codec, reference, text):
    assert ids(codec, text) == reference.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_bpe_backtracks_as_the_merges_do():
    ranks = {bytes([b]): b for b in range(256)}
    for word in ("ab", "bc", "abc", "cd", "bcd", "dd", "abcd"):
        ranks[word.encode()] = len(ranks)
    own, rng = bytepair.Codec(ranks, ".+"), random.Random(1)
    for _ in range(500):
        data = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 30)))
        assert [own.bytes_of[i] for i in own.encode_piece(data)] == ([data] if data in ranks else bytepair.merge(ranks, data))


def test_bpe_is_linear_in_long_pieces(codec, reference):
    for text in ("a" * 200_000, "ab" * 100_000):
        assert len(ids(codec, text)) > 0 and codec.decode(codec.encode(text)) == text.encode()
    assert ids(codec, "ab" * 2_000) == reference.encode_ordinary("ab" * 2_000)


def test_bpe_query(spark, reference):
    rows = {r.doc_id: r for r in bytepair.op7_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        expected = np.array(reference.encode_ordinary(d.text or ""), "<u4")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(expected), hashlib.sha256(expected.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_bpe_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "x", 1), (3, "x", 1), (3, "x", 1)], "doc_id long, text string, ids int")
    path = public.path(bytepair.VOCABULARY)
    rows = bytepair.encode_documents(docs, path, public.PATTERN).collect()
    assert sorted((r.n_tokens, bytes(r.decoded)) for r in rows) == [(0, b""), (0, b""), (1, b"x"), (1, b"x"), (1, b"x")]
    assert bytepair.digest_documents(docs.where("false"), path, public.PATTERN).count() == 0


def test_word_by_word_is_the_whole_text():
    with open(public.path(packing.VOCABULARY), encoding="utf-8") as file:
        definition = file.read()
    tool, own, rng = Tokenizer.from_str(definition), packing.Encoder(definition), random.Random(2)
    assert own.direct
    odd = [32, 10, 0x1c, 0x85, 0xa0, 0x3a3, 0x130, 0x301, 0xaa, 0xb5, 0xd7, 0xf7, 0x1e9e, 39, 46]
    for _ in range(3000):
        text = "".join(chr(rng.choice([rng.randrange(1, 127), rng.randrange(0x80, 0x800), rng.randrange(0xC0, 0x100), rng.choice(odd)]))
                       for _ in range(rng.randrange(40)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tool.encode(text, add_special_tokens=False).ids


def packed(rows, capacity):
    """Sequences are gapless, within capacity and padded by nothing; every id lies in one piece."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0
    return by_doc


def test_packing_query(spark):
    tool = Tokenizer.from_file(public.path(packing.VOCABULARY))
    expected = {d.doc_id: np.array(tool.encode(d.text or "", add_special_tokens=False).ids + [2], "<u4")
                for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = packing.op9_packing(spark, SF).collect()
    by_doc = packed(rows, packing.CAPACITY)
    assert by_doc.keys() == expected.keys()
    for name, pieces in by_doc.items():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at and total == len(expected[name])
            at += length
        assert at == len(expected[name])
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(expected[r.doc_id][r.start:r.start + r.length].tobytes())


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 200), max_size=40), sequences=st.integers(0, 10))
def test_pack_fills_sequences(lengths, sequences):
    capacity = 64
    sequences = min(sequences, sum(lengths) // capacity)
    pieces, left = packing.pack([(n, i, 0) for i, n in enumerate(lengths)], sequences, capacity)
    assert sum(p[2] for p in pieces) == sequences * capacity
    assert sum(p[2] for p in pieces) + sum(n for n, _, _ in left) == sum(lengths)
    last = packing.tail([x for x in left if x[0]], 1 << 20)
    assert sum(p[2] for p in last) == sum(n for n, _, _ in left)


def test_pack_balances_cost():
    pieces, _ = packing.pack([(1024, i, 0) for i in range(4)] + [(16, 10 + i, 0) for i in range(256)], 2, 4096)
    costs = [sum(packing.cost(p[2]) for p in pieces if p[3] == k) for k in (0, 1)]
    assert max(costs) < 1.01 * min(costs)


def test_packing_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (None, "word", 7), (3, "word " * 6000, 7), (3, "word " * 6000, 7)],
                                 "doc_id long, text string, offset int")
    path = public.path(packing.VOCABULARY)
    rows = packing.pack_documents(docs, path, capacity=256, block=4, with_ids=True).collect()
    assert sum(r.length for r in rows) == 1 + 1 + 2 + 2 * 6001
    packed(rows, 256)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    assert packing.pack_documents(docs.where("false"), path).count() == 0


def test_a_part_of_a_word_is_encoded_and_kept_once():
    with open(public.path(packing.VOCABULARY), encoding="utf-8") as file:
        own = packing.Encoder(file.read())
    assert own.direct
    own.words.clear()
    assert own.encode("house House! HOUSE, house") == b"".join(map(own._whole, ("house", "House!", "HOUSE,", "house")))
    assert set(own.words) == {w.encode() for w in ("house", "House!", "HOUSE,", "HOUSE", "!", ",")} - {b"HOUSE"}
    # Only ASCII blanks separate words; others stay inside one.
    assert own.encode("a\x1cb\x85c\xa0d e") == own._whole("a\x1cb\x85c\xa0d") + own._whole("e")


def test_entries_are_looked_up_where_a_token_begins():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    ranks = {bytes([c]): c for c in range(256)} | {b"a" * 2 ** k: 255 + k for k in range(1, 5)}
    own = bytepair.Codec(ranks, public.PATTERN)
    own.entries = Counted(own.entries)
    data = b"a" * 16 * 100 + b"b"
    assert [own.bytes_of[i] for i in own.encode_piece(data)] == [b"a" * 16] * 100 + [b"b"]
    assert own.entries.asked == 101


def test_pairs_that_stay_are_those_the_merge_rules_leave(codec):
    rng = random.Random(5)
    tokens, pairs = list(codec.entries), []
    for token in rng.sample(tokens, 1500):  # tokens cut anywhere, so that parts meet as they do in texts
        parts = [bytepair.merge(codec.ranks, p) for p in (token[:len(token) // 2], token[len(token) // 2:]) if p]
        pairs += [(parts[0][-1], parts[-1][0])] + [(token, t) for t in (token, *rng.sample(tokens, 2))]
    assert codec.ordered
    for a, b in pairs:
        assert codec._stay(codec.ranks[a], codec.ranks[b]) == (bytepair.merge(codec.ranks, a + b) == [a, b])
    # Ranks that do not rise with the merges go by the plain rules.
    odd = bytepair.Codec({bytes([c]): c for c in range(256)} | {b"ab": 900, b"abc": 300, b"bc": 800}, public.PATTERN)
    assert not odd.ordered
    for text in ("abc", "abcabc", "ababc", "cabcab"):
        assert [odd.bytes_of[i] for i in odd.encode_piece(text.encode())] in (bytepair.merge(odd.ranks, text.encode()), [text.encode()])
