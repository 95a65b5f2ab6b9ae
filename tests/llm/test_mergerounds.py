"""Batched merge rounds against the public tokenizer."""

import hashlib
import json
import random

import pyarrow as pa
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrace.llm import mergerounds

PATH = public.path(mergerounds.VOCABULARY)
ODD = [32, 10, 0x1c, 0x85, 0xa0, 0x3a3, 0x130, 0x301, 0xaa, 0xb5, 0xd7, 0xf7, 0x1e9e, 39, 46, 0x1f600, 0x4e2d, 0x200d, 0xfeff, 0]


@pytest.fixture(scope="module")
def definition():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def codec(definition):
    return mergerounds.Codec(definition)


@pytest.fixture(scope="module")
def reference(definition):
    return Tokenizer.from_str(definition)


def check(codec, reference, texts):
    ids, bounds = codec.encode(pa.array(texts, pa.string()))
    for text, i, j in zip(texts, bounds, bounds[1:]):
        expected = reference.encode(text or "", add_special_tokens=False).ids
        assert ids[i:j].tolist() == expected
        assert codec.decode(ids[i:j]) == reference.decode(expected, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(max_size=60) | st.text(alphabet="aeinrst '\n1é", max_size=200), max_size=8))
def test_agrees_with_the_tokenizer(codec, reference, texts):
    check(codec, reference, texts)


def test_odd_texts(codec, reference):
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([rng.randrange(127), rng.randrange(97, 123), rng.randrange(0x80, 0x800), rng.randrange(0xC0, 0x100),
                                     rng.choice(ODD)])) for _ in range(rng.randrange(60))) for _ in range(2000)]
    check(codec, reference, texts + ["", None, "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext", "'s't're'LL don't I'M"])


def test_long_pieces(codec, reference):
    """Neighbourhoods instead of whole pieces: runs of one symbol and letters without order."""
    rng = random.Random(4)
    texts = ["a" * 777, "ab" * 900, "the" * 700, "!" * 500 + "?!" * 300, "ß" * 300]
    for alphabet in ("aab", "etaoinshr", "abcdefghijklmnopqrstuvwxyzéü", "=-"):
        texts += ["".join(rng.choice(alphabet) for _ in range(n)) for n in (65, 200, 3000)]
    check(codec, reference, texts)
    ids, _ = codec.encode(pa.array(["".join(rng.choice("etaoin") for _ in range(200_000))]))
    assert len(ids) > 50_000


def test_worker_memory_is_emptied(definition, reference, monkeypatch):
    monkeypatch.setattr(mergerounds, "WORDS_KEPT", 50)
    monkeypatch.setattr(mergerounds, "BATCH", 40)
    own, rng = mergerounds.Codec(definition), random.Random(6)
    for _ in range(30):
        check(own, reference, ["".join(rng.choice("abc ") for _ in range(100)) for _ in range(3)])
        assert len(own.words) < 50 + 110


def test_slices_of_a_column():
    column = pa.array(["a" * 10, None, "b" * 95, "", "c" * 10])
    parts = mergerounds.slices(column, 50)
    assert [i for a, b in parts for i in range(a, b)] == list(range(5)) and len(parts) > 1
    assert mergerounds.slices(column.slice(0, 0)) == []


def test_other_definitions_are_refused(definition):
    parts = json.loads(definition)
    swapped = {**parts, "model": {**parts["model"], "merges": parts["model"]["merges"][::-1]}}
    for wrong in (swapped, {**parts, "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}}):
        with pytest.raises(ValueError):
            mergerounds.Codec(json.dumps(wrong))


def test_query(spark, reference):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in mergerounds.op13_word_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = reference.encode(d.text or "", add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "x", 1), (3, "x y", 1), (3, "x y", 1), (4, "word " * 100_000, 1)],
                                 "doc_id long, text string, ids int")
    rows = mergerounds.encode_documents(docs, PATH).collect()
    assert sorted((r.n_tokens, r.decoded) for r in rows)[:5] == [(0, ""), (0, ""), (1, "x</w>"), (2, "x</w> y</w>"), (2, "x</w> y</w>")]
    assert max(r.n_tokens for r in rows) == 100_000 and all(len(r.ids) == r.n_tokens for r in rows)
    assert mergerounds.digest_documents(docs.where("false"), PATH).count() == 0
