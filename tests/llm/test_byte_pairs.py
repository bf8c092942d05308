"""Byte-level BPE against the library that the ranks are made for."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm import helpers as h
from vitrine.llm import byte_pairs as b
from vitrine.llm.catalog import op12_byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(b.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return b.build_vocabulary(b.read_ranks(RANKS))


def odd_texts():
    rnd = random.Random(5)
    letters = "aeiou thsn\n\t.'1é日\U0001F642\x00\x1c\x85　"
    mixed = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300))) for _ in range(400)]
    single = ["".join(rnd.choice("abt") for _ in range(rnd.randint(1, 90))) for _ in range(400)]
    long = ["a" * 3000, "ab" * 5000, " " * 2000, "\n" * 3000 + "x", "日" * 700, "we'll it's I'D <|endoftext|>"]
    return [None, "", *mixed, *single, *long]


def test_ids_equal_the_library(spark, library):
    rows = [*enumerate(odd_texts()), (None, "no id"), (5, "again"), (5, "again")]
    got = b.encode(h.frame(spark, rows, clash=True), RANKS, public_tokenizers.PATTERN, decoded=True)
    assert got.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    expected = [(doc, library.encode_ordinary(text or "")) for doc, text in rows]
    found = got.collect()
    assert h.ordered((r.doc_id, r.ids) for r in found) == h.ordered(expected)
    assert all(r.n_tokens == len(r.ids) for r in found)
    assert h.ordered((r.doc_id, bytes(r.decoded)) for r in found) == h.ordered((d, (t or "").encode()) for d, t in rows)
    back = b.decode(got.select("ids", "doc_id", "n_tokens"), RANKS)
    assert h.ordered((r.doc_id, bytes(r.decoded)) for r in back.collect()) == h.ordered((d, (t or "").encode()) for d, t in rows)
    assert b.encode(h.frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0
    assert [bytes(r.decoded) for r in b.decode(spark.sql("select 1L doc_id, cast(null as array<int>) ids"), RANKS).collect()] == [b""]


def test_the_query_equals_the_library(spark, small, library):
    expected = []
    for doc, text in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        digests = [hashlib.sha256(data).hexdigest() for data in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((doc, len(ids), *digests))
    assert h.ordered(op12_byte_bpe(spark, small).collect()) == h.ordered(expected)


def test_long_texts_are_matched_in_parts(monkeypatch, vocabulary, library):
    monkeypatch.setattr(b, "PART_CHARS", 7)
    encoder = b.Encoder(vocabulary, public_tokenizers.PATTERN, remembered=50)
    for text in odd_texts()[1:]:
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_both_ways_to_merge(monkeypatch, vocabulary, library):
    texts = odd_texts()[1:]
    expected = [i for text in texts for i in library.encode_ordinary(text)]
    for widths in ((), (4,), (8, 64)):
        monkeypatch.setattr(b, "WIDTHS", widths)
        assert b.Encoder(vocabulary, public_tokenizers.PATTERN).encode(texts)[0].tolist() == expected


def test_the_hash_is_perfect_and_minimal(vocabulary):
    tokens = b.read_ranks(RANKS)
    assert sorted(vocabulary.slots.tolist()) == list(range(len(tokens)))
    strings = b.Strings(vocabulary.data)
    assert (vocabulary.find(strings, vocabulary.offsets[:-1], vocabulary.offsets[1:]) == np.arange(len(tokens))).all()
    other = [bytes(reversed(token)) + b"\xff" for token in tokens]
    known = set(tokens)
    data = np.frombuffer(b"".join(other), np.uint8)
    ends = np.cumsum([len(t) for t in other])
    found = vocabulary.find(b.Strings(data), ends - [len(t) for t in other], ends)
    assert [i >= 0 for i in found.tolist()] == [t in known for t in other]


def test_ranks_have_no_gaps(tmp_path):
    path = tmp_path / "gap.tiktoken"
    path.write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        b.read_ranks(str(path))
