"""Repeated words, repeated bytes and similar sets against brute force."""

import random

import pytest

from tests.llm import helpers as h
from vitrine.llm import exchange, repeated_bytes, similar_sets, words
from vitrine.llm.prefix_tree import PrefixTree, least_overlap
from vitrine.llm.repeated_words import levels, remove_repeated_words


def test_levels_double_up_to_the_window():
    assert levels(13) == [7, 13] and levels(13, 3) == [3, 6, 12, 13] and levels(1) == [1]


@pytest.mark.parametrize(("window", "first"), [(13, None), (4, 1), (6, 2), (1, None)])
def test_repeated_words(spark, window, first):
    rows = h.odd_rows()
    got = remove_repeated_words(h.frame(spark, rows, clash=True), window, first)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert h.ordered(got.collect()) == h.repeated_words(rows, window)


def test_repeated_words_of_the_earliest_document_stay(spark):
    text = " ".join(f"w{n}" for n in range(20))
    got = remove_repeated_words(h.frame(spark, [(5, text), (3, "x " + text), (None, text), (5, text)]))
    assert sorted((r.doc_id or 0, r.n_removed) for r in got.collect()) == [(0, 20), (3, 0), (5, 20), (5, 20)]


def test_lone_documents_of_few_words(spark):
    for count in range(15):
        rows = [(1, " ".join(f"w{n}" for n in range(count)))]
        assert h.ordered(remove_repeated_words(h.frame(spark, rows)).collect()) == h.repeated_words(rows, 13)


@pytest.mark.parametrize("operator", [remove_repeated_words, repeated_bytes.remove_repeated_bytes, similar_sets.similar_groups])
def test_empty_tables(spark, operator):
    assert operator(h.frame(spark, [])).collect() == []
    assert operator(h.frame(spark, [(1, None)])).count() == 1


def byte_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab") for _ in range(60)) for _ in range(4)]
    rows = []
    for n in range(40):
        text = "".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 40)))
        if rnd.random() < 0.6:
            part = rnd.choice(base)
            start = rnd.randint(0, 30)
            text += part[start : start + rnd.randint(5, 50)]
        rows.append((n, text + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 20)))))
    rows += [(50, "a" * 100), (51, "ab" * 40), (52, None), (53, ""), (None, "x" * 9), (54, rows[3][1]), (54, rows[3][1])]
    rnd.shuffle(rows)
    return rows


def result(df):
    return h.ordered((*r[:4], bytes(r[4])) for r in df.collect())


@pytest.mark.parametrize(("seed", "length", "gram", "hot"), [(1, 12, 5, 20_000), (2, 12, 5, 2), (3, 16, 16, 20_000), (4, 9, 3, 3)])
def test_repeated_bytes(spark, monkeypatch, seed, length, gram, hot):
    monkeypatch.setattr(repeated_bytes, "HOT", hot)
    rows = byte_rows(seed)
    df = h.frame(spark, rows, clash=True)
    assert result(repeated_bytes.remove_repeated_bytes(df, length, gram)) == h.repeated_bytes(rows, length)


@pytest.mark.parametrize("bucket_bytes", [1, 500])
def test_any_number_of_buckets(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(exchange, "BUCKET_BYTES", bucket_bytes)
    rows = byte_rows(5)
    df = h.frame(spark, rows)
    assert exchange.buckets_of(df) > 1
    assert result(repeated_bytes.remove_repeated_bytes(df, 12, 5)) == h.repeated_bytes(rows, 12)
    texts = h.odd_rows()
    got = remove_repeated_words(h.frame(spark, texts), 4)
    assert h.ordered(got.collect()) == h.repeated_words(texts, 4)


def test_long_texts_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "_PIECE", 50)
    monkeypatch.setattr(words, "BLOCK_BYTES", 40)
    monkeypatch.setattr(words.blocks, "__defaults__", (40,))
    rnd = random.Random(9)
    rows = [(n, "".join(rnd.choice("abc") for _ in range(150))) for n in range(6)] + [(9, "abc" * 100)]
    got = repeated_bytes.remove_repeated_bytes(h.frame(spark, rows), 8, 4)
    assert result(got) == h.repeated_bytes(rows, 8)


def test_cut_characters_are_left_out(spark):
    shared = "é" * 10
    df = h.frame(spark, [(1, "a" + shared + "b"), (2, "c" + shared[:9] + "è"), (3, "y" * 30)])
    whole = {r.doc_id: bytes(r.kept) for r in repeated_bytes.remove_repeated_bytes(df, 17, 8).collect()}
    assert any(kept.decode("utf-8", "ignore").encode() != kept for kept in whole.values())
    texts = {r.doc_id: r.kept for r in repeated_bytes.remove_repeated_bytes(df, 17, 8, as_text=True).collect()}
    assert texts == {doc: kept.decode("utf-8", "ignore") for doc, kept in whole.items()}


@pytest.mark.parametrize("hot", [(1000, 2000), (3, 4)])
def test_similar_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(similar_sets, "HOT", hot[0])
    monkeypatch.setattr(similar_sets, "BLOCK_DOCS", hot[1])
    rows = h.odd_rows(seed=hot[0], count=100)
    got = similar_sets.similar_groups(h.frame(spark, rows, clash=True))
    assert h.ordered(got.collect()) == h.similar_groups(rows)


def test_first_of_groups_keeps_columns_and_lone_rows(spark):
    text = " ".join(f"w{n}" for n in range(30))
    rows = [(4, text), (2, text + " x"), (None, text), (None, "lone one"), (None, "lone one"), (9, None), (8, ""), (2, "b"), (2, "a")]
    got = similar_sets.first_of_groups(h.frame(spark, rows, clash=True))
    assert got.columns[:3] == ["doc_id", "text", "part"]
    assert h.ordered((r.doc_id, r.text) for r in got.collect()) == h.ordered(
        [(2, "a"), (None, "lone one"), (9, None), (8, "")]
    )


def test_prefix_tree_connects_what_is_similar():
    rnd = random.Random(4)
    import numpy as np

    base = [rnd.sample(range(400), 40) for _ in range(5)]
    sets = []
    for _ in range(120):
        own = set(rnd.choice(base))
        for _ in range(rnd.randint(0, 6)):
            own.discard(rnd.choice(sorted(own)))
            own.add(rnd.randrange(400))
        sets.append(own)
    similar = [
        (i, j) for i in range(120) for j in range(i)
        if len(sets[i] & sets[j]) >= least_overlap(len(sets[i]), len(sets[j]), 80)
    ]
    want, got = h.Union(120), h.Union(120)
    for i, j in similar:
        want.join(i, j)
    tree = PrefixTree([np.array(sorted(s), np.uint64) for s in sets], [len(s) for s in sets], 80)
    for i, j in tree.links():
        assert (max(i, j), min(i, j)) in set(similar)
        got.join(i, j)
    assert {(want.find(i) == want.find(j)) == (got.find(i) == got.find(j)) for i in range(120) for j in range(i)} == {True}


@pytest.mark.parametrize("letters", [65, 1024, 2048])
def test_long_words_of_two_letters_are_told_apart(spark, letters):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(letters))  # Thue-Morse: equal to its complement by polynomials
    other = one.translate(str.maketrans("ab", "ba"))
    common = " ".join(f"w{n}" for n in range(12))
    rows = [(1, f"{common} {one}"), (2, f"{common} {other}"), (3, one), (4, other), (5, one.upper()), (6, f"{common} {one}")]
    got = remove_repeated_words(h.frame(spark, rows), 13)
    assert h.ordered((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == h.repeated_words(rows, 13)
    assert h.ordered(similar_sets.similar_groups(h.frame(spark, rows)).collect()) == h.similar_groups(rows)
