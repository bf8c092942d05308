"""Contamination, language, quality, resampling and token ids."""

import itertools
import math
import re
import string
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm import helpers as h
from vitrine.llm import contamination, pieces, quality_votes, resampling
from vitrine.llm.catalog import PIECE_MODEL
from vitrine.llm.language import accepted, identify, is_held_out, train
from vitrine.llm.words import text_bytes

# --- contamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(h.LOWER))


def brute_contamination(rows, items, window=10):
    found = {}
    for item, text in items:
        own = plain_words(text)
        size = min(len(own), window)
        for i in range(len(own) - size + 1 if own else 0):
            found.setdefault(tuple(own[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        own, hit, named = plain_words(text), set(), set()
        for size in {len(k) for k in found}:
            for i in range(len(own) - size + 1):
                key = tuple(own[i : i + size])
                if key in found:
                    named |= found[key]
                    hit.update(range(i, i + size))
        out.append((doc, len(own), len(hit), sorted(named)))
    return h.ordered(out)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "x-Y z"), (None, "É 7"), (3, None), (4, "!"), (10, "x y z"), (2, "x y z")]


@pytest.mark.parametrize("at_once", [200_000, 2])
def test_contamination(spark, monkeypatch, at_once):
    monkeypatch.setattr(contamination, "WINDOWS_PER_BLOCK", at_once)
    phrase = "ONE, two; three four five six seven eight nine ten"
    rows = [
        (1, f"a b {phrase} c"), (2, phrase.replace("ten", "tenth")), (3, f"{phrase} eleven. X y, z!"), (4, None), (5, ""),
        (6, "É 7 é 7"), (None, "x y z"), (6, "É 7 é 7"), (7, "x y" + " word" * 3000 + " x y z"), (8, "é 7" * 2),
    ]
    docs = h.frame(spark, rows, clash=True)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination.find_contamination(docs, items, carry=("label",))
    assert got.columns == ["doc_id", "n_words", "n_hit", "items", "kept_text", "label"]
    assert h.ordered((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()) == brute_contamination(rows, ITEMS)
    kept = {r.doc_id: r.kept_text for r in got.filter("doc_id < 6").collect()}
    # between two runs of one item what separates them stays
    assert kept == {1: "a b  c", 2: rows[1][1], 3: "!", 4: "", 5: ""}
    left = contamination.decontaminate(docs, items)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 5, 6, 6, 7, 8]


def test_contamination_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination.find_contamination(h.frame(spark, []), items).count() == 0
    row = contamination.find_contamination(h.frame(spark, [(1, "x y z")]), items.filter("false")).first()
    assert (row.n_words, row.n_hit, row["items"]) == (3, 0, [])


# --- language


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.filter(~is_held_out()))
    assert len(model.languages) == 4 and len(model.centroids) > 4
    judged = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(is_held_out())
    right, total = judged.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right >= 0.97 * total


def test_language_of_odd_texts(spark):
    learn = [(n, "der und die nicht ein das ist", "de") for n in range(30)] + [(n, "the and of that was for it", "en") for n in range(30)]
    learn += [(90, None, "de"), (91, "the", None), (None, "the and that", "en"), (92, "123", "en"), (92, "123", "en")]
    model = train(spark.createDataFrame(learn, "doc_id long, text string, lang string"))
    rows = [(1, None), (2, ""), (3, "123 ... !"), (4, "und das ist nicht die"), (5, "that was the and of it"), (5, "that was the and of it"),
            (6, "日本語のテキスト"), (None, "und die"), (7, "the and of that " * 20000)]
    df = h.frame(spark, rows, clash=True)
    got = sorted(((r.doc_id or 0, r.lang_pred, r.rejected) for r in identify(df, model).collect()), key=str)
    assert [g[:2] for g in got if g[0] not in (6,)] == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en"), (5, "en"), (7, "en")]
    assert {g[0] for g in got if g[2]} == {1, 2, 3, 6}
    assert all(0 <= r.score <= 1 for r in identify(df, model).collect())
    kept = accepted(df, model)
    assert kept.columns == df.columns and kept.count() == 5
    assert identify(h.frame(spark, []), model).count() == 0


def test_one_document_with_many_rows_is_learned_once(spark):
    rows = [(7, "en", f"the words of text {n % 3}") for n in range(300)] + [(n, "en", f"some other words {n}") for n in range(100, 120)]
    model = train(spark.createDataFrame(rows, "doc_id long, lang string, text string"), sample_rows=30)
    # a gram that no text has tells how many rows were learned from
    assert round(math.exp(float(model.weights.max()) - 1) - 1) == 21


def test_nothing_to_learn_from(spark):
    assert train(spark.createDataFrame([(1, None, "de"), (2, "a", None)], "doc_id long, text string, lang string")) is None
    row = identify(h.frame(spark, [(1, "abc")]), None).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)


# --- quality


def brute_features(text):
    own = h.words(text)
    lines = [line for line in (text or "").split("\n") if h.words(line)]
    count = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    again = set()
    for i in range(len(own) - 7):
        if count[tuple(own[i : i + 8])] > 1:
            again.update(range(i, i + 8))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(again)


def test_features(spark):
    rows = h.odd_rows() + [(400, "a b c d e f g h " * 3), (401, "a " * 40), (402, "x\n\n x\nx\ny#\ny#\n$ <|>&"), (403, "a\x0bb\x0cc\rd e")]
    df = h.frame(spark, rows, clash=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality_votes.features(df).select("doc_id", *names).collect()
    assert h.ordered(got) == h.ordered((doc, *brute_features(text)) for doc, text in rows)


def test_verdicts(spark):
    clean = " ".join(f"word{n} is here." for n in range(40))
    rows = [(n, clean.replace("here", f"there{n}")) for n in range(40)]
    rows += [(50 + n, " | ".join(f"w{n}{k}" for k in range(60))) for n in range(4)]
    rows += [(70, None), (71, "few words"), (72, "a b c d e f g h " * 9), (None, clean), (None, clean)]
    judged = {r.doc_id: r for r in quality_votes.judge(h.frame(spark, rows)).collect()}
    assert all(judged[n].kept for n in range(40)) and not any(judged[50 + n].kept for n in range(4))
    assert all(judged[n].base_failed and not judged[n].kept for n in (70, 71, 72))
    assert all(0 <= r.posterior <= 1 for r in judged.values())
    assert quality_votes.judge(h.frame(spark, [])).count() == 0


def test_expectation_maximisation_follows_the_votes(spark):
    rules = ["a", "b", "c"]
    votes = [(1, 1, 1)] * 80 + [(0, 0, 1)] * 15 + [(0, 0, None)] * 5
    trust = quality_votes.estimate(spark.createDataFrame(votes, "a int, b int, c int"), rules)
    # plain Python, pattern by pattern
    prior, good, bad = 0.8, dict.fromkeys(rules, 0.8), dict.fromkeys(rules, 0.8)
    for _ in range(15):
        weights = []
        for row in votes:
            odds = math.log(prior / (1 - prior))
            for rule, vote in zip(rules, row, strict=True):
                if vote is not None:
                    odds += math.log(good[rule] / (1 - bad[rule])) if vote else math.log((1 - good[rule]) / bad[rule])
            weights.append(1 / (1 + math.exp(-odds)))
        new = {}
        for k, rule in enumerate(rules):
            said = [(w, row[k]) for w, row in zip(weights, votes, strict=True) if row[k] is not None]
            g = (sum(w for w, v in said if v == 1) + 0.8) / (sum(w for w, _ in said) + 1)
            b = (sum(1 - w for w, v in said if v == 0) + 0.8) / (sum(1 - w for w, _ in said) + 1)
            g, b = min(max(g, 0.02), 0.98), min(max(b, 0.02), 0.98)
            new[rule] = g, max(b, 1 - g)
        prior = min(max(sum(weights) / len(votes), 0.05), 0.95)
        good, bad = {r: v[0] for r, v in new.items()}, {r: v[1] for r, v in new.items()}
    assert trust.prior == pytest.approx(prior) and trust.on_good == pytest.approx(good) and trust.on_bad == pytest.approx(bad)


# --- resampling


def test_resampling_takes_the_largest_keys(spark, monkeypatch):
    rows = [(n, f"good fine text number{n}" if n % 2 else f"||| ### junk{n}") for n in range(300)]
    rows += [(400, None), (401, ""), (None, "good fine"), (5, "good fine text number5")]
    docs = h.frame(spark, rows, clash=True)
    target = docs.filter("doc_id % 2 = 1 and doc_id < 100")
    monkeypatch.setattr(resampling, "AT_ONCE", 5)
    monkeypatch.setattr(resampling, "BINS", 8)
    got = resampling.resample(docs, target, share=0.5).collect()
    assert len(got) == len(rows)
    wanted = round(0.5 * len(rows))
    best = sorted(got, key=lambda r: (-r.key, r.doc_id is None, r.doc_id or 0))
    assert {r.doc_id for r in got if r.selected} == {r.doc_id for r in best[:wanted]}
    assert sum(r.selected for r in got if r.doc_id and r.doc_id % 2) > 0.9 * 151
    assert {r.log_weight for r in got if r.doc_id in (400, 401)} == {0.0}
    again = resampling.resample(docs, target, share=0.5).collect()
    assert sorted(r.key for r in again) == sorted(r.key for r in got)


def test_resampling_counts_and_weights(spark):
    docs, target = h.frame(spark, [(1, "a b"), (2, "b b c")]), h.frame(spark, [(1, "A b")])
    counts = [r.n for r in resampling.bucket_counts(docs).collect()]
    assert sum(counts) == 5 + 3
    rows = {r.doc_id: r for r in resampling.importance(docs, target).collect()}
    assert (rows[1].n_grams, rows[2].n_grams) == (3, 5) and rows[1].log_weight > rows[2].log_weight
    assert resampling.resample(h.frame(spark, []), target).count() == 0


def test_resampling_weights_against_plain_python(spark):
    words = ["tree", "Sea", "salt", "wind", "é", "x" * 50, "stone"]
    texts = {n: " ".join(words[(n * k * k + k) % (3 + n % 5)] for k in range(n * n % 700)) for n in range(40)}
    texts[90] = " ".join(words[k * k % 7] for k in range(60_000))
    target = {n: t for n, t in texts.items() if n % 3 == 0}

    def grams(text):
        said = [w.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) for w in text.split()]
        return said + [f"{a} {b}" for a, b in itertools.pairwise(said)]

    # a gram's bucket, asked of the operator for the gram by itself; the last bucket given is that of the whole gram
    known = sorted({g for t in texts.values() for g in grams(t)})
    data, cuts = text_bytes(pa.array(known))
    text, bucket = resampling._buckets(data, cuts)
    place = {known[t]: int(b) for t, b in zip(text, bucket, strict=True)}

    def model(chosen):
        counts = [1.0] * (1 << resampling.BUCKET_BITS)
        for t in chosen:
            for g in grams(t):
                counts[place[g]] += 1
        total = math.fsum(counts)
        return [c / total for c in counts]

    good, raw = model(target.values()), model(texts.values())
    docs, chosen = h.frame(spark, list(texts.items())), h.frame(spark, list(target.items()))
    whole = {r.doc_id: r for r in resampling.importance(docs, chosen).collect()}
    tempered = {r.doc_id: r.log_weight for r in resampling.importance(docs, chosen, length=10).collect()}
    for n, t in texts.items():
        ratios = [math.log(good[place[g]] / raw[place[g]]) for g in grams(t)]
        assert whole[n].n_grams == len(ratios)
        assert whole[n].log_weight == pytest.approx(math.fsum(ratios), rel=1e-6, abs=1e-6)
        mean = math.fsum(ratios) / max(len(ratios), 1) * min(len(ratios), 10)
        assert tempered[n] == pytest.approx(mean, rel=1e-6, abs=1e-6)


def test_equal_keys_go_by_id(spark):
    keyed = spark.createDataFrame([(n, 1.0) for n in range(50)] + [(None, 1.0)], "doc_id long, key double")
    assert resampling._last_selected(keyed, 20) == (1.0, 19)


# --- token ids

PROBES = [
    "", "a", " a", "  a", "a  b", "   ", "a   b    c     d", " " * 40 + "x" + " " * 15 + "y", "▁a ▁▁ b",
    "日本語 テスト\U0001F642", "\x00\n\t x", "<s> </s> <0x41> <unk>", "é", "한국어  \U0001F642\U0001F642 ", None, "x" * 5000, "a" + " b" * 5000,
]


def test_ids_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = [*enumerate(PROBES), (None, "no id"), (1, "a")]
    encoded = pieces.encode(h.frame(spark, rows, clash=True), PIECE_MODEL, parity_share=1)
    got = encoded.collect()
    assert h.ordered((r.doc_id, r.ids) for r in got) == h.ordered((doc, library.encode(text or "")) for doc, text in rows)
    assert all(r.parity and r.decoded_equal and r.n_tokens == len(r.ids) for r in got)
    assert sum(r.n_bytes_fallback for r in got if r.doc_id == 9) == sum(3 <= i < 259 for i in library.encode(PROBES[9]))
    back = {r.doc_id: r.text for r in pieces.decode(encoded, PIECE_MODEL).collect()}
    assert all(back[n] == (text or "").replace("▁", " ") for n, text in enumerate(PROBES) if n != 1)
    assert pieces.encode(h.frame(spark, []), PIECE_MODEL).count() == 0


def test_parity_is_told_for_every_text(spark):
    got = pieces.encode(h.frame(spark, list(enumerate(PROBES))), PIECE_MODEL).collect()
    assert len(got) == len(PROBES) and all(r.parity is True for r in got)


def test_units_that_deviate_get_the_ids_of_the_library():
    import pyarrow as pa

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    with open(PIECE_MODEL, "rb") as file:
        model = pieces.read_model(file.read())
    assert pieces.splits_at_blanks(model)
    # "the" can't be merged any more
    model.pieces = [(p, s, pieces.CONTROL if p == "▁the" else k) for p, s, k in model.pieces]
    texts = ["in the end", "in   an end ", "", " ", "the", "x  "]
    flat, sizes, sound, same = pieces._by_units(pieces.build_tokenizer(model, units=True), library, pa.array(texts))
    assert flat.tolist() == [i for t in texts for i in library.encode(t)] and sound.all()
    assert sizes.tolist() == [len(library.encode(t)) for t in texts]
    assert same.tolist() == [False, True, True, True, False, True]


def varint(value):
    out = b""
    while value >= 0x80:
        out += bytes([value & 0x7F | 0x80])
        value >>= 7
    return out + bytes([value])


def message(*fields):
    import struct

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model():
    scored = [("▁", -2.0), ("▁a", -1.0), ("a", -2.5), ("b", -2.6), ("ab", -3.0), ("▁ab", -2.2), ("ba", -3.1)]
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{n:02X}>", 0.0, 6) for n in range(256)] + [(p, s, 1) for p, s in scored]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in rows)
    return body + message((2, message((3, 1), (35, 1)))) + message((3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))


def test_a_unigram_model(spark, tmp_path):
    path = tmp_path / "tiny_unigram.model"
    path.write_bytes(unigram_model())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["ab ab", "aabba b", "", "aé b", "  a  b", "abab ba"]
    got = {r.doc_id: r for r in pieces.encode(h.frame(spark, list(enumerate(texts))), str(path), parity_share=1).collect()}
    assert [got[n].ids for n in range(len(texts))] == [library.encode(t) for t in texts]
    model = pieces.read_model(path.read_bytes())
    assert model.kind == pieces.UNIGRAM and model.byte_fallback and not model.trim_blanks
    own = pieces.build_tokenizer(model)
    assert [own.encode(t, add_special_tokens=False).ids for t in texts] == [library.encode(t) for t in texts]
