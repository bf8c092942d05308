"""The pipeline stage by stage, the registered queries and their oracles."""

import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from tests.llm import helpers as h
from tools.check_oracles import compare, duck
from vitrine.llm import catalog


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, small, con, name):
    fine, text = compare(spark, con, small, name, catalog.ORACLES.get(name))
    assert fine, text


def test_registration():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(contract.queries()) >= {*catalog.QUERIES, "pipeline"} and set(catalog.ORACLES) <= set(catalog.QUERIES)


def sentences(rnd, count):
    voc = ["der", "und", "die", "nicht", "haus", "baum", "wasser", "stadt", "strasse", "morgen", "abend", "gehen", "sehen", "gross", "klein"]
    return " ".join(rnd.choice(voc) + (str(rnd.randint(0, 99)) if rnd.random() < 0.5 else "") for _ in range(count))


@pytest.fixture
def corpus(spark, folder):
    """Documents with copies, a shared passage, a benchmark passage and odd texts."""
    rnd = random.Random(2)
    passage, leak = sentences(rnd, 60), sentences(rnd, 25)
    texts = [sentences(rnd, rnd.randint(60, 120)) for _ in range(30)]
    texts[3] = texts[2] + " und mehr"
    texts[4] = texts[2]
    texts[5], texts[6] = f"{texts[5]} {passage} {sentences(rnd, 40)}", f"{sentences(rnd, 50)} {passage} {texts[6]}"
    texts[7] = f"{texts[7]} {leak} {sentences(rnd, 40)}"
    texts[8], texts[9], texts[10] = None, "", "12345 !!"
    rows = [(n, t, "de" if n % 5 else None, "s" if n % 7 else None, len(t) if t else None) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.selectExpr("*", "1 as part", "2 as key").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(enumerate(texts)), passage, leak


def test_stages(spark, corpus, tmp_path):
    folder, texts, passage, leak = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for n, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == pipeline.COLUMNS
            kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == set(range(30)) - {8, 9, 10}
    left = [(n, texts[n]) for n in sorted(kept[0])]
    assert set(kept[1]) == {row[2] for row in h.similar_groups(left)} == set(range(30)) - {3, 4, 8, 9, 10}
    want = {r[0]: r[4].decode("utf-8", "ignore") for r in h.repeated_bytes([r for r in left if r[0] in kept[1]], 200)}
    assert {n: r.text for n, r in kept[2].items()} == want
    assert passage[10:-10] not in kept[2][5].text and kept[2][5].n_chars == len(kept[2][5].text)
    assert leak not in kept[3][7].text and kept[3][7].n_chars == len(kept[3][7].text)
    assert all(kept[3][n].text == kept[2][n].text for n in kept[3] if n != 7)
    assert {r.doc_id for r in docs.collect()} == set(kept[3]) and all(r.decoded_equal for r in docs.collect())
    assert h.ordered((r.doc_id, r.ids) for r in pipeline.run(spark, folder).collect()) == h.ordered(
        (r.doc_id, r.ids) for r in docs.collect()
    )


def test_an_empty_corpus(spark, corpus, tmp_path):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
    assert docs.count() == 0
