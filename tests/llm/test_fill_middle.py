"""Fill-in-the-middle against a plain version, and its learned index."""

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm import helpers as h
from vitrine.llm.fill_middle import fill_in_middle, fit_index, restored


def plainly(doc, text, rate=100, share=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return doc, len(lines), "plain", None, None, text
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < share:
        return doc, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    (None, None), (None, "no\nid\n"), (1, ""), (1, ""), (2, "\n"), (3, "\n\n\n"), (4, "one line"), (5, "a\r\nb\rc\n"),
    (6, "has <M> in it\nx"), (7, "<P"), (8, ">\n<S\n>"), (9, "é日\U0001F642\n日本\n" * 40), (10, "x\n" * 100_000), (10, "x\n" * 100_000),
    (11, "word " * 400_000 + "\nlast"), (12, "\x00\n\x0b y\n"),
]


def test_cuts_equal_a_plain_version(spark):
    rows = ODD + h.odd_rows()
    for rate, share in ((100, 50), (40, 100), (0, 0)):
        got = fill_in_middle(h.frame(spark, rows, clash=True), rate=rate, suffix_first=share)
        assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        assert h.ordered(got.collect()) == h.ordered(plainly(*row, rate, share) for row in rows)
    assert fill_in_middle(h.frame(spark, [])).count() == 0


def test_texts_come_back(spark):
    rows = list(enumerate(text for _, text in ODD + h.odd_rows()))
    back = fill_in_middle(h.frame(spark, rows)).select("doc_id", restored(F.col("form"), F.col("output")).alias("text"))
    assert h.ordered(back.collect()) == h.ordered((doc, text or "") for doc, text in rows)


def test_index_is_near_before_its_residuals_and_exact_behind():
    rng = np.random.default_rng(3)
    for steps in (rng.integers(1, 200, 5000), np.ones(5000, int), rng.pareto(0.5, 3000).astype(int) % 10**6 + 1, [7]):
        offsets = np.concatenate(([0], np.cumsum(steps)))
        ranks = np.arange(len(offsets))
        for error in (0, 5, 64, 1000):
            index = fit_index(offsets, error)
            assert (index.offset(ranks) == offsets).all()
            assert np.abs(index.predicted(ranks) - offsets).max() <= error + 1
    assert len(fit_index(np.arange(0, 10**6, 3)).firsts) == 1
