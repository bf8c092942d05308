"""Connected components."""

import random

import pytest

from tests.llm import helpers as h
from vitrine.llm.components import components


@pytest.mark.parametrize("shape", ["random", "chain", "star", "stars", "none"])
def test_components(spark, shape):
    rnd = random.Random(6)
    pairs = {
        "random": [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(3, 3)],
        "chain": [(n, n + 1) for n in rnd.sample(range(40), 40)],
        "star": [(n, 500) for n in range(60)],
        "stars": [(n, n % 5) for n in range(5, 60)],
        "none": [],
    }[shape]
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    groups = h.Union(600)
    for a, b in pairs:
        groups.join(a, b)
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: min(m for m in nodes if groups.find(m) == groups.find(n)) for n in nodes}
