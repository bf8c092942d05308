"""Operators against brute force, with one group holding a large part of the rows."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators.filters import MarketFilter
from vitrine.operators.keyed import append_outcomes, append_unseen, first_per_key, merge_on_key, unseen_rows
from vitrine.operators.percentiles import _band, combine_groups, exact_percentiles
from vitrine.operators.ranks import even_slices, observation_ranks


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(rng, n):
    """Values with a hot group, repeated values, several bands and negative numbers."""
    for _ in range(n):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randrange(6)}"
        yield group, rng.choice(
            [rng.randrange(50), rng.randrange(-3_000_000, 9_000_000), 10_000, rng.randrange(-(10**12), 10**12), -(10**9)]
        )


def test_bands_follow_the_order_of_values(spark):
    edges = [e + d for e in (-(10**12), -(10**9), -10_000, 0, 10_000, 10**9, 10**12) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in edges], "v bigint")
    bands = [r.b for r in df.orderBy("v").select(_band(F.col("v")).alias("b")).collect()]
    assert bands == sorted(bands) and max(bands) - min(bands) < 2_300_000


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_numpy(spark, seed):
    rows = list(skewed(random.Random(seed), 3000)) + [("one", 7), ("two", 1), ("two", 2)]
    df = spark.createDataFrame(rows + [("hot", None), (None, 5)], "g string, v bigint")
    wanted = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}
    got = {r.g: r for r in exact_percentiles(df, ["g"], F.col("v"), wanted).collect()}
    assert set(got) == {g for g, _ in rows}
    for g in got:
        values = [v for k, v in rows if k == g]
        for name, fraction in wanted.items():
            assert got[g][name] == np.percentile(values, fraction * 100)


def test_percentiles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(v,) for v in (4, 1, 3, 2)], "v bigint")
    assert exact_percentiles(df, [], F.col("v"), {"m": 0.5}).first().m == 2.5
    empty = exact_percentiles(df.filter("v > 9"), [], F.col("v"), {"m": 0.5})
    assert [r.m for r in empty.collect()] == [None]


def test_percentiles_scan_and_shuffle_the_rows_once(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    df = exact_percentiles(lines, ["l_returnflag"], F.col("l_extendedprice"), {"m": 0.5})
    plan = executed_plan(df).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


def test_combine_groups_keeps_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3.0), (None, 4.0), ("y", 5.0)], "k string, b double")
    got = {r.k: (r.a, r.b) for r in combine_groups([a, b], ["k"]).collect()}
    assert got == {"x": (1, 3.0), None: (2, 4.0), "y": (None, 5.0)}


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), "id")
    best = first_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted((r.k, r.id) for r in best.collect()) == [(0, 9999), (1, 9997), (2, 9998)]
    plan = executed_plan(best).split("== Initial Plan ==")[0]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


ROWS = "p string, t int, id string"


def test_append_first_row_wins_and_null_keys_are_all_added(spark):
    held = spark.createDataFrame([("a", 1, "old"), (None, 1, "n0")], ROWS)
    incoming = spark.createDataFrame(
        [("a", 1, "new"), ("b", 1, "b1"), ("b", 1, "b2"), (None, 1, "n1"), (None, 1, "n2"), ("a", 2, "x")], ROWS
    )
    order = [F.col("id")]
    added = unseen_rows(incoming, held, ["p", "t"], order)
    assert sorted(r.id for r in added.collect()) == ["b1", "n1", "n2", "x"]
    assert append_unseen(held, incoming, ["p", "t"], order).count() == 6
    assert tuple(append_outcomes(incoming, held, ["p", "t"]).first()) == (6, 4, 2)
    again = append_outcomes(incoming.filter("p is not null"), append_unseen(held, incoming, ["p", "t"], order), ["p", "t"])
    assert tuple(again.first()) == (4, 0, 4)


def test_merge_replaces_equal_keys(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], ROWS)
    updates = spark.createDataFrame([("a", 1, "new"), ("c", 1, "add")], ROWS)
    assert sorted(r.id for r in merge_on_key(target, updates, ["p", "t"]).collect()) == ["add", "keep", "new"]


def test_ranks_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [
        ("hot" if rng.random() < 0.5 else f"p{rng.randrange(5)}", f"2024-01-{rng.randrange(1, 9):02d} 0{rng.randrange(9)}:00:00", i)
        for i in range(800)
    ]
    df = spark.createDataFrame(rows, "p string, t string, id int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r.id: (r.rank_asc, r.rank_desc, r.num_observations) for r in observation_ranks(df, "p", "t", ["id"]).collect()}
    for p in {r[0] for r in rows}:
        ordered = sorted((t, i) for q, t, i in rows if q == p)
        for position, (_, i) in enumerate(ordered):
            assert got[i] == (position + 1, len(ordered) - position, len(ordered))


def test_ranks_cut_copies_of_one_instant_into_slices(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise("cold").alias("p"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), "id",
    )
    got = observation_ranks(df, "p", "t", ["id"])
    hot = sorted((r.id, r.rank_asc, r.rank_desc) for r in got.filter("p = 'hot'").collect())
    assert [(asc, desc) for _, asc, desc in hot] == [(n, 3001 - n) for n in range(1, 3001)]
    sizes = [r["count"] for r in even_slices(df, ["p", "t", "id"]).groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500


def test_filter_clauses(spark):
    from datetime import date

    df = spark.createDataFrame(
        [
            (1, Decimal("100"), "new", "A", "2024-01-10 00:00:00"), (2, Decimal("100"), "used", "A", "2024-01-10 00:00:00"),
            (3, Decimal("100"), "new", None, "2024-01-10 00:00:00"), (4, Decimal("100"), "new", "A", "2024-01-01 23:59:59"),
            (5, Decimal("99.99"), "new", "A", "2024-01-10 00:00:00"), (6, Decimal("200.01"), "new", "A", "2024-01-10 00:00:00"),
            (7, Decimal("200"), "new", "B", "2024-01-02 00:00:00"), (8, Decimal("0"), "new", "A", "2024-01-10 00:00:00"),
        ],
        "id int, price decimal(12,2), condition string, brand string, t string",
    ).withColumn("collected_at", F.col("t").cast("timestamp_ntz"))

    def chosen(**choice):
        return [r.id for r in df.filter(MarketFilter(date(2024, 1, 9), **choice).predicate()).orderBy("id").collect()]

    assert chosen() == [1, 2, 3, 5, 6, 7]
    assert chosen(min_price=100, max_price=200) == [1, 2, 3, 7]
    assert chosen(condition="used") == [2]
    assert chosen(brands=["A", "B"], min_price=100, max_price=200) == [1, 2, 7]
    assert chosen(period_days=30, condition="new", brands=["A"], min_price=100) == [1, 4, 6]
