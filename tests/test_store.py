"""Stored facts: pruning, the log of loads, compaction; and the graph of models."""

import threading
import time
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_layers import day, raw_rows
from tools.check_oracles import TABLES, compare
from vitrine.catalog import oracles
from vitrine.operators.filters import MarketFilter
from vitrine.plans import reports as rep
from vitrine.plans.facts import (
    compact_facts, current_loads, facts, finished_loads, read_facts, remove_replaced, upsert_facts, write_facts,
)
from vitrine.plans.graph import Model, ModelsFailed, build_models
from vitrine.plans.staging import staged
from vitrine.schemas import FACTS
from vitrine.sources import tables


def some_facts(spark, *days):
    return facts(staged(raw_rows(spark, *(day(n) for n in days))))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def products(df):
    return sorted(r.product_id for r in df.collect())


def test_a_report_opens_only_the_folders_since_its_cutoff(spark, folder):
    path = f"{folder}/facts"
    write_facts(some_facts(spark, 1, 2), path)
    upsert_facts(spark, path, some_facts(spark, 2, 3, 4, 5))
    chosen = MarketFilter(as_of=date(2024, 1, 5), period_days=1)
    rows = chosen.rows_of(read_facts(spark, path))
    scan = next(line for line in plan_of(rows).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(collection_date" in scan and ">= 2024-01-04" in scan
    assert "PushedFilters: [IsNotNull(price)" in scan
    assert products(rows) == ["p4", "p5"]
    # the folders themselves can be chosen before anything is listed
    some = read_facts(spark, path, since=chosen.cutoff)
    assert len(some.inputFiles()) == 2 and products(some) == ["p4", "p5"]
    kpis = rep.filtered_kpis(some, chosen)
    assert kpis.collect() == rep.filtered_kpis(some_facts(spark, 1, 2, 3, 4, 5), chosen).collect()
    assert read_facts(spark, path, since=date(2030, 1, 1)).count() == 0


def test_rows_of_facts_without_a_date_column(spark):
    rows = some_facts(spark, 1, 5).drop("collection_date")
    assert products(MarketFilter(as_of=date(2024, 1, 5), period_days=1).rows_of(rows)) == ["p5"]


def test_rows_of_a_file_go_by_brand_and_price(spark, folder):
    rows = raw_rows(spark, *(day(1, product_id=f"x{n}", price=str(900 - n), title=f"Samsung {n}") for n in range(50)))
    write_facts(facts(staged(rows)), f"{folder}/facts")
    prices = [r.price for r in spark.read.parquet(f"{folder}/facts").select("price").collect()]
    assert len(prices) == 50 and prices == sorted(prices)


def test_compaction_changes_no_row_and_no_open_reader(spark, folder):
    path = f"{folder}/facts"
    write_facts(some_facts(spark, 1, 2), path)
    for last in (3, 4):
        upsert_facts(spark, path, some_facts(spark, *range(1, last + 1)))
    before = read_facts(spark, path)
    files = len(before.inputFiles())
    rows = sorted(map(str, before.collect()))
    compact_facts(spark, path)
    after = read_facts(spark, path)
    assert sorted(map(str, after.collect())) == rows == sorted(map(str, before.collect()))
    assert [r.load for r in current_loads(spark, path).select("load").distinct().collect()] == [3]
    assert all("load=3" in name for name in after.inputFiles()) and files == 4
    upsert_facts(spark, path, some_facts(spark, 1, 2, 3, 4, 5))
    assert products(read_facts(spark, path)) == ["p1", "p2", "p3", "p4", "p5"]
    assert remove_replaced(spark, path) == [0, 1, 2] and remove_replaced(spark, path) == []
    assert products(read_facts(spark, path)) == ["p1", "p2", "p3", "p4", "p5"]
    # the log still says what each load has brought, and the watermark stands
    assert sum(r["rows"] for r in finished_loads(spark, path).filter("not base").collect()) == 5
    upsert_facts(spark, path, some_facts(spark, 5))
    assert read_facts(spark, path).count() == 5


def test_a_compaction_broken_off_is_not_read(spark, folder):
    path = f"{folder}/facts"
    write_facts(some_facts(spark, 1, 2), path)
    read_facts(spark, path).write.partitionBy("collection_date").parquet(f"{path}/load=1")
    assert products(read_facts(spark, path)) == ["p1", "p2"]
    compact_facts(spark, path)
    assert products(read_facts(spark, path)) == ["p1", "p2"]


def kinds(schema):
    return [(f.name, f.dataType) for f in schema]


def test_a_store_whose_loads_have_no_row(spark, folder):
    path, nothing = f"{folder}/facts", some_facts(spark, 1).filter("product_id is null")
    write_facts(nothing, path)
    upsert_facts(spark, path, nothing)
    chosen = MarketFilter(as_of=date(2024, 1, 5), period_days=1)
    empty = read_facts(spark, path, since=chosen.cutoff)
    assert empty.collect() == [] and kinds(empty.schema) == kinds(FACTS)
    assert rep.filtered_kpis(empty, chosen).collect() == rep.filtered_kpis(nothing, chosen).collect()
    compact_facts(spark, path)
    assert read_facts(spark, path).collect() == []
    upsert_facts(spark, path, some_facts(spark, 4))
    assert products(read_facts(spark, path)) == ["p4"] and kinds(read_facts(spark, path).schema) == kinds(FACTS)


@pytest.mark.parametrize("name", ["filtered_from_store", "fact_snapshots"])
def test_stored_queries_without_a_sale(spark, small, folder, name):
    for table in TABLES:
        rows = spark.read.parquet(f"{small}/{table}.parquet")
        (rows.limit(0) if table == "lineitem" else rows).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    fine, text = compare(spark, con, folder, name, oracles()[name])
    assert fine, text


def test_bloom_filters_are_as_big_as_their_products_need(spark, folder):
    rows = raw_rows(spark, *(day(1, product_id=f"x{n}") for n in range(900)), day(2))
    write_facts(facts(staged(rows)), f"{folder}/facts")
    files = f"{folder}/facts/load=0/*/*.parquet"
    sizes = duckdb.sql(
        f"select num_values, bloom_filter_length from parquet_metadata('{files}') "
        "where path_in_schema = 'product_id' order by 1"
    ).fetchall()
    assert [n for n, _ in sizes] == [1, 900] and all(1000 < size < 5000 for _, size in sizes)
    told = duckdb.sql(f"select bloom_filter_excludes from parquet_bloom_probe('{files}', 'product_id', 'x7')").fetchall()
    assert sorted(told) == [(False,), (True,)]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for n in range(found.size()) if (name := found.apply(n).getName()).startswith("shuffle_")}


def lasting_shuffle_files(spark, before):
    for _ in range(50):  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def in_slices(monkeypatch, count):
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    monkeypatch.setattr(tables, "MOST_SLICES", count)


def test_a_load_in_slices_leaves_no_shuffle_file(spark, folder, monkeypatch):
    days = [day(n, product_id=f"p{m}") for n in range(1, 8) for m in range(3)]
    raw_rows(spark, *days, day(4, product_id="p1"), day(9, product_id=None)).write.parquet(f"{folder}/raw")
    rows = facts(staged(spark.read.parquet(f"{folder}/raw")))
    expected = sorted(map(str, rows.collect()))
    in_slices(monkeypatch, 3)
    before, setting = shuffle_files(spark), spark.conf.get(tables._CLEAN_UP)
    write_facts(rows, f"{folder}/facts")
    assert lasting_shuffle_files(spark, before) == set() and spark.conf.get(tables._CLEAN_UP) == setting
    stored = read_facts(spark, f"{folder}/facts")
    assert sorted(map(str, stored.collect())) == expected and len(stored.inputFiles()) == 7
    counted = finished_loads(spark, f"{folder}/facts").orderBy("collection_date").collect()
    assert [(r["load"], r["rows"]) for r in counted] == [(0, 3)] * 7
    kinds = duckdb.sql(f"select distinct compression from parquet_metadata('{folder}/facts/load=0/*/*.parquet')")
    assert kinds.fetchall() == [("ZSTD",)]
    # another try of a load replaces all its slices
    write_facts(rows.filter("product_id = 'p2'"), f"{folder}/facts")
    assert products(read_facts(spark, f"{folder}/facts")) == ["p2"] * 7


def test_slices_are_picked_before_the_shuffle(spark, folder, monkeypatch):
    raw_rows(spark, *(day(n) for n in range(1, 6))).write.parquet(f"{folder}/raw")
    rows = facts(staged(spark.read.parquet(f"{folder}/raw")))
    assert tables.day_slices(rows, F.col("collection_date")) == [rows]  # small input
    in_slices(monkeypatch, 2)
    parts = tables.day_slices(rows, F.col("collection_date"))
    assert sorted(n for part in parts for n in products(part)) == [f"p{n}" for n in range(1, 6)]
    for part in parts:
        lines = plan_of(part).splitlines()
        exchange = next(n for n, line in enumerate(lines) if "Exchange" in line)
        assert any("pmod" in line and "Filter" in line for line in lines[exchange:])


def test_a_row_without_a_date_is_in_one_slice(spark, folder, monkeypatch):
    spark.sql("select id, if(id % 3 = 0, null, date_add(date'1969-12-25', int(id))) as d from range(20)").write.parquet(folder + "/t")
    in_slices(monkeypatch, 4)
    parts = tables.day_slices(spark.read.parquet(folder + "/t"), F.col("d"))
    assert len(parts) == 4 and sorted(r.id for part in parts for r in part.collect()) == list(range(20))


# --- models


def test_models_are_built_side_by_side_in_order(spark, folder):
    started, both = [], threading.Barrier(2, timeout=60)

    def slow(name):
        def build(base):
            started.append(name)
            both.wait()  # passes only if two are built at the same time
            return base.select((F.col("id") * 2).alias(name))

        return build

    models = {
        "sum": Model(lambda a, b: a.join(b, F.col("a") == F.col("b")), ("a", "b")),
        "a": Model(slow("a"), ("base",)),
        "b": Model(slow("b"), ("base",)),
        "base": Model(lambda given: given.filter("id < 7"), ("given",)),
    }
    built = build_models(spark, models, folder, {"given": spark.range(10)})
    assert sorted(started) == ["a", "b"]
    assert built.rows == {"base": 7, "a": 7, "b": 7, "sum": 7}
    assert {name: built.tables[name].count() for name in models} == built.rows
    assert spark.read.parquet(f"{folder}/sum").columns == ["a", "b"]


def test_a_failed_model_stops_only_what_needs_it(spark, folder):
    def broken(base):
        raise ValueError("no such column")

    models = {
        "fine": Model(lambda base: base, ("base",)),
        "broken": Model(broken, ("base",)),
        "late": Model(lambda b: b, ("broken",)),
        "later": Model(lambda b, f: b, ("late", "fine")),
        "base": Model(lambda: spark.range(3)),
    }
    with pytest.raises(ModelsFailed, match="broken: no such column") as caught:
        build_models(spark, models, folder)
    assert caught.value.built.rows == {"base": 3, "fine": 3} and caught.value.built.skipped == ["late", "later"]


def test_models_in_a_circle_are_refused(spark, folder):
    with pytest.raises(ValueError, match="no way to build a, b"):
        build_models(spark, {"a": Model(None, ("b",)), "b": Model(None, ("a",)), "c": Model(None)}, folder)


def test_a_model_in_slices_leaves_no_shuffle_file(spark, folder, monkeypatch):
    rows = [*(day(n, product_id=f"p{m}") for n in range(1, 6) for m in range(4)), day(2, product_id="p1")]
    raw_rows(spark, *rows).write.parquet(f"{folder}/raw")
    given = {"raw": spark.read.parquet(f"{folder}/raw")}
    expected = sorted(map(str, staged(given["raw"]).collect()))
    in_slices(monkeypatch, 3)
    before = shuffle_files(spark)
    models = {
        "staging": Model(staged, ("raw",), instant="collected_at"),
        "days": Model(lambda s: s.groupBy("collected_at").count(), ("staging",)),
    }
    built = build_models(spark, models, folder, given)
    assert lasting_shuffle_files(spark, before) == set()
    assert built.rows == {"staging": 20, "days": 5}
    assert sorted(map(str, built.tables["staging"].collect())) == expected
    kinds = duckdb.sql(f"select distinct compression from parquet_metadata('{folder}/staging/*.parquet')")
    assert kinds.fetchall() == [("ZSTD",)]
    # built again, the table is replaced, not added to
    assert build_models(spark, models, folder, given).tables["staging"].count() == 20
