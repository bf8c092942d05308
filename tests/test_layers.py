"""Staging, facts, marts and quality rules on small tables with known results."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import seed
from vitrine.operators import quality as q
from vitrine.operators.filters import MarketFilter
from vitrine.plans import daily_run, marts, reports
from vitrine.plans.facts import facts, finished_loads, newer_rows, read_facts, upsert_facts, upserted, write_facts
from vitrine.plans.staging import staged
from vitrine.schemas import FACT_COLUMNS, RAW, STAGED
from vitrine.sources.tables import materialise_view, read_seed
from vitrine.streaming.ingest import held_rows

D = Decimal


def raw_rows(spark, *changes):
    base = {
        "ingestion_id": "i", "batch_id": "b", "source": "other", "collected_at": "2024-01-01 10:00:00",
        "inserted_at": "2024-01-01 11:00:00", "product_id": "p", "title": "Samsung A", "brand": None, "condition": None,
        "url": None, "thumbnail_url": None, "price": "100", "original_price": None, "discount_pct": None, "currency": None,
        "rating": None, "num_ratings": None, "is_best_seller": None, "is_amazon_choice": None, "is_prime": None,
        "free_shipping": None, "delivery_text": None, "sales_volume": None, "num_offers": None, "raw_payload": None,
    }
    rows = [{**base, "ingestion_id": f"i{n}", **change} for n, change in enumerate(changes)]
    names = RAW.fieldNames()
    text = spark.createDataFrame(
        [tuple(None if r[c] is None else str(r[c]) for c in names) for r in rows], ", ".join(f"`{c}` string" for c in names)
    )
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields])


def test_staging_keeps_the_last_inserted_copy(spark):
    df = staged(raw_rows(
        spark,
        {"inserted_at": "2024-01-01 11:00:00"}, {"inserted_at": "2024-01-01 12:00:00"},
        {"inserted_at": "2024-01-01 12:00:00", "ingestion_id": "i1b"}, {"product_id": None},
        {"product_id": "q", "price": None}, {"product_id": "r", "price": "0"}, {"product_id": "s", "price": "-5"},
        # the newest copy decides, even when it has no price
        {"product_id": "t", "inserted_at": "2024-01-01 10:00:00"}, {"product_id": "t", "price": None},
    ))
    assert df.schema.fieldNames() == STAGED.fieldNames()
    assert [(r.product_id, r.ingestion_id) for r in df.collect()] == [("p", "i1b")]


def test_staging_fills_and_repairs(spark):
    rows = staged(raw_rows(
        spark,
        {"product_id": "a"},
        {"product_id": "b", "price": "450.00", "original_price": "600", "discount_pct": "0"},
        {"product_id": "c", "original_price": "90", "discount_pct": "-11.11"},
        {"product_id": "d", "sales_volume": "", "raw_payload": '{"sales_volume": "500 compras"}', "condition": "Usado"},
        {"product_id": "e", "original_price": "100", "discount_pct": "5"},
    ))
    got = {r.product_id: r for r in rows.collect()}
    a = got["a"]
    assert (a.source, a.brand, a.condition, a.currency, a.num_ratings, a.num_offers) == ("amazon_br", "Samsung", "new", "BRL", 0, 0)
    assert (a.is_best_seller, a.is_amazon_choice, a.is_prime, a.free_shipping) == (False, False, False, False)
    assert (a.delivery_text, a.sales_volume, a.discount_pct, a.seed_flag) == ("", None, 0, False)
    assert got["b"].discount_pct == D("25.00") and got["c"].discount_pct == D("-11.11") and got["e"].discount_pct == 5
    assert got["d"].sales_volume == "500 compras" and got["d"].condition == "used"


def test_facts_add_bands_and_score(spark):
    df = facts(staged(raw_rows(
        spark, {"price": "1234.50", "rating": "4.5", "num_ratings": "100"}, {"product_id": "q", "rating": "0", "num_ratings": "9"}
    )))
    assert df.columns == FACT_COLUMNS
    got = {r.product_id: r for r in df.collect()}
    p = got["p"]
    assert (p.price_bucket, p.price_bucket_500_start, p.price_bucket_500_end) == ("R$1.000 – R$2.000", 1000, 1499)
    assert (p.value_score, p.collection_date) == (D("0.3645"), date(2024, 1, 1))
    assert got["q"].value_score is None


def day(n, **change):
    return {"collected_at": f"2024-01-{n:02d} 10:00:00", "product_id": f"p{n}", **change}


def test_newer_rows_and_empty_target(spark):
    candidates = facts(staged(raw_rows(spark, day(1), day(2), day(3))))
    loaded = candidates.filter("product_id <> 'p3'")
    assert [r.product_id for r in newer_rows(candidates, loaded).collect()] == ["p3"]
    assert newer_rows(candidates, loaded.filter("price > 1e6")).count() == 3
    late = facts(staged(raw_rows(spark, day(1, product_id="late"))))
    assert newer_rows(late, loaded).count() == 0
    assert upserted(loaded, candidates).count() == 3


def test_upsert_on_disk(spark, folder):
    path = f"{folder}/facts"
    write_facts(facts(staged(raw_rows(spark, day(1), day(2)))), path)
    later = {"collected_at": "2024-01-02 18:00:00", "product_id": "p2"}
    run = facts(staged(raw_rows(spark, day(1, price="999"), later, day(3))))
    upsert_facts(spark, path, run)
    rows = sorted((r.product_id, str(r.collected_at), r.price) for r in read_facts(spark, path).collect())
    assert rows == [
        ("p1", "2024-01-01 10:00:00", D("100.00")), ("p2", "2024-01-02 10:00:00", D("100.00")),
        ("p2", "2024-01-02 18:00:00", D("100.00")), ("p3", "2024-01-03 10:00:00", D("100.00")),
    ]
    upsert_facts(spark, path, run)
    assert read_facts(spark, path).count() == 4


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()


def test_an_incremental_run_reads_new_rows_and_no_facts(spark, folder):
    raw = raw_rows(spark, day(1), day(2), day(3))
    raw.write.parquet(f"{folder}/raw")
    write_facts(facts(staged(raw.filter("product_id <> 'p3'"))), f"{folder}/facts")
    loaded = finished_loads(spark, f"{folder}/facts").select(F.col("watermark").alias("collected_at"))
    plan = final_plan(newer_rows(facts(staged(spark.read.parquet(f"{folder}/raw"))), loaded))
    watermark = next(n for n, line in enumerate(plan) if "Filter" in line and "collected_at" in line and "Subquery" in line)
    assert watermark > next(n for n, line in enumerate(plan) if "WindowGroupLimit" in line and "Partial" in line)
    assert not any("FileScan" in line and f"{folder}/facts]" in line for line in plan)


def test_a_load_broken_off_is_not_read(spark, folder):
    path = f"{folder}/facts"
    upsert_facts(spark, path, facts(staged(raw_rows(spark, day(1)))))
    stray = facts(staged(raw_rows(spark, day(2)))).withColumn("load", F.lit(1).cast("bigint"))
    stray.write.mode("append").partitionBy("collection_date", "load").parquet(path)
    assert [r.product_id for r in read_facts(spark, path).collect()] == ["p1"]
    upsert_facts(spark, path, facts(staged(raw_rows(spark, day(1), day(2, title="Samsung B")))))
    assert sorted((r.product_id, r.title) for r in read_facts(spark, path).collect()) == [("p1", "Samsung A"), ("p2", "Samsung B")]


def test_facts_without_a_column_are_refused(spark, folder):
    with pytest.raises(ValueError, match="facts lack price"):
        write_facts(facts(staged(raw_rows(spark, day(1)))).drop("price"), f"{folder}/facts")


def dates(rows):
    return [r.collection_date for r in rows.select("collection_date").distinct().collect()]


def test_a_raw_load_reads_only_its_dates(spark, folder):
    rows = raw_rows(spark, day(1), day(2), day(3)).withColumn("collection_date", F.to_date("collected_at"))
    rows.withColumn("load", F.lit(0).cast("bigint")).write.partitionBy("collection_date", "load").parquet(f"{folder}/raw")
    held = held_rows(spark, f"{folder}/raw", dates(rows.filter("product_id = 'p2'")))
    assert [r.product_id for r in held.collect()] == ["p2"]
    assert all("collection_date=2024-01-02" in f for f in held.inputFiles())
    assert held_rows(spark, f"{folder}/raw", dates(rows.filter("product_id = 'none'"))).count() == 0


def test_a_report_without_choices_keeps_every_price(spark):
    rows = raw_rows(spark, day(1, price="15000"), day(2, price="99999"), day(3, price="1"))
    chosen = MarketFilter(date(2024, 1, 5)).predicate()
    assert facts(staged(rows)).filter(chosen).count() == 3
    assert facts(staged(rows)).filter(MarketFilter(date(2024, 1, 5), max_price=15000).predicate()).count() == 2


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    return read_seed(spark, seed.write(str(tmp_path_factory.mktemp("seed") / "history.csv")))


def test_seed_is_typed(history):
    assert history.count() == 30
    assert dict(history.dtypes)["price"] == "decimal(12,2)" and dict(history.dtypes)["seed_flag"] == "boolean"
    assert history.filter("price is null or collected_at is null or not seed_flag").count() == 0


def test_overview_of_the_seed(history):
    row = marts.market_overview(history).first()
    assert (row.total_observations, row.total_distinct_products, row.total_collection_days) == (30, 5, 6)
    assert (row.min_price, row.max_price, row.median_price) == (D("640.00"), D("4200.00"), D("1125.00"))
    prices = sorted(float(r["price"]) for r in seed.rows())
    assert float(row.avg_price) == round(sum(prices) / 30 + 1e-9, 2)
    assert (row.total_free_shipping, row.pct_free_shipping) == (30, D("100.00"))
    assert (row.total_prime, row.total_amazon_choice, row.total_best_sellers) == (18, 12, 0)


def test_overview_of_nothing_is_one_row(history):
    row = marts.market_overview(history.filter("price < 0")).collect()
    assert len(row) == 1 and row[0].total_observations == 0
    assert row[0].avg_price is None and row[0].median_price is None and row[0].pct_free_shipping is None


def test_variation_of_the_seed(history):
    got = {r.product_id: r for r in marts.price_variation(history).collect()}
    first = got["LOJA-A"]
    assert (first.first_price, first.last_price, first.num_observations) == (D("1200.00"), D("1050.00"), 6)
    assert (first.price_variation_pct, first.max_drop_pct, first.price_trend) == (D("-12.50"), D("12.50"), "caiu")
    assert (got["LOJA-D"].price_variation_pct, got["LOJA-D"].price_trend) == (D("5.00"), "subiu")
    assert (got["LOJA-D"].max_drop_pct, got["LOJA-C"].price_trend) == (0, "estável")
    assert got["LOJA-E"].price_variation_pct == D("-0.51") and got["LOJA-E"].price_trend == "estável"
    assert marts.price_variation(history.filter("product_id = 'LOJA-A'").limit(1)).count() == 0


def test_evolution_of_the_seed(history):
    rows = marts.price_evolution(history).collect()
    assert [r.collection_date for r in rows] == [date(2025, 11, 10 + n) for n in range(6)]
    assert all(r.total_observations == 5 and r.only_seed_data and r.real_data_days == 0 for r in rows)
    assert rows[0].avg_price == D("1844.00") and rows[0].avg_price_pct_change is None
    assert rows[1].avg_price == D("1843.40") and rows[1].avg_price_pct_change == D("-0.03")
    live = marts.price_evolution(history.withColumn("seed_flag", F.lit(False))).first()
    assert live.real_data_days == 1 and not live.only_seed_data


def test_brands_of_the_seed(history):
    nameless = history.filter("product_id = 'LOJA-C'").withColumn("brand", F.lit(None).cast("string"))
    rows = marts.brand_dimension(history.unionByName(nameless.withColumn("sales_volume", F.lit("")))).collect()
    got = {r.brand: r for r in rows}
    boreal = got["Boreal"]
    assert (boreal.total_products, boreal.total_observations, boreal.total_sales_volume_units) == (2, 12, 12000)
    assert boreal.avg_sales_volume_units == 2000
    assert got["Duna"].total_sales_volume_units == 21000 and got["Duna"].rank_by_sales_volume == 1
    assert got["Cedro"].stddev_price == 0
    unknown = got["Sem marca identificada"]
    assert unknown.total_sales_volume_units is None and unknown.total_reviews == got["Cedro"].total_reviews
    # 6015 reviews stand in for the unknown volume: behind 12000 units, ahead of 4200
    assert (boreal.rank_by_sales_volume, unknown.rank_by_sales_volume, got["Cedro"].rank_by_sales_volume) == (2, 3, 4)
    reviews = sum(2000 + n for n in range(6))
    assert got["Duna"].competitiveness_score == round(D("4.50") * reviews / D("4100"), 4)
    assert [r.rank_by_sales_volume for r in rows] == sorted(r.rank_by_sales_volume for r in rows)


def test_mixes_of_the_seed(history):
    assert [r.condition for r in marts.condition_distribution(history).collect()] == ["new"]
    rows = marts.free_shipping_mix(history).collect()
    assert [(r.scope, r.condition, r.shipping_group, r.pct) for r in rows] == [
        ("global", "todos", "com frete grátis", 100), ("por_condition", "new", "com frete grátis", 100)
    ]
    assert all(r.price_diff_vs_no_free_shipping is None for r in rows)
    bands = marts.discount_buckets(history).collect()
    assert bands[0].discount_bucket == "global" and bands[0].total_products == 30
    assert bands[0].products_with_sales_data == 24 and bands[1].pearson_discount_x_ratings is None
    histogram = marts.price_histogram(history.unionByName(history.limit(1).withColumn("price", F.lit(15000.01).cast("decimal(12,2)")))).collect()
    assert sum(r.total_observations for r in histogram) == 30
    assert histogram[0].price_range_label == "R$500 – R$999" and histogram[0].concentration_rank == 1


def test_union_reads_columns_by_name(history):
    both = marts.all_observations(history, history.select(*reversed(history.columns)))
    assert both.count() == 60 and both.columns == marts.OBSERVATION_COLUMNS


def test_reports_on_the_seed(history):
    series = reports.series_since(marts.price_evolution(history), date(2025, 11, 12))
    summary = reports.period_summary(series).first()
    assert (summary.days, summary.observations_per_day, summary.direction) == (4, 5, "caiu")
    assert summary.lowest_price == D("640.00") and summary.has_seed_days
    live = facts(history.withColumn("raw_payload", F.lit(None).cast("string")).withColumn("seed_flag", F.lit(False)))
    everything = MarketFilter(date(2025, 11, 20), period_days=30)
    moves = reports.top_price_moves(marts.price_variation(history), live.filter("product_id <> 'LOJA-D'"), everything)
    assert [r.product_id for r in moves.collect()][:2] == ["LOJA-A", "LOJA-B"]
    assert moves.count() == 4
    trend = reports.trend_summary(moves).first()
    assert (trend.total, trend.falling, trend.rising, trend.flat) == (4, 2, 0, 2)
    assert trend.biggest_fall_pct == D("-12.50") and trend.biggest_faller.startswith("Celular Aurora")
    only = MarketFilter(date(2025, 11, 20), period_days=30, brands=["Boreal"])
    assert [r.brand for r in reports.top_price_moves(marts.price_variation(history), live, only, limit=1).collect()] == []
    peak = reports.peak_bucket(reports.filtered_histogram(live, everything)).first()
    assert (peak.bucket_start, peak.total) == (500, 12)
    assert [r.brand for r in reports.brand_list(live).collect()] == ["Aurora", "Boreal", "Cedro", "Duna"]
    gaps = reports.group_gaps(live, everything).first()
    assert gaps.new_vs_used is None and gaps.free_vs_paid_direction is None and gaps.free_shipping_count == 30


def test_report_without_rows(history):
    live = facts(history.withColumn("raw_payload", F.lit(None).cast("string")).withColumn("seed_flag", F.lit(False)))
    nothing = MarketFilter(date(2030, 1, 1))
    assert reports.filtered_kpis(live, nothing).first().total == 0
    assert reports.filtered_histogram(live, nothing).count() == 0
    assert reports.discount_ratings_corr(live, nothing).first().strength is None


def test_rules_find_what_is_wrong(spark):
    bad = raw_rows(
        spark, {"discount_pct": "-1"}, {"discount_pct": "100.01"}, {"price": None}, {"price": "0"}, {"num_ratings": "-1"},
        {"condition": "velho"}, {"condition": "new"}, {"title": None}, {"ingestion_id": "i0"}, {"source": "amazon_br"},
    )
    report = {r.rule: (r.failures, r.status) for r in q.rule_report(bad).collect()}
    assert report["discount_range"] == (2, "fail") and report["price_positive"] == (2, "fail")
    assert report["quantity_nonnegative"] == (1, "fail") and report["valid_condition"] == (9, "fail")
    assert report["staged.condition.accepted_values"] == (1, "fail")
    assert report["staged.source.accepted_values"] == (9, "fail") and report["staged.title.not_null"] == (1, "fail")
    assert report["staged.ingestion_id.unique"] == (1, "fail")
    assert report["staged.product_collected.unique"] == (1, "fail")
    assert report["staged.batch_id.not_null"] == (0, "pass")
    assert q.run_status(q.rule_report(bad)).first().run_status == "PARTIAL"


def test_daily_run_twice(spark, history, folder):
    first = raw_rows(spark, day(1), day(2), day(2, inserted_at="2024-01-02 12:00:00"))
    done = daily_run.run(spark, first, history, folder)
    assert done.status().first().run_status == "COMPLETED" and done.quality().count() == 25
    counts = {r.table_name: r.row_count for r in done.audit().collect()}
    assert (counts["raw.products"], counts["staging.stg_products"], counts["marts.fct_products"]) == (3, 2, 2)
    assert counts["marts.agg_market_overview"] == 1 and counts["marts.agg_price_variation"] == 5
    assert counts["marts.agg_price_evolution"] == 8 and counts["marts.agg_discount_vs_volume"] >= 3
    second = first.unionByName(raw_rows(spark, day(3, discount_pct="-4")))
    done = daily_run.run(spark, second, history, folder)
    counts = {r.table_name: r.row_count for r in done.audit().collect()}
    assert counts["marts.fct_products"] == 3 and list(counts) == sorted(counts)
    assert done.status().first().run_status == "PARTIAL"


def test_staging_view(spark, history):
    view = materialise_view(history, "history_view")
    assert spark.sql("select count(*) n from history_view").first().n == view.count() == 30
