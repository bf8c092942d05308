"""Report queries: filtered KPIs, filtered distributions, top lists, summaries.

They read the fact set or a mart.  Row-level lists always end in a limit with
a total order, so Spark keeps only the best rows of every partition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.labels import CONDITION_DISPLAY, TREND_DISPLAY, TREND_DOWN, TREND_FLAT, TREND_UP, display, shorten
from vitrine.functions.numeric import (
    DISCOUNT_SCALE, PRICE_SCALE, RATING_SCALE, cents, count_where, half_up, mean, pct_change, share,
)
from vitrine.functions.statistics import correlation_strength, pearson
from vitrine.operators.filters import MarketFilter
from vitrine.operators.keyed import first_per_key
from vitrine.operators.percentiles import combine_groups, exact_percentiles

OTHER_BRANDS = "Outros"


def _percentile_prices(rows: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """Price percentiles as interpolated, without rounding."""
    found = exact_percentiles(rows, keys, cents(F.col("price")), wanted)
    return found.select(*keys, *[(F.col(name) / 100).alias(name) for name in wanted])


def brand_list(facts: DataFrame) -> DataFrame:
    return facts.filter("brand is not null").select("brand").distinct().orderBy("brand")


def filtered_kpis(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    """One row of headline figures, with the gap between mean and median price."""
    rows = chosen.rows_of(facts)
    totals = rows.agg(
        F.count(F.lit(1)).alias("total"),
        mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        share(count_where(F.col("free_shipping")), F.count(F.lit(1)), 1).alias("pct_free_shipping"),
        mean(F.col("rating"), RATING_SCALE, 2).alias("avg_rating"),
        mean(F.col("discount_pct"), DISCOUNT_SCALE, 1).alias("avg_discount"),
    )
    quartiles = _percentile_prices(rows, [], {"median_price": 0.5, "p25_price": 0.25, "p75_price": 0.75})
    return combine_groups([totals, quartiles], []).select(
        "total", "avg_price", "min_price", "max_price", "median_price", "p25_price", "p75_price",
        "pct_free_shipping", "avg_rating", "avg_discount",
    )


def filtered_histogram(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    buckets = (
        chosen.rows_of(facts)
        .groupBy(
            F.col("price_bucket_500_start").alias("bucket_start"), F.col("price_bucket_500_end").alias("bucket_end")
        )
        .agg(F.count(F.lit(1)).alias("total"))
    )
    everything = F.sum("total").over(Window.partitionBy())
    return buckets.withColumn("pct", share(F.col("total"), everything, 1)).orderBy("bucket_start")


def peak_bucket(histogram: DataFrame) -> DataFrame:
    """The fullest bucket; the lowest one of several equals."""
    fullest = F.max_by(
        F.struct("bucket_start", "bucket_end", "total", "pct"),
        F.struct(F.col("total"), -F.col("bucket_start")),
    )
    return histogram.agg(fullest.alias("peak")).select("peak.*")


def filtered_condition_mix(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    rows = chosen.rows_of(facts)
    totals = rows.groupBy("condition").agg(
        F.count(F.lit(1)).alias("total"), mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price")
    )
    medians = _percentile_prices(rows, ["condition"], {"median_price": 0.5})
    everything = F.sum("total").over(Window.partitionBy())
    return (
        combine_groups([totals, medians], ["condition"])
        .select(
            "condition", display(F.col("condition"), CONDITION_DISPLAY).alias("condition_label"),
            "total", share(F.col("total"), everything, 1).alias("pct"), "avg_price", "median_price",
        )
        .orderBy(F.col("total").desc())
    )


def filtered_shipping_mix(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    of_condition = F.sum("total").over(Window.partitionBy("condition"))
    return (
        chosen.rows_of(facts)
        .groupBy("condition", "free_shipping")
        .agg(F.count(F.lit(1)).alias("total"))
        .withColumn("pct_within_condition", share(F.col("total"), of_condition, 1))
        .orderBy("condition", F.col("free_shipping").desc())
    )


def filtered_shipping_price(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    rows = chosen.rows_of(facts)
    totals = rows.groupBy("free_shipping").agg(
        mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price"), F.count(F.lit(1)).alias("total")
    )
    medians = _percentile_prices(rows, ["free_shipping"], {"median_price": 0.5})
    return (
        combine_groups([totals, medians], ["free_shipping"])
        .select("free_shipping", "avg_price", "total", "median_price")
        .orderBy(F.col("free_shipping").desc())
    )


def group_gaps(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    """One row: mean against median, new against used, free against paid shipping."""
    rows = chosen.rows_of(facts)

    def avg_price(group: Column) -> Column:
        return mean(F.when(group, F.col("price")), PRICE_SCALE, 2)

    averages = rows.agg(
        F.count(F.lit(1)).alias("total"),
        share(count_where(F.col("free_shipping")), F.count(F.lit(1)), 1).alias("pct_free_shipping"),
        mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price"),
        avg_price(F.col("condition") == "new").alias("avg_new"),
        avg_price(F.col("condition") == "used").alias("avg_used"),
        avg_price(F.col("free_shipping")).alias("avg_free"),
        avg_price(~F.col("free_shipping")).alias("avg_paid"),
    )
    mean_over_median = F.try_divide(
        F.col("avg_price").cast("double") - F.col("median_price"), F.col("median_price")
    ) * F.lit(100.0)
    return combine_groups([averages, _percentile_prices(rows, [], {"median_price": 0.5})], []).select(
        half_up(F.col("total") * F.col("pct_free_shipping").cast("double") / 100, 0)
        .cast("bigint").alias("free_shipping_count"),
        half_up(mean_over_median, 4).alias("mean_vs_median_pct"),
        (F.col("avg_new") - F.col("avg_used")).alias("new_vs_used"),
        pct_change(F.col("avg_new"), F.col("avg_used")).alias("new_vs_used_pct"),
        (F.col("avg_free") - F.col("avg_paid")).alias("free_vs_paid"),
        F.when(F.col("avg_free") > F.col("avg_paid"), "mais caro")
        .when(F.col("avg_free").isNotNull() & F.col("avg_paid").isNotNull(), "mais barato")
        .alias("free_vs_paid_direction"),
    )


def top_brands(facts: DataFrame, chosen: MarketFilter, limit: int = 10) -> DataFrame:
    """Brands by number of reviews.  Rows without a brand form their own group,
    shown under the same name as a brand called so would be, but not merged."""
    return (
        chosen.rows_of(facts)
        .groupBy(F.col("brand").alias("stated_brand"))
        .agg(
            F.count(F.lit(1)).alias("total_produtos"),
            F.sum("num_ratings").alias("total_avaliacoes"),
            mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price"),
            mean(F.col("rating"), RATING_SCALE, 2).alias("avg_rating"),
            mean(F.col("discount_pct"), DISCOUNT_SCALE, 1).alias("avg_discount"),
            share(count_where(F.col("free_shipping")), F.count(F.lit(1)), 1).alias("pct_free_shipping"),
        )
        .orderBy(F.col("total_avaliacoes").desc_nulls_last(), F.col("stated_brand").asc_nulls_last())
        .limit(limit)
        .withColumn("stated_brand", F.coalesce("stated_brand", F.lit(OTHER_BRANDS)))
        .withColumnRenamed("stated_brand", "brand")
    )


def _discounted(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    return chosen.rows_of(facts).filter("discount_pct is not null and num_ratings > 0")


def discount_scatter(facts: DataFrame, chosen: MarketFilter, limit: int = 500) -> DataFrame:
    """The most reviewed observations; ties go by ingestion id."""
    return (
        _discounted(facts, chosen)
        .orderBy(F.col("num_ratings").desc(), "ingestion_id")
        .limit(limit)
        .select(
            "ingestion_id",
            F.coalesce("brand", F.lit(OTHER_BRANDS)).alias("brand"),
            F.round("discount_pct", 1).alias("discount_pct"),
            "num_ratings", "price", "rating", "condition",
        )
    )


def discount_trend(scatter: DataFrame, width: int = 5) -> DataFrame:
    """Moving average of reviews along the discount axis, full windows only.

    The scatter is limited, so one task may sort it.
    """
    along = Window.orderBy("discount_pct", "ingestion_id")
    trailing = along.rowsBetween(-(width - 1), Window.currentRow)
    return (
        scatter.select(
            F.row_number().over(along).alias("position"),
            F.col("discount_pct").alias("trend_x"),
            F.avg("num_ratings").over(trailing).alias("trend_y"),
        )
        .filter(F.col("position") >= width)
        .orderBy("position")
    )


def discount_ratings_corr(facts: DataFrame, chosen: MarketFilter) -> DataFrame:
    r = pearson(F.col("discount_pct"), F.col("num_ratings"))
    return (
        _discounted(facts, chosen)
        .agg(half_up(r, 3).alias("pearson_desconto_avaliacoes"))
        .withColumn("strength", correlation_strength(F.col("pearson_desconto_avaliacoes")))
    )


def top_value_brands(brands: DataFrame, chosen: MarketFilter, limit: int = 15) -> DataFrame:
    """Brands by competitiveness; the brand choice applies after the limit."""
    return (
        brands.filter("brand is not null and total_products >= 2")
        .orderBy("rank_by_competitiveness", "brand")
        .limit(limit)
        .filter(chosen.of_brands(F.col("brand")))
        .select(
            "brand", "avg_price", "avg_rating", "total_products", "total_reviews",
            "competitiveness_score", "rank_by_competitiveness",
        )
    )


def latest_per_product(facts: DataFrame) -> DataFrame:
    """Newest observation of every product; ties go to the highest ingestion id."""
    return first_per_key(facts, ["product_id"], [F.col("collected_at").desc(), F.col("ingestion_id").desc()])


def top_price_moves(variation: DataFrame, facts: DataFrame, chosen: MarketFilter, limit: int = 30) -> DataFrame:
    """Largest first-to-last price moves, with the products' latest titles.

    Products without a current observation drop out.  The brand choice applies
    after the limit.
    """
    latest = latest_per_product(facts.select("product_id", "title", "brand", "collected_at", "ingestion_id"))
    moves = variation.filter("num_observations >= 2").drop("title", "brand")
    return (
        moves.join(latest.select("product_id", "title", "brand"), "product_id")
        .orderBy(F.abs("price_variation_pct").desc_nulls_first(), "product_id")
        .limit(limit)
        .filter(chosen.of_brands(F.col("brand")))
        .select(
            "product_id", "title", "brand", "first_price", "last_price",
            "price_variation_pct", "max_drop_pct", "price_trend", "num_observations",
            shorten(F.col("title"), 55).alias("title_short"),
            shorten(F.col("title"), 40).alias("label"),
            display(F.col("price_trend"), TREND_DISPLAY).alias("trend_display"),
        )
    )


def trend_summary(moves: DataFrame) -> DataFrame:
    """How many of the listed products fell, rose or stayed, and the biggest faller."""
    total = F.count(F.lit(1))
    falling = count_where(F.col("price_trend") == TREND_DOWN)
    rising = count_where(F.col("price_trend") == TREND_UP)
    fallen = F.col("price_variation_pct").isNotNull()
    faller = F.min(F.when(fallen, F.struct("price_variation_pct", "product_id", "title")))
    return moves.agg(
        total.alias("total"),
        falling.alias("falling"),
        share(falling, total, 1).alias("pct_falling"),
        rising.alias("rising"),
        share(rising, total, 1).alias("pct_rising"),
        count_where(F.col("price_trend") == TREND_FLAT).alias("flat"),
        faller.alias("faller"),
    ).select(
        "total", "falling", "pct_falling", "rising", "pct_rising", "flat",
        F.col("faller.title").alias("biggest_faller"),
        F.col("faller.price_variation_pct").alias("biggest_fall_pct"),
    )


def series_since(evolution: DataFrame, cutoff: date) -> DataFrame:
    return (
        evolution.filter(F.col("collection_date") >= F.lit(cutoff))
        .select(
            "collection_date", "avg_price", "min_price", "p25_price", "p75_price", "median_price",
            "avg_discount_pct", "avg_price_pct_change", "total_observations", "only_seed_data",
        )
        .orderBy("collection_date")
    )


def period_summary(series: DataFrame) -> DataFrame:
    """One row over a daily series: length, volume, price range, first-to-last change."""
    summary = series.agg(
        F.count(F.lit(1)).alias("days"),
        F.floor(F.avg("total_observations")).cast("bigint").alias("observations_per_day"),
        mean(F.col("avg_price_pct_change"), 2, 4).alias("avg_daily_change_pct"),
        F.min("min_price").alias("lowest_price"),
        F.max("avg_price").alias("highest_avg_price"),
        F.min_by("avg_price", "collection_date").alias("first_price"),
        F.max_by("avg_price", "collection_date").alias("last_price"),
        F.coalesce(F.bool_or("only_seed_data"), F.lit(False)).alias("has_seed_days"),
    )
    variation = F.coalesce(pct_change(F.col("last_price"), F.col("first_price")), F.lit(0))
    return summary.withColumns(
        {
            "amplitude": F.col("highest_avg_price") - F.col("lowest_price"),
            "variation_pct": variation,
            "direction": F.when(variation > 0, TREND_UP).otherwise(TREND_DOWN),
        }
    )
