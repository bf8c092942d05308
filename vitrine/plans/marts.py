"""The analytic tables over product observations.

Every mart takes the observations it works on: real rows, history rows, or
their union from :func:`all_observations`.  Measures are DECIMAL or BIGINT.
Windows only ever run over aggregated rows (days, brands, price buckets).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.labels import (
    bucket_end, bucket_label, bucket_start, discount_band, shipping_label, trend_label,
)
from vitrine.functions.numeric import (
    DISCOUNT_SCALE, PRICE_SCALE, RATING_SCALE, cents, count_where, from_units, half_up, mean, mean_of, pct_change,
    share, units,
)
from vitrine.functions.statistics import moments, pearson_of
from vitrine.functions.text import parse_sales_volume
from vitrine.operators.percentiles import combine_groups, exact_percentiles
from vitrine.schemas import MONEY

OBSERVATION_COLUMNS = [
    "product_id", "title", "brand", "condition", "price", "original_price", "discount_pct",
    "rating", "num_ratings", "is_best_seller", "is_amazon_choice", "is_prime", "free_shipping",
    "sales_volume", "collected_at", "seed_flag",
]
PRICE_CAP = 15000
PACKED_PRICES = Decimal(10) ** 13
UNKNOWN_BRAND = "Sem marca identificada"
QUARTILES = {"median_price": 0.5, "p25_price": 0.25, "p75_price": 0.75}


def all_observations(live: DataFrame, history: DataFrame) -> DataFrame:
    """Live rows and the history seed in one set; marts filter and prune it further."""
    return live.select(*OBSERVATION_COLUMNS).unionByName(history.select(*OBSERVATION_COLUMNS))


def _priced(observations: DataFrame) -> DataFrame:
    return observations.filter("price > 0")


def _percentile_prices(rows: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """Price percentiles rounded to cents."""
    found = exact_percentiles(rows, keys, cents(F.col("price")), wanted)
    return found.select(
        *keys, *[from_units(F.floor(F.col(name) + 0.5), PRICE_SCALE).alias(name) for name in wanted]
    )


def _distinct_products(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct products per group, counted by themselves.

    Together with other measures, Spark would first sum all of them up by product,
    and shuffle about as many wide rows as it has read.
    """
    return rows.groupBy(*keys).agg(F.count_distinct("product_id").alias(name))


def _avg_price():
    return mean(F.col("price"), PRICE_SCALE, 2)


def _avg_discount():
    return mean(F.col("discount_pct"), DISCOUNT_SCALE, 2)


def _avg_ratings_count():
    return mean(F.col("num_ratings"), 0, 0)


def _pct_free_shipping():
    return share(count_where(F.col("free_shipping")), F.count(F.lit(1)))


def market_overview(observations: DataFrame) -> DataFrame:
    """One row of catalogue-wide indicators, also when there are no observations.

    Each distinct count reads its own column; together with the sums they would
    have every row repeated for each of them.
    """
    rows = _priced(observations)
    days = rows.agg(F.count_distinct(F.to_date("collected_at")).alias("total_collection_days"))
    products = rows.agg(F.count_distinct("product_id").alias("total_distinct_products"))
    totals = rows.agg(
        F.min("collected_at").alias("first_collected_at"),
        F.max("collected_at").alias("last_collected_at"),
        F.count(F.lit(1)).alias("total_observations"),
        _avg_price().alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _avg_discount().alias("avg_discount_pct"),
        F.max("discount_pct").alias("max_discount_pct"),
        count_where(F.col("discount_pct") > 0).alias("products_with_discount"),
        mean(F.col("rating"), RATING_SCALE, 2).alias("avg_rating"),
        _avg_ratings_count().alias("avg_num_ratings"),
        count_where(F.col("free_shipping")).alias("total_free_shipping"),
        _pct_free_shipping().alias("pct_free_shipping"),
        count_where(F.col("is_prime")).alias("total_prime"),
        count_where(F.col("is_best_seller")).alias("total_best_sellers"),
        count_where(F.col("is_amazon_choice")).alias("total_amazon_choice"),
    )
    return combine_groups([totals, days, products, _percentile_prices(rows, [], QUARTILES)], []).select(
        "first_collected_at", "last_collected_at", "total_collection_days", "total_distinct_products",
        "total_observations", "avg_price", "min_price", "max_price", "median_price", "p25_price",
        "p75_price", "avg_discount_pct", "max_discount_pct", "products_with_discount", "avg_rating",
        "avg_num_ratings", "total_free_shipping", "pct_free_shipping", "total_prime",
        "total_best_sellers", "total_amazon_choice",
    )


def condition_distribution(observations: DataFrame) -> DataFrame:
    """New against used: volume, price level and rank by average price."""
    rows = _priced(observations)
    keys = ["condition"]
    products = _distinct_products(rows, keys, "total_distinct_products")
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_observations"),
        _avg_price().alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _avg_discount().alias("avg_discount_pct"),
        count_where(F.col("discount_pct") > 0).alias("products_with_discount"),
        count_where(F.col("free_shipping")).alias("total_free_shipping"),
        _pct_free_shipping().alias("pct_free_shipping"),
        mean(F.col("rating"), RATING_SCALE, 2).alias("avg_rating"),
        _avg_ratings_count().alias("avg_num_ratings"),
    )
    medians = _percentile_prices(rows, keys, {"median_price": 0.5})
    everything = Window.partitionBy()
    return (
        combine_groups([products, totals, medians], keys)
        .withColumn("pct_of_total", share(F.col("total_observations"), F.sum("total_observations").over(everything)))
        .withColumn("rank_by_avg_price", F.rank().over(Window.orderBy(F.col("avg_price").desc_nulls_first())))
        .select(
            "condition", "total_distinct_products", "total_observations", "pct_of_total", "avg_price",
            "min_price", "max_price", "median_price", "avg_discount_pct", "products_with_discount",
            "total_free_shipping", "pct_free_shipping", "avg_rating", "avg_num_ratings", "rank_by_avg_price",
        )
        .orderBy(F.col("total_observations").desc())
    )


def free_shipping_mix(observations: DataFrame) -> DataFrame:
    """Free against paid shipping, per condition and overall.

    The rows are summed up once by condition and shipping; the overall rows come
    from those few sums.
    """
    fine = (
        _priced(observations)
        .groupBy("condition", "free_shipping")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents(F.col("price"))).alias("price_sum"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
            F.sum(units(F.col("discount_pct"), DISCOUNT_SCALE)).alias("discount_sum"),
            F.count("discount_pct").alias("discount_n"),
        )
    )
    grouped = fine.groupingSets(
        [[F.col("condition"), F.col("free_shipping")], [F.col("free_shipping")]],
        F.col("condition"),
        F.col("free_shipping"),
    ).agg(
        (F.grouping_id() > 0).alias("overall"),
        F.sum("n").alias("total_products"),
        mean_of(F.sum("price_sum"), F.sum("n"), PRICE_SCALE, 2).alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        mean_of(F.sum("discount_sum"), F.sum("discount_n"), DISCOUNT_SCALE, 2).alias("avg_discount_pct"),
    )
    peers = Window.partitionBy("overall", "condition")
    paid_avg = F.max(F.when(~F.col("free_shipping"), F.col("avg_price"))).over(peers)
    return grouped.select(
        F.when(F.col("overall"), "global").otherwise("por_condition").alias("scope"),
        F.when(F.col("overall"), "todos").otherwise(F.col("condition")).alias("condition"),
        shipping_label(F.col("free_shipping")).alias("shipping_group"),
        "total_products",
        share(F.col("total_products"), F.sum("total_products").over(peers)).alias("pct"),
        "avg_price", "min_price", "max_price", "avg_discount_pct",
        F.when(F.col("overall"), F.col("avg_price") - paid_avg).alias("price_diff_vs_no_free_shipping"),
    ).orderBy("scope", F.col("condition").asc_nulls_last(), "shipping_group")


def price_histogram(observations: DataFrame) -> DataFrame:
    """Observations per price bucket of 500, up to the price cap."""
    rows = observations.filter(f"price > 0 and price <= {PRICE_CAP}").withColumns(
        {"bucket_start": bucket_start(F.col("price")), "bucket_end": bucket_end(F.col("price"))}
    )
    keys = ["bucket_start", "bucket_end"]
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_observations"),
        _avg_price().alias("avg_price_in_bucket"),
        F.min("price").alias("min_price_in_bucket"),
        F.max("price").alias("max_price_in_bucket"),
    )
    histogram = combine_groups([_distinct_products(rows, keys, "total_distinct_products"), totals], keys)
    return histogram.select(
        "bucket_start",
        "bucket_end",
        bucket_label(F.col("bucket_start"), F.col("bucket_end")).alias("price_range_label"),
        "total_distinct_products", "total_observations",
        "avg_price_in_bucket", "min_price_in_bucket", "max_price_in_bucket",
        share(F.col("total_observations"), F.sum("total_observations").over(Window.partitionBy())).alias("pct_of_total"),
        F.rank().over(Window.orderBy(F.col("total_observations").desc())).alias("concentration_rank"),
    ).orderBy("bucket_start")


def price_evolution(observations: DataFrame) -> DataFrame:
    """Daily price series with change against the previous day of the series."""
    rows = _priced(observations).withColumn("collection_date", F.to_date("collected_at"))
    keys = ["collection_date"]
    daily = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_observations"),
        # all rows of a group share its date, so the distinct count is 1 or 0
        F.max(F.when(~F.col("seed_flag"), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("real_data_days"),
        _avg_price().alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _avg_discount().alias("avg_discount_pct"),
        F.max("discount_pct").alias("max_discount_pct"),
        count_where(F.col("free_shipping")).alias("total_free_shipping"),
        count_where(F.col("is_prime")).alias("total_prime"),
        count_where(F.col("is_best_seller")).alias("total_best_sellers"),
        F.bool_and("seed_flag").alias("only_seed_data"),
    )
    series = combine_groups([daily, _percentile_prices(rows, keys, QUARTILES)], keys)
    previous = F.lag("avg_price").over(Window.orderBy("collection_date"))
    return (
        series.withColumn("avg_price_pct_change", pct_change(F.col("avg_price"), previous))
        .select(
            "collection_date", "total_observations", "real_data_days", "avg_price", "min_price", "max_price",
            "median_price", "p25_price", "p75_price", "avg_discount_pct", "max_discount_pct",
            "total_free_shipping", "total_prime", "total_best_sellers", "only_seed_data", "avg_price_pct_change",
        )
        .orderBy("collection_date")
    )


def price_variation(observations: DataFrame) -> DataFrame:
    """First against last price of every product seen at least twice.

    Rows of one instant are ordered by price.  Instant and price are packed into
    one number, so that all measures have a fixed width and the rows are
    aggregated by hashing, without a sort.  They are grouped by title and brand
    as well; the largest of those come from the few groups of a product.
    """
    micros = F.unix_micros(F.col("collected_at").cast("timestamp")).cast("decimal(20,0)")
    packed = (micros * F.lit(PACKED_PRICES) + cents(F.col("price")).cast("decimal(13,0)")).cast("decimal(38,0)")
    per_title = (
        _priced(observations)
        .groupBy("product_id", "title", "brand")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("collected_at").alias("first_seen_at"),
            F.max("collected_at").alias("last_seen_at"),
            F.min(packed).alias("first"),
            F.max(packed).alias("last"),
            F.sum(cents(F.col("price"))).alias("price_sum"),
            F.min("price").alias("low"),
        )
    )
    per_product = (
        per_title.groupBy("product_id")
        .agg(
            F.max("title").alias("title"),
            F.max("brand").alias("brand"),
            F.sum("n").alias("num_observations"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            mean_of(F.sum("price_sum"), F.sum("n"), PRICE_SCALE, 2).alias("avg_price"),
            F.min("low").alias("min_price"),
        )
        .filter("num_observations >= 2")
    )
    first, last = (
        from_units(F.pmod(F.col(c), F.lit(PACKED_PRICES)).cast("bigint"), PRICE_SCALE).cast(MONEY)
        for c in ("first", "last")
    )
    return (
        per_product.select(
            "product_id", "title", "brand", "num_observations",
            "first_seen_at",
            "last_seen_at",
            first.alias("first_price"),
            last.alias("last_price"),
            "avg_price", "min_price",
            pct_change(last, first).alias("price_variation_pct"),
            (-pct_change(F.col("min_price"), first)).alias("max_drop_pct"),
        )
        .withColumn("price_trend", trend_label(F.col("price_variation_pct")))
        .orderBy(F.abs("price_variation_pct").desc_nulls_first())
    )


def discount_buckets(observations: DataFrame) -> DataFrame:
    """Discount bands with sales measures, headed by a row for all observations.

    The rows are summed up once by band; the overall row comes from those few
    sums.  Correlations are reported for the overall row only.
    """
    label, low, high = discount_band(F.col("discount_pct"))
    rows = _priced(observations).select(
        label.alias("discount_bucket"),
        low.alias("bucket_min_pct"),
        high.alias("bucket_max_pct"),
        units(F.col("discount_pct"), DISCOUNT_SCALE).alias("discount"),
        F.col("num_ratings").cast("bigint").alias("ratings"),
        cents(F.col("price")).alias("price"),
        parse_sales_volume(F.col("sales_volume")).cast("bigint").alias("volume"),
    )
    band = ["discount_bucket", "bucket_min_pct", "bucket_max_pct"]
    measures = ["discount", "ratings", "volume", "price"]
    fine = rows.groupBy(*band).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(m).alias(f"{m}_sum") for m in measures),
        *(F.count(m).alias(f"{m}_n") for m in measures),
        *moments(F.col("discount"), F.col("ratings"), "by_ratings"),
        *moments(F.col("discount"), F.col("volume"), "by_volume"),
    )

    def average(measure: str, scale: int, digits: int) -> Column:
        return mean_of(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"), scale, digits)

    grouped = fine.groupingSets([[], [F.col(c) for c in band]], *band).agg(
        (F.grouping_id() > 0).alias("overall"),
        F.sum("n").alias("total_products"),
        average("discount", DISCOUNT_SCALE, 2).alias("avg_discount_pct"),
        average("ratings", 0, 0).alias("avg_num_ratings"),
        average("volume", 0, 0).alias("avg_sales_volume_units"),
        F.sum("volume_n").alias("products_with_sales_data"),
        pearson_of("by_ratings").alias("r_ratings"),
        pearson_of("by_volume").alias("r_volume"),
        average("price", PRICE_SCALE, 2).alias("avg_price"),
    )
    return grouped.select(
        F.when(F.col("overall"), "global").otherwise(F.col("discount_bucket")).alias("discount_bucket"),
        "bucket_min_pct", "bucket_max_pct", "total_products", "avg_discount_pct", "avg_num_ratings",
        "avg_sales_volume_units", "products_with_sales_data",
        F.when(F.col("overall"), half_up(F.col("r_ratings"), 4)).alias("pearson_discount_x_ratings"),
        F.when(F.col("overall"), half_up(F.col("r_volume"), 4)).alias("pearson_discount_x_sales_volume"),
        "avg_price",
    ).orderBy(F.col("bucket_min_pct").asc_nulls_first())


def brand_dimension(observations: DataFrame) -> DataFrame:
    """Brands with volume, price, rating and competitiveness measures and two ranks."""
    rows = _priced(observations).withColumns(
        {
            "brand": F.coalesce(F.col("brand"), F.lit(UNKNOWN_BRAND)),
            "sales_volume_units": parse_sales_volume(F.col("sales_volume")),
        }
    )
    totals = rows.groupBy("brand").agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.sum("sales_volume_units").alias("total_sales_volume_units"),
        mean(F.col("sales_volume_units"), 0, 0).alias("avg_sales_volume_units"),
        F.sum("num_ratings").alias("total_reviews"),
        _avg_ratings_count().alias("avg_num_ratings"),
        _avg_price().alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        from_units(F.floor(F.stddev_samp(cents(F.col("price"))) + 0.5), PRICE_SCALE).alias("stddev_price"),
        _avg_discount().alias("avg_discount_pct"),
        F.max("discount_pct").alias("max_discount_pct"),
        mean(F.col("rating"), RATING_SCALE, 2).alias("avg_rating"),
        F.max("rating").alias("max_rating"),
        count_where(F.col("free_shipping")).alias("total_free_shipping"),
        count_where(F.col("is_prime")).alias("total_prime"),
        count_where(F.col("is_best_seller")).alias("total_best_sellers"),
        count_where(F.col("is_amazon_choice")).alias("total_amazon_choice"),
        _pct_free_shipping().alias("pct_free_shipping"),
        F.min("collected_at").alias("first_seen_at"),
        F.max("collected_at").alias("last_seen_at"),
    )
    brands = combine_groups([_distinct_products(rows, ["brand"], "total_products"), totals], ["brand"])
    reviews_by_rating = F.col("avg_rating").cast("decimal(4,2)") * F.col("total_reviews").cast("decimal(15,0)")
    score = F.when(
        (F.col("avg_price") > 0) & (F.col("avg_rating") > 0), F.try_divide(reviews_by_rating, F.col("avg_price"))
    )
    volume = F.coalesce("total_sales_volume_units", "total_reviews")
    return (
        brands.withColumn("rank_by_sales_volume", F.rank().over(Window.orderBy(volume.desc_nulls_first())))
        .withColumn("competitiveness_score", F.round(score, 4).cast("decimal(20,4)"))
        .withColumn("rank_by_competitiveness", F.rank().over(Window.orderBy(score.desc_nulls_last())))
        .orderBy("rank_by_sales_volume")
    )
