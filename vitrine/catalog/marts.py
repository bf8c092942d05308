"""Registered queries for the marts and the layer audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.catalog.sql import OBS, OBS_ONLY, STAGED, corr, half_up, mean, money, quantile, rounded, share, volume_units
from vitrine.plans import daily_run, marts
from vitrine.session import scratch_folder
from vitrine.sources.sales_tables import observations, raw_products


_MEASURES = ["product_id", "price", "discount_pct", "rating", "num_ratings", "free_shipping"]


def market_overview(spark: SparkSession, folder: str) -> DataFrame:
    flags = ["is_prime", "is_best_seller", "is_amazon_choice"]
    return marts.market_overview(observations(spark, folder, *_MEASURES, *flags, "collected_at"))


def condition_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return marts.condition_distribution(observations(spark, folder, *_MEASURES, "condition"))


def free_shipping_mix(spark: SparkSession, folder: str) -> DataFrame:
    return marts.free_shipping_mix(observations(spark, folder, "condition", "free_shipping", "price", "discount_pct"))


def price_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return marts.price_histogram(observations(spark, folder, "product_id", "price"))


def price_evolution(spark: SparkSession, folder: str) -> DataFrame:
    columns = [
        "collected_at", "price", "discount_pct", "free_shipping", "is_prime", "is_best_seller", "seed_flag",
    ]
    return marts.price_evolution(observations(spark, folder, *columns))


def price_variation(spark: SparkSession, folder: str) -> DataFrame:
    return marts.price_variation(observations(spark, folder, "product_id", "title", "brand", "price", "collected_at"))


def brand_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return marts.brand_dimension(observations(spark, folder))


def discount_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return marts.discount_buckets(
        observations(spark, folder, "discount_pct", "num_ratings", "price", "sales_volume")
    )


def discount_corr_global(spark: SparkSession, folder: str) -> DataFrame:
    return (
        discount_buckets(spark, folder)
        .filter("discount_bucket = 'global'")
        .select("total_products", "pearson_discount_x_ratings", "pearson_discount_x_sales_volume")
    )


def observation_union(spark: SparkSession, folder: str) -> DataFrame:
    """Live facts and history rows put together again, counted per kind and condition."""
    rows = observations(spark, folder)
    live = rows.filter(~F.col("seed_flag"))
    history = rows.filter("seed_flag")
    return (
        marts.all_observations(live, history)
        .groupBy("seed_flag", "condition")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("price") * 100).cast("bigint")).alias("price_cents"),
            F.min("collected_at").alias("first_collected_at"),
            F.max("collected_at").alias("last_collected_at"),
        )
    )


def row_count_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every layer, counted while it is stored."""
    history = observations(spark, folder).filter("seed_flag")
    home = scratch_folder(spark, "layers")
    return daily_run.rebuild(spark, raw_products(spark, folder), history, home, at_once=8).audit()


QUERIES = {
    f.__name__: f
    for f in [
        market_overview, condition_distribution, free_shipping_mix, price_histogram, price_evolution,
        price_variation, brand_dimension, discount_buckets, discount_corr_global, observation_union,
        row_count_audit,
    ]
}

_PCT_FREE = share("count(*) filter (free_shipping)", "count(*)")
_UNITS = volume_units("sales_volume")

# Fixed values in these: discount bands, price segments, labels and their limits.
ORACLES = {
    "market_overview": f"""
with {OBS}
select min(collected_at) as first_collected_at, max(collected_at) as last_collected_at,
  count(distinct collection_date) as total_collection_days, count(distinct product_id) as total_distinct_products,
  count(*) as total_observations, {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price,
  {money('max(cents)')} as max_price, {quantile(0.5)} as median_price, {quantile(0.25)} as p25_price,
  {quantile(0.75)} as p75_price, {mean('pct', 0, 2)} as avg_discount_pct, max(pct)::double as max_discount_pct,
  count(*) filter (pct > 0) as products_with_discount, {rounded('sum(rating2)', '2 * count(rating2)', 2)} as avg_rating,
  {mean('num_ratings', 0, 0)} as avg_num_ratings, count(*) filter (free_shipping) as total_free_shipping,
  {_PCT_FREE} as pct_free_shipping, count(*) filter (is_prime) as total_prime,
  count(*) filter (is_best_seller) as total_best_sellers, count(*) filter (is_amazon_choice) as total_amazon_choice
from obs where cents > 0""",
    "condition_distribution": f"""
with {OBS}, g as (
  select condition, count(distinct product_id) as total_distinct_products, count(*) as total_observations,
    {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price, {money('max(cents)')} as max_price,
    {quantile(0.5)} as median_price, {mean('pct', 0, 2)} as avg_discount_pct,
    count(*) filter (pct > 0) as products_with_discount, count(*) filter (free_shipping) as total_free_shipping,
    {_PCT_FREE} as pct_free_shipping, {rounded('sum(rating2)', '2 * count(rating2)', 2)} as avg_rating,
    {mean('num_ratings', 0, 0)} as avg_num_ratings
  from obs where cents > 0 group by condition),
t as (select sum(total_observations) as all_rows from g)
select g.*, {share('total_observations', 'all_rows')} as pct_of_total,
  cast(rank() over (order by avg_price desc) as int) as rank_by_avg_price
from g, t""",
    "free_shipping_mix": f"""
with {OBS}, m as (
  select 'por_condition' as scope, condition, free_shipping, count(*) as total_products,
    {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price, {money('max(cents)')} as max_price,
    {mean('pct', 0, 2)} as avg_discount_pct
  from obs where cents > 0 group by condition, free_shipping
  union all
  select 'global', 'todos', free_shipping, count(*), {mean('cents', 2, 2)}, {money('min(cents)')},
    {money('max(cents)')}, {mean('pct', 0, 2)}
  from obs where cents > 0 group by free_shipping),
w as (
  select *, sum(total_products) over (partition by scope, condition) as peers,
    max(case when not free_shipping then avg_price end) over (partition by scope, condition) as paid
  from m)
select scope, condition,
  case when free_shipping then 'com frete grátis' else 'sem frete grátis' end as shipping_group, total_products,
  {share('total_products', 'peers')} as pct, avg_price, min_price, max_price, avg_discount_pct,
  case when scope = 'global' then {half_up('(avg_price - paid)', 2)} end as price_diff_vs_no_free_shipping
from w""",
    "price_histogram": f"""
with {OBS}, g as (
  select bucket_start, bucket_start + 499 as bucket_end, count(distinct product_id) as total_distinct_products,
    count(*) as total_observations, {mean('cents', 2, 2)} as avg_price_in_bucket,
    {money('min(cents)')} as min_price_in_bucket, {money('max(cents)')} as max_price_in_bucket
  from obs where cents > 0 and cents <= 1500000 group by bucket_start),
t as (select sum(total_observations) as all_rows from g)
select bucket_start, bucket_end,
  'R$' || replace(format('{{:,}}', bucket_start), ',', '.') || ' – R$' || replace(format('{{:,}}', bucket_end), ',', '.')
    as price_range_label,
  total_distinct_products, total_observations, avg_price_in_bucket, min_price_in_bucket, max_price_in_bucket,
  {share('total_observations', 'all_rows')} as pct_of_total,
  cast(rank() over (order by total_observations desc) as int) as concentration_rank
from g, t""",
    "price_evolution": f"""
with {OBS}, g as (
  select collection_date, count(*) as total_observations,
    count(distinct case when not seed_flag then collection_date end) as real_data_days,
    {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price, {money('max(cents)')} as max_price,
    {quantile(0.5)} as median_price, {quantile(0.25)} as p25_price, {quantile(0.75)} as p75_price,
    {mean('pct', 0, 2)} as avg_discount_pct, max(pct)::double as max_discount_pct,
    count(*) filter (free_shipping) as total_free_shipping, count(*) filter (is_prime) as total_prime,
    count(*) filter (is_best_seller) as total_best_sellers, bool_and(seed_flag) as only_seed_data
  from obs where cents > 0 group by collection_date),
l as (
  select *, cast(round(avg_price * 100) as bigint) as now_c,
    cast(round(lag(avg_price) over (order by collection_date) * 100) as bigint) as old_c
  from g)
select * exclude (now_c, old_c), {rounded('100 * (now_c - old_c)', 'old_c', 2)} as avg_price_pct_change from l""",
    "price_variation": f"""
with {OBS}, r as (
  select *, row_number() over (partition by product_id order by collected_at, cents) as up,
    row_number() over (partition by product_id order by collected_at desc, cents desc) as down
  from obs where cents > 0),
g as (
  select product_id, max(title) as title, max(brand) as brand, count(*) as num_observations,
    max(case when up = 1 then collected_at end) as first_seen_at,
    max(case when down = 1 then collected_at end) as last_seen_at,
    max(case when up = 1 then cents end) as first_c, max(case when down = 1 then cents end) as last_c,
    {mean('cents', 2, 2)} as avg_price, min(cents) as min_c
  from r group by product_id having count(*) >= 2),
v as (select *, {rounded('100 * (last_c - first_c)', 'first_c', 2)} as variation from g)
select product_id, title, brand, num_observations, first_seen_at, last_seen_at, {money('first_c')} as first_price,
  {money('last_c')} as last_price, avg_price, {money('min_c')} as min_price, variation as price_variation_pct,
  {rounded('100 * (first_c - min_c)', 'first_c', 2)} as max_drop_pct,
  case when variation > 1 then 'subiu' when variation < -1 then 'caiu' else 'estável' end as price_trend
from v""",
    "brand_dimension": f"""
with {OBS}, b as (select *, coalesce(brand, 'Sem marca identificada') as b, {_UNITS} as u from obs where cents > 0),
g as (
  select b as brand, count(distinct product_id) as total_products, count(*) as total_observations,
    cast(sum(u) as bigint) as total_sales_volume_units, {mean('u', 0, 0)} as avg_sales_volume_units,
    cast(sum(num_ratings) as bigint) as total_reviews, {mean('num_ratings', 0, 0)} as avg_num_ratings,
    {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price, {money('max(cents)')} as max_price,
    floor(stddev_samp(cents) + 0.5) / 100 as stddev_price, {mean('pct', 0, 2)} as avg_discount_pct,
    max(pct)::double as max_discount_pct, {rounded('sum(rating2)', '2 * count(rating2)', 2)} as avg_rating,
    max(rating2)::double / 2 as max_rating, count(*) filter (free_shipping) as total_free_shipping,
    count(*) filter (is_prime) as total_prime, count(*) filter (is_best_seller) as total_best_sellers,
    count(*) filter (is_amazon_choice) as total_amazon_choice, {_PCT_FREE} as pct_free_shipping,
    min(collected_at) as first_seen_at, max(collected_at) as last_seen_at
  from b group by b),
s as (
  select *, case when avg_price > 0 and avg_rating > 0
      then cast(round(avg_rating * 100) as bigint) * total_reviews end as num,
    cast(round(avg_price * 100) as bigint) as den
  from g)
select * exclude (num, den),
  cast(rank() over (order by coalesce(total_sales_volume_units, total_reviews) desc nulls first) as int)
    as rank_by_sales_volume,
  {rounded('num', 'den', 4)} as competitiveness_score,
  cast(rank() over (order by num::double / den desc nulls last) as int) as rank_by_competitiveness
from s""",
    "discount_buckets": f"""
with {OBS}, b as (select *, {_UNITS} as u from obs where cents > 0)
select 'global' as discount_bucket, null::double as bucket_min_pct, null::double as bucket_max_pct,
  count(*) as total_products, {mean('pct', 0, 2)} as avg_discount_pct, {mean('num_ratings', 0, 0)} as avg_num_ratings,
  {mean('u', 0, 0)} as avg_sales_volume_units, count(u) as products_with_sales_data,
  {corr('pct', 'num_ratings', 4)} as pearson_discount_x_ratings,
  {corr('pct', 'u', 4)} as pearson_discount_x_sales_volume, {mean('cents', 2, 2)} as avg_price
from b
union all
select case when pct = 0 then '0% (sem desconto)' when pct between 0.01 and 10 then '1% – 10%'
    when pct between 10.01 and 20 then '11% – 20%' when pct between 20.01 and 30 then '21% – 30%'
    when pct between 30.01 and 50 then '31% – 50%' else 'Acima de 50%' end,
  case when pct = 0 then 0 when pct <= 10 then 0.01 when pct <= 20 then 10.01 when pct <= 30 then 20.01
    when pct <= 50 then 30.01 else 50.01 end::double,
  case when pct = 0 then 0 when pct <= 10 then 10 when pct <= 20 then 20 when pct <= 30 then 30
    when pct <= 50 then 50 else 100 end::double,
  count(*), {mean('pct', 0, 2)}, {mean('num_ratings', 0, 0)}, {mean('u', 0, 0)}, count(u),
  null::double, null::double, {mean('cents', 2, 2)}
from b group by 1, 2, 3""",
    "discount_corr_global": f"""
with {OBS}, b as (select *, {_UNITS} as u from obs where cents > 0)
select count(*) as total_products, {corr('pct', 'num_ratings', 4)} as pearson_discount_x_ratings,
  {corr('pct', 'u', 4)} as pearson_discount_x_sales_volume
from b""",
    "observation_union": f"""
with {OBS}
select seed_flag, condition, count(*) as n, cast(sum(cents) as bigint) as price_cents,
  min(collected_at) as first_collected_at, max(collected_at) as last_collected_at
from obs group by all""",
    "row_count_audit": f"""
with {STAGED}, {OBS_ONLY},
live as (select product_id, condition, brand, free_shipping, cents, discount_pct, collected_at from stg),
both_ as (
  select * from live
  union all
  select product_id, condition, brand, free_shipping, cents, pct, collected_at from obs where seed_flag and cents > 0)
select 'raw.products' as table_name, count(*) as row_count from raw
union all select 'staging.stg_products', count(*) from stg
union all select 'marts.fct_products', count(*) from stg
union all select 'marts.dim_sellers', count(distinct coalesce(brand, 'Sem marca identificada')) from both_
union all select 'marts.agg_market_overview', 1
union all select 'marts.agg_free_shipping', count(distinct (condition, free_shipping)) + count(distinct free_shipping) from both_
union all select 'marts.agg_discount_vs_volume', 1 + count(distinct (
    case when discount_pct = 0 then 1 when discount_pct between 0.01 and 10 then 2
      when discount_pct between 10.01 and 20 then 3 when discount_pct between 20.01 and 30 then 4
      when discount_pct between 30.01 and 50 then 5 else 6 end,
    case when discount_pct = 0 then 1 when discount_pct <= 10 then 2 when discount_pct <= 20 then 3
      when discount_pct <= 30 then 4 when discount_pct <= 50 then 5 else 6 end)) from both_
union all select 'marts.agg_condition_distribution', count(distinct condition) from both_
union all select 'marts.agg_price_histogram', count(distinct floor(cents / 50000)) from both_ where cents <= 1500000
union all select 'marts.agg_price_evolution', count(distinct cast(collected_at as date)) from both_
union all select 'marts.agg_price_variation', count(*) from (
  select product_id from both_ group by product_id having count(*) >= 2)""",
}
