"""Registered queries for the reports.  Cut-off dates are fixed, never the wall clock."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vitrine.catalog.marts import ORACLES as MART_ORACLES
from vitrine.catalog.marts import brand_dimension, price_evolution, price_variation
from vitrine.catalog.sql import OBS, corr, half_up, mean, money, rounded, share
from vitrine.operators.filters import MarketFilter
from vitrine.plans import reports as rep
from vitrine.sources.sales_tables import live_facts

AS_OF = date(2001, 11, 5)
BRANDS = [f"Brand#{i}" for i in (1, 3, 4, 8, 12, 17, 21)]
UP_TO_15000 = MarketFilter(as_of=AS_OF, period_days=1500, max_price=15000)
CHOSEN = MarketFilter(
    as_of=AS_OF, period_days=1500, min_price=500, max_price=8000, condition="new", brands=BRANDS
)
BRAND_CHOICE = MarketFilter(as_of=AS_OF, max_price=15000, brands=BRANDS)


def filtered_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return rep.filtered_kpis(live_facts(spark, folder), CHOSEN)


def filtered_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rep.filtered_histogram(live_facts(spark, folder), CHOSEN)


def filtered_condition_mix(spark: SparkSession, folder: str) -> DataFrame:
    return rep.filtered_condition_mix(live_facts(spark, folder), UP_TO_15000)


def filtered_shipping_mix(spark: SparkSession, folder: str) -> DataFrame:
    return rep.filtered_shipping_mix(live_facts(spark, folder), UP_TO_15000)


def filtered_shipping_price(spark: SparkSession, folder: str) -> DataFrame:
    return rep.filtered_shipping_price(live_facts(spark, folder), CHOSEN)


def brand_list(spark: SparkSession, folder: str) -> DataFrame:
    return rep.brand_list(live_facts(spark, folder))


def group_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return rep.group_gaps(live_facts(spark, folder), UP_TO_15000)


def peak_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return rep.peak_bucket(rep.filtered_histogram(live_facts(spark, folder), UP_TO_15000))


def top_brands(spark: SparkSession, folder: str) -> DataFrame:
    return rep.top_brands(live_facts(spark, folder), UP_TO_15000)


def top_value_brands(spark: SparkSession, folder: str) -> DataFrame:
    return rep.top_value_brands(brand_dimension(spark, folder), BRAND_CHOICE)


def top_price_moves(spark: SparkSession, folder: str) -> DataFrame:
    return rep.top_price_moves(price_variation(spark, folder), live_facts(spark, folder), BRAND_CHOICE)


def trend_summary(spark: SparkSession, folder: str) -> DataFrame:
    moves = rep.top_price_moves(price_variation(spark, folder), live_facts(spark, folder), MarketFilter(AS_OF))
    return rep.trend_summary(moves)


def discount_scatter(spark: SparkSession, folder: str) -> DataFrame:
    return rep.discount_scatter(live_facts(spark, folder), UP_TO_15000)


def discount_trend_ma5(spark: SparkSession, folder: str) -> DataFrame:
    return rep.discount_trend(discount_scatter(spark, folder))


def discount_ratings_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rep.discount_ratings_corr(live_facts(spark, folder), UP_TO_15000)


def series_since(spark: SparkSession, folder: str) -> DataFrame:
    return rep.series_since(price_evolution(spark, folder), UP_TO_15000.cutoff)


def period_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rep.period_summary(series_since(spark, folder))


QUERIES = {
    f.__name__: f
    for f in [
        filtered_kpis, filtered_histogram, filtered_condition_mix, filtered_shipping_mix, filtered_shipping_price,
        brand_list, group_gaps, peak_bucket, top_brands, top_value_brands, top_price_moves, trend_summary,
        discount_scatter, discount_trend_ma5, discount_ratings_corr, series_since, period_summary,
    ]
}

_SINCE = f"collected_at >= timestamp '{UP_TO_15000.cutoff}'"
_IN_BRANDS = "brand in (" + ", ".join(f"'{b}'" for b in BRANDS) + ")"
_ALL = f"{OBS}, f as (select * from obs where not seed_flag and cents between 1 and 1500000 and {_SINCE})"
_SOME = f"""{OBS}, f as (
  select * from obs where not seed_flag and cents between 50000 and 800000 and condition = 'new' and {_IN_BRANDS}
    and {_SINCE})"""
_RATING = rounded("sum(rating2)", "2 * count(rating2)", 2)
_FREE1 = share("count(*) filter (free_shipping)", "count(*)", 1)
_MEDIAN = "quantile_cont(cents::double, 0.5) / 100"
_SCATTER = f"""{_ALL}, s as (
  select ingestion_id, coalesce(brand, 'Outros') as brand, pct, num_ratings, cents, rating2, condition
  from f where num_ratings > 0 order by num_ratings desc, ingestion_id limit 500)"""


def _nested(name: str) -> str:
    """A mart's oracle as a derived table."""
    return f"({MART_ORACLES[name].strip()})"


_MOVES = f"""
select v.product_id, p.title, p.brand, v.first_price, v.last_price, v.price_variation_pct, v.max_drop_pct,
  v.price_trend, v.num_observations,
  case when length(p.title) > 55 then substr(p.title, 1, 55) || '...' else p.title end as title_short,
  case when length(p.title) > 40 then substr(p.title, 1, 40) || '...' else p.title end as label,
  case v.price_trend when 'subiu' then '↑ Alta' when 'caiu' then '↓ Queda' else '→ Estável' end as trend_display
from {_nested('price_variation')} v join (
  with {OBS}
  select distinct on (product_id) product_id, title, brand from obs where not seed_flag
  order by product_id, collected_at desc, ingestion_id desc) p on p.product_id = v.product_id
order by abs(v.price_variation_pct) desc, v.product_id limit 30"""
_SERIES = f"""
select collection_date, avg_price, min_price, p25_price, p75_price, median_price, avg_discount_pct,
  avg_price_pct_change, total_observations, only_seed_data
from {_nested('price_evolution')} where collection_date >= date '{UP_TO_15000.cutoff}'"""

ORACLES = {
    "filtered_kpis": f"""
with {_SOME}
select count(*) as total, {mean('cents', 2, 2)} as avg_price, {money('min(cents)')} as min_price,
  {money('max(cents)')} as max_price, {_MEDIAN} as median_price,
  quantile_cont(cents::double, 0.25) / 100 as p25_price, quantile_cont(cents::double, 0.75) / 100 as p75_price,
  {_FREE1} as pct_free_shipping, {_RATING} as avg_rating, {mean('pct', 0, 1)} as avg_discount
from f""",
    "filtered_histogram": f"""
with {_SOME}, g as (select bucket_start, bucket_start + 499 as bucket_end, count(*) as total from f group by 1, 2),
t as (select sum(total) as all_rows from g)
select bucket_start, bucket_end, total, {share('total', 'all_rows', 1)} as pct from g, t""",
    "filtered_condition_mix": f"""
with {_ALL}, g as (
  select condition, count(*) as total, {mean('cents', 2, 2)} as avg_price, {_MEDIAN} as median_price
  from f group by 1),
t as (select sum(total) as all_rows from g)
select condition, case condition when 'new' then 'Novo' else 'Usado' end as condition_label, total,
  {share('total', 'all_rows', 1)} as pct, avg_price, median_price
from g, t""",
    "filtered_shipping_mix": f"""
with {_ALL}, g as (select condition, free_shipping, count(*) as total from f group by 1, 2),
t as (select *, sum(total) over (partition by condition) as all_rows from g)
select condition, free_shipping, total, {share('total', 'all_rows', 1)} as pct_within_condition from t""",
    "filtered_shipping_price": f"""
with {_SOME}
select free_shipping, {mean('cents', 2, 2)} as avg_price, count(*) as total, {_MEDIAN} as median_price
from f group by 1""",
    "brand_list": f"with {OBS} select distinct brand from obs where not seed_flag and brand is not null",
    "group_gaps": f"""
with {_ALL}, k as (
  select count(*) as total, {mean('cents', 2, 2)} as avg_price, {_MEDIAN} as median_price, {_FREE1} as pct_free from f),
c as (
  select max(case when condition = 'new' then a end) as n, max(case when condition = 'used' then a end) as u
  from (select condition, cast(round({mean('cents', 2, 2)} * 100) as bigint) as a from f group by 1)),
s as (
  select max(case when free_shipping then a end) as fr, max(case when not free_shipping then a end) as pd
  from (select free_shipping, cast(round({mean('cents', 2, 2)} * 100) as bigint) as a from f group by 1))
select cast({half_up('(total * pct_free / 100)', 0)} as bigint) as free_shipping_count,
  {half_up('((avg_price - median_price) / median_price * 100)', 4)} as mean_vs_median_pct,
  {money('n - u')} as new_vs_used, {rounded('100 * (n - u)', 'u', 2)} as new_vs_used_pct,
  {money('fr - pd')} as free_vs_paid, case when fr > pd then 'mais caro' else 'mais barato' end as free_vs_paid_direction
from k, c, s""",
    "peak_bucket": f"""
with {_ALL}, g as (select bucket_start, bucket_start + 499 as bucket_end, count(*) as total from f group by 1, 2),
t as (select sum(total) as all_rows from g)
select bucket_start, bucket_end, total, {share('total', 'all_rows', 1)} as pct from g, t
order by total desc, bucket_start limit 1""",
    "top_brands": f"""
with {_ALL}
select coalesce(b, 'Outros') as brand, * exclude (b) from (
  select brand as b, count(*) as total_produtos, cast(sum(num_ratings) as bigint) as total_avaliacoes,
    {mean('cents', 2, 2)} as avg_price, {_RATING} as avg_rating, {mean('pct', 0, 1)} as avg_discount,
    {_FREE1} as pct_free_shipping
  from f group by brand order by total_avaliacoes desc nulls last, brand nulls last limit 10)""",
    "top_value_brands": f"""
select brand, avg_price, avg_rating, total_products, total_reviews, competitiveness_score, rank_by_competitiveness
from (select * from {_nested('brand_dimension')} where total_products >= 2
      order by rank_by_competitiveness, brand limit 15)
where {_IN_BRANDS}""",
    "top_price_moves": f"select * from ({_MOVES}) where {_IN_BRANDS}",
    "trend_summary": f"""
with m as ({_MOVES})
select count(*) as total, count(*) filter (price_trend = 'caiu') as falling,
  {share("count(*) filter (price_trend = 'caiu')", 'count(*)', 1)} as pct_falling,
  count(*) filter (price_trend = 'subiu') as rising,
  {share("count(*) filter (price_trend = 'subiu')", 'count(*)', 1)} as pct_rising,
  count(*) filter (price_trend = 'estável') as flat,
  (select title from m order by price_variation_pct, product_id limit 1) as biggest_faller,
  min(price_variation_pct) as biggest_fall_pct
from m""",
    "discount_scatter": f"""
with {_SCATTER}
select ingestion_id, brand, pct::double as discount_pct, num_ratings, {money('cents')} as price,
  rating2::double / 2 as rating, condition
from s""",
    "discount_trend_ma5": f"""
with {_SCATTER}
select position, trend_x, trend_y from (
  select cast(row_number() over w as int) as position, pct::double as trend_x,
    (sum(num_ratings) over (w rows between 4 preceding and current row))::double / 5 as trend_y
  from s window w as (order by pct, ingestion_id))
where position >= 5""",
    "discount_ratings_corr": f"""
with {_ALL}, c as (select {corr('pct', 'num_ratings', 3)} as r from f where num_ratings > 0)
select r as pearson_desconto_avaliacoes, case when r is null then null when r > 0.5 then 'forte positiva'
  when r > 0.2 then 'moderada positiva' when r > 0 then 'fraca positiva' when r < -0.5 then 'forte negativa'
  when r < -0.2 then 'moderada negativa' else 'fraca negativa' end as strength
from c""",
    "series_since": _SERIES,
    "period_summary": f"""
with s as ({_SERIES}), a as (
  select count(*) as days, cast(floor(avg(total_observations)) as bigint) as observations_per_day,
    {rounded('sum(cast(round(avg_price_pct_change * 100) as bigint))', '100 * count(avg_price_pct_change)', 4)}
      as avg_daily_change_pct,
    min(min_price) as lowest_price, max(avg_price) as highest_avg_price,
    arg_min(avg_price, collection_date) as first_price, arg_max(avg_price, collection_date) as last_price,
    bool_or(only_seed_data) as has_seed_days
  from s),
v as (
  select *, {rounded('100 * cast(round((last_price - first_price) * 100) as bigint)',
                     'cast(round(first_price * 100) as bigint)', 2)} as variation_pct from a)
select *, {half_up('(highest_avg_price - lowest_price)', 2)} as amplitude,
  case when variation_pct > 0 then 'subiu' else 'caiu' end as direction
from v""",
}
