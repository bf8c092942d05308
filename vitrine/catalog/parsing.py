"""Registered queries for parsing, normalising and cleaning.

Row-level results are counted per parsed value, which keeps them small on a
table of any size while every row is parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.catalog.sql import (
    BRAND_OF, CONDITION_OF, DISCOUNT_OF, LINE_ID, LINES, OBS, RAW, STAGED, VOLUME_TEXT, mean, money, rounded,
    share, volume_units,
)
from vitrine.functions.labels import brl, int_text, pct_text
from vitrine.functions.text import (
    brand_from_title, first_filled, is_free_shipping, normalize_condition, parse_price, parse_sales_volume,
)
from vitrine.functions.numeric import cents, count_where
from vitrine.plans.facts import facts
from vitrine.plans.marts import brand_dimension
from vitrine.plans.staging import repaired_discount, staged, with_neutral_values
from vitrine.schemas import SEARCH_PAGE
from vitrine.sources import sales_tables as st
from vitrine.sources.listings import collection_discount, page_items, records

def _n():
    return F.count(F.lit(1)).alias("n")


def parse_price_br(spark: SparkSession, folder: str) -> DataFrame:
    lines = st.observed_lines(spark, folder)
    parsed = parse_price(st.price_text())
    return (
        lines.select("l_linenumber", parsed.alias("price"))
        .groupBy("l_linenumber")
        .agg(
            _n(),
            F.count("price").alias("n_parsed"),
            F.sum(F.floor(F.col("price") * 100 + 0.5)).alias("price_cents"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
    )


def parse_sales_volume_query(spark: SparkSession, folder: str) -> DataFrame:
    units = parse_sales_volume(F.col("sales_volume"))
    return st.observations(spark, folder, "sales_volume").groupBy(units.alias("units")).agg(_n())


def parse_sales_volume_first_number(spark: SparkSession, folder: str) -> DataFrame:
    units = parse_sales_volume(F.col("sales_volume"), empty_as_zero=True)
    return st.observations(spark, folder, "sales_volume").groupBy(units.alias("units")).agg(_n())


def discount_at_collection(spark: SparkSession, folder: str) -> DataFrame:
    raw = st.raw_products(spark, folder)
    seen = collection_discount(F.col("price"), F.col("original_price"))
    return raw.groupBy(seen.alias("discount_pct")).agg(_n())


def free_shipping_flag(spark: SparkSession, folder: str) -> DataFrame:
    lines = st.observed_lines(spark, folder).select(st.delivery_text().alias("delivery"))
    return lines.groupBy("delivery", is_free_shipping(F.col("delivery")).alias("free_shipping")).agg(_n())


def normalize_listing(spark: SparkSession, folder: str) -> DataFrame:
    """JSON search pages, parsed, flattened and normalised to records."""
    pages = st.search_pages(spark, folder).select(
        "collected_at", "ingestion_id", F.from_json("page", SEARCH_PAGE).alias("parsed")
    )
    items = page_items(pages.select("collected_at", "ingestion_id", F.col("parsed.data").alias("data")))
    rows = records(items, F.col("collected_at"), F.col("ingestion_id"))
    return rows.groupBy("currency", "free_shipping", "is_prime", "is_best_seller", "condition", "source").agg(
        _n(),
        F.count("price").alias("n_price"),
        F.sum(cents(F.col("price"))).alias("price_cents"),
        F.sum(cents(F.col("original_price"))).alias("original_cents"),
        F.sum(cents(F.col("discount_pct"))).alias("discount_hundredths"),
        F.count("rating").alias("n_rating"),
        F.sum(cents(F.col("rating"))).alias("rating_hundredths"),
        F.sum("num_ratings").alias("num_ratings"),
        F.sum("num_offers").alias("num_offers"),
        F.count("brand").alias("n_brand"),
        count_where(F.col("is_amazon_choice")).alias("n_choice"),
        count_where(F.col("sales_volume") == "").alias("n_no_volume"),
        count_where(F.col("delivery_text") == "").alias("n_no_delivery"),
        F.sum(F.length("title")).alias("title_chars"),
        F.min("batch_id").alias("first_batch"),
        F.max("batch_id").alias("last_batch"),
        F.min("ingestion_id").alias("first_ingestion_id"),
        F.min("url").alias("first_url"),
        F.max("thumbnail_url").alias("last_thumbnail_url"),
    )


def brand_from_title_query(spark: SparkSession, folder: str) -> DataFrame:
    raw = st.raw_products(spark, folder)
    brand = brand_from_title(F.col("brand"), F.col("title"))
    return raw.groupBy(brand.alias("brand")).agg(_n(), F.count_distinct("title").alias("n_titles"))


def condition_normalize(spark: SparkSession, folder: str) -> DataFrame:
    raw = st.raw_products(spark, folder).select(F.col("condition").alias("stated"))
    return raw.groupBy("stated", normalize_condition(F.col("stated")).alias("condition")).agg(_n())


def discount_repair(spark: SparkSession, folder: str) -> DataFrame:
    raw = st.raw_products(spark, folder)
    repaired = repaired_discount(F.col("price"), F.col("original_price"), F.col("discount_pct"))
    return raw.groupBy(repaired.alias("discount_pct")).agg(_n())


def null_fill(spark: SparkSession, folder: str) -> DataFrame:
    filled = with_neutral_values(st.raw_products(spark, folder))
    keys = ["currency", "is_best_seller", "is_amazon_choice", "is_prime", "free_shipping", "delivery_text", "num_offers"]
    return filled.groupBy(*keys).agg(
        _n(), F.count("num_ratings").alias("n_ratings"), F.sum("num_ratings").alias("sum_ratings")
    )


def staged_products(spark: SparkSession, folder: str) -> DataFrame:
    """The whole staging set."""
    return staged(st.raw_products(spark, folder))


def fact_products(spark: SparkSession, folder: str) -> DataFrame:
    """The whole fact set built from staging."""
    return facts(staged(st.raw_products(spark, folder)))


def price_segment(spark: SparkSession, folder: str) -> DataFrame:
    return (
        st.live_facts(spark, folder)
        .groupBy("price_bucket", "price_bucket_500_start", "price_bucket_500_end")
        .agg(_n(), F.min("price").alias("min_price"), F.max("price").alias("max_price"))
    )


def value_score_topk(spark: SparkSession, folder: str) -> DataFrame:
    return (
        st.live_facts(spark, folder)
        .orderBy(F.col("value_score").desc_nulls_last(), "ingestion_id")
        .limit(50)
        .select("ingestion_id", "product_id", "title", "price", "rating", "num_ratings", "value_score")
    )


def format_brl(spark: SparkSession, folder: str) -> DataFrame:
    brands = brand_dimension(st.observations(spark, folder))
    return brands.select(
        "brand",
        brl(F.col("avg_price")).alias("avg_price_text"),
        brl(F.when(F.col("brand") == "Brand#1", F.lit(None)).otherwise(F.col("max_price"))).alias("max_price_text"),
        pct_text(F.col("pct_free_shipping")).alias("pct_text"),
        int_text(F.col("total_reviews")).alias("reviews_text"),
    )


def json_fallback(spark: SparkSession, folder: str) -> DataFrame:
    events = st.table(spark, folder, "events")
    stated = F.when(F.col("event_type") == "purchase", F.col("event_type")).when(
        F.col("event_type") == "view", F.lit("")
    )
    text = first_filled(stated, F.col("props"), "$.k")
    return events.groupBy("event_type", text.alias("volume_text")).agg(_n())


QUERIES = {
    "parse_price_br": parse_price_br,
    "parse_sales_volume": parse_sales_volume_query,
    "parse_sales_volume_first_number": parse_sales_volume_first_number,
    "discount_at_collection": discount_at_collection,
    "free_shipping_flag": free_shipping_flag,
    "normalize_listing": normalize_listing,
    "brand_from_title": brand_from_title_query,
    "condition_normalize": condition_normalize,
    "discount_repair": discount_repair,
    "null_fill": null_fill,
    "staged_products": staged_products,
    "fact_products": fact_products,
    "price_segment": price_segment,
    "value_score_topk": value_score_topk,
    "format_brl": format_brl,
    "json_fallback": json_fallback,
}

# Delivery texts of the listing source, price segments with their limits.
_DELIVERY = """case l_linenumber when 1 then 'Entrega GRÁTIS: amanhã' when 2 then 'Entrega grátis em 2 dias'
    when 3 then 'FREE delivery' when 4 then '' when 5 then 'Entrega padrão em 5 dias'
    when 6 then 'Retirada na loja' end"""
_UNITS = volume_units("sales_volume")
_SEGMENT = """case when cents < 100000 then 'Até R$1.000' when cents < 200000 then 'R$1.000 – R$2.000'
    when cents < 350000 then 'R$2.000 – R$3.500' when cents < 500000 then 'R$3.500 – R$5.000'
    else 'Acima de R$5.000' end"""
_SCORE = f"case when cents > 0 and rating2 > 0 then {rounded('100 * rating2 * num_ratings', '2 * cents', 4)} end"


def _brl(cents: str) -> str:
    whole = f"replace(format('{{:,}}', cast(({cents}) // 100 as bigint)), ',', '.')"
    return f"'R$ ' || {whole} || ',' || lpad(cast(({cents}) % 100 as varchar), 2, '0')"


ORACLES = {
    "parse_price_br": f"""
with {LINES}, p as (select l_linenumber, case when l_linenumber in (1, 2, 3, 6) then cents end as c from lines)
select l_linenumber, count(*) as n, count(c) as n_parsed, cast(sum(c) as bigint) as price_cents,
  {money('min(c)')} as min_price, {money('max(c)')} as max_price
from p group by l_linenumber""",
    "parse_sales_volume": f"with {OBS} select {_UNITS} as units, count(*) as n from obs group by 1",
    "parse_sales_volume_first_number": f"""
with {OBS}, t as (
  select regexp_extract(sales_volume, '(?i)([0-9]+)\\s*mil', 1) as mil,
    regexp_extract(sales_volume, '([0-9]+)', 1) as num from obs)
select case when mil <> '' then cast(mil as int) * 1000 when num <> '' then cast(num as int) else 0 end as units,
  count(*) as n
from t group by 1""",
    "discount_at_collection": f"""
with {RAW}
select case when original_cents > 0 and cents <> 0
    then {rounded('100 * (original_cents - cents)', 'original_cents', 2)} else 0 end::double as discount_pct,
  count(*) as n
from raw group by 1""",
    "free_shipping_flag": f"""
with d as (select {_DELIVERY} as delivery from lineitem)
select delivery, coalesce(contains(lower(delivery), 'grátis') or contains(lower(delivery), 'free'), false)
    as free_shipping, count(*) as n
from d group by all""",
    "normalize_listing": f"""
with {LINES}, i as (
  select *, {LINE_ID} as id, case when l_linenumber in (1, 2, 3, 6) then cents end as p,
    case when pct > 0 then cents * 100 // (100 - pct) end as o, {_DELIVERY} as delivery, {VOLUME_TEXT} as volume,
    strftime(l_shipdate, 'batch-%Y-%m-%d-%Hh') as batch,
    case l_returnflag when 'A' then 50 * (p_size % 11) when 'N' then 0 end as r
  from lines)
select 'BRL' as currency,
  coalesce(contains(lower(delivery), 'grátis') or contains(lower(delivery), 'free'), false) as free_shipping,
  l_linenumber <= 3 as is_prime, l_returnflag <> 'N' and l_quantity >= 45 as is_best_seller, 'new' as condition,
  'amazon_br' as source, count(*) as n, count(p) as n_price, cast(sum(p) as bigint) as price_cents,
  cast(sum(o) as bigint) as original_cents,
  cast(sum(case when o > 0 and p <> 0 then cast(round({rounded('100 * (o - p)', 'o', 2)} * 100) as bigint) else 0 end)
    as bigint) as discount_hundredths,
  count(r) as n_rating, cast(sum(r) as bigint) as rating_hundredths,
  cast(sum(case when l_linenumber <> 3 then l_quantity else 0 end) as bigint) as num_ratings,
  cast(sum(case when l_linenumber <> 4 then l_linenumber else 0 end) as bigint) as num_offers,
  0::bigint as n_brand, 0::bigint as n_choice, count(*) filter (volume = '') as n_no_volume,
  count(*) filter (coalesce(delivery, '') = '') as n_no_delivery, cast(sum(length(p_name)) as bigint) as title_chars,
  min(batch) as first_batch, max(batch) as last_batch, min(id) as first_ingestion_id,
  min('https://example.com/dp/' || l_partkey) as first_url,
  max('https://example.com/thumb/' || l_partkey || '.jpg') as last_thumbnail_url
from i group by 1, 2, 3, 4, 5, 6""",
    "brand_from_title": f"""
with {RAW} select {BRAND_OF} as brand, count(*) as n, count(distinct title) as n_titles from raw group by 1""",
    "condition_normalize": f"""
with {RAW} select condition as stated, {CONDITION_OF} as condition, count(*) as n from raw group by 1, 2""",
    "discount_repair": f"with {RAW} select {DISCOUNT_OF} as discount_pct, count(*) as n from raw group by 1",
    "null_fill": f"""
with {RAW}
select coalesce(currency, 'BRL') as currency, coalesce(is_best_seller, false) as is_best_seller,
  coalesce(is_amazon_choice, false) as is_amazon_choice, coalesce(is_prime, false) as is_prime,
  coalesce(free_shipping, false) as free_shipping, coalesce(delivery_text, '') as delivery_text,
  coalesce(num_offers, 0) as num_offers, count(*) as n, count(coalesce(num_ratings, 0)) as n_ratings,
  cast(sum(coalesce(num_ratings, 0)) as bigint) as sum_ratings
from raw group by 1, 2, 3, 4, 5, 6, 7""",
    "staged_products": f"""
with {STAGED}
select * exclude (cents, original_cents, rating2), {money('cents')} as price, {money('original_cents')} as original_price,
  rating2::double / 2 as rating
from stg""",
    "fact_products": f"""
with {STAGED}
select * exclude (cents, original_cents, rating2, raw_payload), {money('cents')} as price,
  {money('original_cents')} as original_price, rating2::double / 2 as rating,
  cast(collected_at as date) as collection_date, {_SEGMENT} as price_bucket,
  cast(cents // 50000 * 500 as int) as price_bucket_500_start,
  cast(cents // 50000 * 500 + 499 as int) as price_bucket_500_end, {_SCORE} as value_score
from stg""",
    "price_segment": f"""
with {OBS}
select {_SEGMENT} as price_bucket, bucket_start as price_bucket_500_start, bucket_start + 499 as price_bucket_500_end,
  count(*) as n, {money('min(cents)')} as min_price, {money('max(cents)')} as max_price
from obs where not seed_flag group by 1, 2, 3""",
    "value_score_topk": f"""
with {OBS}
select ingestion_id, product_id, title, {money('cents')} as price, rating2::double / 2 as rating, num_ratings,
  {_SCORE} as value_score
from obs where not seed_flag order by value_score desc nulls last, ingestion_id limit 50""",
    "format_brl": f"""
with {OBS}, g as (
  select coalesce(brand, 'Sem marca identificada') as brand, cast(round({mean('cents', 2, 2)} * 100) as bigint) as a,
    max(cents) as m, cast(round({share('count(*) filter (free_shipping)', 'count(*)')} * 100) as bigint) as f,
    sum(num_ratings) as r
  from obs group by 1)
select brand, {_brl('a')} as avg_price_text,
  case when brand = 'Brand#1' then 'R$ —' else {_brl('m')} end as max_price_text,
  replace(format('{{:.1f}}', f::double / 100), '.', ',') || '%' as pct_text,
  replace(format('{{:,}}', cast(r as bigint)), ',', '.') as reviews_text
from g""",
    "json_fallback": """
select event_type,
  coalesce(nullif(case event_type when 'purchase' then event_type when 'view' then '' end, ''),
    json_extract_string(props, '$.k')) as volume_text, count(*) as n
from events group by 1, 2""",
}
