"""Building blocks of the oracle SQL: derived tables and exact rounding."""

from __future__ import annotations

from vitrine.sources.sales_tables import HISTORY_END, TITLE_STARTS


def rounded(num: str, den: str, digits: int) -> str:
    """num / den, half away from zero, from whole numbers; NULL when den is 0."""
    p = 10**digits
    return (
        f"(case when ({num}) < 0 then -1 else 1 end * "
        f"((2 * abs(({num})::hugeint) * {p} + ({den})) // nullif(2 * ({den})::hugeint, 0)))::double / {p}"
    )


def mean(units: str, scale: int, digits: int) -> str:
    return rounded(f"sum({units})", f"count({units}) * {10**scale}", digits)


def share(part: str, whole: str, digits: int = 2) -> str:
    return rounded(f"100 * ({part})", whole, digits)


def quantile(fraction: float, cents: str = "cents") -> str:
    return f"floor(quantile_cont(({cents})::double, {fraction}) + 0.5) / 100"


def money(cents: str) -> str:
    return f"({cents})::double / 100"


def half_up(x: str, digits: int) -> str:
    p = 10**digits
    return f"sign({x}) * floor(abs({x}) * {p} + 0.5) / {p}"


def corr(x: str, y: str, digits: int) -> str:
    r = f"corr({x}, {y})"
    return f"case when isnan({r}) then null else {half_up(r, digits)} end"


VOLUME_TEXT = """case l_linenumber % 4
      when 0 then ''
      when 1 then 'Mais de ' || cast(l_quantity as int) || ' compras no mês passado'
      when 2 then 'Mais de ' || cast(l_quantity as int) || ' mil compras no mês passado'
      else 'Mais de ' || (cast(l_quantity as int) // 10) || ',' || (cast(l_quantity as int) % 10)
           || ' mil compras no mês passado' end"""

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date))"

LINES = """lines as (
  select *, cast(floor(l_extendedprice * 100 + 0.5) as bigint) // cast(l_quantity as bigint) as cents,
         6 * cast(floor(l_discount * 100 + 0.5) as bigint) as pct
  from lineitem join part on l_partkey = p_partkey)"""

OBS_ONLY = f"""obs as (
  select {LINE_ID} as ingestion_id, l_shipdate as collected_at, cast(l_partkey as varchar) as product_id,
    p_name as title, nullif(p_brand, 'Brand#7') as brand,
    case when l_returnflag = 'R' then 'used' else 'new' end as condition,
    cents, cents * 100 // (100 - pct) as original_cents, pct, (p_size % 11) as rating2,
    cast(l_quantity as int) as num_ratings, l_quantity >= 45 as is_best_seller, l_tax = 0 as is_amazon_choice,
    l_linenumber <= 3 as is_prime, l_linestatus = 'O' as free_shipping, {VOLUME_TEXT} as sales_volume,
    l_shipdate < timestamp '{HISTORY_END}' as seed_flag, cast(l_shipdate as date) as collection_date,
    cast(floor(cents / 50000) * 500 as int) as bucket_start
  from lines)"""

OBS = f"{LINES}, {OBS_ONLY}"


def volume_units(text: str) -> str:
    """Decimal + mil, integer + mil, all digits, NULL."""
    return f"""case
      when regexp_matches({text}, '(?i)[0-9]+[,.][0-9]+\\s*mil') then
        cast(round(cast(replace(regexp_extract({text}, '(?i)([0-9]+[,.][0-9]+)\\s*mil', 1), ',', '.')
          as decimal(28, 9)) * 1000) as int)
      when regexp_matches({text}, '(?i)[0-9]+\\s*mil') then
        cast(regexp_extract({text}, '(?i)([0-9]+)\\s*mil', 1) as int) * 1000
      when regexp_matches({text}, '[0-9]') then try_cast(regexp_replace({text}, '[^0-9]', '', 'g') as int)
    end"""


def _brand_rules(title: str) -> str:
    # The brand names and the title patterns they go by.
    return f"""case
      when {title} ilike '%samsung%' then 'Samsung'
      when {title} ilike '%iphone%' or {title} ilike 'apple%' then 'Apple'
      when {title} ilike 'motorola%' or {title} ilike '%moto %' then 'Motorola'
      when {title} ilike 'xiaomi%' or {title} ilike '%redmi%' or {title} ilike '%poco%' then 'Xiaomi'
      when {title} ilike 'realme%' then 'Realme'
      when {title} ilike 'lg %' or {title} ilike 'smartphone lg%' then 'LG'
      when {title} ilike 'sony%' then 'Sony'
      when {title} ilike 'asus%' or {title} ilike '%zenfone%' then 'Asus'
      when {title} ilike 'positivo%' then 'Positivo' end"""


_STARTS = ", ".join(f"'{t}'" for t in TITLE_STARTS)

RAW = f"""{LINES}, raw0 as (
  select *, cents * 9 // 10 as raised, cents * 100 // (100 - pct) as full_cents, cast(l_quantity as int) as q from lines),
raw as (
  select {LINE_ID} as ingestion_id,
    'batch-' || strftime(l_shipdate, '%Y-%m-%d-%H') || 'h' as batch_id,
    case when l_linenumber = 6 and l_tax = 0 then 'outra_fonte' else 'amazon_br' end as source,
    l_shipdate as collected_at, l_shipdate + to_hours(l_linenumber) as inserted_at,
    case when l_linenumber = 7 and l_linestatus = 'F' and q <= 5 then null else cast(l_partkey as varchar) end as product_id,
    list_extract([{_STARTS}], l_partkey % {len(TITLE_STARTS)} + 1) || p_name as title,
    case l_returnflag when 'R' then p_brand when 'A' then '' end as brand,
    case l_returnflag when 'R' then 'Refurbished' when 'A' then 'new' end as condition,
    'https://example.com/dp/' || l_partkey as url,
    'https://example.com/thumb/' || l_partkey || '.jpg' as thumbnail_url,
    case when l_linenumber = 7 and pct = 0 then null when l_linenumber = 7 and pct = 6 then 0 else cents end as cents,
    case pct when 0 then raised when 6 then null else full_cents end as original_cents,
    case pct when 0 then {rounded("100 * (raised - cents)", "raised", 2)} when 6 then null when 12 then 0
      else pct end as discount_pct,
    case when l_returnflag <> 'N' then 'BRL' end as currency, (p_size % 11) as rating2,
    case when q >= 48 then null when q = 1 then -1 else q end as num_ratings,
    case when l_returnflag <> 'N' then q >= 45 end as is_best_seller,
    case when l_linenumber <> 3 then l_tax = 0 end as is_amazon_choice,
    case when l_linenumber <> 2 then l_linenumber <= 3 end as is_prime,
    case when l_linenumber <> 1 then l_linestatus = 'O' end as free_shipping,
    case when l_linenumber = 2 then null when l_linestatus = 'O' then 'Entrega GRÁTIS'
      else 'Entrega padrão em 5 dias' end as delivery_text,
    case when l_linenumber <> 5 then {VOLUME_TEXT} end as sales_volume,
    case when l_linenumber <> 4 then l_linenumber end as num_offers,
    '{{"sales_volume": "' || q || ' compras"}}' as raw_payload
  from raw0)"""

BRAND_OF = f"coalesce(nullif(brand, ''), {_brand_rules('title')})"
CONDITION_OF = "case when lower(condition) in ('usado', 'used', 'refurbished') then 'used' else 'new' end"
DISCOUNT_OF = (
    f"case when original_cents > 0 and cents < original_cents then "
    f"{rounded('100 * (original_cents - cents)', 'original_cents', 2)} else coalesce(discount_pct, 0)::double end"
)

STAGED = f"""{RAW}, stg as (
  select ingestion_id, batch_id, 'amazon_br' as source, collected_at, inserted_at, product_id, title,
    {BRAND_OF} as brand, {CONDITION_OF} as condition, url, thumbnail_url, cents, original_cents,
    {DISCOUNT_OF} as discount_pct, coalesce(currency, 'BRL') as currency, rating2,
    coalesce(num_ratings, 0) as num_ratings, coalesce(is_best_seller, false) as is_best_seller,
    coalesce(is_amazon_choice, false) as is_amazon_choice, coalesce(is_prime, false) as is_prime,
    coalesce(free_shipping, false) as free_shipping, coalesce(delivery_text, '') as delivery_text,
    coalesce(nullif(sales_volume, ''), json_extract_string(raw_payload, '$.sales_volume')) as sales_volume,
    coalesce(num_offers, 0) as num_offers, raw_payload, false as seed_flag
  from (select *, row_number() over (partition by product_id, collected_at
          order by inserted_at desc, ingestion_id desc) as pos
        from raw where product_id is not null)
  where pos = 1 and cents > 0)"""
