"""Registered queries for deduplication, appends, upserts, messages and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.catalog.sql import OBS, RAW, money
from vitrine.operators.keyed import append_outcomes, append_unseen, first_per_key, merge_on_key
from vitrine.operators.partitioning import as_asked
from vitrine.operators.ranks import observation_ranks as ranks
from vitrine.plans.facts import newer_rows, upserted
from vitrine.plans.reports import latest_per_product as latest
from vitrine.plans.staging import latest_copies
from vitrine.schemas import KEY, MESSAGE, RECORD
from vitrine.sources import messages as msg
from vitrine.sources import sales_tables as st
from vitrine.sources.listings import batch_stamp
from vitrine.sources.listings import pages_until_empty as before_empty_page

LOADED_UNTIL = "2001-01-01"
CORRECTED_FROM = "2000-07-01"


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    kept = latest_copies(st.raw_products(spark, folder))
    return kept.select("product_id", "collected_at", "inserted_at", "ingestion_id", "price")


def observation_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Position of every observation in the history of its product, from both ends."""
    rows = st.observations(spark, folder, "product_id", "collected_at", "ingestion_id", "price")
    return ranks(rows, "product_id", "collected_at", ["ingestion_id"])


def latest_per_product(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["product_id", "title", "brand", "collected_at", "ingestion_id", "price"]
    return latest(st.observations(spark, folder, *columns))


def _held_and_incoming(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A raw table as loaded up to a date, and a delivery that replays all of it."""
    columns = ["product_id", "collected_at", "ingestion_id", "price"]
    incoming = st.raw_products(spark, folder).select(*columns)
    early = incoming.filter(F.col("collected_at") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    held = first_per_key(early.filter("product_id is not null"), KEY, [F.col("ingestion_id")])
    return held, incoming


def idempotent_append(spark: SparkSession, folder: str) -> DataFrame:
    held, incoming = _held_and_incoming(spark, folder)
    return append_unseen(held, incoming, KEY, [F.col("ingestion_id")])


def append_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    held, incoming = _held_and_incoming(spark, folder)
    return append_outcomes(incoming, held, KEY)


def _staged_and_loaded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    columns = ["product_id", "collected_at", "ingestion_id", "price"]
    rows = first_per_key(st.observations(spark, folder, *columns), KEY, [F.col("ingestion_id").desc()])
    rows = rows.withColumn("collection_date", F.to_date("collected_at"))
    return rows, rows.filter(F.col("collection_date") <= F.lit(LOADED_UNTIL).cast("date"))


def incremental_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows, loaded = _staged_and_loaded(spark, folder)
    return newer_rows(rows, loaded)


def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The fact set after an incremental run, counted per collection date."""
    rows, loaded = _staged_and_loaded(spark, folder)
    corrected = rows.withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    return (
        upserted(loaded, corrected)
        .groupBy("collection_date")
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("price") * 100).cast("bigint")).alias("price_cents"))
    )


def keyed_correction(spark: SparkSession, folder: str) -> DataFrame:
    """Prices corrected for keys that are there already, and new keys added; counted per collection date."""
    rows, loaded = _staged_and_loaded(spark, folder)
    late = F.col("collection_date") > F.lit(CORRECTED_FROM).cast("date")
    corrected = rows.filter(late).withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    return (
        merge_on_key(loaded, corrected, KEY)
        .groupBy("collection_date")
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("price") * 100).cast("bigint")).alias("price_cents"))
    )


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return st.event_messages(as_asked(st.table(spark, folder, "events")))


def dead_letter_split(spark: SparkSession, folder: str) -> DataFrame:
    """Messages per sink and cause; each payload is parsed once."""
    sink = F.when(F.col("error").isNull(), "record").otherwise("dead letter")
    cents = F.when(F.col("error").isNull(), (F.col("record.price") * 100).cast("bigint"))
    return (
        msg.parsed(_messages(spark, folder))
        .groupBy(sink.alias("sink"), "error")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("price_cents"))
    )


def dead_letter_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every refused message with what is known about it."""
    return msg.dead_letters(msg.parsed(_messages(spark, folder))).drop("original_msg_id", "payload")


def message_totals(spark: SparkSession, folder: str) -> DataFrame:
    return msg.totals(msg.parsed(_messages(spark, folder)))


def publish_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows sent as messages and read back; nothing may get lost on the way."""
    raw = st.raw_products(spark, folder).select(*RECORD.fieldNames())
    sent = msg.envelope(raw).select(*MESSAGE.fieldNames())
    back = msg.loadable(msg.parsed(sent))
    return back.groupBy("source", "condition", "currency").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("product_id").alias("n_product"),
        F.sum((F.col("price") * 100).cast("bigint")).alias("price_cents"),
        F.sum((F.col("discount_pct") * 100).cast("bigint")).alias("discount_hundredths"),
        F.sum("num_ratings").alias("num_ratings"),
        F.count_if("is_prime").alias("n_prime"),
        F.sum(F.length("raw_payload")).alias("payload_chars"),
        F.max(F.to_date("collected_at")).alias("last_day"),
    )


def pages_until_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events as pages; an error event is an empty page."""
    events = st.table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    kept = before_empty_page(events, "user_id", "event_id", F.col("event_type") == "error")
    return kept.groupBy("user_id").agg(F.count(F.lit(1)).alias("pages"), F.max("event_id").alias("last_page"))


def batch_hour_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = st.table(spark, folder, "events")
    return events.groupBy(batch_stamp(F.col("ts")).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


QUERIES = {
    f.__name__: f
    for f in [
        dedup_latest, observation_ranks, latest_per_product, idempotent_append, append_outcome_counts,
        incremental_new_rows, incremental_upsert, keyed_correction, dead_letter_split, dead_letter_rows, message_totals,
        publish_envelope, pages_until_empty, batch_hour_counts,
    ]
}

_HELD = f"""{RAW}, held as (
  select * from (select *, row_number() over (partition by product_id, collected_at order by ingestion_id) as pos
    from raw where product_id is not null and collected_at < timestamp '{LOADED_UNTIL}') where pos = 1),
fresh as (
  select * from (select *, row_number() over (partition by product_id, collected_at order by ingestion_id) as pos
    from raw r where product_id is not null and not exists (
      select 1 from held h where h.product_id = r.product_id and h.collected_at = r.collected_at)) where pos = 1
  union all select *, 1 from raw where product_id is null)"""
_UNIQUE = f"""{OBS}, u as (
  select product_id, collected_at, ingestion_id, cents, collection_date
  from (select *, row_number() over (partition by product_id, collected_at order by ingestion_id desc) as pos from obs)
  where pos = 1)"""
_RAW_KEY = f"product_id, collected_at, ingestion_id, {money('cents')} as price"
_VERDICT = """case event_type when 'error' then 'payload is not a JSON object'
    when 'signup' then 'no value for: batch_id' when 'click' then 'wrong type for: price' end"""

ORACLES = {
    "dedup_latest": f"""
with {RAW}
select product_id, collected_at, inserted_at, ingestion_id, {money('cents')} as price
from (select *, row_number() over (partition by product_id, collected_at
        order by inserted_at desc, ingestion_id desc) as pos
      from raw where product_id is not null)
where pos = 1""",
    "observation_ranks": f"""
with {OBS}
select product_id, collected_at, ingestion_id, {money('cents')} as price,
  row_number() over (partition by product_id order by collected_at, ingestion_id) as rank_asc,
  row_number() over (partition by product_id order by collected_at desc, ingestion_id desc) as rank_desc,
  count(*) over (partition by product_id) as num_observations
from obs""",
    "latest_per_product": f"""
with {OBS}
select distinct on (product_id) product_id, title, brand, collected_at, ingestion_id, {money('cents')} as price
from obs order by product_id, collected_at desc, ingestion_id desc""",
    "idempotent_append": f"""
with {_HELD} select {_RAW_KEY} from held union all select {_RAW_KEY} from fresh""",
    "append_outcome_counts": f"""
with {_HELD}
select (select count(*) from raw) as processed, (select count(*) from fresh) as inserted,
  (select count(*) from raw) - (select count(*) from fresh) as duplicates""",
    "incremental_new_rows": f"""
with {_UNIQUE}
select product_id, collected_at, ingestion_id, {money('cents')} as price, collection_date
from u where collected_at > (select max(collected_at) from u where collection_date <= date '{LOADED_UNTIL}')""",
    "incremental_upsert": f"""
with {_UNIQUE}
select collection_date, count(*) as n,
  cast(sum(case when collection_date > date '{LOADED_UNTIL}' then cents + 100 else cents end) as bigint) as price_cents
from u group by 1""",
    "keyed_correction": f"""
with {_UNIQUE}
select collection_date, count(*) as n,
  cast(sum(case when collection_date > date '{CORRECTED_FROM}' then cents + 100 else cents end) as bigint) as price_cents
from u group by 1""",
    "dead_letter_split": f"""
with m as (select *, {_VERDICT} as error from events)
select case when error is null then 'record' else 'dead letter' end as sink, error, count(*) as n,
  cast(sum(case when error is null then cast(floor(value * 100 + 0.5) as bigint) end) as bigint) as price_cents
from m group by 1, 2""",
    "dead_letter_rows": f"""
select cast(event_id as varchar) as ingestion_id,
  case when event_type = 'error' then 'unknown' else cast(user_id as varchar) end as product_id,
  strftime(ts, 'batch-%Y-%m-%d-%Hh') as batch_id, {_VERDICT} as error
from events where event_type in ('error', 'signup', 'click')""",
    "message_totals": """
select count(*) as messages, count(*) filter (event_type not in ('error', 'signup', 'click')) as loadable,
  count(*) filter (event_type in ('error', 'signup', 'click')) as refused
from events""",
    "publish_envelope": f"""
with {RAW}
select source, condition, currency, count(*) as n, count(product_id) as n_product,
  cast(sum(cents) as bigint) as price_cents,
  cast(sum(cast(round(discount_pct * 100) as bigint)) as bigint) as discount_hundredths,
  cast(sum(num_ratings) as bigint) as num_ratings, count(*) filter (is_prime) as n_prime,
  cast(sum(length(raw_payload)) as bigint) as payload_chars, max(cast(collected_at as date)) as last_day
from raw group by 1, 2, 3""",
    "pages_until_empty": """
with c as (select user_id, min(event_id) as cut from events where event_type = 'error' group by 1)
select e.user_id, count(*) as pages, max(event_id) as last_page
from events e left join c on e.user_id = c.user_id where cut is null or event_id < cut group by 1""",
    "batch_hour_counts": """
select strftime(ts, 'batch-%Y-%m-%d-%Hh') as batch_id, count(*) as n, min(event_id) as first_event,
  max(event_id) as last_event
from events group by 1""",
}
