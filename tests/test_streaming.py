import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_messages import GOOD
from vitrine.schemas import LANDED, MESSAGE, RECORD
from vitrine.sources import messages as msg
from vitrine.streaming import ingest, publish
from vitrine.streaming.drain import drain
from vitrine.streaming.windows import compact_windows, daily_prices, hourly_counts, start_window_table, window_table


def land(folder, name, payloads):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        for ingestion_id, payload in payloads:
            text = payload if isinstance(payload, str) else json.dumps({**payload, "ingestion_id": ingestion_id})
            message = {"ingestion_id": ingestion_id, "batch_id": "b", "source": "amazon_br", "collected_at": "x", "payload": text}
            out.write(json.dumps(message) + "\n")
    # the source reads files in order of their age
    os.utime(os.path.join(folder, name), (1.7e9 + int(name.split(".")[0]), 1.7e9 + int(name.split(".")[0])))


def product(name, at="2025-02-03T08:15:00", **change):
    return {**GOOD, "product_id": name, "collected_at": at, **change}


class Ingest:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landing, self.raw, self.dead = (f"{folder}/{n}" for n in ("landing", "raw", "dead"))

    def run(self, files_per_batch=1):
        stream = ingest.message_stream(self.spark, self.landing, files_per_batch)
        before = self.read()
        drain(ingest.start_ingest(stream, self.raw, self.dead, f"{self.folder}/checkpoint"))
        return self.read() - before

    def read(self):
        if not os.path.exists(f"{self.raw}_totals"):
            return 0
        return ingest.lag(self.spark, self.landing, self.raw).first().read

    def stored(self):
        return sorted((r.product_id or "", r.ingestion_id) for r in ingest.raw_table(self.spark, self.raw).collect())

    def refused(self):
        return sorted((r.ingestion_id, r.error) for r in ingest.dead_letter_table(self.spark, self.dead).collect())


def test_replay_restart_and_poison(spark, folder):
    p = Ingest(spark, folder)
    land(p.landing, "1.json", [("a1", product("a")), ("a2", product("a")), ("n1", product(None)), ("bad", "{bad")])
    assert p.run() == 4
    assert p.stored() == [("", "n1"), ("a", "a1")]
    assert p.refused() == [("bad", "payload is not a JSON object")]
    # the same messages again, one new product, one new instant, another poisoned message
    land(p.landing, "2.json", [("a1", product("a")), ("b1", product("b")), ("a3", product("a", "2025-02-04T08:15:00"))])
    land(p.landing, "3.json", [("late", product("b")), ("txt", product("c", price="caro"))])
    assert p.run() == 5
    assert p.stored() == [("", "n1"), ("a", "a1"), ("a", "a3"), ("b", "b1")]
    assert p.refused() == [("bad", "payload is not a JSON object"), ("txt", "wrong type for: price")]
    assert p.run() == 0
    totals = [tuple(r) for r in ingest.load_totals(spark, p.raw).collect()]
    assert totals == [(0, 4, 2, 1), (1, 3, 2, 0), (2, 2, 0, 1)]
    assert tuple(ingest.lag(spark, p.landing, p.raw).first()) == (9, 9, 0, 4, 2, 3)
    land(p.landing, "4.json", [("c1", product("c"))])
    assert ingest.lag(spark, p.landing, p.raw).first().pending == 1
    row = ingest.raw_table(spark, p.raw).filter("ingestion_id = 'a1'").first()
    assert json.loads(row.raw_payload) == GOOD["raw_payload"] and row.inserted_at is not None


def test_more_batches_than_a_query_remembers(spark, folder):
    p = Ingest(spark, folder)
    for n in range(105):
        land(p.landing, f"{n}.json", [(f"i{n}", product(f"p{n}"))])
    assert p.run() == 105 and len(p.stored()) == 105


def test_published_messages_arrive_in_order_and_can_be_traced(spark, folder):
    p = Ingest(spark, folder)
    rows = [(f"z{9 - n}", json.dumps({**product("a", price=n + 1.0), "ingestion_id": f"z{9 - n}"})) for n in range(3)]
    parsed = msg.parsed(spark.createDataFrame([(i, "b", "s", "t", text) for i, text in rows], MESSAGE).coalesce(1))
    sent = msg.loadable(parsed)
    unsent = sent.limit(1).withColumn("batch_id", F.lit(None).cast("string"))
    msg.publish(sent.unionByName(unsent).coalesce(1), p.landing, f"{folder}/unsent", 1)
    letters = spark.read.parquet(f"{folder}/unsent").collect()
    assert [(r.product_id, r.error) for r in letters] == [("a", "no value for: batch_id")]
    land(p.landing, "7.json", [("bad", "{bad")])
    assert p.run(files_per_batch=10) == 4
    # the first sent wins, though its id is the largest
    assert p.stored() == [("a", "z9")]
    with pytest.raises(ValueError, match="records lack price"):
        msg.publish(sent.drop("price"), p.landing, f"{folder}/unsent", 2)


def test_dead_letters_name_the_message(spark, folder):
    batch = spark.createDataFrame([("7-1", "i", "b", "s", "t", "[1]")], LANDED)
    ingest.load_batch(batch, 0, f"{folder}/raw", f"{folder}/dead")
    assert ingest.dead_letter_table(spark, f"{folder}/dead").first().original_msg_id == "7-1"


def test_a_batch_without_a_field_is_refused(spark, folder):
    batch = spark.createDataFrame([("i", "b", "s", "t")], "ingestion_id string, batch_id string, source string, collected_at string")
    with pytest.raises(ValueError, match="messages lack payload"):
        ingest.load_batch(batch, 0, f"{folder}/raw", f"{folder}/dead")
    assert not os.path.exists(f"{folder}/raw")


def test_compacted_raw_table_holds_the_same_rows(spark, folder):
    p = Ingest(spark, folder)
    for n in range(3):
        land(p.landing, f"{n}.json", [(f"i{n}", product(f"p{n}"))])
    p.run()
    ingest.compact_raw(spark, p.raw, f"{folder}/compact")
    assert len([f for _, _, names in os.walk(f"{folder}/compact") for f in names if f.endswith(".parquet")]) == 1
    before, p.raw = p.stored(), f"{folder}/compact"
    assert p.stored() == before


def test_a_batch_tried_again_replaces_itself(spark, folder):
    raw, dead = f"{folder}/raw", f"{folder}/dead"
    rows = [(f"i{n}", "b", "s", "t", json.dumps({**product("a"), "ingestion_id": f"i{n}"})) for n in range(3)]
    batch = spark.createDataFrame(rows + [("x", "b", "s", "t", "[1]")], MESSAGE)
    for _ in range(2):
        ingest.load_batch(batch, 7, raw, dead)
    ingest.load_batch(batch, 8, raw, dead)
    assert [(r.ingestion_id, r.load) for r in ingest.raw_table(spark, raw).collect()] == [("i0", 7)]
    assert sorted(r.load for r in ingest.dead_letter_table(spark, dead).collect()) == [7, 8]


def landed_rows(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "product_id string, t string, price string")
    df.coalesce(1).write.mode("append").json(f"{folder}/{name}")


SCHEMA = "product_id string, t string, price string"


def observed(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(path).select(
        "product_id", F.col("t").cast("timestamp").alias("collected_at"), F.col("price").cast("decimal(12,2)").alias("price")
    )


def test_bounded_dedup_across_restart(spark, folder):
    rows = [(f"p{n % 5}", f"2024-01-01 00:{n % 20:02d}:00", "1") for n in range(100)]

    def run():
        unique = ingest.deduplicated(observed(spark, f"{folder}/in"), ["product_id", "collected_at"], "collected_at", "1 day")
        query = (
            unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start(f"{folder}/out")
        )
        drain(query, 120)
        return spark.read.parquet(f"{folder}/out").count()

    landed_rows(spark, folder, "in", rows)
    assert run() == 20
    landed_rows(spark, folder, "in", rows + [("p9", "2024-01-01 00:00:00", "1")])
    assert run() == 21


def test_window_tables_equal_batch_and_drop_what_is_too_late(spark, folder):
    source = f"{folder}/in"

    def run(build, name, delay):
        windows = build(observed(spark, source), "collected_at", delay)
        drain(start_window_table(windows, f"{folder}/{name}", f"{folder}/{name}-checkpoint"), 120)
        return {str(r.window_start): r for r in window_table(spark, f"{folder}/{name}").collect()}

    landed_rows(spark, folder, "in", [("a", "2024-01-01 10:10:00", "10"), ("b", "2024-01-01 10:50:00", "20.01")])
    hours = run(hourly_counts, "hours", "2 hours")
    assert {k: r.n for k, r in hours.items()} == {"2024-01-01 10:00:00": 2}
    days = run(daily_prices, "days", "30 days")
    assert float(days["2024-01-01 00:00:00"].avg_price) == 15.01
    # late by an hour counts; the price of 0 never does
    landed_rows(spark, folder, "in", [("c", "2024-01-01 10:59:00", "30"), ("d", "2024-01-02 11:00:00", "0")])
    assert {k: r.n for k, r in run(hourly_counts, "hours", "2 hours").items()} == {
        "2024-01-01 10:00:00": 3, "2024-01-02 11:00:00": 1
    }
    days = run(daily_prices, "days", "30 days")
    assert len(days) == 1 and days["2024-01-01 00:00:00"].total_observations == 3
    # behind the watermark of 2024-01-02 09:00: dropped by the short delay, kept by the long one
    landed_rows(spark, folder, "in", [("e", "2024-01-01 10:20:00", "40")])
    assert run(hourly_counts, "hours", "2 hours")["2024-01-01 10:00:00"].n == 3
    last = run(daily_prices, "days", "30 days")["2024-01-01 00:00:00"]
    assert (last.total_observations, float(last.max_price), float(last.min_price)) == (4, 40.0, 10.0)
    table = f"{folder}/days"
    for _ in range(2):
        before = sorted(map(tuple, window_table(spark, table).collect()))
        compact_windows(spark, table)
        assert sorted(map(tuple, window_table(spark, table).collect())) == before
        assert len([d for d in os.listdir(table) if d.startswith("epoch=")]) == 1
    landed_rows(spark, folder, "in", [("f", "2024-01-01 10:21:00", "50")])
    assert run(daily_prices, "days", "30 days")["2024-01-01 00:00:00"].total_observations == 5
    compact_windows(spark, table)
    assert window_table(spark, table).agg(F.sum("total_observations")).first()[0] == 5


def test_drain_gives_up(spark, folder):
    landed_rows(spark, folder, "in", [("a", "2024-01-01 10:10:00", "10")])
    query = observed(spark, f"{folder}/in").writeStream.format("noop").trigger(processingTime="1 hour").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).start()
    with pytest.raises(TimeoutError):
        drain(query, 3)
    assert not query.isActive


# --- publishing


class Outbox:
    """Records in files, published by a stream."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.records, self.sent, self.unsent, self.checkpoint = (
            f"{folder}/{n}" for n in ("records", "sent", "unsent", "checkpoint")
        )

    def write(self, *rows):
        records = [json.dumps({**product(name), "ingestion_id": name, **change}) for name, change in rows]
        lines = self.spark.createDataFrame([(r,) for r in records], "value string")
        lines.select(F.from_json("value", RECORD).alias("r")).select("r.*").coalesce(1).write.mode("append").parquet(self.records)

    def run(self):
        stream = self.spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(self.records)
        for query in publish.start_publish(stream, self.sent, self.unsent, self.checkpoint):
            drain(query)

    def ids(self):
        return sorted(r.ingestion_id for r in publish.sent_messages(self.spark, self.sent).collect())

    def refused(self):
        return sorted((r.ingestion_id, r.error) for r in publish.refused_records(self.spark, self.unsent).collect())


def test_a_restarted_publisher_repeats_no_message(spark, folder):
    box = Outbox(spark, folder)
    box.write(("a", {}), ("b", {}), ("x", {"source": None}))
    box.write(("c", {}), ("y", {"batch_id": None, "collected_at": None}))
    box.run()
    refused = [("x", "no value for: source"), ("y", "no value for: batch_id, collected_at")]
    assert box.ids() == ["a", "b", "c"] and box.refused() == refused
    # broken off after the sink had its last batch and before the query noted it
    for kind in ("sent", "refused"):
        commits = f"{box.checkpoint}/{kind}/commits"
        for name in os.listdir(commits):
            if name.lstrip(".").startswith("1"):
                os.remove(f"{commits}/{name}")
    # and files of an attempt that the sink never noted
    part = next(n for n in os.listdir(box.sent) if n.startswith("part-"))
    with open(f"{box.sent}/{part}", "rb") as whole, open(f"{box.sent}/part-99999-stray.json", "wb") as stray:
        stray.write(whole.read())
    box.write(("d", {}))
    box.run()
    assert box.ids() == ["a", "b", "c", "d"] and box.refused() == refused
    box.run()
    assert box.ids() == ["a", "b", "c", "d"]
    messages = publish.sent_messages(spark, box.sent).collect()
    assert len({r.message_id for r in messages}) == 4 and all(r.message_id.endswith(f"-{r.ingestion_id}") for r in messages)
    # the ingest goes by the sink's log too
    raw, dead = f"{folder}/raw", f"{folder}/dead"
    drain(ingest.start_ingest(ingest.message_stream(spark, box.sent), raw, dead, f"{folder}/taken"))
    assert tuple(ingest.load_totals(spark, raw).agg(F.sum("messages"), F.sum("inserted"), F.sum("refused")).first()) == (4, 4, 0)
    assert ingest.dead_letter_table(spark, dead).count() == 0


def test_publishing_needs_all_fields(spark, folder):
    stream = spark.readStream.schema("price double").parquet(spark.range(1).selectExpr("1.0D AS price").write.parquet(folder + "/r") or folder + "/r")
    with pytest.raises(ValueError, match="records lack"):
        publish.start_publish(stream, f"{folder}/s", f"{folder}/u", f"{folder}/c")


def test_totals_outlive_the_query_and_a_retried_batch(spark, folder):
    p = Ingest(spark, folder)
    land(p.landing, "1.json", [("a1", product("a")), ("bad", "{bad")])
    land(p.landing, "2.json", [("b1", product("b")), ("b2", product("b"))])
    p.run()
    batch = spark.read.schema(LANDED).json(f"{p.landing}/2.json")
    ingest.load_batch(batch, 1, p.raw, p.dead)  # the second try of a batch that was broken off after its writes
    assert [tuple(r) for r in ingest.load_totals(spark, p.raw).collect()] == [(0, 2, 1, 1), (1, 2, 1, 0)]
    assert p.stored() == [("a", "a1"), ("b", "b1")]


def messages(spark, *records):
    rows = [("%04d" % n, i, "b", "s", "t", json.dumps({**p, "ingestion_id": i})) for n, (i, p) in enumerate(records)]
    return spark.createDataFrame(rows, LANDED)


def runs(spark, folder):
    return ingest._key_runs(spark, f"{folder}/raw_keys")


def test_a_batch_opens_a_few_runs_of_keys(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest, "RUNS", 2)
    raw, dead = f"{folder}/raw", f"{folder}/dead"
    for n in range(5):
        new, none = (f"i{n}", product(f"p{n}")), (f"n{n}", product(None))
        ingest.load_batch(messages(spark, new, ("again", product("p0", at="2025-02-03T08:15:00")), none), n, raw, dead)
    assert runs(spark, folder) == [(0, 3), (4, 4)]
    assert len(ingest.held_keys(spark, raw, 5).inputFiles()) == 2
    assert [r.inserted for r in ingest.load_totals(spark, raw).collect()] == [2] * 5
    # the last load once more, then one that was loaded long ago: the raw table tells
    ingest.load_batch(messages(spark, ("i4", product("p4")), ("x", product("p1"))), 4, raw, dead)
    assert runs(spark, folder) == [(0, 3), (4, 4)]
    ingest.load_batch(messages(spark, ("i1", product("p1")), ("x", product("p4"))), 1, raw, dead)
    ingest.load_batch(messages(spark, ("y", product("p1")), ("z", product("p9"))), 5, raw, dead)
    stored = sorted(r.ingestion_id for r in ingest.raw_table(spark, raw).collect() if r.product_id)
    assert stored == ["i0", "i1", "i2", "i3", "i4", "z"]


def test_runs_are_made_of_a_raw_table_without_them(spark, folder):
    raw, dead = f"{folder}/old", f"{folder}/dead"
    for n in range(2):
        ingest.load_batch(messages(spark, (f"i{n}", product(f"p{n}"))), n, raw, dead)
    ingest.compact_raw(spark, raw, f"{folder}/raw")
    ingest.load_batch(messages(spark, ("x", product("p1")), ("i2", product("p2"))), 2, f"{folder}/raw", dead)
    assert runs(spark, folder) == [(-1, -1), (2, 2)]
    stored = sorted(r.ingestion_id for r in ingest.raw_table(spark, f"{folder}/raw").collect())
    assert stored == ["i0", "i1", "i2"]
