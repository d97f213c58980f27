from __future__ import annotations

import json
from types import SimpleNamespace

import pandas as pd
import pytest
from helpers import definitions, message, messages, rows
from pyspark.sql import functions as F

from tallyline.operators.accumulate import slice_totals
from tallyline.operators.fold import running_slice_values
from tallyline.operators.parse import field_schema, good_orders, parse_messages
from tallyline.plans.backfill import backfill_messages
from tallyline.plans.options import JobOptions
from tallyline.plans.sample_queries import stream_definitions_live
from tallyline.schemas import INCREMENT, SLICE_UPDATE
from tallyline.session import children, new_run_dir, prepare_streaming, shared_dir
from tallyline.sources.definitions import DefinitionFeed, definitions_from_rows
from tallyline.sources.orders import kafka_options, read_message_files, read_text_files
from tallyline.streaming.dedupe import updates_of_increments
from tallyline.streaming.fold import SliceReplay, read_running_values, running_value_writers, start_running_values
from tallyline.streaming.job import Job, Versions, parquet_batches, parquet_sink, script_rejects_of
from tallyline.streaming.sinks import dead_letter_records, kafka_records, kafka_sink_options, read_parquet, to_parquet
from tallyline.streaming.state import SliceState
from tallyline.streaming.totals import read_slice_totals, start_slice_totals

SUM = {"refName": "s", "dimensions": ["m"], "accScript": "current + amount"}
CNT = {"refName": "c"}


class Harness:
    """A job over a folder of messages, run to the end of what is there each time."""

    def __init__(self, spark, online, **options):
        self.spark, self.online, self.sent = prepare_streaming(spark), online, 0
        self.run_dir = new_run_dir(spark, "test")
        self.job = Job(
            spark=spark,
            read=lambda: read_message_files(spark, f"{self.run_dir}/messages"),
            feed=DefinitionFeed(spark, lambda: definitions_from_rows(spark, self.online)),
            options=JobOptions(**options),
            checkpoint=f"{self.run_dir}/checkpoint",
            updates=parquet_sink(f"{self.run_dir}/out"),
            letters=parquet_batches(f"{self.run_dir}/letters"),
            counters=parquet_batches(f"{self.run_dir}/counters"),
            available_now=True,
        )

    def send(self, *texts):
        numbered = [(self.sent + n, text) for n, text in enumerate(texts)]
        self.sent += len(texts)
        frame = self.spark.createDataFrame(numbered, "arrival_seq long, value string")
        frame.repartition(2).write.mode("append").parquet(f"{self.run_dir}/messages")

    def run(self):
        self.job.run_available()
        found = read_parquet(self.spark, f"{self.run_dir}/out", SLICE_UPDATE)
        return rows(found, "ref_name", "dimension_key", "order_id", "increment")

    def letters(self):
        return rows(self.spark.read.parquet(f"{self.run_dir}/letters"), "raw", "fail_reason")


@pytest.mark.parametrize("dedupe", ["first_arrival", "any"])
def test_restarts_keep_what_was_counted(spark, dedupe):
    """Duplicates across runs, a failed then a good delivery, a changed script and a new definition."""
    run = Harness(spark, [SUM], dedupe=dedupe)
    run.send(message("a", m="M", amount=1), message("b", m="M"), "{ not json", "")
    assert run.run() == [("s", "M", "a", 1.0)]
    run.send(message("a", m="M", amount=9), message("b", m="M", amount=5))
    assert run.run() == [("s", "M", "a", 1.0), ("s", "M", "b", 5.0)]
    run.online = [CNT, {**SUM, "accScript": "current + amount * 10"}]
    run.send(message("b", m="M", amount=7), message("d", m="M", amount=2))
    assert run.run() == [
        ("c", "", "b", 1.0), ("c", "", "d", 1.0), ("s", "M", "a", 1.0), ("s", "M", "b", 5.0), ("s", "M", "d", 20.0),
    ]
    run.online = []
    run.send(message("e", m="M", amount=3))
    assert ("s", "M", "e", 30.0) in run.run()
    reasons = dict(run.letters())
    assert reasons[""] == "空消息" and reasons["{ not json"].startswith("反序列化失败")


def test_first_arrival_within_one_batch(spark):
    run = Harness(spark, [SUM, {"refName": "s", "dimensions": ["m"]}])
    run.send(*[message("a", m="M", amount=n) for n in range(1, 9)], message("b", m="M"), message("b", m="M", amount=4))
    assert run.run() == [("s", "M", "a", 1.0), ("s", "M", "b", 1.0)]


def test_stream_equals_batch(spark):
    raw = [SUM, CNT, {"refName": "h", "dimensions": ["m", "n"], "sliceGranularity": "HOUR", "windowDays": 2}]
    texts = [message(f"o{i % 40}", "E", i * 700_000, m=f"M{i % 3}", n=i % 2, amount=i % 40) for i in range(60)]
    run = Harness(spark, raw)
    run.send(*texts[:30])
    run.run()
    run.send(*texts[30:])
    run.run()
    streamed = read_parquet(spark, f"{run.run_dir}/out", SLICE_UPDATE)
    batch = backfill_messages(messages(spark, texts), definitions(spark, *raw)).updates
    columns = SLICE_UPDATE.fieldNames()
    assert rows(streamed, *columns) == rows(batch, *columns)


def test_bounded_state_forgets(spark):
    run = Harness(spark, [CNT], dedupe="any", forget_after="1 minute")
    run.send(message("a", "E", 0), message("a", "E", 10))
    assert len(run.run()) == 1
    run.send(message("z", "E", 600_000))
    run.run()
    run.send(message("a", "E", 700_000))
    assert [r[2] for r in run.run()] == ["a", "a", "z"]


def test_script_rejects_stream(spark):
    run_dir = new_run_dir(prepare_streaming(spark), "test")
    messages(spark, [message("a", m="M"), message("b", m="M", amount=1)]).write.parquet(f"{run_dir}/messages")
    rejects = script_rejects_of(read_message_files(spark, f"{run_dir}/messages"), definitions(spark, SUM))
    writer = to_parquet(rejects, f"{run_dir}/out", "append").option("checkpointLocation", f"{run_dir}/cp")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{run_dir}/out"), "order_id", "ref_name") == [("a", "s")]


FOLDS = {
    "scans": [
        {**SUM, "sliceGranularity": "HOUR"},
        {"refName": "top", "dimensions": ["m"], "accScript": "greatest(current, amount)"},
        {"refName": "low", "dimensions": ["m"], "accScript": "least(current, amount)"},
        {"refName": "latest", "accScript": "amount"},
    ],
    "affine": [{"refName": "decay", "dimensions": ["m"], "accScript": "current * 0.5 + amount"}],
    "general": [{"refName": "restart", "accScript": "if(current > 9, amount, current + amount)"}],
    "ordered": [{"refName": "capped", "sliceGranularity": "HOUR", "accScript": "if(current < 3, current + amount, null)"}],
}
FOLDS["all"] = [row for some in list(FOLDS.values()) for row in some]


@pytest.mark.parametrize("kind", FOLDS)
def test_running_values_stream_equals_batch(spark, kind):
    """Three runs on one checkpoint; orders come again, in their own run and in later ones."""
    known = definitions(spark, *FOLDS[kind])
    texts = [
        message(f"o{i * 7 % 25}", "E", i * 900_000, m=f"M{i % 2}", amount=(i * 7) % 11 - 4, **({"current": 3} if i == 9 else {}))
        for i in range(45)
    ]
    run_dir = new_run_dir(prepare_streaming(spark), "test")
    parse = lambda found: good_orders(parse_messages(found, field_schema(known)))
    for at in (0, 15, 30):
        numbered = list(enumerate(texts))[at : at + 15]
        spark.createDataFrame(numbered, "arrival_seq long, value string").repartition(3).write.mode("append").parquet(
            f"{run_dir}/messages"
        )
        found = parse(read_message_files(spark, f"{run_dir}/messages"))
        for query in start_running_values(found, known, f"{run_dir}/out", f"{run_dir}/cp", availableNow=True):
            query.awaitTermination()
    columns = ("ref_name", "dimension_key", "slice_ts", "order_id", "slice_key", "running_value")
    batch = running_slice_values(parse(messages(spark, texts)), known)
    assert rows(read_running_values(spark, f"{run_dir}/out"), *columns) == rows(batch, *columns)


def test_slice_versions_are_compacted_and_read_as_of_a_batch(spark):
    shape = "ref_name string, dimension_key string, slice_ts long, value double"
    state = SliceState(spark, f"{new_run_dir(spark, 'test')}/state", *shape.rsplit(", ", 1), compact=3)

    def values(number):
        return rows(state.latest(state.before(number)), "slice_ts", "value")

    for number in range(7):
        state.forget(number)
        state.write(spark.createDataFrame([("r", "", number % 3, float(number)), ("r", "", 100 + number, 0.5)], shape), number)
        state.write(spark.createDataFrame([("r", "", number % 3, float(number)), ("r", "", 100 + number, 0.5)], shape), number)
    assert values(0) == [] or values(6)  # what early batches read is gone by now
    assert values(6) == [(0, 3.0), (1, 4.0), (2, 5.0), *((100 + n, 0.5) for n in range(6))]
    assert values(7) == [(0, 6.0), (1, 4.0), (2, 5.0), *((100 + n, 0.5) for n in range(7))]
    state.forget(7)
    whole, batches = state.versions()
    assert sorted(whole) == [5] and sorted(batches) == [6]


def test_streamed_totals_equal_batch_totals(spark):
    known = definitions(spark, SUM, {"refName": "h", "sliceGranularity": "HOUR"})
    texts = [message(f"o{i % 20}", "E", i * 900_000, m=f"M{i % 2}", amount=i) for i in range(40)]
    run_dir = new_run_dir(prepare_streaming(spark), "test")
    parse = lambda found: good_orders(parse_messages(found, field_schema(known)))
    for at in range(0, 40, 10):
        numbered = list(enumerate(texts))[at : at + 10]
        spark.createDataFrame(numbered, "arrival_seq long, value string").write.mode("append").parquet(f"{run_dir}/messages")
        found = parse(read_message_files(spark, f"{run_dir}/messages"))
        start_slice_totals(found, known, f"{run_dir}/out", f"{run_dir}/cp", compact=2, availableNow=True).awaitTermination()
    columns = ("ref_name", "dimension_key", "granularity", "slice_ts", "value", "orders")
    batch = slice_totals(backfill_messages(messages(spark, texts), known).updates)
    assert rows(read_slice_totals(spark, f"{run_dir}/out"), *columns) == rows(batch, *columns)


def test_counters_and_refusals_are_rows(spark):
    run = Harness(spark, [SUM])
    run.send(message("a", m="M", amount=1), message("b", m="M"), "{ not json", "", message("c", m="M", amount=2), "[]")
    run.run()
    run.online = [{"refName": "bad", "sliceGranularity": "WEEK"}]
    run.send(message("d", m="M", amount=1))
    run.run()
    found = spark.read.schema("version long, reason string, count long, batch long").parquet(f"{run.run_dir}/counters")
    counts = {(r.batch, r.reason): r["count"] for r in found.collect()}
    assert counts[0, "messages"] == 6 and counts[0, "空消息"] == 1 and counts[0, "反序列化失败"] == 2
    assert counts[0, "routed"] == 3 and counts[0, "script returned no number"] == 1 and counts[1, "messages"] == 1
    assert any(batch == 1 and reason.startswith("definitions refused: ") for batch, reason in counts)


def test_a_batch_keeps_the_version_it_took(spark):
    versions = Versions(spark, f"{new_run_dir(spark, 'test')}/definitions")
    first, second = definitions(spark, SUM), definitions(spark, CNT)
    versions.add(first)
    versions.add(definitions(spark, SUM))
    assert versions.of_batch(0)[0] == 0 and versions.of_batch(1)[0] == 0
    versions.add(second)
    again = Versions(spark, versions.folder)  # as after a restart
    assert again.of_batch(1)[0] == 0 and again.of_batch(1)[1].same_as(first)
    assert again.of_batch(2)[0] == 1 and again.of_batch(2)[1].same_as(second)
    again.forget(3)
    assert again._numbers("lists") == [1] and again._numbers("batches") == [2]


def test_counting_increments_is_a_hash_aggregation(spark):
    plan = updates_of_increments(spark.createDataFrame([], INCREMENT), JobOptions())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


@pytest.mark.parametrize("row", [{"accScript": "1"}, {"dimensions": ["a b", "A,b"]}, {"dimensions": ["x", "X"]}])
def test_a_batch_holds_no_parsed_messages(spark, monkeypatch, row):
    """Messages parsed are read again in splits, whatever fields they have; a cached block of them is as long as its file."""
    run = Harness(spark, [{"refName": "c", **row}])
    run.send(message("o", **{"a b": 1, "A,b": 2, "x": 3, "X": 4}), "{ not json", json.dumps({"orderId": "p", "eventTypeCode": "E"}))

    def refused(*_):
        raise AssertionError("parsed messages are held")

    monkeypatch.setattr(type(spark.range(1)), "persist", refused)
    keys = {"1": ["", ""], "a b": ["a b#1;A,b#2"], "x": ["x#3;X#4"]}[row.get("accScript") or row["dimensions"][0]]
    assert [key for _, key, _, _ in run.run()] == keys
    assert run.letters() == [("{ not json", "反序列化失败: not an order object")]
    assert children(spark, f"{run.run_dir}/checkpoint/work") == []


def test_live_messages_come_in_many_files(spark, tmp_path):
    events = spark.range(300).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' ts", "id % 9 user_id", "if(id % 2 = 0, 'click', 'purchase') event_type",
        "cast(id as double) value", "'{\"k\": 60}' props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    known = set(children(spark, shared_dir(spark)))
    found = stream_definitions_live(spark, str(tmp_path))
    (run,) = [n for n in set(children(spark, shared_dir(spark))) - known if n.startswith("live-")]
    files = [n for n in children(spark, f"{shared_dir(spark)}/{run}/messages") if n.endswith(".parquet")]
    assert len(files) > 3
    counts = {r.ref_name: r["count"] for r in found.groupBy("ref_name").count().collect()}
    expected_live = sum(1 for n in range(300) if n % 3 < 2 or n % 2 == 0)
    assert counts == {"live": expected_live, "later": sum(1 for n in range(300) if n % 3 and n % 2)}


class _Map(dict):
    """A map state that notes what it is asked for."""

    def __init__(self):
        self.asked = []

    def exists(self):
        return bool(self)

    def containsKey(self, key):
        self.asked.append(key)
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value


def test_replay_asks_its_state_for_orders_that_succeed_only(spark):
    known = definitions(spark, {"refName": "r", "accScript": "if(current < 2, current + 1, null)"})
    states = {"counted": _Map(), "values": _Map()}
    replay = SliceReplay({n: s.step for n, s in enumerate(known.scripts)})
    replay.init(SimpleNamespace(getMapState=lambda name, *_: states[name]))

    def batch(*ids):
        rows_ = [(0, o, n, 0, 0, "k", False, None, [2.0, 1.0]) for n, o in enumerate(ids)]
        names = ["slice_ts", "order_id", "arrival_seq", "def_ord", "script_id", "slice_key", "own", "current", "args"]
        (found,) = replay.handleInputRows(("r", ""), iter([pd.DataFrame(rows_, columns=names)]), None)
        return found["order_id"].tolist()

    assert batch("a") == ["a"] and states["counted"].asked == []
    assert batch("a", "b", "a") == ["b"] and states["counted"].asked == [("a",), ("b",)]
    states["counted"].asked.clear()
    assert batch(*map(str, range(50))) == [] and states["counted"].asked == []


def test_scripts_without_a_step_are_refused(spark):
    known = definitions(spark, {"refName": "r", "accScript": "sin(current) + amount"})
    with pytest.raises(ValueError, match="Sin"):
        running_value_writers(spark.range(1), known, "/nowhere")


def test_default_options():
    options = JobOptions()
    assert (options.source_topic, options.sink_topic) == ("order-final-state", "indicator-slice-updates")
    assert (options.consumer_group, options.dead_letter_topic) == ("indicator-accumulation", "order-final-state-dlq")
    assert (options.checkpoint_interval_ms, options.source_parallelism) == (60_000, 1)
    assert options.definitions_refresh_ms == 30_000
    for bad in ({"dedupe": "some"}, {"forget_after": "1 hour"}):
        with pytest.raises(ValueError):
            JobOptions(**bad)


@pytest.mark.parametrize("given, used", [("latest", "latest"), ("LATEST", "latest"), ("earliest", "earliest"), ("x", "earliest")])
def test_starting_offsets(given, used):
    assert kafka_options(JobOptions(starting_offsets=given))["startingOffsets"] == used


def test_kafka_settings():
    options = JobOptions(kafka_servers="k:9092", source_parallelism=4, max_records_per_trigger=1000)
    assert kafka_options(options) == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "order-final-state", "minPartitions": "4",
        "startingOffsets": "earliest", "groupIdPrefix": "indicator-accumulation", "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_options(options, streaming=False)["startingOffsets"] == "earliest"
    assert kafka_sink_options(options, options.sink_topic)["topic"] == "indicator-slice-updates"


def test_kafka_records(spark):
    update = ("r", "M", "DAY", 86400, 1.5, "o", "ind:r:M:DAY:86400", 172800)
    record = kafka_records(spark.createDataFrame([update], SLICE_UPDATE)).first()
    assert bytes(record.key).decode() == "r|M"
    assert json.loads(bytes(record.value)) == {
        "refName": "r", "dimensionKey": "M", "granularity": "DAY", "sliceTs": 86400, "increment": 1.5,
        "orderId": "o", "sliceKey": "ind:r:M:DAY:86400", "ttlSeconds": 172800,
    }
    letter = dead_letter_records(spark.createDataFrame([("x", "空消息")], "raw string, fail_reason string")).first()
    assert bytes(letter.value) == b"x" and bytes(letter.headers[0].value).decode() == "空消息"


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text(message("a", amount=1) + "\n" + message("a", amount=2) + "\n")
    read = read_text_files(spark, str(tmp_path), streaming=False)
    assert read.orderBy("arrival_seq").select(F.get_json_object("value", "$.fields.amount")).first()[0] == "1"
    assert read_text_files(spark, str(tmp_path)).isStreaming


def test_text_files_arrive_by_time_and_place(spark, tmp_path):
    import os

    (tmp_path / "b_first.txt").write_text("one\ntwo\n")
    (tmp_path / "a_second.txt").write_text("\n".join(f"line {n}" for n in range(3000)) + "\n")
    os.utime(tmp_path / "b_first.txt", (1_000, 1_000))
    os.utime(tmp_path / "a_second.txt", (2_000, 2_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = read_text_files(spark, str(tmp_path), streaming=False).orderBy("arrival_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in read] == ["one", "two", *(f"line {n}" for n in range(3000))]
    assert len({r.arrival_seq for r in read}) == len(read)
