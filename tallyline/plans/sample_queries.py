"""The engine's operators as queries over the sample tables.

Each query takes a session and a table folder, reads whole tables and returns a DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyline.functions import slices
from tallyline.functions.text import as_input
from tallyline.operators import window_values
from tallyline.operators.accumulate import counted_flags, slice_totals
from tallyline.operators.evaluate import route_and_evaluate
from tallyline.operators.fold import running_slice_values
from tallyline.operators.parse import dead_letters, field_schema, good_orders, parse_messages
from tallyline.operators.route import pair_by_event, route, with_legacy_keys
from tallyline.plans import sample_definitions as samples
from tallyline.plans.backfill import backfill_messages, backfill_orders
from tallyline.plans.options import JobOptions
from tallyline.schemas import SLICE_UPDATE
from tallyline.session import new_run_dir, prepare, prepare_streaming
from tallyline.sources import feeds
from tallyline.sources.definitions import (
    BOOTSTRAP,
    DefinitionFeed,
    DefinitionSet,
    definitions_from_rows,
    normalise_documents,
)
from tallyline.sources.orders import read_message_files
from tallyline.streaming.dedupe import output_mode, streaming_updates
from tallyline.streaming.fold import read_running_values, start_running_values
from tallyline.streaming.job import Job, dead_letters_of, parquet_batches, parquet_sink
from tallyline.streaming.sinks import kafka_records, read_parquet, to_parquet
from tallyline.streaming.totals import read_slice_totals, start_slice_totals

Query = Callable[[SparkSession, str], DataFrame]

#: 2024-01-16T00:00:00Z, in the middle of the sample events.
MID_SECOND = 1705363200
#: 2024-01-25T12:34:56Z
NOW_SECOND = 1706186096


_snapshots: dict[str, DefinitionSet] = {}


def _definitions(spark: SparkSession, rows: Iterable[Mapping]) -> DefinitionSet:
    """A snapshot of these definitions, read once per session."""
    identity = spark.sparkContext.applicationId + json.dumps(list(rows))
    found = _snapshots.get(identity)
    if found is None or found.spark is not spark:
        if len(_snapshots) >= 100:
            _snapshots.clear()
        found = _snapshots[identity] = DefinitionSet.of_rows(prepare(spark), rows)
    return found


def _named(spark: SparkSession, *names: str) -> DefinitionSet:
    return _definitions(spark, [r for r in samples.EVENTS if r["refName"] in names])


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.spread(feeds.read_table(prepare(spark), folder, "events"), "event_id")


def _event_orders(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.event_orders(_events(spark, folder))


def _event_updates(spark: SparkSession, folder: str) -> DataFrame:
    return backfill_orders(_event_orders(spark, folder), _definitions(spark, samples.EVENTS)).updates


# ---------------------------------------------------------------- slice updates


def slice_updates_events(spark: SparkSession, folder: str) -> DataFrame:
    return _event_updates(spark, folder)


def slice_updates_orders(spark: SparkSession, folder: str) -> DataFrame:
    table = feeds.spread(feeds.read_table(spark, folder, "orders"), "o_orderkey")
    orders = feeds.table_orders(table)
    return backfill_orders(orders, _definitions(spark, samples.ORDERS)).updates


def bootstrap_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """The built-in definitions, with purchases as payments and users as merchants."""
    fields = F.col("fields")
    payments = _event_orders(spark, folder).select(
        "order_id",
        F.when(F.col("event_type_code") == "purchase", F.lit("EVT_PAY_RESULT"))
        .otherwise(F.col("event_type_code"))
        .alias("event_type_code"),
        "event_epoch_ms",
        "arrival_seq",
        F.struct(fields["userId"].alias("merchantId"), fields["amount"].alias("amount")).alias("fields"),
    )
    return backfill_orders(payments, _definitions(spark, BOOTSTRAP)).updates


def slice_updates_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = feeds.event_messages(_events(spark, folder))
    return backfill_messages(messages, _definitions(spark, samples.EVENTS)).updates


def negative_epoch_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Events moved so that half of them lie before 1970: slices truncate toward zero."""
    moved = _event_orders(spark, folder).withColumn("event_epoch_ms", F.col("event_epoch_ms") - MID_SECOND * 1000)
    updates = backfill_orders(moved, _named(spark, "act_cnt_1d", "buy_amount_7d")).updates
    return updates.select("ref_name", "dimension_key", "order_id", "slice_ts", "slice_key")


# ---------------------------------------------------------------- routing


def route_by_event_type(spark: SparkSession, folder: str) -> DataFrame:
    definitions = _named(spark, "act_cnt_1d", "buy_amount_1d", "buy_amount_7d", "error_cnt_1d")
    return route(_event_orders(spark, folder), definitions).select("ref_name", "order_id")


def route_missing_dimension(spark: SparkSession, folder: str) -> DataFrame:
    definitions = _named(spark, "coupon_cnt_1d", "by_country")
    return route(_event_orders(spark, folder), definitions).select("ref_name", "order_id", "dimension_key")


def route_wildcard_event(spark: SparkSession, folder: str) -> DataFrame:
    """Event types blanked by attribute: an order without one matches nothing, wildcard or not."""
    code = F.when(F.col("fields.k") < 10, F.lit(" ")).when(F.col("fields.k") >= 20, F.col("event_type_code"))
    orders = _event_orders(spark, folder).withColumn("event_type_code", code)
    return route(orders, _named(spark, "all_cnt_2d", "act_cnt_1d")).select("ref_name", "order_id")


def route_fanout_counts(spark: SparkSession, folder: str) -> DataFrame:
    routed = route(_event_orders(spark, folder), _definitions(spark, samples.EVENTS))
    return routed.groupBy("order_id").agg(
        F.count("*").alias("matches"), F.min("def_ord").alias("first_def"), F.max("def_ord").alias("last_def")
    )


def _dimension_keys(spark: SparkSession, folder: str, name: str) -> DataFrame:
    routed = route(_event_orders(spark, folder), _named(spark, name))
    return routed.select("ref_name", "order_id", "dimension_key")


def dimension_key_single(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension_keys(spark, folder, "act_cnt_1d")


def dimension_key_multi(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension_keys(spark, folder, "view_amount_by_k")


def dimension_key_global(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension_keys(spark, folder, "all_cnt_2d")


def dimension_key_legacy(spark: SparkSession, folder: str) -> DataFrame:
    definitions = _named(spark, "view_amount_by_k", "coupon_cnt_1d")
    pairs = with_legacy_keys(pair_by_event(_event_orders(spark, folder), definitions), definitions)
    return pairs.select("ref_name", "order_id", "legacy_key")


# ---------------------------------------------------------------- de-duplication and totals


def dedupe_first_success(spark: SparkSession, folder: str) -> DataFrame:
    orders = feeds.redelivered_orders(_events(spark, folder))
    return backfill_orders(orders, _named(spark, "act_cnt_1d", "buy_amount_1d", "buy_amount_7d")).updates


def dedupe_same_ref_name(spark: SparkSession, folder: str) -> DataFrame:
    orders = feeds.redelivered_orders(_events(spark, folder))
    return backfill_orders(orders, _definitions(spark, samples.SAME_NAME)).updates


def counted_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    definitions = _named(spark, "buy_amount_1d", "act_cnt_1d")
    evaluated = route_and_evaluate(feeds.redelivered_orders(_events(spark, folder)), definitions)
    return counted_flags(evaluated, definitions).select(
        "ref_name", "dimension_key", "order_id", "arrival_seq", "counted"
    )


def _rounded(value: str = "value") -> Column:
    return F.round(value, 4).alias(value)


def slice_totals_events(spark: SparkSession, folder: str) -> DataFrame:
    totals = slice_totals(_event_updates(spark, folder))
    return totals.select("ref_name", "dimension_key", "granularity", "slice_ts", _rounded(), "orders")


# ---------------------------------------------------------------- windows


def _totals_and_definitions(spark: SparkSession, folder: str) -> tuple[DataFrame, DefinitionSet]:
    definitions = _definitions(spark, samples.EVENTS)
    return slice_totals(backfill_orders(_event_orders(spark, folder), definitions).updates), definitions


def window_value_at_now(spark: SparkSession, folder: str) -> DataFrame:
    totals, definitions = _totals_and_definitions(spark, folder)
    values = window_values.value_at(totals, definitions, NOW_SECOND)
    return values.select("ref_name", "dimension_key", _rounded("window_value"))


def window_value_every_slice(spark: SparkSession, folder: str) -> DataFrame:
    totals, definitions = _totals_and_definitions(spark, folder)
    values = window_values.value_at_every_slice(totals, definitions)
    return values.select("ref_name", "dimension_key", "granularity", "slice_ts", _rounded("window_value"))


def _shared_name_totals(spark: SparkSession, folder: str) -> tuple[DataFrame, DefinitionSet]:
    definitions = _definitions(spark, samples.SAME_NAME)
    orders = feeds.redelivered_orders(_events(spark, folder))
    return slice_totals(backfill_orders(orders, definitions).updates), definitions


def window_shared_name_now(spark: SparkSession, folder: str) -> DataFrame:
    """Two definitions of one name with slices of different width: each sums its own window."""
    values = window_values.value_at(*_shared_name_totals(spark, folder), NOW_SECOND)
    return values.select("ref_name", "dimension_key", _rounded("window_value"))


def window_shared_name_every_slice(spark: SparkSession, folder: str) -> DataFrame:
    values = window_values.value_at_every_slice(*_shared_name_totals(spark, folder))
    return values.select("ref_name", "dimension_key", "granularity", "slice_ts", _rounded("window_value"))


def many_scripts_updates(spark: SparkSession, folder: str) -> DataFrame:
    """What every one of many scripts adds, from one scan of the orders."""
    updates = backfill_orders(_event_orders(spark, folder), _definitions(spark, samples.MANY_SCRIPTS)).updates
    totals = updates.groupBy("ref_name").agg(F.sum("increment").alias("total"), F.count("*").alias("orders"))
    return totals.select("ref_name", _rounded("total"), "orders")


def many_scripts_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The last running value of every one of many scripts, over factors, bounds and fields of their own."""
    values = running_slice_values(_event_orders(spark, folder), _definitions(spark, samples.MANY_FOLDS))
    last = values.groupBy("ref_name", "dimension_key", "slice_ts").agg(F.max_by("running_value", "arrival_seq").alias("value"))
    totals = last.groupBy("ref_name").agg(F.sum("value").alias("total"), F.count("*").alias("slices"))
    return totals.select("ref_name", F.round(F.col("total"), 3).alias("total"), "slices")


def slice_retention(spark: SparkSession, folder: str) -> DataFrame:
    kept = window_values.retained(_event_updates(spark, folder), NOW_SECOND)
    return kept.select("slice_key", "order_id", "ttl_seconds")


# ---------------------------------------------------------------- definitions


def granularity_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Granularity arithmetic for every customer, spelled and sized by its attributes."""
    spelled = F.create_map(
        *[
            F.lit(x)
            for pair in {
                "AUTOMOBILE": "MINUTE",
                "BUILDING": " hour",
                "FURNITURE": "Day ",
                "MACHINERY": " ",
                "HOUSEHOLD": "\tMinute\n",
            }.items()
            for x in pair
        ]
    )
    rows = feeds.read_table(spark, folder, "customer").select(
        "c_custkey",
        F.try_element_at(spelled, "c_mktsegment").alias("granularity"),
        (F.col("c_nationkey") - 3).alias("days"),
    )
    step = slices.step_seconds(F.col("granularity"))
    return rows.select(
        "c_custkey",
        step.alias("step"),
        slices.normalise_granularity(F.col("granularity")).alias("name"),
        slices.granularity_name(step).alias("name_of_step"),
        slices.granularity_name(F.col("days") * 60).alias("name_of_other"),
        slices.window_slices(F.col("days"), step).alias("window_slices"),
    )


def definitions_normalised(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON array of definition rows per customer, some of them with properties left out or null."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    full = F.concat(
        F.lit('{"refName":"cust_'), key, F.lit('","eventTypeCodes":["'), F.col("c_mktsegment"),
        F.lit('"],"dimensions":["a","b"],"windowDays":'), nation,
        F.lit(',"sliceGranularity":" hour","accScript":"current + amount","status":"ONLINE"}'),
    )
    sparse = F.concat(F.lit('{"refName":'), key, F.lit(',"eventTypeCodes":null,"windowDays":null}'))
    offline = F.concat(F.lit('{"refName":"off_'), key, F.lit('","status":"OFFLINE"}'))
    unnamed = F.lit('{"accScript":null,"dimensions":["a"],"windowDays":2.9,"sliceGranularity":"MINUTE"}')
    documents = feeds.spread(feeds.read_table(spark, folder, "customer"), "c_custkey").select(
        F.concat(F.lit("["), F.concat_ws(",", full, sparse, offline, unnamed), F.lit("]")).alias("value")
    )
    return normalise_documents(documents).select(
        "ref_name",
        F.array_join("event_type_codes", ",").alias("codes"),
        F.array_join("dimensions", ",").alias("dims"),
        "slice_seconds",
        "window_slices",
        "slice_granularity",
        "acc_script",
    )


# ---------------------------------------------------------------- messages


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    definitions = _named(spark, "buy_amount_1d")
    return parse_messages(feeds.event_messages(_events(spark, folder)), field_schema(definitions))


def parse_valid_orders(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.col("fields")
    return good_orders(_parsed(spark, folder)).select(
        "order_id",
        "event_type_code",
        "event_epoch_ms",
        fields["userId"].alias("user_id"),
        as_input(fields["amount"], T.VariantType(), "double").alias("amount"),
        F.schema_of_variant(fields["amount"]).isin("STRING").alias("amount_is_text"),
    )


def coerced_epoch_ms(spark: SparkSession, folder: str) -> DataFrame:
    return good_orders(_parsed(spark, folder)).select("arrival_seq", "event_epoch_ms")


def dead_letter_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return dead_letters(_parsed(spark, folder)).groupBy("fail_reason").agg(F.count("*").alias("messages"))


def script_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = [*samples.TYPED, *(r for r in samples.EVENTS if r["refName"] == "fails")]
    rejects = backfill_orders(_event_orders(spark, folder), _definitions(spark, rows)).script_rejects
    return rejects.select("ref_name", "dimension_key", "order_id", "acc_script", "reason")


def typed_script_inputs(spark: SparkSession, folder: str) -> DataFrame:
    updates = backfill_orders(_event_orders(spark, folder), _definitions(spark, samples.TYPED)).updates
    return updates.select("ref_name", "dimension_key", "order_id", "increment")


def script_field_overrides_current(spark: SparkSession, folder: str) -> DataFrame:
    """Messages in which the order has a field called ``current``; text amounts fail the sum."""
    messages = feeds.event_messages(_events(spark, folder))
    updates = backfill_messages(messages, _named(spark, "buy_amount_1d", "act_cnt_1d")).updates
    return updates.select("ref_name", "order_id", "increment")


def slice_update_kafka_records(spark: SparkSession, folder: str) -> DataFrame:
    records = kafka_records(_event_updates(spark, folder))
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# ---------------------------------------------------------------- running values


def _running(spark: SparkSession, orders: DataFrame, definitions: DefinitionSet) -> DataFrame:
    values = running_slice_values(orders, definitions)
    return values.select("slice_key", "order_id", _settled("running_value"))


def _settled(value: str) -> Column:
    """Halved sums end on a 5; a nudge keeps both engines' rounding on the same side."""
    return F.round(F.col(value) + 1e-7, 4).alias(value)


def running_slice_value(spark: SparkSession, folder: str) -> DataFrame:
    orders = feeds.redelivered_orders(_events(spark, folder))
    return _running(spark, orders, _named(spark, "act_cnt_1d", "buy_amount_7d", "all_cnt_2d"))


def running_slice_fold(spark: SparkSession, folder: str) -> DataFrame:
    return _running(spark, _event_orders(spark, folder), _definitions(spark, samples.EXTREMES))


def running_slice_decay(spark: SparkSession, folder: str) -> DataFrame:
    """An affine script: its orders compose, so long slices are read in parts."""
    return _running(spark, _event_orders(spark, folder), _definitions(spark, samples.DECAY))


def running_slice_general(spark: SparkSession, folder: str) -> DataFrame:
    """A script that can only be applied order by order."""
    return _running(spark, feeds.redelivered_orders(_events(spark, folder)), _definitions(spark, samples.GENERAL))


def running_slice_capped(spark: SparkSession, folder: str) -> DataFrame:
    """An order that comes when its slice is full fails, and counts if it comes again in another slice."""
    return _running(spark, feeds.redelivered_orders(_events(spark, folder)), _definitions(spark, samples.CAPPED))


# ---------------------------------------------------------------- streams


def _run(rows: DataFrame, folder: str, checkpoint: str, mode: str) -> DataFrame:
    writer = to_parquet(rows, folder, mode).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return read_parquet(rows.sparkSession, folder, rows.schema)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, because a stream takes a plain path for a folder and the table may be one file.
    schema = feeds.read_table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/[e]vents.parquet")


def stream_slice_updates(spark: SparkSession, folder: str) -> DataFrame:
    run = new_run_dir(prepare_streaming(spark), "stream")
    options = JobOptions(dedupe="any")
    orders = feeds.event_orders(_event_stream(spark, folder))
    updates = streaming_updates(orders, _definitions(spark, samples.EVENTS), options)
    return _run(updates, f"{run}/out", f"{run}/checkpoint", output_mode(options))


def _stream_running(spark: SparkSession, orders: DataFrame, definitions: DefinitionSet) -> DataFrame:
    run = new_run_dir(prepare_streaming(spark), "stream")
    for query in start_running_values(orders, definitions, f"{run}/out", f"{run}/checkpoint", availableNow=True):
        query.awaitTermination()
    return read_running_values(spark, f"{run}/out").select("slice_key", "order_id", _settled("running_value"))


def stream_running_value(spark: SparkSession, folder: str) -> DataFrame:
    rows = [*samples.EXTREMES, *(r for r in samples.EVENTS if r["refName"] == "buy_amount_7d")]
    return _stream_running(spark, feeds.event_orders(_event_stream(spark, folder)), _definitions(spark, rows))


def stream_running_decay(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_running(spark, feeds.event_orders(_event_stream(spark, folder)), _definitions(spark, samples.DECAY))


def stream_running_general(spark: SparkSession, folder: str) -> DataFrame:
    rows = [*samples.GENERAL, *samples.CAPPED]
    return _stream_running(spark, feeds.redelivered_orders(_event_stream(spark, folder)), _definitions(spark, rows))


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    run = new_run_dir(prepare_streaming(spark), "stream")
    messages = feeds.event_messages(_event_stream(spark, folder))
    letters = dead_letters_of(messages, _named(spark, "buy_amount_1d"))
    written = _run(letters, f"{run}/out", f"{run}/checkpoint", "append")
    return written.groupBy("fail_reason").agg(F.count("*").alias("messages"))


def stream_dedupe_restart(spark: SparkSession, folder: str) -> DataFrame:
    """The job stopped and started on one checkpoint, with redeliveries and one more definition."""
    known = [r for r in samples.EVENTS if r["refName"] in ("act_cnt_1d", "buy_amount_1d")]
    added = [r for r in samples.EVENTS if r["refName"] == "all_cnt_2d"]
    return _restarted(spark, folder, known, [*added, *known])


def stream_restart_shared_name(spark: SparkSession, folder: str) -> DataFrame:
    """The second run has a second definition under the name of the first."""
    return _restarted(spark, folder, samples.SAME_NAME[:1], samples.SAME_NAME)


def _restarted(spark: SparkSession, folder: str, before: Iterable[Mapping], after: Iterable[Mapping]) -> DataFrame:
    """Two runs on one checkpoint.  The first sees every message; the second sees every message again."""
    run = new_run_dir(prepare_streaming(spark), "restart")
    online = before

    job = Job(
        spark=spark,
        read=lambda: read_message_files(spark, f"{run}/messages"),
        feed=DefinitionFeed(spark, lambda: definitions_from_rows(spark, online)),
        options=JobOptions(),
        checkpoint=f"{run}/checkpoint",
        updates=parquet_sink(f"{run}/out"),
        available_now=True,
    )
    messages = feeds.event_messages(_events(spark, folder))
    messages.write.parquet(f"{run}/messages")
    job.run_available()
    online = after
    later = messages.withColumn("arrival_seq", F.col("arrival_seq") + feeds.REDELIVERY_OFFSET)
    later.write.mode("append").parquet(f"{run}/messages")
    job.run_available()
    return read_parquet(spark, f"{run}/out", SLICE_UPDATE)


def stream_job_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Updates, dead letters, script rejects and counters of one run, from one reading of the messages."""
    run = new_run_dir(prepare_streaming(spark), "job")
    rows = [r for r in samples.EVENTS if r["refName"] in ("buy_amount_1d", "act_cnt_1d", "fails")]
    job = Job(
        spark=spark,
        read=lambda: read_message_files(spark, f"{run}/messages"),
        feed=DefinitionFeed(spark, lambda: definitions_from_rows(spark, rows)),
        options=JobOptions(),
        checkpoint=f"{run}/checkpoint",
        updates=parquet_sink(f"{run}/updates"),
        letters=parquet_batches(f"{run}/letters"),
        rejects=parquet_batches(f"{run}/rejects"),
        counters=parquet_batches(f"{run}/counters"),
        available_now=True,
    )
    feeds.event_messages(_events(spark, folder)).write.parquet(f"{run}/messages")
    job.run_available()

    def output(name: str, kind: Column, about: Column, number: Column) -> DataFrame:
        found = spark.read.parquet(f"{run}/{name}").groupBy(kind.alias("kind"), about.alias("about"))
        return found.agg(F.sum(number).alias("number")).withColumn("output", F.lit(name))

    one = F.lit(1).cast("bigint")
    return (
        output("updates", F.col("ref_name"), F.col("slice_key"), one)
        .unionByName(output("letters", F.lit("letter"), F.col("fail_reason"), one))
        .unionByName(output("rejects", F.col("ref_name"), F.col("reason"), one))
        .unionByName(output("counters", F.lit("counter"), F.col("reason"), F.col("count")))
    )


def stream_definitions_live(spark: SparkSession, folder: str) -> DataFrame:
    """Definitions that change twice while the job runs: a second one comes, then the first takes another script.

    Every third of the messages comes in micro-batches of its own, and nothing is restarted between them.
    """
    run = new_run_dir(prepare_streaming(spark), "live")
    lists = [samples.LIVE[:1], samples.LIVE[:2], samples.LIVE[1:]]
    online = list(lists[0])
    messages = feeds.event_messages(_events(spark, folder))
    job = Job(
        spark=spark,
        read=lambda: read_message_files(spark, f"{run}/messages"),
        feed=DefinitionFeed(spark, lambda: definitions_from_rows(spark, online)),
        options=JobOptions(checkpoint_interval_ms=100),
        checkpoint=f"{run}/checkpoint",
        updates=parquet_sink(f"{run}/out"),
    )
    third = F.col("arrival_seq") % 3
    messages.where(third == 0).write.parquet(f"{run}/messages")
    queries = job.start()
    try:
        for n, rows in enumerate(lists):
            if n:
                online[:] = rows
                job.refresh()
                messages.where(third == n).write.mode("append").parquet(f"{run}/messages")
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return read_parquet(spark, f"{run}/out", SLICE_UPDATE)


def stream_slice_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Slice totals kept up to date by a stream of redelivered orders."""
    run = new_run_dir(prepare_streaming(spark), "stream")
    orders = feeds.redelivered_orders(_event_stream(spark, folder))
    definitions = _definitions(spark, samples.EVENTS)
    start_slice_totals(orders, definitions, f"{run}/out", f"{run}/checkpoint", availableNow=True).awaitTermination()
    found = read_slice_totals(spark, f"{run}/out")
    return found.select("ref_name", "dimension_key", "granularity", "slice_ts", _rounded(), "orders")


QUERIES: dict[str, Query] = {
    "slice_updates_events": slice_updates_events,
    "slice_updates_orders": slice_updates_orders,
    "slice_updates_messages": slice_updates_messages,
    "bootstrap_indicators": bootstrap_indicators,
    "negative_epoch_slices": negative_epoch_slices,
    "route_by_event_type": route_by_event_type,
    "route_missing_dimension": route_missing_dimension,
    "route_wildcard_event": route_wildcard_event,
    "route_fanout_counts": route_fanout_counts,
    "dimension_key_single": dimension_key_single,
    "dimension_key_multi": dimension_key_multi,
    "dimension_key_global": dimension_key_global,
    "dimension_key_legacy": dimension_key_legacy,
    "dedupe_first_success": dedupe_first_success,
    "dedupe_same_ref_name": dedupe_same_ref_name,
    "counted_deliveries": counted_deliveries,
    "slice_totals": slice_totals_events,
    "window_value_at_now": window_value_at_now,
    "window_value_every_slice": window_value_every_slice,
    "window_shared_name_now": window_shared_name_now,
    "window_shared_name_every_slice": window_shared_name_every_slice,
    "many_scripts_updates": many_scripts_updates,
    "slice_retention": slice_retention,
    "granularity_steps": granularity_steps,
    "definitions_normalised": definitions_normalised,
    "parse_valid_orders": parse_valid_orders,
    "coerced_epoch_ms": coerced_epoch_ms,
    "dead_letter_reasons": dead_letter_reasons,
    "script_rejects": script_rejects,
    "typed_script_inputs": typed_script_inputs,
    "script_field_overrides_current": script_field_overrides_current,
    "slice_update_kafka_records": slice_update_kafka_records,
    "running_slice_value": running_slice_value,
    "running_slice_fold": running_slice_fold,
    "running_slice_decay": running_slice_decay,
    "running_slice_general": running_slice_general,
    "running_slice_capped": running_slice_capped,
    "many_scripts_fold": many_scripts_fold,
    "stream_slice_updates": stream_slice_updates,
    "stream_running_value": stream_running_value,
    "stream_running_decay": stream_running_decay,
    "stream_running_general": stream_running_general,
    "stream_dead_letters": stream_dead_letters,
    "stream_job_outputs": stream_job_outputs,
    "stream_definitions_live": stream_definitions_live,
    "stream_slice_totals": stream_slice_totals,
    "stream_dedupe_restart": stream_dedupe_restart,
    "stream_restart_shared_name": stream_restart_shared_name,
}
