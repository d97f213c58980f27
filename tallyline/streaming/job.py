"""The streaming job: messages in, slice updates, dead letters, script rejects and counters out.

One query reads the messages.  Each of its micro-batches is parsed once under one version of the definitions and gives
all outputs, written under the batch's number, so a batch that runs again after a failure replaces or keeps what it
wrote.  Increments go to an inner table of narrow rows, from which a second query, whose state remembers the orders
counted, makes the slice updates.

Definitions may change while the job runs: a changed list is stored as a further version, the next micro-batch takes
it, and the version a batch took is noted before its outputs are written.  No query stops for it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyline.operators.accumulate import describe
from tallyline.operators.evaluate import NOT_A_NUMBER, failed_scripts, route_and_evaluate
from tallyline.operators.parse import EMPTY_MESSAGE, NO_ORDER_ID, UNREADABLE_PREFIX, dead_letters, field_schema, good_orders, parse_messages
from tallyline.plans.options import JobOptions
from tallyline.schemas import COUNTER, INCREMENT
from tallyline.session import children, prepare_streaming, remove
from tallyline.sources.definitions import DefinitionFeed, DefinitionSet
from tallyline.sources.orders import read_kafka
from tallyline.streaming.dedupe import output_mode, updates_of_increments
from tallyline.streaming.sinks import (
    dead_letter_records,
    kafka_records,
    kafka_sink_options,
    reject_records,
    to_batches,
    to_kafka,
    to_parquet,
)

Sink = Callable[[DataFrame, str], DataStreamWriter]
BatchSink = Callable[[DataFrame, int], None]


def dead_letters_of(messages: DataFrame, definitions: DefinitionSet) -> DataFrame:
    return dead_letters(parse_messages(messages, field_schema(definitions)))


def script_rejects_of(messages: DataFrame, definitions: DefinitionSet) -> DataFrame:
    parsed = parse_messages(messages, field_schema(definitions))
    return failed_scripts(route_and_evaluate(good_orders(parsed), definitions), definitions)


class Versions:
    """Definition lists as numbered versions in a folder, and which version each micro-batch took."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._held: dict[int, DefinitionSet] = {}

    def _numbers(self, kind: str) -> list[int]:
        names = (n.partition("=") for n in children(self.spark, f"{self.folder}/{kind}"))
        return sorted(int(n) for key, _, n in names if key == "n")

    def add(self, definitions: DefinitionSet) -> None:
        """Store a list as the next version, unless the last one is the same."""
        last = max(self._numbers("lists"), default=-1)
        if last >= 0 and self.get(last).same_as(definitions):
            return
        definitions.source.write.mode("overwrite").parquet(f"{self.folder}/lists/n={last + 1}")
        self._held[last + 1] = definitions

    def get(self, number: int) -> DefinitionSet:
        if number not in self._held:
            self._held[number] = DefinitionSet.of(self.spark.read.parquet(f"{self.folder}/lists/n={number}"))
        return self._held[number]

    def of_batch(self, batch: int) -> tuple[int, DefinitionSet]:
        """The version a batch has to take: what it took before, else the latest."""
        noted = f"{self.folder}/batches/n={batch}"
        if batch in self._numbers("batches"):
            number = self.spark.read.parquet(noted).first()["version"]
        else:
            number = max(self._numbers("lists"))
            self.spark.createDataFrame([(number,)], "version long").coalesce(1).write.mode("overwrite").parquet(noted)
        return number, self.get(number)

    def forget(self, batch: int) -> None:
        """Remove notes of batches long done, and versions before the one that the batch before took."""
        before = [n for n in self._numbers("batches") if n < batch]
        if before:
            used = self.of_batch(before[-1])[0]
            for n in before[:-1]:
                remove(self.spark, f"{self.folder}/batches/n={n}")
            for n in self._numbers("lists"):
                if n < used:
                    self._held.pop(n, None)
                    remove(self.spark, f"{self.folder}/lists/n={n}")


def _reason(text: Column) -> Column:
    """What a refused message is counted as."""
    return F.when(text.startswith(UNREADABLE_PREFIX), F.lit(UNREADABLE_PREFIX.strip(" :"))).otherwise(text)


def _kept(parsed: DataFrame, folder: str) -> DataFrame:
    """Parsed messages written to a folder and read again, in splits of Spark's usual size; only refused ones keep their text."""
    kind = parsed.schema["fields"].dataType
    raw = F.when(F.col("fail_reason").isNotNull(), F.col("raw"))
    plain, fields = parsed.withColumn("raw", raw), F.col("fields")
    if isinstance(kind, T.StructType):
        # fields may have any name; a file's columns are numbered, and there has to be one
        numbered = T.StructType([T.StructField(f"f{n}", f.dataType) for n, f in enumerate(kind)])
        stored = fields.cast(numbered) if len(kind) else fields.isNotNull()
        fields = fields.cast(kind) if len(kind) else F.when(fields, F.struct().cast(kind))
        plain = plain.withColumn("fields", stored)
    plain.write.mode("overwrite").parquet(folder)
    read = parsed.sparkSession.read.schema(plain.schema).parquet(folder)
    return read.withColumn("fields", fields)


_REFUSALS = {"empty": EMPTY_MESSAGE, "unnamed": NO_ORDER_ID, "unreadable": UNREADABLE_PREFIX.strip(" :")}


@dataclass
class Job:
    """One running job.  Its queries keep checkpoints, the definition versions and the increments below ``checkpoint``."""

    spark: SparkSession
    read: Callable[[], DataFrame]
    feed: DefinitionFeed
    options: JobOptions
    checkpoint: str
    updates: Sink
    letters: BatchSink | None = None
    rejects: BatchSink | None = None
    counters: BatchSink | None = None
    available_now: bool = False
    versions: Versions = field(init=False)

    def __post_init__(self) -> None:
        self.versions = Versions(self.spark, f"{self.checkpoint}/definitions")

    @property
    def _increments(self) -> str:
        return f"{self.checkpoint}/increments"

    def _take(self, messages: DataFrame, batch: int) -> None:
        """All outputs of one micro-batch from one parse."""
        number, definitions = self.versions.of_batch(batch)
        self.versions.forget(batch)
        parsed = parse_messages(messages, field_schema(definitions))
        seen, tried = Observation(f"messages {batch}"), Observation(f"scripts {batch}")
        refused = _reason(F.col("fail_reason"))
        parsed = parsed.observe(seen, F.count("*").alias("messages"), *[F.count_if(refused == r).alias(n) for n, r in _REFUSALS.items()])
        work = f"{self.checkpoint}/work/batch={batch}"
        try:
            parsed = _kept(parsed, work)
            evaluated = route_and_evaluate(good_orders(parsed), definitions)
            failed = F.col("increment").isNull()
            watched = evaluated.observe(tried, F.count("*").alias("routed"), F.count_if(failed).alias("failed"))
            described = describe(watched.where(~failed), definitions)
            to_batches(described.select(*INCREMENT.fieldNames()), self._increments)(batch)
            if self.letters:
                self.letters(dead_letters(parsed), batch)
            if self.rejects:
                self.rejects(failed_scripts(evaluated, definitions), batch)
            if self.counters:
                counts = seen.get | tried.get
                named = {"messages": counts["messages"], **{r: counts[n] for n, r in _REFUSALS.items()}}
                named |= {"routed": counts["routed"], NOT_A_NUMBER: counts["failed"]}
                refusals = [(text, 1) for _, text in self.feed.take_refusals()]
                rows = [(batch, number, reason, n) for reason, n in [*named.items(), *refusals]]
                self.counters(self.spark.createDataFrame(rows, COUNTER), batch)
        finally:
            remove(self.spark, work)

    def _reading(self) -> DataStreamWriter:
        return self.read().writeStream.foreachBatch(self._take)

    def _counting(self) -> DataStreamWriter:
        # a batch that ran again wrote its rows once more at most, and orders counted already are dropped
        reader = self.spark.readStream.schema(INCREMENT).option("ignoreMissingFiles", "true")
        increments = reader.option("maxFilesPerTrigger", 1000).parquet(f"{self._increments}/*")
        return self.updates(updates_of_increments(increments, self.options), output_mode(self.options))

    def _started(self, name: str, writer: DataStreamWriter) -> StreamingQuery:
        writer = writer.option("checkpointLocation", f"{self.checkpoint}/{name}")
        if self.available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{self.options.checkpoint_interval_ms} milliseconds").start()

    def refresh(self) -> None:
        """Load the definitions; a changed list holds from the next micro-batch on."""
        self.feed.refresh()
        self.versions.add(self.feed.snapshot)

    def start(self) -> list[StreamingQuery]:
        prepare_streaming(self.spark)
        self.spark.createDataFrame([], INCREMENT).write.mode("overwrite").parquet(f"{self._increments}/none")
        self.refresh()
        return [self._started("reading", self._reading()), self._started("counting", self._counting())]

    def run(self, refreshes: int | None = None) -> None:
        """Run with periodic definition refresh, for ever or for a number of refresh periods."""
        queries = self.start()
        try:
            while refreshes is None or refreshes > 0:
                queries[0].awaitTermination(self.feed.refresh_seconds)
                for query in queries:
                    if query.exception():
                        raise query.exception()
                self.refresh()
                refreshes = None if refreshes is None else refreshes - 1
        finally:
            for query in queries:
                query.stop()

    def run_available(self) -> None:
        """Process what is there and return."""
        prepare_streaming(self.spark)
        self.refresh()
        self._started("reading", self._reading()).awaitTermination()
        self._started("counting", self._counting()).awaitTermination()


def kafka_job(
    spark: SparkSession, load_definitions: Callable[[], DataFrame], options: JobOptions, checkpoint: str
) -> Job:
    """The job between Kafka topics.  Needs Spark's Kafka connector on the class path."""

    def topic(records: Callable[[DataFrame], DataFrame], name: str | None) -> BatchSink | None:
        if name is None:
            return None
        sink = kafka_sink_options(options, name)
        return lambda rows, batch: records(rows).write.format("kafka").options(**sink).save()

    return Job(
        spark=spark,
        read=lambda: read_kafka(spark, options),
        feed=DefinitionFeed(spark, load_definitions, options.definitions_refresh_ms / 1000),
        options=options,
        checkpoint=checkpoint,
        updates=lambda rows, mode: to_kafka(kafka_records(rows), options, options.sink_topic, mode),
        letters=topic(dead_letter_records, options.dead_letter_topic),
        rejects=topic(reject_records, options.reject_topic),
        counters=parquet_batches(f"{checkpoint}/counters"),
    )


def parquet_sink(folder: str) -> Sink:
    return lambda rows, mode: to_parquet(rows, folder, mode)


def parquet_batches(folder: str) -> BatchSink:
    return lambda rows, batch: to_batches(rows, folder)(batch)
