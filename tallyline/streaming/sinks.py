"""Outputs of the job: Kafka records, and parquet folders for runs without a broker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tallyline import schemas
from tallyline.functions.slices import partition_key
from tallyline.plans.options import JobOptions


def update_json() -> Column:
    """A slice update as JSON under its wire names."""
    return F.to_json(F.struct(*[F.col(c).alias(n) for c, n in schemas.UPDATE_PROPERTIES.items()]))


def kafka_records(updates: DataFrame) -> DataFrame:
    key = partition_key(F.col("ref_name"), F.col("dimension_key"))
    return updates.select(key.cast("binary").alias("key"), update_json().cast("binary").alias("value"))


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """Refused messages as they came, with the reason as a header."""
    reason = F.struct(F.lit("reason").alias("key"), F.col("fail_reason").cast("binary").alias("value"))
    return letters.select(F.col("raw").cast("binary").alias("value"), F.array(reason).alias("headers"))


def reject_records(rejects: DataFrame) -> DataFrame:
    """Orders whose script gave no number, as JSON."""
    return rejects.select(F.to_json(F.struct(*rejects.columns)).cast("binary").alias("value"))


def kafka_sink_options(options: JobOptions, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": options.kafka_servers, "topic": topic, "includeHeaders": "true"}


def to_kafka(records: DataFrame, options: JobOptions, topic: str, mode: str) -> DataStreamWriter:
    return records.writeStream.format("kafka").options(**kafka_sink_options(options, topic)).outputMode(mode)


def to_batches(rows: DataFrame, folder: str) -> Callable[[int], None]:
    """Write rows below ``folder`` under a micro-batch's number; a batch that runs again replaces its own."""

    def write(number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def to_parquet(rows: DataFrame, folder: str, mode: str) -> DataStreamWriter:
    """Rows below ``folder``, each micro-batch exactly once.

    Append output uses Spark's file sink.  Update output writes one folder per micro-batch; a batch
    that runs again after a failure replaces its own folder.
    """
    if mode == "append":
        return rows.writeStream.format("parquet").option("path", folder).outputMode("append")

    return rows.writeStream.outputMode(mode).foreachBatch(lambda batch, number: to_batches(batch, folder)(number))


def read_parquet(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What ``to_parquet`` wrote."""
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
