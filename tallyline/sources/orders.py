"""Order message sources, as a stream or as a static backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyline.plans.options import JobOptions

MESSAGE = "arrival_seq long, value string"


def kafka_arrival() -> Column:
    """One number that keeps the order within a partition and differs between partitions."""
    return F.col("offset") * 65536 + F.col("partition")


def kafka_options(options: JobOptions, streaming: bool = True) -> dict[str, str]:
    """Options of Spark's Kafka source.  Offsets apply only until a checkpoint exists."""
    settings = {
        "kafka.bootstrap.servers": options.kafka_servers,
        "subscribe": options.source_topic,
        "minPartitions": str(options.source_parallelism),
        "startingOffsets": options.first_offsets if streaming else "earliest",
    }
    if streaming:
        settings["groupIdPrefix"] = options.consumer_group
        if options.max_records_per_trigger:
            settings["maxOffsetsPerTrigger"] = str(options.max_records_per_trigger)
    return settings


def read_kafka(spark: SparkSession, options: JobOptions, streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**kafka_options(options, streaming)).load()
    return records.select(kafka_arrival().alias("arrival_seq"), F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, streaming: bool = True, files_per_trigger: int = 1000) -> DataFrame:
    """Messages in parquet files with the columns of ``MESSAGE``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if streaming else spark.read
    return reader.schema(MESSAGE).parquet(path)


def read_text_files(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """One message per line, in files that arrive by modification time and then name; redeliveries belong in later files.

    A stream takes one file per micro-batch, so a later file is a later batch.  A backfill reads the files twice: the
    blocks that were scanned are ranked by file and place, whatever scan task they fell into, and a line's arrival
    is its block's rank and its place in the block.
    """
    if streaming:
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
        return lines.select(F.monotonically_increasing_id().alias("arrival_seq"), "value")
    about = F.col("_metadata")
    block = [about["file_modification_time"].alias("time"), about["file_path"].alias("file"), about["file_block_start"].alias("start")]
    lines = spark.read.text(path).select("value", *block, F.monotonically_increasing_id().alias("place"))
    # one row for each scanned block
    blocks = lines.groupBy("time", "file", "start").agg(F.min("place").alias("first"))
    rank = F.row_number().over(Window.orderBy("time", "file", "start")).cast("bigint")
    ranked = blocks.withColumn("rank", rank).withColumnsRenamed({"time": "t", "file": "f", "start": "s"})
    same = (F.col("time") == F.col("t")) & (F.col("file") == F.col("f")) & (F.col("start") == F.col("s"))
    arrival = F.shiftleft(F.col("rank"), 33) + F.col("place") - F.col("first")
    return lines.join(ranked, same).select(arrival.alias("arrival_seq"), "value")
