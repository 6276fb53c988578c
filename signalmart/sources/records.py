"""Raw record sources in broker shape `(topic, partition, offset, value)`, streaming or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import catalog

BROKER_SCHEMA = "topic string, `partition` int, `offset` bigint, value binary"


def kafka_options(
    bootstrap_servers: str,
    topics: tuple[str, ...],
    max_records: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Subscription from the beginning; `max_records` bounds each batch, None takes all there is.

    `fail_on_data_loss=True` stops the query when records were dropped by the broker before they
    were read; otherwise it goes on behind the gap, which the load reports in `source_gaps`.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def gaps(records: DataFrame, positions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(partitions whose first record lies behind the expected one, positions after these records).

    What a broker dropped before it was read shows as a gap; nothing else tells of it where the query does
    not fail on data loss. Gaps inside a batch are not looked for: brokers leave out control records.
    """
    bounds = records.groupBy("topic", "partition").agg(
        F.min("offset").alias("found_offset"), (F.max("offset") + 1).alias("after")
    )
    both = positions.join(bounds, ["topic", "partition"], "full")
    found = both.where("found_offset > next_offset").select(
        "topic", "partition", F.col("next_offset").alias("expected_offset"), "found_offset"
    )
    return found, both.select("topic", "partition", F.greatest("next_offset", "after").alias("next_offset"))


def event_topics() -> tuple[str, ...]:
    return tuple(catalog.TOPICS)


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: tuple[str, ...],
    max_records: int | None = None,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    options = kafka_options(bootstrap_servers, topics, max_records, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files in broker shape as a stream, at most `max_files` per batch."""
    reader = spark.readStream.schema(BROKER_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
