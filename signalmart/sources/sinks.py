"""Where dead letters are published: a broker topic, or files a stream can read back."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.operators import deadletter


class DeadLetterSink(Protocol):
    def publish(self, envelopes: DataFrame, batch_id: int) -> None: ...


@dataclass(frozen=True)
class KafkaSink:
    """Compact JSON to the dead-letter topic, acknowledged by all replicas."""

    bootstrap_servers: str

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "kafka.acks": "all"}

    def publish(self, envelopes: DataFrame, batch_id: int) -> None:
        messages = deadletter.to_broker(envelopes).select("topic", "value")
        messages.write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class FileSink:
    """The same messages as files in broker shape; publishing a batch again replaces its files."""

    path: str

    def publish(self, envelopes: DataFrame, batch_id: int) -> None:
        messages = deadletter.to_broker(envelopes).withColumns(
            {"value": F.col("value").cast("binary"), "batch_id": F.lit(batch_id)}
        )
        (
            messages.hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(self.path)
        )
