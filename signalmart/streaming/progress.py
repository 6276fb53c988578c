"""Streaming progress reports as rows of the metrics table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_OFFSETS = "map<string, map<string, bigint>>"
_REPORT = "name string, timestamp string, sources array<struct<endOffset: string, latestOffset: string>>"


def source_offsets(reports: DataFrame, column: str = "report") -> DataFrame:
    """Progress JSON of broker sources to one row per query, topic and partition.

    The committed offset is where the finished trigger stopped, the latest is what the broker held.
    """
    parsed = reports.select(F.from_json(column, _REPORT).alias("p"))
    sources = parsed.select(
        F.col("p.name").alias("query"),
        F.to_timestamp("p.timestamp").alias("sampled_at"),
        F.explode("p.sources").alias("source"),
    ).select(
        "query",
        "sampled_at",
        F.from_json("source.endOffset", _OFFSETS).alias("end"),
        F.from_json("source.latestOffset", _OFFSETS).alias("latest"),
    )
    topics = sources.select(
        "query", "sampled_at", "latest", F.explode("end").alias("topic", "partitions")
    )
    return topics.select(
        "query",
        "topic",
        "sampled_at",
        F.try_element_at("latest", F.col("topic")).alias("heads"),
        F.explode("partitions").alias("number", "committed_offset"),
    ).select(
        "query",
        "topic",
        F.col("number").cast("int").alias("partition"),
        "sampled_at",
        F.coalesce(F.try_element_at("heads", F.col("number")), "committed_offset").alias(
            "latest_offset"
        ),
        "committed_offset",
    )


class ProgressRecorder(StreamingQueryListener):
    """Appends every progress report as one JSON row; `source_offsets` reads them back.

    An idle query reports no progress, so its last report is sampled again under the idle time:
    a stalled stream shows as unchanged offsets, not as missing minutes.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.last: dict[str, dict] = {}  # one report per running query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.last[str(event.progress.runId)] = json.loads(event.progress.json)
        self._append(event.progress.json)

    def onQueryIdle(self, event) -> None:
        report = self.last.get(str(event.runId))
        if report:
            self._append(json.dumps({**report, "timestamp": event.timestamp}))

    def onQueryTerminated(self, event) -> None:
        self.last.pop(str(event.runId), None)

    def _append(self, report: str) -> None:
        row = self.spark.createDataFrame([(report,)], "report string")
        row.write.mode("append").parquet(self.path)
