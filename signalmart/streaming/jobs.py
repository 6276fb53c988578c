"""The two streaming queries: events into the mart, dead letters into their review table.

Each has its own checkpoint and is the only writer of its tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from signalmart.operators import validate
from signalmart.plans import load
from signalmart.sources.sinks import DeadLetterSink
from signalmart.sources.store import Store


@dataclass(frozen=True)
class Trigger:
    """Every five seconds by default; `available_now` drains the source and stops."""

    interval: str = "5 seconds"
    available_now: bool = False

    def arguments(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": self.interval}


@dataclass
class Jobs:
    store: Store
    sink: DeadLetterSink
    checkpoints: str
    trigger: Trigger = field(default_factory=Trigger)
    load_options: dict = field(default_factory=dict)

    def _start(
        self, name: str, records: DataFrame, run: Callable[[DataFrame, Store, int], None]
    ) -> StreamingQuery:
        def on_batch(batch: DataFrame, batch_id: int) -> None:
            # The batch belongs to the query's own session; tables must be opened there too.
            store = Store(batch.sparkSession, self.store.root, self.store.staging)
            run(validate.decode(batch), store, batch_id)

        return (
            records.writeStream.queryName(name)
            .foreachBatch(on_batch)
            .option("checkpointLocation", f"{self.checkpoints}/{name}")
            .trigger(**self.trigger.arguments())
            .start()
        )

    def start_events(self, records: DataFrame) -> StreamingQuery:
        def run(raw: DataFrame, store: Store, batch_id: int) -> None:
            load.run_batch(raw, store, batch_id, self.sink, **self.load_options)

        return self._start(load.EVENTS_QUERY, records, run)

    def start_dead_letters(self, records: DataFrame) -> StreamingQuery:
        return self._start(load.DLQ_QUERY, records, load.run_dead_letter_batch)


def supervise(spark: SparkSession) -> None:
    """Return as soon as any query stops, raising its error, so that a restart replays."""
    spark.streams.awaitAnyTermination()
