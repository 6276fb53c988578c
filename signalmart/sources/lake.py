"""Event lake: typed events per type, partitioned by wire date, and their replay."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.operators import keys

if TYPE_CHECKING:
    from signalmart.sources.store import Store


def with_date(events: DataFrame) -> DataFrame:
    """Add the lake's `date`: the first ten characters of the wire timestamp, as text."""
    return events.withColumn("date", F.substring("timestamp", 1, 10))


def rows(events: DataFrame, batch_id: int) -> DataFrame:
    """Events as the lake stores them: with their date and the batch they came with."""
    return with_date(events).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def replay(store: Store, event_type: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored events of one type with wire dates from `first` to `last`, each id once, as it first came.

    Only the folders of those dates are opened; only their rows are told apart by id.
    """
    events = store.read_lake(event_type, first, last)
    return keys.first_per_key(events, ["event_id"], [F.col("batch_id").asc(), F.col("timestamp").asc()])
