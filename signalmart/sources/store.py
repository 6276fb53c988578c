"""Parquet-backed table store: declared schemas, atomic batches, bounded numbers of folders.

A table is the union of its segments, folders written by one batch or by a merge. The manifest of a query
names them (see `manifest`); `Batch` writes new ones and publishes them all at once. Rollups hold partial sums
per segment and are folded when read. Merging keeps the segments of a table to a few per level, and the
levels grow with the logarithm of the batches; so does what a reader has to list.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalmart import catalog
from signalmart.functions import times
from signalmart.operators import rollups
from signalmart.operators.star import FACT_TABLES
from signalmart.sources.batch import Batch, concurrently
from signalmart.sources.files import Folder
from signalmart.sources.manifest import Log, Manifest, Segment
from signalmart.sources.mart import Mart

_EVENT = "event_id string, event_timestamp timestamp"
_DAY = "date_key int"

#: Names, columns and types of the star. Table -> (columns, partition columns).
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "dim_subscriber": (
        "subscriber_key bigint, subscriber_id bigint, msisdn string, plan string, province string,"
        " created_at timestamp, is_active boolean",
        (),
    ),
    "dim_tower": (
        "tower_key bigint, tower_id string, tower_name string, province string,"
        " technologies array<string>",
        (),
    ),
    "dim_bundle": (
        "bundle_key bigint, bundle_code string, bundle_name string, bundle_type string,"
        " price decimal(10,2)",
        (),
    ),
    "dim_date": (
        "date_key int, full_date date, day_of_week smallint, month smallint, quarter smallint,"
        " year smallint, is_weekend boolean",
        (),
    ),
    "fact_recharges": (
        f"{_EVENT}, subscriber_key bigint, amount decimal(10,2), payment_method string, {_DAY}",
        ("date_key",),
    ),
    "fact_bundle_sales": (
        f"{_EVENT}, subscriber_key bigint, bundle_key bigint, price decimal(10,2), {_DAY}",
        ("date_key",),
    ),
    "fact_calls": (
        f"{_EVENT}, caller_key bigint, tower_key bigint, receiver_msisdn string,"
        f" duration_seconds bigint, dropped boolean, {_DAY}",
        ("date_key",),
    ),
    "fact_sms": (
        f"{_EVENT}, sender_key bigint, receiver_msisdn string, length bigint, {_DAY}",
        ("date_key",),
    ),
    "fact_data_usage": (
        f"{_EVENT}, subscriber_key bigint, tower_key bigint, mb_used decimal(12,2),"
        f" session_seconds bigint, technology string, {_DAY}",
        ("date_key",),
    ),
    "dlq_records": (
        "event_id string, source_topic string, rejection_reason string, original_payload string,"
        f" rejected_at timestamp, {_DAY}",
        ("date_key",),
    ),
    "dlq_skipped": (
        "topic string, `partition` int, `offset` bigint, raw string, cause string",
        (),
    ),
    "tower_status_current": (
        "tower_id string, technology string, signal_strength bigint, connected_devices bigint,"
        " status string, updated_at timestamp",
        (),
    ),
    "agg_revenue_minute": (
        "minute timestamp, province string, revenue_type string, total_amount decimal(14,2),"
        f" txn_count bigint, {_DAY}",
        ("date_key",),
    ),
    "agg_calls_minute": (
        "minute timestamp, tower_key bigint, call_count bigint, dropped_count bigint,"
        f" total_duration bigint, {_DAY}",
        ("date_key",),
    ),
    "agg_data_minute": (
        "minute timestamp, tower_key bigint, technology string, total_mb decimal(16,2),"
        f" session_count bigint, {_DAY}",
        ("date_key",),
    ),
    "agg_dlq_minute": (
        "minute timestamp, source_topic string, rejection_reason string, record_count bigint,"
        f" {_DAY}",
        ("date_key",),
    ),
    "batch_metrics": (
        "event_type string, accepted boolean, n_records bigint, query string, batch_id bigint",
        (),
    ),
    # Where the next record of each source partition is expected, and where one came later than that.
    "source_positions": ("topic string, `partition` int, next_offset bigint", ()),
    "source_gaps": (
        "topic string, `partition` int, expected_offset bigint, found_offset bigint, batch_id bigint", (),
    ),
    # Numbers taken, as their own index; ids stored, as sixteen bytes.
    "ids/msisdn": ("key string", ()),
    **{f"ids/{name}": ("key binary", ()) for name in (*FACT_TABLES, "dlq_records")},
    **{
        f"lake/{kind}": (", ".join(f"`{name}` {type_}" for name, type_ in catalog.fields(kind)) + ", batch_id bigint, date string", ("date",))
        for kind in catalog.EVENT_TYPES
    },
}
#: Tables looked up by a key: kept in buckets of its hash, sorted.
KEYED = {"dim_subscriber": "subscriber_id", **{name: "key" for name in TABLES if name.startswith("ids/")}}
BUCKETS = 256
#: Order within the files of merged tables.
SORTED = {**{name: "event_timestamp" for name in FACT_TABLES}, "dlq_records": "rejected_at"}
#: Written whole, outside the batches.
SEEDED = ("dim_tower", "dim_bundle", "dim_date")
#: Segments of a level that are merged into one of the next.
FAN = 8
ROLLUPS = {**rollups.FACT_ROLLUPS, **rollups.DLQ_ROLLUPS}


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


class Store:
    """Tables, lake and staging area under one root folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, staging: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.staging = staging or f"{self.root}/_staging"
        self.folder = Folder(spark, self.root)

    def folder_of(self, path: str) -> Folder:
        return Folder(self.spark, path)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def schema(self, table: str) -> str:
        return TABLES[table][0]

    # --- Reading -----------------------------------------------------------------------------

    def log(self, query: str) -> Log:
        return Log(self.folder, query)

    def manifests(self) -> list[Manifest]:
        """The newest manifest of each query."""
        return [self.log(query).latest() for query in self.folder.names("_manifests")]

    def segments(self, table: str) -> tuple[Segment, ...]:
        return tuple(s for manifest in self.manifests() for s in manifest.tables.get(table, ()))

    def read(self, table: str) -> DataFrame:
        """The stored table as of the newest manifests; empty, with its schema, before the first write."""
        if table in SEEDED and self.folder.names(table):
            return self.spark.read.schema(self.schema(table)).parquet(self.path(table))
        found = self.open(table, self.segments(table))
        return rollups.fold(table, found) if table in ROLLUPS else found

    def open(self, table: str, segments: tuple[Segment, ...]) -> DataFrame:
        """The rows of some segments, partial sums as they are."""
        if table not in KEYED:
            return self._scan(table, segments, self.schema(table))
        flat, merged = self.open_keyed(table, segments)
        return flat.unionByName(merged).drop("bucket")

    def open_keyed(self, table: str, segments: tuple[Segment, ...]) -> tuple[DataFrame, DataFrame]:
        """A keyed table with its `bucket`: recent segments, and merged ones with buckets as folders."""
        schema = f"{self.schema(table)}, bucket int"
        return tuple(
            self._scan(table, tuple(s for s in segments if bool(s.level) == merged), schema)
            for merged in (False, True)
        )

    def _scan(self, table: str, segments: tuple[Segment, ...], schema: str) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{segment.path}" for segment in segments]
        found = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)
        return found.select(*StructType.fromDDL(schema).names)  # and not the name of the segment

    def read_lake(self, event_type: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """Events of one type, of the wire dates from `first` to `last`; other folders are not opened."""
        table = f"lake/{event_type}"
        lo, hi = first or "", last or "9999-99-99"
        segments = [s for s in self.segments(table) if any(lo <= date <= hi for date in s.parts)]
        events = self.open(table, tuple(segments))
        return events if first is last is None else events.where(F.col("date").between(lo, hi))

    # --- Writing -----------------------------------------------------------------------------

    def begin(self, query: str, batch_id: int, as_of: datetime | Column | None = None) -> Batch | None:
        """A new attempt at a batch; None if newer batches stand on it, which makes it final.

        A replay of the newest batch starts from what was there before it, so that it replaces all of it.
        """
        log = self.log(query)
        newest = log.latest()
        if batch_id < newest.batch:
            return None
        base = log.at(newest.before) if batch_id == newest.batch else newest
        clock = newest.as_of if batch_id == newest.batch else None
        if clock is None:
            now = self.spark.range(1).select(times.as_time(as_of).cast("timestamp").cast("string")).first()[0]
            clock = log.clock(batch_id, now)
        return Batch(self, log, base, batch_id, clock)

    def overwrite(self, table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(table))

    def seed(self, first_day: str = "2026-01-01", last_day: str = "2027-12-31") -> None:
        """Write the fixed dimensions."""
        self.overwrite("dim_tower", catalog.tower_seed(self.spark))
        self.overwrite("dim_bundle", catalog.bundle_seed(self.spark))
        self.overwrite("dim_date", catalog.calendar_between(self.spark, first_day, last_day))

    # --- Merging -----------------------------------------------------------------------------

    def compact(self, query: str, fan: int = FAN) -> bool:
        """Merge each level that has `fan` segments into one segment of the next; true if there was any.

        Only the writer of a query may call this, between its batches. The newest batch is left alone, so a
        replay can still replace it. Folders go once no kept manifest names them.
        """
        log = self.log(query)
        newest = log.latest()
        tables = dict(newest.tables)
        name = f"m{newest.batch:012d}-{newest.version:08d}"

        def merge(table: str, level: int) -> None:
            old = tuple(s for s in tables[table] if s.level == level and s.batch < newest.batch)
            merged = self._merged(table, old, name)
            tables[table] = (*merged, *(s for s in tables[table] if s not in old))

        due = []
        for table, segments in tables.items():
            levels = [s.level for s in segments if s.batch < newest.batch]
            due += [(table, level) for level in sorted(set(levels)) if levels.count(level) >= fan][:1]
        if not due:
            return False
        concurrently(self.spark, [lambda t=t, level=level: merge(t, level) for t, level in due])
        log.publish(Manifest(0, newest.batch, newest.as_of, newest.before, tables))
        self.sweep(query)
        return True

    def _merged(self, table: str, old: tuple[Segment, ...], name: str) -> tuple[Segment, ...]:
        rows = self.open(table, old)
        level = max(s.level for s in old) + 1
        if table in ROLLUPS:
            rows = rollups.fold(table, rows)
        segment = write_segment(self, table, rows, name, max(s.batch for s in old), level)
        return (segment,) if segment else ()

    def sweep(self, query: str) -> None:
        """Remove folders of this query's tables that no kept manifest names: merged ones and failed attempts."""
        log = self.log(query)
        kept, newest = log.retained(), log.latest()
        for table in newest.tables:
            for name in self.folder.names(table):
                path = f"{table}/{name}"
                if name.startswith("segment=") and path not in kept and int(name[9:21]) <= newest.batch:
                    self.folder.delete(path)

    # --- Views -------------------------------------------------------------------------------

    @property
    def mart(self) -> Mart:
        """All tables of the star, opened when used."""
        names = [name for name in TABLES if "/" not in name]
        return Mart({name: (lambda name=name: self.read(name)) for name in names})

    def register_views(self) -> None:
        """Make every table available to SQL under its name."""
        for name, df in self.mart.items():
            df.createOrReplaceTempView(name)


def write_segment(
    store: Store, table: str, rows: DataFrame, name: str, batch: int, level: int = 0
) -> Segment | None:
    """Write rows as one segment; None, and nothing to read, if there are none.

    The rebalance hint gathers each partition's rows into few files and splits a partition that holds a
    large share of the rows, both by measured size.
    """
    partitions, order = TABLES[table][1], []
    options = {}
    if table in KEYED:
        key = KEYED[table]
        rows, order = rows.withColumn("bucket", bucket_of(key)), ["bucket", key]
        if level:
            partitions = ("bucket",)
            options = {"parquet.bloom.filter.adaptive.enabled": "true", f"parquet.bloom.filter.enabled#{key}": "true"}
    elif level and table in SORTED:
        order = [*partitions, SORTED[table]]
    rows = rows.hint("rebalance", *partitions)
    if order:
        rows = rows.sortWithinPartitions(*order)
    path = f"{table}/segment={name}"
    rows.write.mode("overwrite").options(**options).partitionBy(*partitions).parquet(store.path(path))
    names = [n for n in store.folder.names(path) if not n.startswith(("_", "."))]
    parts = tuple(n.partition("=")[2] for n in names) if partitions else ()
    return Segment(path, batch, level, parts) if names else None
