"""One batch of a query: its tables are written apart and published together."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from signalmart.operators import keys
from signalmart.sources.manifest import Log, Manifest, Segment

if TYPE_CHECKING:
    from signalmart.sources.store import Store

#: Keys that are looked up one by one, by the statistics of the files; more are joined.
LOOKUP = 2000


def concurrently(spark: SparkSession, steps: list[Callable[[], None]]) -> None:
    """Run independent writes as concurrent jobs, so small ones do not wait for each other."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(steps) or 1) as pool:
        for done in [pool.submit(inherit(step)) for step in steps]:
            done.result()


class Batch:
    """What a batch sees, the state before it and its own writes, and what it adds.

    Nothing it writes is read by others before `commit`; a failed attempt leaves folders that no manifest
    names, and the next attempt writes to others.
    """

    def __init__(self, store: Store, log: Log, base: Manifest, batch_id: int, as_of: str):
        self.store, self.log, self.base = store, log, base
        self.id, self.as_of = batch_id, as_of
        self.name = f"b{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        self.written: dict[str, Segment | None] = {}
        self.replaced: set[str] = set()

    @property
    def clock(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    # --- Reading -----------------------------------------------------------------------------

    def before(self, table: str) -> DataFrame:
        """The table as it was before the batch."""
        return self.store.open(table, self.base.tables.get(table, ()))

    def own(self, table: str) -> DataFrame:
        """The rows this attempt has written."""
        segment = self.written.get(table)
        return self.store.open(table, (segment,) if segment else ())

    def lookup(self, table: str, wanted: DataFrame, own: bool = False) -> DataFrame:
        """Rows of a keyed table whose key stands in `wanted`: as before the batch, or with its own.

        Merged segments are opened in the buckets of the wanted keys only. A few keys are handed to the
        scan itself, which passes over files and pages by their bloom filters and bounds.
        """
        from signalmart.sources.store import KEYED, bucket_of

        segments = self.base.tables.get(table, ())
        if own and (added := self.written.get(table)):
            segments = (*segments, added)
        flat, merged = self.store.open_keyed(table, segments)
        if not segments:
            return flat
        key = KEYED[table]
        wanted = wanted.select(key).where(F.col(key).isNotNull()).distinct()
        some = wanted.select(key, bucket_of(key).alias("bucket")).limit(LOOKUP + 1).collect()
        few = len(some) <= LOOKUP
        if few:
            buckets = {row["bucket"] for row in some}
        else:  # at most one row a bucket
            buckets = {row["bucket"] for row in wanted.select(bucket_of(key).alias("bucket")).distinct().collect()}
        found = flat.unionByName(merged).where(F.col("bucket").isin(sorted(buckets)))
        if few:
            return found.where(_one_of(key, [row[key] for row in some]))
        return found.join(keys.shuffled(wanted), key, "left_semi")

    def fresh(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows whose `event_id` the table did not hold before the batch."""
        keyed = rows.withColumn("key", keys.id_bytes("event_id"))
        stored = self.lookup(f"ids/{table}", keyed).select("key")
        return keyed.join(keys.shuffled(stored), "key", "left_anti").drop("key")

    # --- Writing -----------------------------------------------------------------------------

    def write(self, table: str, rows: DataFrame) -> bool:
        """Add rows to a table; false if there were none."""
        from signalmart.sources.store import write_segment

        self.written[table] = write_segment(self.store, table, rows, self.name, self.id)
        return self.written[table] is not None

    def replace(self, table: str, rows: DataFrame) -> None:
        """Let the table hold these rows and no others."""
        self.replaced.add(table)
        self.write(table, rows)

    def insert(self, table: str, rows: DataFrame) -> bool:
        """Add the rows whose id is new, and their ids to the index; false if there were none."""
        added = self.write(table, self.fresh(table, rows))
        if added:
            self.write(f"ids/{table}", self.own(table).select(keys.id_bytes("event_id").alias("key")))
        return added

    def commit(self) -> Manifest:
        """Publish everything at once."""
        tables = {name: segments for name, segments in self.base.tables.items() if name not in self.replaced}
        for name, segment in self.written.items():
            if segment:
                tables[name] = (*tables.get(name, ()), segment)
        return self.log.publish(Manifest(0, self.id, self.as_of, self.base.version, tables))


def _one_of(key: str, values: list) -> Column:
    """`key` is one of the values, as one parsed list."""
    literals = [
        f"X'{bytes(v).hex()}'" if isinstance(v, bytes | bytearray)
        else str(v) if isinstance(v, int)
        else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        for v in values
    ]
    return F.expr(f"{key} IN ({', '.join(literals)})") if literals else F.lit(False)
