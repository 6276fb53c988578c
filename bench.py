"""Time the headline queries and one full batch load; prints a single JSON line.

BENCH_SF_DIR picks the data (default sf0.1), BENCH_CPUS the local cores. Each query is run once to
warm up and once for the clock, into a sink that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from signalmart import session
from signalmart.bindings import history, registry
from signalmart.bindings.model import Model
from signalmart.plans import load
from signalmart.sources.sinks import FileSink

HEADLINE = (
    "decode_raw validate_events schema_verdict typed_events dedupe_first dlq_records"
    " referential_rejects dim_subscriber_upsert fact_bundle_sales fact_calls fact_data_usage"
    " tower_status_current rollup_revenue_minute rollup_calls_minute rollup_data_minute"
    " rollup_refresh kpi_revenue_per_minute kpi_tower_load kpi_top_bundles"
    " kpi_revenue_by_province kpi_arpu kpi_top_data_users kpi_latest_dlq kpi_tps"
    " quality_report audit_duplicates metric_rate alert_lag"
).split()


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def _load_seconds(spark: SparkSession, sf_dir: str) -> tuple[float, float, int]:
    """One batch of the whole raw stream, laid out like broker partitions, into a fresh mart; and a second one
    of a tenth of the records, all of them repeated, into the mart that holds them."""
    root = tempfile.mkdtemp(prefix="signalmart-bench-")
    model = Model(spark, sf_dir)
    model.raw.repartition(24, "topic", "partition").write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    store = load.open_store(spark, f"{root}/mart")
    store.overwrite("dim_tower", model.towers)
    store.overwrite("dim_bundle", model.bundles)
    store.overwrite("dim_date", model.calendar)
    sink = FileSink(f"{root}/dead-letters")
    as_of = model.source("events").agg({"ts": "max"}).first()[0]
    first = _timed(lambda: load.run_batch(raw, store, 0, sink, as_of=as_of))
    again = raw.where("offset % 10 = 0")
    return first, _timed(lambda: load.run_batch(again, store, 1, sink, as_of=as_of)), raw.count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.start(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("signalmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = registry.QUERIES[name]
        _drain(query(spark, sf_dir))
        seconds[name] = _timed(lambda: _drain(query(spark, sf_dir)))
    # All batches of the mart that rollup_refresh and others read, written and merged anew.
    history._built.clear()
    seconds["history_write"] = _timed(lambda: history.mart(Model(spark, sf_dir)))
    seconds["load_batch"], seconds["load_next_batch"], n_records = _load_seconds(spark, sf_dir)
    load_seconds = seconds["load_batch"]
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "load_records_per_second": round(n_records / load_seconds),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
