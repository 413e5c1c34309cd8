"""The stream: events to all tables, a batch at a time, the cursor last."""

from __future__ import annotations

import signal
import threading
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firelark.config import Settings
from firelark.operators.storage import Warehouse
from firelark.plans import ingest
from firelark.schemas import CURSORS, JOBS


def now_of(spark: SparkSession):
    """The time of a batch as a literal: every row and every table of the batch gets the same."""
    return F.lit(spark.sql("SELECT current_timestamp()").first()[0])


def _write(warehouse: Warehouse, batch: ingest.Batch, batch_id: int) -> dict:
    batch.records = batch.records.persist()  # decoded once for five tables; spills to disk, lineage stays
    counts = {}
    try:
        for table, rows in batch.tables().items():
            counts[table] = warehouse.write_counted(table, rows, batch_id)
    finally:
        batch.records.unpersist()
    return {"records": counts["records"], "backlinks": counts["backlinks"], "deletes": counts["pending_deletes"] // 2}


def write_batch(warehouse: Warehouse, events: DataFrame, batch_id: int, settings: Settings | None = None, jobs: DataFrame | None = None, name: str = "firehose") -> dict:
    """Writes one batch under its number and then its cursor, so a cursor never leads the data. Returns the counts: of events, of operations
    read, written and skipped (read = records + deletes + skipped), of rows by table."""
    s, spark = settings or Settings(), warehouse.spark
    seen = Observation(f"events_{batch_id}")
    # of all events, decided before any filter
    ops = F.when(F.col("kind") == "commit", F.size(F.coalesce("ops", F.array()))).otherwise(0)
    events = events.observe(seen, F.count(F.lit(1)).alias("events"), F.max("seq").alias("seq"), F.sum(ops).alias("read"))
    batch = ingest.batch_of(ingest.ops_of_events(events), now_of(spark), jobs if s.gate_backfilling else None, s.post_collection)
    counts = _write(warehouse, batch, batch_id)
    got = seen.get
    counts |= {"events": got["events"], "seq": got["seq"], "read": got["read"] or 0}
    counts["skipped"] = counts["read"] - counts["records"] - counts["deletes"]
    if counts["seq"] is not None:
        row = spark.createDataFrame([(name, counts["seq"], None)], CURSORS).withColumn("updated_at", F.date_trunc("MILLISECOND", F.current_timestamp()))
        warehouse.write("cursors", row, batch_id)
    return counts


def backfill(warehouse: Warehouse, repos: DataFrame, batch_id: int, shard: tuple[int, int] = (0, 1), settings: Settings | None = None) -> dict:
    """Repository snapshots through the same plan, under a batch number of their own. Their jobs are in progress while they are written
    and complete afterwards."""
    s = settings or Settings()
    ops = ingest.ops_of_repos(repos, *shard)
    set_jobs(warehouse, ops.select("did").distinct(), "in_progress", 2 * batch_id)
    counts = _write(warehouse, ingest.batch_of(ops, now_of(warehouse.spark), None, s.post_collection), batch_id)
    set_jobs(warehouse, ops.select("did").distinct(), "complete", 2 * batch_id + 1)
    return counts | {"backfilled": counts["records"]}


def set_jobs(warehouse: Warehouse, dids: DataFrame, state: str, batch_id: int) -> None:
    """Notes a state of repositories (enqueued, in_progress, complete); the newest of a repository counts."""
    if state not in ("enqueued", "in_progress", "complete"):
        raise ValueError(f"no such state: {state!r}")
    warehouse.write("jobs", dids.select("did", F.lit(state).alias("state"), F.date_trunc("MILLISECOND", F.current_timestamp()).alias("updated_at"), F.lit(batch_id).cast("long").alias("step")).select(*JOBS.names), batch_id)


def start(warehouse: Warehouse, stream: DataFrame, settings: Settings, jobs=None, once: bool = False, done=None):
    """Starts the query. jobs: a table, or a function that reads it anew for each batch. once: what there is, then stop. done(batch_id, counts) is
    called after each batch. The query's `asked` event, if set, lets no further batch begin."""
    asked = threading.Event()

    def sink(df: DataFrame, batch_id: int) -> None:
        if asked.is_set():
            raise Stopped("asked to stop; the batch is read again at the next start")
        counts = write_batch(warehouse, df, batch_id, settings, jobs() if callable(jobs) else jobs)
        if done:
            done(batch_id, counts)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", settings.checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{settings.trigger_seconds} seconds")
    query = w.start()
    query.asked = asked
    return query


class Stopped(Exception):
    pass


def drain(query, seconds: float = 30) -> bool:
    """Ends a query: no batch begins any more, the one in hand is finished and its offsets are committed, if that takes no longer than some
    seconds. Whether it was."""
    query.asked.set()
    until = time.monotonic() + seconds
    # between two triggers a query can be stopped; within one, its next batch is refused, which ends it
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    finished = not query.isActive or not query.status["isTriggerActive"]
    query.stop()
    return finished


def run(begin, seconds: float = 30, wait: float = 2.0) -> bool:
    """Keeps a query up: begin() starts it, again from its checkpoint, `wait` seconds after a failure. The first interrupt ends it after the
    batch in hand, within some seconds; the second at once. Whether all was drained."""
    asked = threading.Event()

    def stop(*_):
        if asked.is_set():
            raise SystemExit(1)
        asked.set()

    before = {s: signal.signal(s, stop) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        while True:
            query = begin()
            try:
                while not asked.is_set() and not query.awaitTermination(1):
                    pass
                return drain(query, seconds) if query.isActive else True
            except Exception:
                if asked.is_set():
                    return False
                asked.wait(wait)
    finally:
        for s, h in before.items():
            signal.signal(s, h)
