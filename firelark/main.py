"""Command line: run the stream, a backfill or a compaction over a warehouse folder."""

from __future__ import annotations

import argparse
import time
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from firelark.config import Settings, parse_shard
from firelark.operators.storage import Warehouse
from firelark.operators import tables
from firelark.sources import replay
from firelark.streaming import metrics, pipeline


def session(name: str = "firelark") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("command", choices=["stream", "backfill", "compact", "ddl"])
    p.add_argument("--input", default="")
    p.add_argument("--batch-id", type=int, default=1 << 40)
    base = Settings.from_env()
    for f in fields(Settings):
        flag = "--" + f.name.replace("_", "-")
        if f.type == "bool":
            p.add_argument(flag, action="store_true", default=getattr(base, f.name))
        else:
            p.add_argument(flag, type=int if f.type == "int" else str, default=getattr(base, f.name))
    a = p.parse_args(argv)
    s = Settings(**{f.name: getattr(a, f.name) for f in fields(Settings)})
    spark = session()
    house = Warehouse(spark, s.warehouse, s.rows_per_file)
    house.create()
    if a.command == "stream" and not s.disable_stream:
        stream(spark, house, a.input, s)
    elif a.command == "backfill" and not s.disable_backfill:
        print(pipeline.backfill(house, spark.read.parquet(a.input), a.batch_id, parse_shard(s.shard), s))
    elif a.command == "compact":
        print(house.maintain(cutoff(), next_number(), s.compact_after_files))
    elif a.command == "ddl":
        print(";\n".join(house.ddl()))


def cutoff():
    return F.date_trunc("SECOND", F.current_timestamp())


def next_number() -> int:
    """A number for compacted folders: beyond those of batches, and growing."""
    return (1 << 41) + int(time.time() * 1000)


def stream(spark: SparkSession, house: Warehouse, folder: str, s: Settings) -> bool:
    """The stream with metrics, the job states of the moment, and a compaction between two batches every compact_seconds."""
    m = metrics.Metrics()
    spark.streams.addListener(m)
    last = [time.monotonic()]

    def done(_, counts: dict) -> None:
        m.add(counts)
        if s.compact_seconds and time.monotonic() - last[0] > s.compact_seconds:
            applied = house.maintain(cutoff(), next_number(), s.compact_after_files)
            m.add({"applied": sum(applied.values()) if applied else 0})
            last[0] = time.monotonic()

    def begin():
        after = tables.load_cursor(house.read("cursors")) if s.from_cursor else 0
        events = replay.event_stream(spark, folder, s.max_files_per_trigger, after)
        return pipeline.start(house, events, s, lambda: house.current("jobs"), done=done)

    try:
        return pipeline.run(begin, s.shutdown_seconds, s.retry_seconds)
    finally:
        spark.streams.removeListener(m)
        print(dict(m.values))


if __name__ == "__main__":
    main()
