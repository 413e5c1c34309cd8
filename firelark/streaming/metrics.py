"""Counters of the pipeline from batch counts, and rates from streaming progress."""

from __future__ import annotations

import logging
from collections import Counter

from pyspark.sql.streaming import StreamingQueryListener

# The names of the instruments.
NAMES = ("records.written", "records.failed", "batch.size", "batch.flushes", "backlinks.written", "deletes.queued", "deletes.processed", "firehose.events", "firehose.seq", "backfill.records")
SIZES = (100, 1_000, 10_000, 100_000, 1_000_000, 10_000_000)  # upper bounds of the histogram's classes
LOG = logging.getLogger("firelark")


class Metrics(StreamingQueryListener):
    """values: counters, and of the gauge firehose.seq its last value; sizes: batches by the bound of their size; rate: rows a second
    of the last trigger."""

    def __init__(self):
        self.values: Counter = Counter(dict.fromkeys(NAMES, 0))
        self.sizes: Counter = Counter()
        self.rate = 0.0

    def add(self, counts: dict) -> None:
        """Counts of a batch, as write_batch, backfill and compact give them."""
        for name, key in (("firehose.events", "events"), ("records.written", "records"), ("records.failed", "failed"), ("backlinks.written", "backlinks"), ("deletes.queued", "deletes"), ("deletes.processed", "applied"), ("backfill.records", "backfilled")):
            self.values[name] += counts.get(key) or 0
        self.values["firehose.seq"] = max(self.values["firehose.seq"], counts.get("seq") or 0)
        if "records" in counts:
            n = counts["records"] or 0
            self.values["batch.flushes"] += 1
            self.values["batch.size"] += n
            self.sizes[next((s for s in SIZES if n <= s), float("inf"))] += 1

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rate = event.progress.processedRowsPerSecond
        LOG.info("batch %d: %.0f rows a second", event.progress.batchId, self.rate)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.values["records.failed"] += 1
