"""Event streams from files, and paged repository lists.

Events are JSON lines of {kind, seq, repo, ops: [{action, path, cid, bytes (base64)}]} in files that are put into a folder whole; Spark's own
file source reads them, in batches of files, and keeps in its checkpoint which it has read. A line that is no JSON has no kind: it is
counted and otherwise passed over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firelark.schemas import EVENTS

FILES = "*.{jsonl,txt}"
_TEXT = T.StructType([f if f.name != "ops" else T.StructField("ops", T.ArrayType(T.StructType([T.StructField(x.name, T.StringType()) for x in f.dataType.elementType]))) for f in EVENTS])


def _events(lines: DataFrame, after: int) -> DataFrame:
    bytes_ = lambda o: F.struct(*(F.try_to_binary(o[f], F.lit("base64")).alias(f) if f == "bytes" else o[f].alias(f) for f in ("action", "path", "cid", "bytes")))
    e = lines.withColumn("ops", F.transform("ops", bytes_))
    return e.where(F.col("seq").isNull() | (F.col("seq") > after)) if after > 0 else e


def events(spark: SparkSession, folder: str, after: int = 0) -> DataFrame:
    """All events of a folder, those after a sequence number if it is above 0."""
    return _events(spark.read.schema(_TEXT).json(folder, pathGlobFilter=FILES), after)


def event_stream(spark: SparkSession, folder: str, most: int = 64, after: int = 0) -> DataFrame:
    """The same as a stream of at most `most` files a batch, so a slow sink holds the source back. after: the cursor to go on from, for a
    query without a checkpoint of its own."""
    lines = spark.readStream.schema(_TEXT).option("maxFilesPerTrigger", str(most)).option("pathGlobFilter", FILES).json(folder)
    return _events(lines, after)


def write_events(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Events as files that the sources read."""
    text = lambda o: F.struct(*(F.base64(o[f]).alias(f) if f == "bytes" else o[f].alias(f) for f in ("action", "path", "cid", "bytes")))
    lines = df.withColumn("ops", F.transform("ops", text)).select(F.to_json(F.struct("kind", "seq", "repo", "ops")).alias("value"))
    lines.write.mode(mode).option("lineSep", "\n").text(folder)


class RepoList:
    """A paged list of repositories with a durable checkpoint: fetch(cursor, size) -> (dids, next cursor or ''). Pages are stored as they come;
    a restart goes on from the last stored page, and a finished list is not fetched again."""

    def __init__(self, spark: SparkSession, state: str, fetch, name: str = "default", size: int = 1000):
        self.spark, self.state, self.fetch, self.name, self.size = spark, state.rstrip("/"), fetch, name, size

    def _progress(self):
        path = f"{self.state}/progress"
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return "", 0, False
        rows = self.spark.read.json(path, schema="name string, cursor string, total long, completed boolean, page long")
        last = rows.where(F.col("name") == self.name).agg(F.max_by(F.struct("cursor", "total", "completed"), "page").alias("l")).first()["l"]
        return (last["cursor"], last["total"], last["completed"]) if last else ("", 0, False)

    def pump(self, pages: int | None = None) -> int:
        """Fetches up to some pages (all: None); returns the number of repositories listed so far."""
        at, total, done = self._progress()
        page = 0
        while not done and (pages is None or page < pages):
            dids, at = self.fetch(at, self.size)
            total, page, done = total + len(dids), page + 1, not at or not dids
            if dids:
                self.spark.createDataFrame([(d,) for d in dids], "did string").coalesce(1).write.mode("append").parquet(f"{self.state}/repos")
            self.spark.createDataFrame([(self.name, at, total, done, total * 2 + done)], "name string, cursor string, total long, completed boolean, page long").coalesce(1).write.mode("append").json(f"{self.state}/progress")
        return total

    def repos(self) -> DataFrame:
        """Listed repositories, each once."""
        return self.spark.read.parquet(f"{self.state}/repos").dropDuplicates(["did"])
