"""From events or repository snapshots to the rows of every table: one plan for batch and stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelark.config import POST
from firelark.functions import cbor
from firelark.functions import exprs as X
from firelark.operators import tables as T


def ops_of_events(events: DataFrame) -> DataFrame:
    """(did, path, action, cid, bytes, seq) of commits; other kinds of events are only counted."""
    commits = events.where(F.col("kind") == "commit")
    return commits.select("seq", F.col("repo").alias("did"), F.explode("ops").alias("o")).select("did", "o.path", "o.action", "o.cid", "o.bytes", "seq")


def ops_of_repos(repos: DataFrame, shard: int = 0, of: int = 1) -> DataFrame:
    """The same of repository snapshots: no cid, sequence 0; only repositories of the shard."""
    return repos.where(X.in_shard(F.col("did"), shard, of)).select("did", "path", "action", F.lit("").alias("cid"), "bytes", F.lit(0).cast("long").alias("seq"))


def records_of(ops: DataFrame, now: Column) -> DataFrame:
    """Rows of records, with links, of creates and updates. Operations without a slash in the path, a cid or bytes are skipped."""
    rkey = X.rkey_of(F.col("path"))
    good = ops.where(F.col("action").isin("create", "update") & F.col("path").contains("/") & F.col("cid").isNotNull() & F.col("bytes").isNotNull() & (F.octet_length("bytes") > 0))
    d = cbor.decoded(good.select("did", "path", "bytes", "seq"))
    d = d.withColumn("rkey", rkey)
    return d.select(X.uri_of(F.col("did"), F.col("path")).alias("uri"), "did", X.collection_of(F.col("path")).alias("collection"), "rkey", "record", X.created_at(F.col("created_text"), F.col("rkey"), now).alias("created_at"), X.millis(now).alias("indexed_at"), "seq", "links")


def tombstones_of(ops: DataFrame, now: Column) -> DataFrame:
    """Two tombstones, one a table, of each delete."""
    gone = ops.where((F.col("action") == "delete") & F.col("path").contains("/"))
    return gone.select(X.uri_of(F.col("did"), F.col("path")).alias("uri"), F.explode(F.array(F.lit("records"), F.lit("backlinks"))).alias("table_name"), X.seconds(now).alias("created_at"))


@dataclass
class Batch:
    """Rows for each table of one batch of operations; records carries its links until it is written."""

    records: DataFrame
    tombstones: DataFrame
    collection: str = POST

    def tables(self) -> dict[str, DataFrame]:
        r = self.records
        return {
            "records": T.with_month(r.drop("links"), "records"),
            "backlinks": T.with_month(T.backlink_rows(r), "backlinks"),
            "pending_deletes": self.tombstones,
            "collection_stats": T.stats_partial(r),
            "posts_by_time_data": T.with_month(T.posts(r, self.collection), "posts_by_time_data"),
            "labels": T.label_rows(r, self.collection),
        }


def batch_of(ops: DataFrame, now: Column, jobs: DataFrame | None = None, collection: str = POST) -> Batch:
    ops = T.gated(ops, jobs) if jobs is not None else ops
    return Batch(records_of(ops, now), tombstones_of(ops, now), collection)
