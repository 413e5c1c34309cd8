"""Operators over the tables: current rows, deletes, statistics, projections. Lazy DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelark.config import POST
from firelark.functions import exprs as X
from firelark.schemas import KEYS


def latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the greatest version of each key; ties go to the greatest hash of the row. One shuffle with a partial
    aggregate, no sort of a key's rows."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*version, F.xxhash64(*df.columns))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def current(df: DataFrame, table: str) -> DataFrame:
    keys, version, _, _ = KEYS[table]
    return latest(df, keys, version)


def backlinks_current(df: DataFrame, by_path: bool = False) -> DataFrame:
    """Edges by (ref, collection, source_uri), of which the last in the record stays; by_path: by (ref, source_uri, path), which keeps an
    edge for each path."""
    return latest(df, ["ref", "source_uri", "path"], ["indexed_at", "collection", "ordinal"]) if by_path else current(df, "backlinks")


def snapshot(pending: DataFrame, table: str, cutoff: Column) -> DataFrame:
    """Distinct URIs to delete from a table, as of the cutoff."""
    return pending.where((F.col("table_name") == table) & (F.col("created_at") <= cutoff)).select("uri").distinct()


def survivors(df: DataFrame, uris: DataFrame, on: str = "uri") -> DataFrame:
    return df.join(uris.select(F.col("uri").alias("_gone")), F.col(on) == F.col("_gone"), "left_anti")


def matched(df: DataFrame, uris: DataFrame, on: str = "uri") -> DataFrame:
    return df.join(uris.select(F.col("uri").alias("_gone")), F.col(on) == F.col("_gone"), "left_semi")


def unprocessed(pending: DataFrame, table: str, cutoff: Column) -> DataFrame:
    """Tombstones left once those of a table up to the cutoff are applied."""
    return pending.where(~((F.col("table_name") == table) & (F.col("created_at") <= cutoff)))


def stats_partial(records: DataFrame) -> DataFrame:
    """Counts of inserts by collection, of one batch."""
    return records.groupBy("collection").agg(F.count(F.lit(1)).alias("record_count"))


def stats_merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("collection").agg(F.sum("record_count").alias("record_count"))


def posts(records: DataFrame, collection: str = POST) -> DataFrame:
    p = records.where(F.col("collection") == collection)
    p = p.withColumn("v", F.try_parse_json("record"))  # a column of its own, so a record is parsed once
    return p.select("uri", "did", "rkey", X.seconds(F.col("created_at")).alias("created_at"), X.seconds(F.col("indexed_at")).alias("indexed_at"), X.variant_string(F.col("v"), "$.text").alias("text"), X.variant_string(F.col("v"), "$.reply.parent.uri").alias("reply_parent"))


def label_rows(records: DataFrame, collection: str = POST) -> DataFrame:
    return records.where(F.col("collection") == collection).select("uri", "did", F.explode(X.self_labels(F.col("record"))).alias("label"))


def backlink_rows(records: DataFrame) -> DataFrame:
    """Edges of records that carry links, with their place in the record; the column of a record's own URI becomes source_uri."""
    e = records.select(F.posexplode("links").alias("ordinal", "l"), "collection", F.col("uri").alias("source_uri"), F.col("did").alias("source_did"), "created_at", "indexed_at")
    return e.select("l.ref", "l.ref_type", "collection", "l.path", "source_uri", "source_did", "created_at", "indexed_at", "ordinal")


def recent(df: DataFrame, n: int) -> DataFrame:
    """The n rows of the latest created_at, then uri: a top-k without a global sort."""
    return df.orderBy(F.desc("created_at"), F.desc("uri")).limit(n)


def with_month(df: DataFrame, table: str) -> DataFrame:
    at = F.col("created_at")
    return df.withColumn("month_key", (X.record_month(at) if table == "records" else X.plain_month(at)).cast("int"))


def gated(ops: DataFrame, jobs: DataFrame) -> DataFrame:
    """Operations without the creates and updates of repositories whose backfill is queued or under way. Jobs are a row a
    repository and are joined by key; Spark broadcasts them if they are small."""
    busy = jobs.where(F.col("state").isin("enqueued", "in_progress")).select(F.col("did").alias("_busy")).distinct()
    return ops.join(busy, F.col("did") == F.col("_busy"), "left").where(F.col("_busy").isNull() | (F.col("action") == "delete")).drop("_busy")


def load_cursor(cursors: DataFrame, name: str = "firehose") -> int:
    """Where a source goes on: the newest cursor of a name, 0 if there is none; one that is no whole number is an error."""
    text = cursors.where(F.col("name") == name).select(F.col("cursor").cast("string").alias("cursor"), "updated_at")
    row = text.agg(F.max_by("cursor", F.struct("updated_at", "cursor")).alias("c")).first()
    if row["c"] is None:
        return 0
    if not row["c"].strip().isdigit():
        raise ValueError(f"the cursor {name!r} is no number: {row['c']!r}")
    return int(row["c"])


def cursor(cursors: DataFrame, name: str = "firehose") -> DataFrame:
    return latest(cursors.where(F.col("name") == name), ["name"], ["updated_at", "cursor"]).select("cursor").limit(1)
