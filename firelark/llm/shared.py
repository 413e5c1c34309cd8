"""Folders that every executor sees, written intermediate tables, and fixed-size Bloom filters."""

from __future__ import annotations

import uuid
import weakref

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelark.deploy import shared_dir

_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()  # folders of written tables
BLOOM_BITS = 1 << 26  # 8 MB whatever the input: past its capacity it only lets more rows through


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/firelark/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for t in tables:
        if path := _PATHS.pop(t, None):
            delete(t.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


MAX_IDS = 1_000_000  # ids of 8 bytes that may be broadcast


def few(ids: DataFrame) -> bool:
    return ids.limit(MAX_IDS + 1).count() <= MAX_IDS


def split_by_ids(df: DataFrame, ids: DataFrame, col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows of df whose col may be in ids, the others), in JVM functions, without moving df. ids: one distinct column, written. A bitmap
    of hashes is broadcast: 2 ** 20 words of 64 bits at most, whatever the input. Rows without an id are of the second part."""
    i, at, bits, found = (fresh(df, x) for x in ("id", "at", "bits", "found"))
    key = F.col(col).cast(ids.schema[0].dataType)
    word = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20))
    bit = lambda c: F.pmod(F.xxhash64(c, F.lit(7)), F.lit(64)).cast("int")
    ids = ids.toDF(i)
    words = written(ids.groupBy(word(F.col(i)).alias(at)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(i)))).alias(bits)), "bitmap")
    tagged = df.join(F.broadcast(words), word(key) == F.col(at), "left")
    tagged = tagged.withColumn(found, F.coalesce(F.call_function("bit_get", F.col(bits), bit(key)) == 1, F.lit(False)) & F.col(col).isNotNull())
    return tagged.where(F.col(found)).select(*df.columns), tagged.where(~F.col(found)).select(*df.columns)


def without_ids(df: DataFrame, ids: DataFrame, col: str = "doc_id") -> DataFrame:
    """Rows of df whose col is not in ids (one distinct column, written). Up to MAX_IDS ids are broadcast; beyond, only rows that the bitmap
    of split_by_ids does not clear are moved."""
    i = fresh(df, "id")
    gone = lambda x, y: x.join(y, F.col(col) == F.col(i), "left_anti")
    if few(ids):
        return gone(df, F.broadcast(ids.toDF(i)))
    maybe, sure = split_by_ids(df, ids, col)
    return sure.unionByName(gone(maybe, ids.toDF(i)))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch than Spark's 10,000, so that a Python worker holds a few MB of texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bloom_slots(ids: np.ndarray, bits: int = BLOOM_BITS) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(ids.astype(np.int64).view(np.uint64))
    return (h % np.uint64(bits)).astype(np.int64), ((h >> np.uint64(32)) * np.uint64(0x9E3779B1) % np.uint64(bits)).astype(np.int64)


def bloom(df: DataFrame, col: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bitmap (uint8, bits // 8 bytes at most on the driver) of a column of longs. Used only to drop rows
    that cannot join, ahead of an exact join; a full bitmap drops nothing and stays right."""

    def slots(batches):
        import pyarrow as pa

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            s = np.unique(np.concatenate(bloom_slots(ids, bits)))
            word, first = np.unique(s >> 6, return_index=True)
            ones = np.uint64(1) << (s & 63).astype(np.uint64)
            v = np.bitwise_or.reduceat(ones, first) if len(first) else ones
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(v.view(np.int64))], names=["word", "v"])

    rows = df.select(F.col(col).cast("long").alias("id")).where("id is not null").mapInArrow(slots, "word long, v long")
    got = rows.groupBy("word").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got["word"].to_numpy()] = got["v"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def in_bloom(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    bits = len(bitmap) * 8
    words = bitmap.view(np.uint64)
    a, b = bloom_slots(ids, bits)
    one = np.uint64(1)
    hit = lambda s: (words[s >> 6] >> (s & 63).astype(np.uint64)) & one
    return (hit(a) & hit(b)).astype(bool)


def keep_in_bloom(df: DataFrame, col: str, bitmap: np.ndarray) -> DataFrame:
    """Rows of df whose column of longs may be in the bitmap."""
    held = df.sparkSession.sparkContext.broadcast(bitmap)
    at = df.columns.index(col)

    def keep(batches):
        import pyarrow as pa

        for b in batches:
            ids = b.column(at)
            mask = in_bloom(held.value, ids.fill_null(0).to_numpy(zero_copy_only=False))
            if mask.any():
                yield b.filter(pa.array(mask))

    return df.mapInArrow(keep, df.schema)


def groups(batches, keys: list[str]):
    """Whole groups (pandas) of an iterator of pandas batches that is sorted by keys. Holds one group and one batch."""
    import pandas as pd

    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pd.concat([rest, pdf], ignore_index=True) if rest is not None else pdf
        change = np.zeros(len(pdf), bool)
        for k in keys:
            v = pdf[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        last = 0
        for c in cuts:
            yield pdf.iloc[last:c]
            last = c
        rest = pdf.iloc[last:]
    if rest is not None and len(rest):
        yield rest


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): (id, comp) with comp the smallest id, for every id of an edge.
    Alternating large-star and small-star steps, so O(log^2 n) rounds, each a few aggregates; every round is
    written to the shared folder. A round groups by node with min(), never by collecting neighbours."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the joined sides are written first, so that adaptive execution can split the edges of a hub
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = written(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        discard(e, low)
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = written(small.where("a <> b").distinct(), "edges")
        discard(large, low)
        # done when all components are stars: one edge a node, and no centre that is a leaf
        one = e.agg(F.count(F.lit(1)) - F.countDistinct("a")).first()[0] == 0
        if one and e.join(e.select(F.col("a").alias("leaf")), F.col("b") == F.col("leaf"), "left_semi").limit(1).count() == 0:
            break
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
