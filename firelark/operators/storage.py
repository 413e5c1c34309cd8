"""Parquet tables of the warehouse: layout, idempotent batch writes, compaction by a manifest."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firelark.operators import tables as ops
from firelark.schemas import KEYS, TABLES

KEPT = 1000  # dropped batches whose names the manifest keeps: a replay can repeat only the last ones


def schema_of(table: str) -> T.StructType:
    extra = [T.StructField("month_key", T.IntegerType())] if KEYS[table][3] else []
    return T.StructType([*TABLES[table].fields, *extra, T.StructField("batch_id", T.LongType())])


def batch_of(folder: str) -> int:
    return int(folder.partition("/")[0].removeprefix("batch_id="))


class Warehouse:
    """Tables under one folder: <root>/<table>/batch_id=<n>[/month_key=<m>]/part files. A batch that is written again replaces its
    own folder, so a replay after a failure adds nothing twice.

    Compaction writes folders of its own beside these, under <root>/_compacted/<table>, and then commits by renaming one small file,
    _manifest/<version>.json, which says of all tables which compacted folders count and which folders don't any more. Before the rename
    readers see the old rows, after it the new ones; what no version names is left over from a failure and deleted by the next
    compaction, and folders are deleted one compaction after they were dropped, so that readers can finish. One compaction runs at a
    time: two that start from the same version can't both commit."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = 5_000_000):
        self.spark, self.root, self.rows_per_file = spark, root.rstrip("/"), rows_per_file

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _names(self, path: str, prefix: str = "") -> list[str]:
        fs, p = self._fs(path)
        return sorted(n for f in (fs.listStatus(p) if fs.exists(p) else ()) if (n := f.getPath().getName()).startswith(prefix))

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def create(self) -> None:
        """Makes the folders of all tables; does nothing to those there."""
        for t in TABLES:
            fs, p = self._fs(self.path(t))
            fs.mkdirs(p)

    def manifest(self) -> dict:
        """The last committed version: dropped and compacted folders by table."""
        found = [n for n in self._names(f"{self.root}/_manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not found:
            return {"version": 0, "dropped": {}, "compacted": {}}
        fs, p = self._fs(f"{self.root}/_manifest/{found[-1]}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        """Makes a version the last one: a file that is renamed into place, which fails if the version is there already."""
        aside, name = f"{self.root}/_manifest/.{uuid.uuid4().hex}", f"{self.root}/_manifest/{manifest['version']:012d}.json"
        fs, a = self._fs(aside)
        fs.mkdirs(a.getParent())
        out = fs.create(a)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        _, n = self._fs(name)
        if fs.exists(n) or not fs.rename(a, n):
            fs.delete(a, False)
            raise OSError(f"version {manifest['version']} was committed by another compaction")

    def _folders(self, base: str, table: str) -> list[str]:
        """Folders of rows under base: batch_id=<n>, or those of its months."""
        batches = self._names(base, "batch_id=")
        return [f"{b}/{m}" for b in batches for m in self._names(f"{base}/{b}", "month_key=")] if KEYS[table][3] else batches

    def live(self, table: str, manifest: dict | None = None) -> dict[str, list[str]]:
        """The folders that count, by the folder that they are in."""
        m = manifest or self.manifest()
        dropped = set(m["dropped"].get(table, ()))
        compacted = f"{self.root}/_compacted/{table}"
        return {
            self.path(table): [f for f in self._folders(self.path(table), table) if f not in dropped],
            compacted: [f for f in m["compacted"].get(table, ()) if self.exists(f"{compacted}/{f}")],
        }

    def _rows(self, table: str, live: dict[str, list[str]]) -> DataFrame:
        schema = schema_of(table)
        parts = [self.spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in folders)).select(*schema.names) for base, folders in live.items() if folders]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, table: str) -> DataFrame:
        return self._rows(table, self.live(table))

    def files(self, table: str) -> int:
        """Live data files of a table, for the decision to compact."""
        n = 0
        for base, folders in self.live(table).items():
            n += sum(x.endswith(".parquet") for f in folders for x in self._names(f"{base}/{f}"))
        return n

    def write(self, table: str, df: DataFrame, batch_id: int, folder: str | None = None) -> None:
        """Sorted by the table's order within files; rows of a month and key range go to one task."""
        _, _, order, month = KEYS[table]
        w = df
        if month:
            # by month and first key, so that a month with most rows is shared out
            w = w.repartition(month, F.pmod(F.xxhash64(*order), F.lit(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 4)))).sortWithinPartitions(month, *order)
        else:
            w = w.sortWithinPartitions(*order)
        out = w.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file)
        for c in ("did", "collection", "source_did"):
            if c in df.columns:
                out = out.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(min(1_000_000, self.rows_per_file)))
        if month:
            out = out.partitionBy(month)
        out.parquet(folder or f"{self.path(table)}/batch_id={batch_id}")

    def write_counted(self, table: str, df: DataFrame, batch_id: int) -> int:
        """Writes a batch; returns its rows, which the files' footers tell."""
        self.write(table, df, batch_id)
        return self.spark.read.schema(schema_of(table)).parquet(f"{self.path(table)}/batch_id={batch_id}").count()

    def current(self, table: str) -> DataFrame:
        """Current rows with pending deletes applied: merge on read, until compaction has applied them."""
        rows = self.read(table).drop("batch_id", "month_key")
        if table in ("records", "backlinks"):
            uris = ops.snapshot(self.read("pending_deletes"), table, F.lit("9999-01-01").cast("timestamp"))
            rows = ops.survivors(rows, uris, "uri" if table == "records" else "source_uri")
        return ops.current(rows, table)

    def compact(self, cutoff: Column, batch_id: int, deduplicate: bool = True) -> dict[str, int]:
        """Applies one snapshot of tombstones to records and backlinks, keeps the current row of each key, and drops the tombstones that were
        applied. Only months with a deleted or superseded row are rewritten. Returns the number of tombstones applied to each table. batch_id:
        the number of the compacted folders, greater than that of every batch."""
        before = self.manifest()
        self._sweep(before)
        seen = {t: self.live(t, before) for t in ("records", "backlinks", "pending_deletes")}
        pending = self._rows("pending_deletes", seen["pending_deletes"]).drop("batch_id")
        after = {k: {t: list(v) for t, v in before[k].items()} for k in ("dropped", "compacted")}
        done: dict[str, int] = {}
        for table, on in (("records", "uri"), ("backlinks", "source_uri")):
            uris = ops.snapshot(pending, table, cutoff)
            done[table] = pending.where((F.col("table_name") == table) & (F.col("created_at") <= cutoff)).count()
            rows = self._rows(table, seen[table])
            months = self._touched(rows, table, uris, on, deduplicate)
            part = {base: [f for f in folders if int(f.rpartition("month_key=")[2]) in months] for base, folders in seen[table].items()}
            kept = ops.survivors(self._rows(table, part).drop("batch_id"), uris, on)
            if deduplicate:
                # all rows of a superseded key lie in rewritten months
                kept = ops.with_month(ops.current(kept.drop("month_key"), table), table)
            self._replace(table, kept, part, batch_id, after)
        left = pending
        for table in ("records", "backlinks"):
            left = ops.unprocessed(left, table, cutoff)
        self._replace("pending_deletes", left, seen["pending_deletes"], batch_id, after)
        self._commit({"version": before["version"] + 1, **after})
        return done

    def _touched(self, rows: DataFrame, table: str, uris: DataFrame, on: str, deduplicate: bool) -> set[int]:
        """Months with a row that is deleted or, of its key, not the only one."""
        keys = KEYS[table][0]
        months = ops.matched(rows, uris, on).select("month_key").distinct()
        if deduplicate:
            twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.collect_set("month_key").alias("m")).where("n > 1")
            months = months.unionByName(twice.select(F.explode("m").alias("month_key")).distinct()).distinct()
        return {r[0] for r in months.collect()}  # a row a month

    def _replace(self, table: str, rows: DataFrame, old: dict[str, list[str]], batch_id: int, after: dict) -> None:
        """Writes rows aside and notes in the next manifest that they take the place of the old folders."""
        base = f"{self.root}/_compacted/{table}"
        if not any(old.values()):
            return
        self.write(table, rows, batch_id, f"{base}/batch_id={batch_id}")
        after["dropped"][table] = [*after["dropped"].get(table, ()), *old[self.path(table)]]
        new = [f for f in self._folders(base, table) if batch_of(f) == batch_id]
        after["compacted"][table] = sorted({*after["compacted"].get(table, ()), *new} - set(old[base]))

    def _sweep(self, m: dict) -> None:
        """Deletes what no reader of the last version needs, and forgets dropped folders that are long gone."""
        for table in TABLES:
            base = f"{self.root}/_compacted/{table}"
            known = set(m["compacted"].get(table, ()))
            for f in self._folders(base, table):
                if f not in known:
                    self._delete(f"{base}/{f}")
            dropped = m["dropped"].get(table, [])
            for f in dropped:
                self._delete(f"{self.path(table)}/{f}")
            if dropped:
                last = sorted({batch_of(f) for f in dropped})[-KEPT:]
                m["dropped"][table] = [f for f in dropped if batch_of(f) in last]

    def maintain(self, cutoff: Column, batch_id: int, after_files: int, **options) -> dict[str, int] | None:
        """Compacts if records or backlinks have more than after_files files, or a tombstone waits; None: there was nothing to do."""
        due = any(self.files(t) > after_files for t in ("records", "backlinks"))
        if not due and not self.read("pending_deletes").where(F.col("created_at") <= cutoff).limit(1).count():
            return None
        return self.compact(cutoff, batch_id, **options)

    def ddl(self, database: str = "firelark") -> list[str]:
        """Statements that register the tables and their live folders in a catalog; each may be run again."""
        out = [f"CREATE DATABASE IF NOT EXISTS {database}"]
        m = self.manifest()
        for t in TABLES:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(t).fields)
            names = ["batch_id", *(["month_key"] if KEYS[t][3] else [])]
            out.append(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({cols}) USING parquet PARTITIONED BY ({', '.join(names)}) LOCATION '{self.path(t)}'")
            out += [f"ALTER TABLE {database}.{t} DROP IF EXISTS PARTITION ({f.replace('/', ', ')})" for f in m["dropped"].get(t, ())]
            out += [f"ALTER TABLE {database}.{t} ADD IF NOT EXISTS PARTITION ({f.replace('/', ', ')}) LOCATION '{base}/{f}'" for base, folders in self.live(t, m).items() for f in folders]
        return out
