"""WARC archives of pages, and capture histories by external index merge.

Method. Pages are written as gzipped WARC records, one archive a task. Each archive is then read back from end to end; its captures, sorted
by URL key (host labels reversed, then path) and timestamp, are a run, written beside it with a sparse index. Runs are merged by a
loser tree: one comparison a level for each record, memory for one block a run. More than `FAN_IN` runs are first merged
in groups. The last merge is cut into key ranges, one task each, that seek into every run by its sparse index, so
the result is globally ordered and no task sees all of it. The driver knows the runs' paths and SAMPLE keys of all of them together.

Of equal payloads (SHA-1 and length) of at least `min_bytes`, the record of the smallest page_id is a response, the others are revisits
that refer to it and hold no payload; smaller ones are all responses. The smallest page_id of a payload is found by a partial
aggregate over digests and joined back; adaptive execution splits that join where a payload is frequent.

Files go to the shared folder through pyarrow's file systems (file, s3, gcs, hdfs), under names that no attempt of a task shares; only
archives that a finished task reported are read, so lost executors and repeated tasks do no harm.

Results of capture_history: url_key, timestamp, url, page_id, payload_bytes, payload_digest, record_type, refers_to, archive, record_offset; ordered
by url_key, timestamp and page_id across partitions. Null html is an empty payload, a null url the key "". Rows without a
page_id are left out; rows of a repeated page_id are a record each, and responses all if they have the smallest page_id of their payload. Capture
times are derived from page_id (modulo ten years), ties are ordered by page_id. Very long payloads are written whole, one record at a time in memory. An empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import struct
import uuid
import zlib
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared

FAN_IN = 256
SPARSE = 64  # captures a block of a run
START, SPAN = datetime(2024, 1, 1, tzinfo=timezone.utc), 10 * 365 * 86400  # capture times: page_id seconds from START, modulo ten years
SAMPLE = 1 << 16  # keys of all runs together that the driver cuts ranges by


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host labels without www, then path and query; scheme, fragment and case of the host go."""
    rest = (url or "").partition("#")[0]
    rest = rest.partition("://")[2] or rest
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].partition(":")[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")/" + path if host or slash else ""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int, url: str, stamp: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzipped WARC record. A revisit keeps the HTTP headers, with the payload's length, and no payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {url}".replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Date: {stamp}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + z.flush()


def read_records(stream):
    """(offset, headers, block) of the records of a gzipped archive, read in pieces."""
    at, data = 0, b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                return
        z, raw, used = zlib.decompressobj(31), [], 0
        while not z.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    raise ValueError("an archive ends within a record")
            raw.append(z.decompress(data))
            used += len(data) - len(z.unused_data)
            data = z.unused_data
        raw = b"".join(raw)
        head, _, rest = raw.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines)
        block = rest[: int(headers["Content-Length"])]
        if not first.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("not a WARC record")
        yield at, headers, block
        at += used


def _open(base: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(base)
    system.create_dir(path, recursive=True)
    return system, path


def _pack(rows: list[tuple]) -> bytes:
    import pickle

    raw = zlib.compress(pickle.dumps(rows), 1)
    return struct.pack("<I", len(raw)) + raw


def _run(system, path: str, blocks, most: int) -> dict:
    """Writes blocks of sorted rows as a run: the blocks, a sparse index of their first keys, and the index's place. Returns the path and about
    `most` of the keys at most."""
    index, at = [], 0
    with system.open_output_stream(path) as out:
        for b in blocks:
            raw = _pack(b)
            index.append((b[0][:3], at))
            out.write(raw)
            at += len(raw)
        out.write(_pack(index) + struct.pack("<Q", at))
    return {"path": path, "keys": [{"a": k[0], "b": k[1], "c": k[2]} for k, _ in index[:: -(-len(index) // most)]]}


def _in_blocks(rows):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == SPARSE:
            yield held
            held = []
    if held:
        yield held


def _rows_of(system, path: str, low, high):
    """Rows of a run with low <= key < high (None: open), from the block on that the run's index gives."""
    import pickle

    with system.open_input_file(path) as f:
        end = f.size() - 8
        f.seek(end)
        end = struct.unpack("<Q", f.read(8))[0]
        if low is not None:
            f.seek(end + 4)
            index = pickle.loads(zlib.decompress(f.read(f.size() - 8 - end - 4)))
            f.seek(index[max(0, bisect.bisect_left(index, (low,)) - 1)][1])
        else:
            f.seek(0)
        while f.tell() < end:
            for r in pickle.loads(zlib.decompress(f.read(struct.unpack("<I", f.read(4))[0]))):
                if high is not None and r[:3] >= high:
                    return
                if low is None or r[:3] >= low:
                    yield r


def loser_tree(runs):
    """Merges sorted iterators: inner nodes hold the loser of their match, so the next row takes one match a level."""
    its = [iter(r) for r in runs]
    k = len(its)
    heads = [next(it, None) for it in its]
    less = lambda a, b: heads[a] is not None and (heads[b] is None or (heads[a], a) < (heads[b], b))
    tree = [-1] * max(1, k)

    def enter(leaf: int):
        node, winner = (leaf + k) // 2, leaf
        while node:
            if tree[node] < 0:
                tree[node] = winner
                return
            if less(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner

    for leaf in range(k):
        enter(leaf)
    while k and heads[tree[0]] is not None:
        i = tree[0]
        yield heads[i]
        heads[i] = next(its[i], None)
        node, winner = (i + k) // 2, i
        while node:
            if less(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> list[tuple[str, int]]:
    """Writes all pages; (file, records) of each archive. pages: page_id, url, html."""
    shared.small_batches(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html")).where("page_id is not null")
    p = p.withColumn("d", F.sha1("html"))
    first = p.where(F.length("html") >= min_bytes).groupBy("d").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    first = shared.written(first.select(F.col("d").alias("d2"), "first"), "first-captures")
    rows = p.join(first, F.col("d") == F.col("d2"), "left").select("page_id", "url", "html", "first")

    def write(batches):
        import pyarrow as pa

        name, n, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for b in batches:
            for page, url, html, one in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    system, path = _open(folder)
                    out = system.open_output_stream(f"{path}/{name}")
                stamp = (START + timedelta(seconds=page % SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")
                out.write(record(page, url, stamp, html, one if one != page else None))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n"])

    return sorted((r["file"], r["n"]) for r in rows.mapInArrow(write, "file string, n long").collect())  # a row a task


def _parallel(spark, items: list, job, schema: str) -> DataFrame:
    """job(item) -> rows, one task an item."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i in b.column(0).to_pylist():
                yield from (pa.RecordBatch.from_pylist(rows, schema=kinds) for rows in job(items[i]))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = to_arrow_schema(_parse_datatype_string(schema))
    return spark.range(0, len(items), 1, max(1, len(items))).mapInArrow(run, schema)


_FIELDS = ("url_key", "timestamp", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "record_offset")
_SCHEMA = "url_key string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long"
_INDEX = "path string, keys array<struct<a:string,b:string,c:long>>"


def read_archive(system, path: str, name: str) -> list[tuple]:
    """Captures of an archive; payloads are checked against their digests."""
    rows = []
    with system.open_input_stream(f"{path}/{name}") as f:
        for at, h, block in read_records(f):
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.decode().lower().rpartition("content-length: ")[2])
            sha = h["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = h["WARC-Type"]
            if kind == "response" and (len(payload) != size or digest(payload) != sha):
                raise ValueError(f"a damaged payload in {name}")
            page = lambda x: int(x[len("<urn:page:") : -1])
            refers = page(h["WARC-Refers-To"]) if kind == "revisit" else None
            url = h["WARC-Target-URI"]
            rows.append((url_key(url), h["WARC-Date"], page(h["WARC-Record-ID"]), url, size, sha, kind, refers, name, at))
    return rows


def capture_history(pages: DataFrame, min_bytes: int = 0, tasks: int | None = None) -> DataFrame:
    spark = pages.sparkSession
    folder = shared.new_path(spark, "warc")
    files = write_archives(pages, folder, min_bytes)
    if not files:
        return spark.createDataFrame([], _SCHEMA)
    tasks = tasks or shared.partitions(spark)
    most = max(1, SAMPLE // len(files))

    def one(file):
        system, path = _open(folder)
        rows = sorted(read_archive(system, path, file[0]), key=lambda r: r[:3])
        if len(rows) != file[1]:
            raise ValueError(f"{file[0]} has {len(rows)} records of {file[1]}")
        yield [_run(system, f"{path}/{uuid.uuid4().hex}.run", _in_blocks(rows), most)]

    unpack = lambda df: [(r["path"], [(k["a"], k["b"], k["c"]) for k in r["keys"]]) for r in df.collect()]
    runs = unpack(_parallel(spark, files, one, _INDEX))  # a path a run, SAMPLE keys in all or one a run
    keys = sorted(k for _, sample in runs for k in sample)
    paths = [p for p, _ in runs]
    while len(paths) > FAN_IN:

        def some(group):
            system, path = _open(folder)
            yield [_run(system, f"{path}/{uuid.uuid4().hex}.run", _in_blocks(loser_tree([_rows_of(system, p, None, None) for p in group])), 1)]

        groups = [paths[i : i + FAN_IN] for i in range(0, len(paths), FAN_IN)]
        paths = [p for p, _ in unpack(_parallel(spark, groups, some, _INDEX))]
    cuts = sorted({keys[len(keys) * i // tasks] for i in range(1, tasks)} if len(keys) >= tasks else ())
    ranges = list(zip([None, *cuts], [*cuts, None]))
    held = spark.sparkContext.broadcast(paths)  # FAN_IN at most

    def merge(span):
        system, _ = _open(folder)
        rows = []
        for r in loser_tree([_rows_of(system, p, *span) for p in held.value]):
            rows.append(dict(zip(_FIELDS, r)))
            if len(rows) == 4096:
                yield rows
                rows = []
        if rows:
            yield rows

    return _parallel(spark, ranges, merge, _SCHEMA)
