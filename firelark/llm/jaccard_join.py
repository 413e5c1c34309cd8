"""N-gram Jaccard join by parity sketches.

Method. A text is the set of its k-word shingles. Linked sets of which the smaller has a size in some band differ in at most d
elements. The shingles (64-bit hashes) are dealt to m > d blocks by value, and the hashes of a block are XORed: a sketch of m words
in which each differing element changes at most one word, so the Hamming distance bounds the symmetric difference from below. By the
pigeonhole principle linked sets agree in at least m - d blocks, and these hold the same shingles. Blocks of fewer than `least` shingles
are keys only of thin sets (those with m - d or more such blocks), which loses no link: if all agreeing blocks of a pair are small
ones, both sets are thin. Sets that share a key of a band are a group. Within it they are compared as bit sketches (one bit flipped by
each element, 2 bits or more an element), whose Hamming distance is a bound too: first each with one of the group; then, in groups that
these links leave in more than one piece, all across the pieces. Only what passes joins sets to classes, so sets that merely have a common
passage don't chain; within a class the exact shingle sets are compared.

Scale. Keys travel as packed arrays, one row a bucket and map task; a key that many sets of a map task share is sent once, with edges to one
of them and its group's rows. Sketches travel only for sets that share a key, texts only for sets of a class, once a part. Groups
and classes over `CLASS` sets are compared block by block, a task a pair of blocks. Tables are written to the shared folder and deleted
when they have been read.

Exactness. Sets are told apart by 128 bits, shingles by 64 (n_shingles of a text of n words is off with a chance of n^2 / 2^65); a link is counted
on the shingles of both texts.

Results: one row a row of the input: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and n_copies
(rows with the very same set). A null or empty text, or one without words, has the empty set and is its own component. Fewer than
k words: the whole sequence is the one shingle. Equal sets of different documents link. All texts of a repeated doc_id are one document:
each row has its own n_shingles, and they share a component. A row without a doc_id takes part in nothing: its component_id is null.
Very long texts are compared whole. Ties need no rule: a component is a set. Other columns of the input are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared
from firelark.llm.words import chunks

CLASS = 2048  # sets compared at once,
CLASS_SHINGLES = 1 << 21  # and about their shingles
FLUSH = 600_000  # keys a map task holds before it sends them
LOCAL_HOT = 64  # sets that share a key within a map task and are still all sent
SKETCH_BITS = 1 << 15  # of the largest bit sketch


def sets_of(col, k: int):
    """Yields (row, sorted distinct shingle hashes) for each text of an Arrow column."""
    for first, w in chunks(col, lower=True):
        g = w.grams(k)
        for i in range(len(w.of) - 1):
            a, b = w.of[i], w.of[i + 1]
            if b - a >= k:
                yield first + i, np.unique(g[a : b - k + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    h = np.uint64(b - a)
                    for x in w.hashes[a:b]:
                        h = shared.mix64(np.array([h * np.uint64(0x100000001B3) + x]))[0]
                yield first + i, np.array([h])
            else:
                yield first + i, np.zeros(0, np.uint64)


def bands(num: int, den: int, ratio: float) -> list[tuple[int, int, int]]:
    """(least size, largest size, d) of the bands of set sizes. d: the largest symmetric difference of linked sets of which the smaller is
    in the band; it is at most (den - num) / num of their intersection, and so of the smaller set."""
    out, lo = [], 1
    while lo < 1 << 40:
        hi = max(lo, int(lo * ratio))
        out.append((lo, hi, hi * (den - num) // num))
        lo = hi + 1
    return out


def block_keys(u: np.ndarray, sizes, band_at, num: int, den: int, slack: float, least: int) -> list[np.ndarray]:
    """Keys of one set in its bands: its own, and those below where a smaller linked set can lie."""
    n, out = len(u), []
    at = int(np.searchsorted(band_at, n, "right")) - 1
    for b in range(at, -1, -1):
        _, hi, d = sizes[b]
        if b < at and n * num > hi * den:
            break
        if d == 0:
            continue  # only equal sets link there
        m = d + 1 + math.ceil(slack * d)
        cut = np.searchsorted(u, (np.arange(1, m, dtype=np.float64) * (2.0**64 / m)).astype(np.uint64))
        edges = np.concatenate(([0], cut, [n]))
        size = np.diff(edges)
        full = np.flatnonzero(size >= least)
        if m - len(full) >= m - d:  # a thin set
            full = np.flatnonzero(size > 0)
            if m - len(full) >= m - d:
                full = np.arange(m)
        x = np.zeros(m, np.uint64)
        some = np.flatnonzero(size > 0)
        x[some] = np.bitwise_xor.reduceat(u, edges[some]) if len(some) else x[some]
        out.append(shared.mix64(x[full] ^ shared.mix64(full.astype(np.uint64) + np.uint64(b << 40))))
    return out


def _uniq_pairs(a: np.ndarray, b: np.ndarray):
    o = np.lexsort((b, a))
    a, b = a[o], b[o]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _spans(a: np.ndarray):
    """Starts and ends of the runs of equal values of a sorted array."""
    s = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, int)
    return s, np.append(s[1:], len(a))


def signature(u: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes, as two signed integers."""
    n = np.uint64(len(u))
    with np.errstate(over="ignore"):
        a = np.bitwise_xor.reduce(u) + np.uint64(3) * np.add.reduce(u) + n
        v = shared.mix64(u ^ np.uint64(0xA0761D6478BD642F))
        b = np.add.reduce(v) ^ (np.bitwise_xor.reduce(v) * np.uint64(0xE7037ED1A0B428DB) + n)
    return tuple(int(x) for x in shared.mix64(np.array([a, b])).view(np.int64))


def bit_sketch(u: np.ndarray, bits: int) -> np.ndarray:
    """Parity sketch: bit (hash mod bits) is flipped by each element; 64-bit words. Its halves XORed are that of half the bits."""
    return np.packbits((np.bincount((u & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def sketch_bits(n: int) -> int:
    return min(SKETCH_BITS, max(64, 1 << (2 * n - 1).bit_length()))


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


_ROW = "kind int, bucket int, doc_id long, n long, sig long, sig2 long, blob binary"
DOCUMENT, KEYS, EDGES, GROUPS = range(4)


def _keyed(docs: DataFrame, k: int, num: int, den: int, ratio: float, slack: float, least: int, buckets: int) -> DataFrame:
    """DOCUMENT: a row of the input with its bit sketch; KEYS of a bucket (rest of the key, set, whether its group's rows are sent by
    the map task), EDGES (two sets) and rows of GROUPS (key, set), packed."""

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        sizes = bands(num, den, ratio)
        band_at = np.array([x[0] for x in sizes])
        held: list[np.ndarray] = []
        sigs: list[np.ndarray] = []
        count = 0

        def rows(*cols):
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)], names=["kind", "bucket", "doc_id", "n", "sig", "sig2", "blob"])

        def flush():
            key, sig = _uniq_pairs(np.concatenate(held), np.concatenate(sigs))
            held.clear(), sigs.clear()
            s, e = _spans(key)
            hot = np.repeat(e - s > LOCAL_HOT, e - s)
            if hot.any():
                at = int(key[0] % np.uint64(buckets))
                a, b = _uniq_pairs(sig[hot], sig[np.repeat(s, e - s)][hot])
                yield rows([EDGES], [at], [0], [len(a)], [0], [0], [np.stack((a, b)).tobytes()])
                yield rows([GROUPS], [at + 1], [0], [int(hot.sum())], [0], [0], [np.stack((_group(key[hot], buckets), sig[hot])).tobytes()])
                first = np.zeros(len(key), bool)
                first[s] = True
                key, sig, hot = key[~hot | first], sig[~hot | first], hot[~hot | first]
            bucket = (key % np.uint64(buckets)).astype(np.int32)
            rest = (key >> np.uint64(32)).astype(np.uint32)
            o = np.argsort(bucket, kind="stable")
            bucket, rest, sig, hot = bucket[o], rest[o], sig[o], hot[o]
            s, e = _spans(bucket)
            z = [0] * len(s)
            yield rows([KEYS] * len(s), bucket[s], z, e - s, z, z, [rest[i:j].tobytes() + sig[i:j].tobytes() + hot[i:j].tobytes() for i, j in zip(s, e)])

        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            n, sg = np.zeros(len(ids), np.int64), np.zeros((2, len(ids)), np.int64)
            sketches: list = [None] * len(ids)
            for i, u in sets_of(batch.column(1), k):
                n[i] = len(u)
                if not len(u) or not known[i]:
                    continue
                sg[:, i] = signature(u)
                sketches[i] = bit_sketch(u, sketch_bits(len(u))).tobytes()
                for x in block_keys(u, sizes, band_at, num, den, slack, least):
                    held.append(x)
                    sigs.append(np.full(len(x), sg[0, i], np.int64))
                    count += len(x)
                if count > FLUSH:
                    yield from flush()
                    count = 0
            yield rows(np.zeros(len(ids)), sg[0].view(np.uint64) % np.uint64(buckets), ids, n, sg[0], sg[1], sketches)
        if count:
            yield from flush()

    # a row that is no key needs no exchange: it goes to a bucket by chance, not by its set
    return docs.mapInArrow(run, _ROW).withColumn("bucket", F.when(F.col("kind") == KEYS, F.col("bucket")).otherwise(F.pmod(F.xxhash64("doc_id", "n", "bucket"), F.lit(buckets)).cast("int")))


def _group(key: np.ndarray, buckets: int) -> np.ndarray:
    """The number of a key's group: what a bucket knows of it."""
    return ((key >> np.uint64(32) << np.uint64(24)) | (key % np.uint64(buckets))).view(np.int64)


def _matched(rows: DataFrame) -> DataFrame:
    """DOCUMENT rows pass; the keys of a bucket become EDGES (doc_id and sig are the two sets), one from each set of a group to its first, and
    GROUPS (doc_id: the group, sig: the set) of three sets or more; of groups of the same sets one in each bucket."""

    def run(batches):
        import pyarrow as pa

        blobs: dict[int, list] = {}
        names = ["kind", "doc_id", "n", "sig", "sig2", "blob"]

        def pairs(kind, a, b):
            zero = pa.repeat(pa.scalar(0, pa.int64()), len(a))
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(kind, pa.int32()), len(a)), pa.array(a, pa.int64()), zero, pa.array(b, pa.int64()), zero, pa.nulls(len(a), pa.binary())], names=names)

        for batch in batches:
            kind = batch.column("kind").to_numpy(zero_copy_only=False)
            if (kind == DOCUMENT).any():
                yield batch.filter(pa.array(kind == DOCUMENT)).select(names)
            for x, n, bucket, blob in zip(*(batch.filter(pa.array(kind != DOCUMENT)).column(c).to_pylist() for c in ("kind", "n", "bucket", "blob"))):
                if x == KEYS:
                    blobs.setdefault(bucket, []).append((np.frombuffer(blob, np.uint32, n), np.frombuffer(blob, np.int64, n, 4 * n), np.frombuffer(blob, bool, n, 12 * n)))
                else:
                    yield pairs(x, *np.frombuffer(blob, np.int64).reshape(2, -1))
        for bucket, got in blobs.items():
            key, sig, hot = (np.concatenate(x) for x in zip(*got))
            o = np.lexsort((sig, key))
            key, sig, hot = key[o], sig[o], hot[o]
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (sig[1:] != sig[:-1]))))
            key, sig, hot = key[new], sig[new], np.logical_or.reduceat(hot, new)
            s, e = _spans(key)
            many = np.repeat(e - s > 1, e - s)
            if not many.any():
                continue
            key, sig, hot = key[many], sig[many], hot[many]
            s, e = _spans(key)
            rep = sig[np.repeat(s, e - s)]
            yield pairs(EDGES, *_uniq_pairs(sig[sig != rep], rep[sig != rep]))
            sent = np.logical_or.reduceat(hot, s)
            alike = np.add.reduceat(shared.mix64(sig.view(np.uint64)), s)
            alike[sent] = np.flatnonzero(sent).astype(np.uint64)
            once = np.zeros(len(s), bool)
            once[np.unique(alike, return_index=True)[1]] = True
            want = np.repeat(sent | (once & (e - s > 2)), e - s)
            if want.any():
                yield pairs(GROUPS, (key[want].astype(np.int64) << 24) | bucket, sig[want])

    return rows.repartition("bucket").mapInArrow(run, "kind int, doc_id long, n long, sig long, sig2 long, blob binary")


def close(far, both, num: int, den: int):
    """Whether sets of `both` elements together, whose sketches differ in `far` places, may have a similarity of num / den."""
    return far * (den + num) <= (den - num) * both


def _passed(edges: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) whose sets pass by size and sketch; edges: a, b, na, sa, nb, sb. A set without a sketch passes."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            keep = []
            for na, sa, nb, sb in zip(*(c.to_pylist() for c in b.columns[2:])):
                if sa is None or sb is None:
                    keep.append(True)
                elif min(na, nb) * den < num * max(na, nb):
                    keep.append(False)
                else:
                    bits = 8 * min(len(sa), len(sb))
                    x = _folded_int(sa, bits) ^ _folded_int(sb, bits)
                    keep.append(close(x.bit_count(), na + nb, num, den))
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return edges.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def _folded_int(blob: bytes, bits: int) -> int:
    x, size = int.from_bytes(blob, "little"), 8 * len(blob)
    while size > bits:
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return x


def link(n: np.ndarray, sk: np.ndarray, num: int, den: int, label: np.ndarray, split: int = 0, same=None) -> list[tuple[int, int]]:
    """Joins the labels (in place) of sets that pass by size and sketch and, if given, same(i, j); returns the pairs that joined two labels.
    Pairs of one label are skipped. split > 0: only pairs with one set before it and one from it on are compared."""
    order = np.argsort(n, kind="stable")
    ns, sk = n[order], sk[order]
    side = order < split
    out = []
    for i in range(len(order) - 1):
        top = int(np.searchsorted(ns, ns[i] * den // num, "right"))
        if top <= i + 1:
            continue
        rest = np.arange(i + 1, top)
        rest = rest[label[order[rest]] != label[order[i]]]
        if split:
            rest = rest[side[rest] != side[i]]
        if not len(rest):
            continue
        far = np.bitwise_count(sk[rest] ^ sk[i]).sum(1, dtype=np.int64)
        for j in rest[close(far, ns[rest] + ns[i], num, den)]:
            x, y = label[order[i]], label[order[j]]
            if x != y and (same is None or same(order[i], order[j])):
                label[label == max(x, y)] = min(x, y)
                out.append((int(order[i]), int(order[j])))
    return out


def linked(sets: list[np.ndarray], num: int, den: int, split: int = 0) -> np.ndarray:
    """Labels of the components of sets under the threshold, compared exactly behind the sketches."""
    n, label = np.array([len(u) for u in sets]), np.arange(len(sets))
    bits = min(SKETCH_BITS, max(64, 1 << (4 * int(n.max()) - 1).bit_length()))
    sk = np.stack([bit_sketch(u, bits) for u in sets])

    def same(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return den * both >= num * (n[i] + n[j] - both)

    link(n, sk, num, den, label, split, same)
    return label


def _in_parts(df: DataFrame, parts: Column) -> DataFrame:
    """Each row for every pair (p, q) of parts that its own part is in."""
    df = df.withColumn("parts", parts.cast("int")).withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    return df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other")).drop("other")


def _split(g) -> int:
    """How many rows of a pair of parts, sorted by part, are of the first; 0 if the parts are one."""
    return int((g["part"] == g["p"].iloc[0]).sum()) if g["p"].iloc[0] != g["q"].iloc[0] else 0


def _across(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) between the pieces of groups; groups: grp, sig, comp, n, sketch, count. Nothing but the sketches is compared."""

    def run(batches):
        import pandas as pd

        for g in shared.groups(batches, ["grp", "p", "q"]):
            g = g.sort_values(["part", "sig"], kind="stable")
            piece = g["comp"].to_numpy()
            if (piece == piece[0]).all():
                continue
            n = g["n"].to_numpy()
            words = min((len(x) // 8 for x in g["sketch"] if x is not None), default=1)
            free = [x is None for x in g["sketch"]]
            sk = np.stack([np.zeros(words, np.uint64) if x is None else folded(np.frombuffer(x, np.uint64), words) for x in g["sketch"]])
            label = np.unique(piece, return_inverse=True)[1]
            found = [(int(piece[i]), int(piece[0])) for i in range(len(free)) if free[i]]  # a set without a sketch joins its group
            found += [(int(piece[i]), int(piece[j])) for i, j in link(n, sk, num, den, label, _split(g))]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    spread = _in_parts(groups, F.ceil(F.col("count") / CLASS)).select("grp", "p", "q", "part", "sig", "comp", "n", "sketch")
    return spread.repartition("grp", "p", "q").sortWithinPartitions("grp", "p", "q").mapInPandas(run, "a long, b long")


def _classes(both: DataFrame, num: int, den: int) -> DataFrame:
    """(sig, comp) of sets that links may join: the closure of the edges that pass by size and sketch, in groups of three or more across pieces."""
    edges = shared.written(both.where(F.col("kind") == EDGES).select(F.col("doc_id").alias("a"), F.col("sig").alias("b")).distinct(), "candidates")
    nodes = shared.bloom(edges.select("a").unionByName(edges.select(F.col("b").alias("a"))), "a")
    found = shared.keep_in_bloom(both.where((F.col("kind") == DOCUMENT) & (F.col("n") > 0) & F.col("doc_id").isNotNull()).select("sig", "sig2", "n", "blob"), "sig", nodes)
    # sets of one 64-bit signature that differ in the other half have no sketch, which passes every test
    sketches = found.groupBy("sig").agg(F.max("n").alias("n"), F.when(F.min("sig2") == F.max("sig2"), F.first("blob")).alias("sketch"))
    sketches = shared.written(sketches, "bits")
    of = lambda x: sketches.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    passed = shared.written(_passed(edges.join(of("a"), "a").join(of("b"), "b"), num, den), "passed")
    shared.discard(edges)
    pieces = shared.written(shared.connected(passed), "pieces")
    shared.discard(passed)
    groups = both.where(F.col("kind") == GROUPS).select(F.col("doc_id").alias("grp"), "sig").distinct()
    groups = shared.written(groups.join(pieces.withColumnRenamed("id", "sig"), "sig", "left").select("grp", "sig", F.coalesce("comp", "sig").alias("comp")), "groups")
    open_ = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("count"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("grp", "count")
    across = shared.written(_across(groups.join(open_, "grp").join(sketches, "sig"), num, den), "across")
    shared.discard(groups, sketches)
    more = shared.written(shared.connected(across).select("id", F.col("comp").alias("comp2")), "joined")
    alone = more.join(pieces, "id", "left_anti").select("id", F.col("id").alias("comp"))
    out = pieces.unionByName(alone).join(more.withColumnRenamed("id", "of"), F.col("comp") == F.col("of"), "left")
    out = shared.written(out.select(F.col("id").alias("sig"), F.coalesce("comp2", "comp").alias("comp")), "classes")
    shared.discard(across, more, pieces)
    return out


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, ratio: float = 1.25) -> DataFrame:
    """Components of documents whose k-word shingle sets have a Jaccard similarity of num / den or more."""
    spark = docs.sparkSession
    slack, least = (0.25, 3) if 10 * num >= 9 * den else (0.3, 2)
    shared.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = max(64, 4 * shared.partitions(spark))
    both = shared.written(_matched(_keyed(docs, k, num, den, ratio, slack, least, buckets)), "sketches")
    rows = both.where(F.col("kind") == DOCUMENT).select("doc_id", "n", "sig", "sig2")
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    sets = shared.written(some.groupBy("sig", "sig2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_copies")), "sets")
    classes = _classes(both, num, den)
    twice = sets.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig", F.col("sig").alias("comp"))
    classes_ = classes.unionByName(twice.join(classes, "sig", "left_anti"))
    members = shared.written(classes_.join(sets, "sig").select("sig", "sig2", "rep", "n", "comp"), "members")
    many = members.groupBy("comp").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("size")).where("count > 1")
    parts = F.greatest(F.ceil(F.col("count") / CLASS), F.ceil(F.col("size") / CLASS_SHINGLES))
    many = shared.written(many.select("comp", parts.cast("int").alias("n_parts")), "many")
    texts = shared.keep_in_bloom(docs, "doc_id", shared.bloom(members.join(many, "comp", "left_semi"), "rep"))
    # a class of one part is compared in one task; of more, each pair of parts in its own
    pairs = _in_parts(members.join(many, "comp").join(texts, F.col("doc_id") == F.col("rep")), F.col("n_parts")).select("comp", "p", "q", "part", "rep", "sig", "sig2", "text")

    def compare(batches):
        import pandas as pd
        import pyarrow as pa

        for g in shared.groups(batches, ["comp", "p", "q"]):
            g = g.sort_values(["part", "sig", "sig2"], kind="stable")
            got = [u for _, u in sets_of(pa.array(g["text"], pa.string()), k)]
            # of a repeated doc_id only the text that is meant, and once
            want = list(zip(g["sig"], g["sig2"]))
            right = _first([len(u) > 0 and signature(u) == w for u, w in zip(got, want)], want)
            if right.sum() < 2:
                continue
            got, g = [u for u, r in zip(got, right) if r], g[right]
            rep, label = g["rep"].to_numpy(), linked(got, num, den, _split(g))
            low = pd.Series(rep).groupby(label).transform("min").to_numpy()
            if (rep != low).any():
                yield pd.DataFrame({"a": rep[rep != low], "b": low[rep != low]})

    spread = pairs.repartition("comp", "p", "q").sortWithinPartitions("comp", "p", "q")
    links = shared.written(spread.mapInPandas(compare, "a long, b long"), "links")
    # the sets of a repeated doc_id are joined by it
    double = some.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("sig", "sig2"))).where("min_sig < max_sig OR min_sig2 < max_sig2")
    double = some.join(double.select("doc_id"), "doc_id").join(sets.select("sig", "sig2", "rep"), ["sig", "sig2"])
    double = shared.written(double.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"), "double")
    if double.limit(1).count() or (many.agg(F.max("n_parts")).first()[0] or 1) > 1:
        closed = shared.written(shared.connected(links.unionByName(double)).select(F.col("id").alias("rep"), "comp"), "closed")
        shared.discard(links)
    else:  # every class was settled in one task, so each link goes to its component's smallest document already
        closed = links.select(F.col("a").alias("rep"), F.col("b").alias("comp"))
    named = shared.written(sets.join(closed, "rep", "left").select("sig", "sig2", F.coalesce("comp", "rep").alias("first"), "n_copies"), "named")
    shared.discard(classes, members, many, double, sets, links, closed)
    # an empty set is alone, though documents share it, and so is a row without a doc_id
    alone = rows.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return some.join(named, ["sig", "sig2"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("first").alias("component_id"), "n_copies").unionByName(alone)


def _first(right: list[bool], names: list[tuple]) -> np.ndarray:
    """The first of the right ones of each name."""
    seen: set = set()
    out = np.zeros(len(right), bool)
    for i, (r, w) in enumerate(zip(right, names)):
        if r and w not in seen:
            seen.add(w)
            out[i] = True
    return out
