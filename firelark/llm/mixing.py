"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

Method. The documents of a source, in an order by hash, form blocks of `block` documents. Weights are whole shares a_s of Q = sum of a_s,
each slot takes one block. Block k of source s is released at slot floor(k Q / a_s) and due by
ceil((k + 1) Q / a_s); in each slot the released block with the earliest deadline goes. On one line of slots this meets all deadlines,
so after any number of slots each source deviates from its weight by less than one block. Q is about `FINE`, so that the shares are the
weights (to 1e-12); with `cycle` they are rounded to whole shares of so many slots, and the deviation holds for these
only. When a source ends, a new phase begins with the weights of the others.

Scale. Documents are numbered without sorting a source in one task: a source is cut by hash range into pieces of about `piece`
documents, these are numbered on their own and offset by the counts before them. The driver gets a row a source and steps through the slots, one
a block, of which there are at most MAX_BLOCKS: beyond a billion documents blocks get longer than BLOCK. Sources, pieces and
schedule are joined as tables, broadcast up to `MAX_BROADCAST` rows; beyond that Spark plans the joins by size.

Results of mixed: the input's rows and columns, plus mix_block (number of the block in its source, from 0), mix_slot (place of the
block in the mix, from 0) and mix_position (place of the document, from 0: by slot, then order within the block). No
document is dropped. Null sources are a source of their own; sources without a weight get the least share; weights of sources
without documents don't matter. Null and repeated doc_ids and texts are rows like others, told apart by their text; equal rows take places next to each
other. Documents of a source are ordered by a hash of doc_id and text, ties by these. Very long texts are moved once, whole. An empty table gives an
empty result; input columns named as one of the three are replaced, no other name matters.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firelark.llm import shared

FINE = 1 << 42
BLOCK = 32
MAX_BLOCKS = 1 << 25  # slots that the driver steps through; more documents make longer blocks
PIECES = 64  # of a source at least, so that a large one is spread over tasks
MAX_BROADCAST = 1_000_000  # rows of about 40 bytes


def shares(weights: dict, cycle: int) -> dict:
    """Whole shares that sum to `cycle` (largest remainders, at least 1 each), divided by their common factor."""
    from math import gcd

    total = sum(weights.values())
    exact = {s: w * cycle / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (-(exact[s] - int(exact[s])), str(s))):
        if sum(out.values()) < cycle:
            out[s] += 1
    g = gcd(*out.values())
    return {s: a // g for s, a in out.items()}


def one_cycle(a: dict) -> list[tuple[object, int]]:
    """(source, block) of each slot of a cycle: earliest deadline first among released blocks."""
    import heapq

    q = sum(a.values())
    release = {0: [(s, 0) for s in sorted(a, key=str)]}
    ready: list = []
    out = []
    for t in range(q):
        for s, k in release.pop(t, []):
            heapq.heappush(ready, (-(-(k + 1) * q // a[s]), str(s), k, s))
        due, _, k, s = heapq.heappop(ready)
        assert due > t
        out.append((s, k))
        if k + 1 < a[s]:
            release.setdefault(max(t + 1, (k + 1) * q // a[s]), []).append((s, k + 1))
            if max(t + 1, (k + 1) * q // a[s]) == t:
                heapq.heappush(ready, (-(-(k + 2) * q // a[s]), str(s), k + 1, s))
    return out


def schedule(blocks: dict, a: dict) -> dict:
    """The slots of the blocks of each source, over all phases."""
    import heapq
    from array import array

    out = {s: array("q") for s in blocks}
    live = sorted((s for s, n in blocks.items() if n), key=str)
    slot = 0
    while live:
        q, t = sum(a[s] for s in live), 0
        release: dict = {0: [(s, 0) for s in live]}
        ready: list = []
        # the phase ends after the slot that takes the last block of the first source to end
        while True:
            for s, k in release.pop(t, ()):
                heapq.heappush(ready, (-(-(k + 1) * q // a[s]), str(s), k, s))
            due, _, k, s = heapq.heappop(ready)
            assert due > t
            out[s].append(slot + t)
            t += 1
            if len(out[s]) == blocks[s]:
                break
            release.setdefault(max(t, (k + 1) * q // a[s]), []).append((s, k + 1))
        slot += t
        live = [s for s in live if len(out[s]) < blocks[s]]
    return out


def mixed(docs: DataFrame, weights: dict | None = None, block: int | None = None, cycle: int | None = None, piece: int = 50_000, power: float = 0.5, seed: int = 1) -> DataFrame:
    """weights: by source; None: the counts of documents to the `power`. block: documents a block; None: BLOCK, or as many as keep the schedule
    under MAX_BLOCKS blocks. cycle: round the weights to shares of so many slots."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import LongType, StructType

    spark = docs.sparkSession
    docs = docs.drop("mix_block", "mix_slot", "mix_position")
    counts = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}  # a row a source
    if not counts:
        return docs.withColumns({c: F.lit(None).cast("long") for c in ("mix_block", "mix_slot", "mix_position")})
    block = block or max(BLOCK, -(-sum(counts.values()) // MAX_BLOCKS))
    given = weights or {s: n**power for s, n in counts.items()}
    low = min(given.values())
    target = {s: given.get(s, low) for s in counts}
    a = shares(target, max(cycle or FINE, len(target)))
    slots = schedule({s: -(-n // block) for s, n in counts.items()}, a)
    # helper columns, named unlike any of the input
    order, part, rank, source, number, slot, start, before, n_parts = (shared.fresh(docs, c) for c in ("o", "p", "r", "s", "b", "t", "at", "before", "parts"))
    kind = docs.schema["source"].dataType

    def table(**cols) -> DataFrame:
        """A row each, of the sources and longs; the columns are arrays."""
        values = [pa.chunked_array([pa.repeat(pa.scalar(s, to_arrow_type(kind)), n) for s, n in cols.pop("sources")], to_arrow_type(kind)), *(pa.array(c, pa.int64()) for c in cols.values())]
        schema = StructType().add(source, kind)
        for c in cols:
            schema = schema.add(c, LongType())
        rows = spark.createDataFrame(pa.table(values, names=schema.names), schema)
        return F.broadcast(rows) if len(values[0]) <= MAX_BROADCAST else rows

    # a slot's first place: every block is full but the last of its source, so it is that of full blocks, less what short ones before it lack
    lack = sorted((slots[s][-1], block - n % block) for s, n in counts.items() if n % block)
    ends, less = [t for t, _ in lack], [0]
    for _, n in lack:
        less.append(less[-1] + n)
    sched = table(sources=[(s, len(x)) for s, x in slots.items()], **{
        number: [i for x in slots.values() for i in range(len(x))],
        slot: [t for x in slots.values() for t in x],
        start: [t * block - less[bisect.bisect_left(ends, t)] for x in slots.values() for t in x],
    })
    pieces = {s: max(PIECES, n // piece) for s, n in counts.items()}
    of_source = table(sources=[(s, 1) for s in pieces], **{n_parts: list(pieces.values())})
    # number the documents of a source in hash order, piece by piece; pieces are ranges of the hash
    hashed = docs.withColumn(order, F.xxhash64(F.lit(seed), "doc_id", "text")).join(of_source, F.col("source").eqNullSafe(F.col(source))).drop(source)
    hashed = hashed.withColumn(part, F.floor((F.shiftrightunsigned(order, 11).cast("double") / F.lit(float(1 << 53))) * F.col(n_parts)).cast("int")).drop(n_parts)
    sums = hashed.groupBy(F.col("source").alias(source), F.col(part).alias(number)).agg(F.count(F.lit(1)).alias(rank))
    sums = sums.withColumn(before, F.sum(rank).over(Window.partitionBy(source).orderBy(number).rowsBetween(Window.unboundedPreceding, -1))).select(source, number, F.coalesce(before, F.lit(0)).alias(before))
    sums = F.broadcast(sums) if sum(pieces.values()) <= MAX_BROADCAST else sums
    ranked = hashed.withColumn(rank, F.row_number().over(Window.partitionBy("source", part).orderBy(order, "doc_id", "text")) - 1)
    ranked = ranked.join(sums, F.col("source").eqNullSafe(F.col(source)) & (F.col(part) == F.col(number))).drop(source, number)
    ranked = ranked.withColumn(rank, F.col(before) + F.col(rank)).withColumn("mix_block", F.floor(F.col(rank) / block).cast("long"))
    ranked = ranked.join(sched, F.col("source").eqNullSafe(F.col(source)) & (F.col("mix_block") == F.col(number)))
    ranked = ranked.withColumn("mix_slot", F.col(slot)).withColumn("mix_position", (F.col(start) + F.col(rank) % block).cast("long"))
    return ranked.select(*docs.columns, "mix_block", "mix_slot", "mix_position")
