"""Passages that repeat across documents, by a sparse suffix array over word hashes.

Method. Of each `window` neighbouring positions of a text the one whose next `head` words have the least hash is
retained (a minimiser), so two texts that share min_words = head + window - 1 words retain the same suffix in
them. Suffixes whose first `head` words occur in one document only are dropped at once (a radix pass). The others get the `side` =
window - 1 words on either side and are sorted by their words, head first, then to the right, then to the left: the sparse suffix array.
Neighbours are compared. Those that share min_words words from the suffix on are a run; each is matched with the first document of its run
(smallest doc_id, then position) and with the least one of its head, and the match is extended to the left and right. Matches beyond
these words are taken on by the next retained suffix, at most `window` words ahead, and joined. What may be left are min_words words
from o words before a suffix on, o = 0 to `side`, that no such match covers. In the array the longest match of a suffix with any other is
that with a neighbour: to the right that of its run with the runs beside it, to the left, within the run, that with the suffixes beside
it. So only offsets at which neighbours share enough can repeat; these are looked up: by their hash each meets the first suffix with the
same words.

Guarantee. Every reported passage stands, word for word, in both documents (hashes of 64 bits, of 32 beside the head). Every run of
min_words words that an earlier document (smaller doc_id) has is reported, whichever words of it other documents share.

Scale. Suffixes travel packed, one row a bucket and map task; a beginning that repeats within a map task is settled there and sent on
once. The array is range-partitioned by words, document and position, so that a passage of any number of documents is spread over
partitions; what a run at the border of a partition may share beyond is looked up. Lookups meet by a partial aggregate that is joined
back. No group is gathered. Texts are moved only if the filter of the first pass lets them through, for the words beside their suffixes.

Results of repeated_passages: doc_id, text_hash, start_word, n_words, match_doc_id (an earlier document with the passage),
match_start_word; overlapping matches of a document are merged (the match is that of the longest; of equal ones the first). Words are
runs of other than space and \\t-\\r, compared as they are. Null, empty and short texts have no passages, nor have rows without a doc_id. Repeats
within one document don't count, and all rows of a doc_id are one document; text_hash (xxhash64 of doc_id and text) tells its texts apart,
and equal rows give their passages once. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared
from firelark.llm.words import chunks, hash_words

HEAD, WINDOW = 26, 25
FLUSH = 400_000  # suffixes that a map task holds before it sends them


def minimisers(g: np.ndarray, of: np.ndarray, head: int, window: int) -> np.ndarray:
    """Retained positions of the texts of[i]:of[i + 1], given the hash g of the head words at each position.
    Texts with fewer positions than a window retain their least; texts shorter than head none."""
    n = len(g)
    if not n:
        return np.zeros(0, np.int64)
    out = np.zeros(n, bool)
    lens = np.minimum(np.diff(of), n - of[:-1]) - 0
    last = of[1:] - head + 1  # one past the last position with a head
    # sliding minimum by doubling, ties to the left
    at = np.arange(n)
    span = 1
    v = g
    while span < window:
        step = min(span, window - span)
        m = n - span - step + 1
        if m <= 0:
            break
        a, b = at[:m], at[step : step + m]
        at = np.where(v[a] <= v[b], a, b)
        span += step
    if span == window:
        room = np.zeros(n + 1, np.int64)
        ok = last - of[:-1] >= window
        np.add.at(room, of[:-1][ok], 1)
        np.add.at(room, (last - window + 1)[ok], -1)
        starts = np.flatnonzero(np.cumsum(room[:-1]) > 0)
        out[at[starts[starts < len(at)]]] = True
    for i in np.flatnonzero((last - of[:-1] < window) & (last > of[:-1]) & (lens > 0)):
        out[of[i] + np.argmin(g[of[i] : last[i]])] = True
    return np.flatnonzero(out)


_ROW = "kind int, bucket int, id long, pos int, blob binary, n int"


def _suffixes(docs: DataFrame, head: int, window: int, min_words: int, buckets: int) -> DataFrame:
    """docs: id, text. Kind 1: suffixes of a bucket (hash, id, position); 0: one whose beginning repeats in the map task."""

    def run(batches):
        import pyarrow as pa

        held: list = []
        count = 0

        def rows(kind, bucket, doc, pos, blob, n):
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), pa.array(blob, pa.binary()), pa.array(n, pa.int32())], names=["kind", "bucket", "id", "pos", "blob", "n"])

        def flush():
            h, doc, pos = (np.concatenate(x) for x in zip(*held))
            held.clear()
            o = np.lexsort((doc, h))
            h, doc, pos = h[o], doc[o], pos[o]
            s = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            e = np.append(s[1:], len(h))
            many = np.repeat(doc[s] != doc[e - 1], e - s)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            if many.any():
                d = doc[many]
                yield rows(np.zeros(len(d)), (shared.mix64(d.view(np.uint64)) % np.uint64(buckets)).astype(np.int32), d, pos[many], [None] * len(d), np.zeros(len(d)))
            first = np.zeros(len(h), bool)
            first[s] = True
            send = ~many | first
            # a repeat that is settled here only has to be known to others: position -1
            pos = np.where(many, -1, pos)[send]
            h, doc, bucket = h[send], doc[send], bucket[send]
            o = np.argsort(bucket, kind="stable")
            h, doc, pos, bucket = h[o], doc[o], pos[o], bucket[o]
            s = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            e = np.append(s[1:], len(bucket))
            yield rows(np.ones(len(s)), bucket[s], np.zeros(len(s)), np.zeros(len(s)), [h[i:j].tobytes() + doc[i:j].tobytes() + pos[i:j].astype(np.int32).tobytes() for i, j in zip(s, e)], e - s)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, w in chunks(batch.column(1)):
                g = w.grams(head)
                p = minimisers(g, w.of, head, window)
                text = np.searchsorted(w.of, p, "right") - 1
                fits = w.of[text + 1] - w.of[text] >= min_words
                p, text = p[fits], text[fits]
                held.append((g[p], ids[first + text], p - w.of[text]))
                count += len(p)
            if count > FLUSH:
                yield from flush()
                count = 0
        if count:
            yield from flush()

    return docs.mapInArrow(run, _ROW)


def _repeated(rows: DataFrame) -> DataFrame:
    """(id, pos) of suffixes whose beginning occurs in two texts or more."""

    def run(batches):
        import pandas as pd

        blobs: dict[int, list] = {}
        for pdf in batches:
            settled = pdf["kind"].to_numpy() == 0
            if settled.any():
                yield pdf.loc[settled, ["id", "pos"]]
            for bucket, blob, n in zip(pdf["bucket"][~settled], pdf["blob"][~settled], pdf["n"][~settled]):
                blobs.setdefault(bucket, []).append((np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.int64, n, 8 * n), np.frombuffer(blob, np.int32, n, 16 * n)))
        for got in blobs.values():
            h, doc, pos = (np.concatenate(x) for x in zip(*got))
            o = np.lexsort((doc, h))
            h, doc, pos = h[o], doc[o], pos[o]
            s = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            e = np.append(s[1:], len(h))
            many = np.repeat((doc[s] != doc[e - 1]) | (np.minimum.reduceat(pos, s) < 0), e - s) & (pos >= 0)
            if many.any():
                yield pd.DataFrame({"id": doc[many], "pos": pos[many]})

    return rows.repartition("bucket").mapInPandas(run, "id long, pos int")


def _with_context(docs: DataFrame, head: int, window: int) -> DataFrame:
    """docs: doc_id, text, id, at (retained positions). A row each: hash of the head words, words beside (32 bits, 0 beyond the text)."""
    side = window - 1

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, keys, at = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3)
            for first, w in chunks(batch.column(1)):
                n = len(w.of) - 1
                sub = at.slice(first, n)
                text = np.repeat(np.arange(n), sub.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                p = sub.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + w.of[text]
                inside = p + head <= w.of[text + 1]  # always, but for texts of one 64-bit hash
                p, text = p[inside], text[inside]
                if not len(p):
                    continue
                lo, hi = w.of[text], w.of[text + 1]
                words = (w.hashes >> np.uint64(32)).astype(np.uint32)
                words[words == 0] = 1
                steps = np.arange(side)
                li = p[:, None] - 1 - steps
                left = np.where(li >= lo[:, None], words[np.maximum(li, 0)], 0).astype(np.uint32)
                ri = p[:, None] + head + steps
                right = np.where(ri < hi[:, None], words[np.minimum(ri, len(words) - 1)], 0).astype(np.uint32)
                grams = w.grams(head)
                pack = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(grams[p].view(np.int64)), pa.array(ids[first + text]), pa.array(keys[first + text]), pa.array((p - lo).astype(np.int32)), pack(left), pack(right)], names=["h", "doc_id", "id", "pos", "lft", "rgt"])

    return docs.select("doc_id", "text", "id", "at").mapInArrow(run, _SUFFIX)


_SUFFIX = "h long, doc_id long, id long, pos int, lft binary, rgt binary"
# rows of kind MATCH (doc_id, id, s, e, m, ms) and LOOKUP (doc_id, id, s, key)
_FOUND = "kind int, doc_id long, id long, s int, e int, m long, ms int, key long"
MATCH, LOOKUP = range(2)


class _Suffixes:
    """Columns of suffixes: h, doc, id, pos and the matrices of the words to the left and right."""

    def __init__(self, h, doc, key, pos, lft, rgt):
        self.all = (h, doc, key, pos, lft, rgt)
        self.h, self.doc, self.id, self.pos, self.lft, self.rgt = self.all

    @classmethod
    def of(cls, batch, names=("h", "doc_id", "id", "pos", "lft", "rgt")):
        cols = [batch.column(c) for c in names]
        words = [np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(len(batch), -1) for c in cols[4:]]
        return cls(*(c.to_numpy(zero_copy_only=False) for c in cols[:4]), *words)

    def __len__(self):
        return len(self.h)

    def __getitem__(self, at):
        return _Suffixes(*(x[at] for x in self.all))

    def __add__(self, other):
        return _Suffixes(*(np.concatenate(x) for x in zip(self.all, other.all)))


def shared_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words the rows of two matrices share; zero marks the end of a text and ends a match."""
    stop = (a != b) | (a == 0)
    return np.where(stop.any(1), stop.argmax(1), a.shape[1])


def _settled(x: _Suffixes, others: list[tuple[_Suffixes, np.ndarray]], alike: np.ndarray, beside: np.ndarray, head: int):
    """Batches of MATCH and LOOKUP rows of suffixes x. Each is compared with its row of every one of `others` (rows, of which it takes that of the
    index) and extended to both sides. What may still repeat is looked up: the min_words words from o words before the suffix on, if no match
    covers them, and if o is at most `alike`, the words to the left that another suffix of the run shares, or side - o at most `beside`,
    the words to the right that another run shares (-1: none, not even the head)."""
    import pyarrow as pa

    side = x.lft.shape[1]
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def rows(kind, i, s, e, m, ms, key):
        z = lambda v, t: pa.array(np.broadcast_to(v, len(i)), t)
        return pa.RecordBatch.from_arrays([z(kind, pa.int32()), pa.array(x.doc[i]), pa.array(x.id[i]), pa.array(s.astype(np.int32)), z(e, pa.int32()), z(m, pa.int64()), z(ms, pa.int32()), z(key, pa.int64())], names=names)

    o = np.arange(side + 1)
    room = [np.where((v == 0).any(1), (v == 0).argmax(1), side) for v in (x.lft, x.rgt)]
    open_ = (o <= room[0][:, None]) & (side - o <= room[1][:, None]) & ((o <= alike[:, None]) | (side - o <= beside[:, None]))
    for n, (y, at) in enumerate(others):
        left, right = shared_words(x.lft, y.lft[at]), shared_words(x.rgt, y.rgt[at])
        if not n:
            # words that the first of the run has too, in the same document: it is looked up for both, if other runs may have them
            open_ &= ~((x.doc == y.doc[at])[:, None] & (o <= left[:, None]) & (side - o > beside[:, None]))
        covered = open_ & ((x.doc > y.doc[at]) & (x.h == y.h[at]))[:, None] & (o <= left[:, None]) & (side - o <= right[:, None])
        i = np.flatnonzero(covered.any(1))
        if len(i):
            yield rows(MATCH, i, x.pos[i] - left[i], x.pos[i] + head + right[i], y.doc[at][i], y.pos[at][i] - left[i], 0)
        open_ &= ~covered
    some = np.flatnonzero(open_.any(1))
    if not len(some):
        return
    sums = []
    for v in (x.lft[some], x.rgt[some]):
        total = np.zeros((len(some), side + 1), np.uint64)
        for k in range(side):
            total[:, k + 1] = shared.mix64(total[:, k] * np.uint64(0x9E3779B97F4A7C15) + v[:, k] + np.uint64(1))
        sums.append(total)
    j, off = np.nonzero(open_[some])
    i = some[j]
    key = shared.mix64(x.h.view(np.uint64)[i] ^ shared.mix64(sums[0][j, off] * np.uint64(0xD6E8FEB86659FD93) + sums[1][j, side - off] + off.astype(np.uint64)))
    yield rows(LOOKUP, i, x.pos[i] - off, 0, 0, 0, key.view(np.int64))


def _least(doc: np.ndarray, pos: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each run that begins at start: its row with the least doc, then pos."""
    run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(doc))))
    order = np.lexsort((pos, doc, run))
    return order[np.searchsorted(run[order], np.arange(len(start)))]


def _to_others(doc: np.ndarray, links: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """links: words that each row shares with the next. Of each row: words that it shares with the next row of another document, and
    with the last one before it; edge: what the rows at the ends share with what is beyond."""
    block = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1])))
    big = np.int64(1000)
    # running least values, begun anew in each block: its numbers are below those of the blocks before
    fwd = np.append(links, edge).astype(np.int64)
    back = np.concatenate(([edge], links)).astype(np.int64)
    ahead = np.minimum.accumulate((fwd - (block[-1] - block) * big)[::-1])[::-1] + (block[-1] - block) * big
    behind = np.minimum.accumulate(back - block * big) + block * big
    return ahead, behind


def _neighbours(ordered: DataFrame, head: int) -> DataFrame:
    """Compares neighbours of a partition of the suffix array, and each suffix with the first document of its run, with the least one of its
    head so far, and with the first of those that are the same on both sides. What the first and the last run of a partition share with suffixes beyond
    is not known, so all that these comparisons don't cover is looked up."""

    def run(batches):
        # rows not settled yet; words that the first of them shares with the run before (None: a border); the least row of its head so far
        held, before, top = None, None, None

        def least(x):
            low = x[_least(x.doc, x.pos, np.array([0]))]
            return top if top is not None and top.h[0] == x.h[0] and (top.doc[0], top.pos[0]) < (low.doc[0], low.pos[0]) else low

        def border(x):
            """Settles suffixes of one run that may go on in another partition."""
            zero = np.zeros(len(x), np.int64)
            block = np.concatenate(([True], ~(x.lft[1:] == x.lft[:-1]).all(1)))
            all_ = np.full(len(x), x.lft.shape[1])
            yield from _settled(x, [(least(x), zero), (x, np.flatnonzero(block)[np.cumsum(block) - 1])], all_, all_, head)

        for batch in batches:
            if not len(batch):
                continue
            x = _Suffixes.of(batch)
            x = held + x if held is not None else x
            same = x.h[1:] == x.h[:-1]
            right = np.where(same, shared_words(x.rgt[1:], x.rgt[:-1]), -1)
            joined = same & (x.rgt[1:] == x.rgt[:-1]).all(1)
            start = np.flatnonzero(np.concatenate(([True], ~joined)))
            if len(start) == 1:
                if before is None:
                    yield from border(x)
                    held, top = x[len(x) :], least(x)
                else:
                    held = x
                continue
            n = start[-1]  # the last run may go on
            ahead = right[start[1:] - 1]
            behind = np.concatenate(([-1 if before is None else before], ahead[:-1]))
            start, size = start[:-1], np.diff(start)
            done = x[:n]
            # the least row of each head, and of the rows before that belong to the first one
            heads = np.flatnonzero(np.concatenate(([True], ~same[: n - 1])))
            low = _least(done.doc, done.pos, heads)
            refs = done[low]
            if top is not None and top.h[0] == done.h[0] and (top.doc[0], top.pos[0]) < (refs.doc[0], refs.pos[0]):
                refs = top + refs[1:]
            of_head = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
            first = _least(done.doc, done.pos, start)
            of_run = np.repeat(np.arange(len(start)), size)
            # the first of those that are the same on both sides
            block = np.concatenate(([True], ~(joined[: n - 1] & (done.lft[1:] == done.lft[:-1]).all(1))))
            block = np.flatnonzero(block)[np.cumsum(block) - 1]
            # words to the left that suffixes of other documents in the run share; its first one is compared with all others anyway
            left = np.where(joined[: n - 1], shared_words(done.lft[1:], done.lft[:-1]), -1)
            near = np.maximum(*_to_others(done.doc, left, -1))
            near[first] = -1
            # words to the right that other documents in other runs share: if the next row is of the same document, as far as the one after it
            after, prior = _to_others(x.doc, right, done.lft.shape[1])
            end = np.append(start[1:], n)
            ahead_of = np.where(x.doc[end][of_run] == done.doc, np.minimum(ahead, after[end])[of_run], ahead[of_run])
            behind_of = np.where(x.doc[start - 1][of_run] == done.doc, np.minimum(behind, prior[start - 1])[of_run], behind[of_run])
            behind_of[of_run == 0] = behind[0]  # what precedes these rows is not held any more
            # the least row of a head that is here as a whole is compared with all others of it
            whole = np.ones(len(heads), bool)
            whole[0] &= before is not None and (top is None or top.h[0] != done.h[0])
            whole[-1] &= x.h[n] != done.h[-1]
            beside = np.maximum(behind_of, ahead_of)
            near[low[whole]] = beside[low[whole]] = -1
            if before is None:
                near[: size[0]] = beside[: size[0]] = done.lft.shape[1]
            yield from _settled(done, [(done, first[of_run]), (refs, of_head), (done, block)], near, beside, head)
            held, before, top = x[n:], int(ahead[-1]), refs[-1:]
        if held is not None and len(held):
            yield from border(held)

    return ordered.mapInArrow(run, _FOUND)


def _running_max(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Greatest value so far in each group; groups are numbered upwards, values are not negative."""
    big = np.int64(1) << 33
    return np.maximum.accumulate(x + group * big) - group * big


def passages(doc, key, s, e, m, ms):
    """Rows of passages of whole texts, from spans sorted by text, m, s - ms and s. Spans that go on along the same words of the same document
    are a chain; overlapping chains are a passage, whose match is that of its longest chain (of equal ones the first)."""
    change = lambda *cols: np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in cols])))
    group = np.cumsum(change(doc, key, m, s - ms)) - 1
    top = _running_max(e, group)
    new = change(group)
    new[1:] |= s[1:] > top[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(s)) - 1
    doc, key, s, m, ms, e = doc[at], key[at], s[at], m[at], ms[at], top[last]
    text = np.cumsum(change(doc, key)) - 1
    o = np.lexsort((ms, m, e, s, text))
    doc, key, s, e, m, ms, text = (x[o] for x in (doc, key, s, e, m, ms, text))
    top = _running_max(e, text)
    new = change(text)
    new[1:] |= s[1:] > top[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(s)) - 1
    part = np.cumsum(new) - 1
    best = np.lexsort((np.arange(len(s)), s - e, part))
    best = best[np.searchsorted(part[best], np.arange(len(at)))]
    return doc[at], key[at], s[at], top[last] - s[at], m[best], ms[best]


def _merged(matches: DataFrame) -> DataFrame:
    """Spans (s, e) of texts and their places (m, ms) elsewhere, to passages."""

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        names = ["doc_id", "text_hash", "start_word", "n_words", "match_doc_id", "match_start_word"]
        held: list = []  # batches of the spans of a text that may go on; they are bounded by its length

        def done(cols):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(passages(*cols), kinds)], names=names)

        for b in batches:
            if not len(b):
                continue
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
            if held and all(h[-1] == c[-1] for h, c in zip(held[-1][:2], cols)):
                held.append(cols)
                continue
            cols = [np.concatenate(x) for x in zip(*held, cols)]
            n = int(np.flatnonzero(np.concatenate(([True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))))[-1])
            if n:
                yield done([c[:n] for c in cols])
            held = [[c[n:] for c in cols]]
        if held:
            yield done([np.concatenate(x) for x in zip(*held)])

    spans = matches.select("doc_id", "id", "s", "e", "m", "ms").repartition("doc_id", "id").sortWithinPartitions("doc_id", "id", "m", F.col("s") - F.col("ms"), "s")
    return spans.mapInArrow(run, "doc_id long, text_hash long, start_word int, n_words int, match_doc_id long, match_start_word int")


def _text_hash(docs: DataFrame):
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def repeated_passages(docs: DataFrame, head: int = HEAD, window: int = WINDOW) -> DataFrame:
    """Passages of head + window - 1 words or more that an earlier document (smaller doc_id) has too."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    least = head + window - 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _text_hash(docs).alias("id")).where("doc_id is not null")
    buckets = max(64, 4 * shared.partitions(spark))
    found = shared.written(_repeated(_suffixes(texts.select("id", "text"), head, window, least, buckets)), "suffixes")
    per_text = found.groupBy("id").agg(F.collect_set("pos").alias("at"))  # bounded by the text's length
    near = shared.keep_in_bloom(texts, "id", shared.bloom(found, "id"))
    rows = shared.written(_with_context(near.join(per_text, "id"), head, window), "context")
    shared.discard(found)
    order = ["h", "rgt", "lft", "doc_id", "pos", "id"]
    array = rows.repartitionByRange(shared.partitions(spark), *order).sortWithinPartitions(*order)
    compared = shared.written(_neighbours(array, head), "compared")
    shared.discard(rows)
    runs = compared.where(F.col("kind") == LOOKUP).select("key", "doc_id", "id", "s")
    again = runs.groupBy("key").agg(F.min(F.struct("doc_id", "s")).alias("f"), F.max("doc_id").alias("last")).where("f.doc_id < last")
    again = shared.written(again.select("key", F.col("f.doc_id").alias("m"), F.col("f.s").alias("ms")), "again")
    others = runs.join(again, "key").where("doc_id > m").select("doc_id", "id", "s", (F.col("s") + least).alias("e"), "m", "ms")
    matches = compared.where(F.col("kind") == MATCH).select("doc_id", "id", "s", "e", "m", "ms").unionByName(others)
    out = shared.written(_merged(matches), "passages")
    shared.discard(compared, again)
    return out


MAX_CUTS = 100_000  # texts with cuts, or cuts, that are broadcast


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs with the words of their repeated passages cut from text (and the white space after them); a document of which no word is left
    goes. Other columns stay as they are, n_chars is counted anew. Rows without passages, null and empty texts and rows without a doc_id among
    them, stay; equal rows are cut alike. Up to MAX_CUTS cuts are broadcast; beyond, only texts that the bitmap of their hashes lets through
    are moved."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    key = shared.fresh(docs, "text_hash")
    cut, at = shared.fresh(docs, "cuts"), docs.columns.index("text")
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), _text_hash(docs)))
    # (start, length) pairs; the passages of a text are bounded by its length
    cuts = passages.groupBy(F.col("text_hash").alias("cut_hash")).agg(F.collect_list(F.struct("start_word", "n_words")).alias(cut))
    n = passages.limit(MAX_CUTS + 1).count()
    names = docs.columns
    join = lambda df, c: df.join(c.withColumnRenamed("cut_hash", key), key, "left").select(*names, cut)
    if n <= MAX_CUTS:
        sure, joined = None, join(keyed, F.broadcast(cuts))
    else:
        ids = shared.written(passages.select("text_hash").distinct(), "cut-texts")
        maybe, sure = shared.split_by_ids(keyed, ids, key)
        joined = join(maybe, cuts)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spans, col = batch.column(batch.num_columns - 1), batch.column(at)
            some = spans.is_valid().to_numpy(zero_copy_only=False)
            cols = [batch.column(j) for j in range(batch.num_columns - 1)]
            if not some.any():
                yield pa.RecordBatch.from_arrays(cols, names=names)
                continue
            texts, keep = col.to_pylist(), np.ones(len(some), bool)
            for i in np.flatnonzero(some):
                raw = texts[i].encode()
                w = hash_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), False)
                gone = np.zeros(len(raw), bool)
                for x in spans[int(i)].as_py():
                    a, b = x["start_word"], x["start_word"] + x["n_words"]
                    gone[w.starts[a] : w.starts[b] if b < len(w.starts) else len(raw)] = True
                texts[i] = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode()
                keep[i] = bool(texts[i].strip())
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep))

    out = joined.mapInArrow(run, docs.schema)
    out = out if sure is None else out.unionByName(sure.select(*names))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
