import inspect
import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from brute import components, repeated, words
from firelark.llm import decontaminate, jaccard_join, shared, suffix_dedup
from test_pairs_data import joined


def joined_rows(docs, k, num):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs, k, num, 100).collect()), key=repr)


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80)])
def test_jaccard_components(make, corpus, k, num):
    assert joined_rows(make(corpus.items()), k, num) == components(corpus, k, num, 100)


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80)])
def test_jaccard_blocks_of_large_classes(make, corpus, monkeypatch, k, num):
    monkeypatch.setattr(jaccard_join, "CLASS", 4)
    monkeypatch.setattr(jaccard_join, "LOCAL_HOT", 3)
    monkeypatch.setattr(jaccard_join, "FLUSH", 500)
    assert joined_rows(make(corpus.items()), k, num) == components(corpus, k, num, 100)


def near_copies(rnd, n, size=60):
    """Texts at and about the threshold: chains of edits of a few bases, which share one passage."""
    passage, out = words(rnd, 25), []
    for _ in range(n // 12):
        w = words(rnd, size) + passage
        for _ in range(12):
            out.append(list(w))
            for _ in range(rnd.randrange(4)):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(50)}"
    return [" ".join(w) for w in out]


def test_jaccard_near_the_threshold(make, monkeypatch):
    """Chained near copies beside a passage that all share: no link is lost, none made up."""
    texts = near_copies(random.Random(5), 240)
    assert joined_rows(make(enumerate(texts)), 5, 80) == components(dict(enumerate(texts)), 5, 80, 100)
    monkeypatch.setattr(jaccard_join, "LOCAL_HOT", 2)
    monkeypatch.setattr(jaccard_join, "CLASS", 8)
    assert joined_rows(make(enumerate(texts)).repartition(7), 5, 80) == components(dict(enumerate(texts)), 5, 80, 100)


def test_jaccard_edges(make, spark):
    """Repeated ids with other texts, ids of 63 bits beside null ones, empty tables."""
    rnd = random.Random(7)
    a, b = (" ".join(words(rnd, 60)) for _ in range(2))
    big = (1 << 62) + 1
    rows = [(1, b), (1, a), (2, b + " tail"), (3, a), (3, a), (None, a), (None, None), (big, b), (big + 1, "other"), (7, None), (7, a), (8, "")]
    assert joined_rows(make(rows), 3, 90) == components(rows, 3, 90, 100)
    from pyspark.sql import functions as F

    docs = make(rows)
    for more in ("comp", "rep", "sig", "_gone", "id", "kind"):
        kept = corpus_pipeline.near_duplicates(spark, docs.drop(more).withColumn(more, F.lit(1)), "")
        assert kept.columns == [*docs.drop(more).columns, more]
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "1", "None", "None", str(big + 1), "8"])
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), "").collect() == []


def test_sketches_bound_the_difference():
    rnd = np.random.default_rng(4)
    for n in (1, 5, 40, 700):
        u = np.unique(rnd.integers(0, 1 << 63, n, np.uint64))
        v = np.unique(np.concatenate((u[n // 4 :], rnd.integers(0, 1 << 63, n // 3, np.uint64))))
        x, y = (jaccard_join.bit_sketch(s, jaccard_join.sketch_bits(len(s))) for s in (u, v))
        least = min(len(x), len(y))
        far = int(np.bitwise_count(jaccard_join.folded(x, least) ^ jaccard_join.folded(y, least)).sum())
        bits = 64 * least
        assert far == (jaccard_join._folded_int(x.tobytes(), bits) ^ jaccard_join._folded_int(y.tobytes(), bits)).bit_count()
        assert far <= len(np.setxor1d(u, v)) and np.array_equal(jaccard_join.folded(x, least), jaccard_join.bit_sketch(u, bits))


def test_no_link_is_missed_by_keys():
    """Pairs at the threshold share a key, whatever their size."""
    rnd = np.random.default_rng(3)
    for num, den, slack, least in ((90, 100, 0.25, 3), (80, 100, 0.3, 2)):
        sizes = jaccard_join.bands(num, den, 1.25)
        at = np.array([x[0] for x in sizes])
        for n in [*range(5, 40), 100, 333, 1000]:
            for _ in range(5):
                u = n * 1.0
                both = int(np.ceil(num * u / den))
                x = rnd.integers(0, 1 << 64, n, np.uint64, endpoint=False)
                cut = (n - both + 1) // 2
                a, b = np.unique(x[: n - cut]), np.unique(x[n - both - cut if n - both - cut > 0 else 0 :])
                inter = len(np.intersect1d(a, b))
                if den * inter < num * (len(a) + len(b) - inter) or np.array_equal(a, b):
                    continue
                keys = [set(np.concatenate(jaccard_join.block_keys(s, sizes, at, num, den, slack, least) or [np.zeros(0)]).tolist()) for s in (a, b)]
                assert keys[0] & keys[1], (num, n)


def test_connected(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(500, 500)] + [(i, i + 1) for i in range(300, 340)]
    got = {r["id"]: r["comp"] for r in shared.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert {k: v for k, v in up.items() if k != 500} == got


def test_repeated_passages(make, corpus):
    texts = dict(corpus)
    rows = suffix_dedup.repeated_passages(make(texts.items())).collect()
    want, got = repeated(texts, 50), {}
    for r in rows:
        assert r["n_words"] >= 50 and r["match_doc_id"] < r["doc_id"]
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
    assert got == want


def test_repeated_passages_of_many(make, spark):
    """A passage of very many documents, spread over partitions of the suffix array, beside passages of two; short batches."""
    rnd = random.Random(31)
    hot, texts = words(rnd, 64), {}
    for i in range(400):
        other = words(rnd, 54) if not i % 5 else texts[i - 1][:52]
        texts[i] = other + hot[: rnd.choice([50, 60, 64])] + words(rnd, rnd.randrange(30))
    texts = {i: " ".join(w) for i, w in texts.items()}
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    got: dict = {}
    try:
        for size in ("7", "1000"):
            spark.conf.set(name, size)
            got.clear()
            for r in suffix_dedup.repeated_passages(make(texts.items())).collect():
                got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
            assert got == repeated(texts, 50)
    finally:
        spark.conf.set(name, before)


def test_links_to_other_documents():
    rnd = np.random.default_rng(6)
    for n in (1, 2, 9, 60):
        doc, links = rnd.integers(0, 3, n), rnd.integers(-1, 25, n - 1)
        ahead, behind = suffix_dedup._to_others(doc, links, 7)
        for i in range(n):
            j = next((j for j in range(i, n) if doc[j] != doc[i]), n)
            assert ahead[i] == min([*links[i : min(j, n - 1)], *([7] if j == n else [])])
            j = next((j for j in range(i, -1, -1) if doc[j] != doc[i]), -1)
            assert behind[i] == min([*links[max(j, 0) : i], *([7] if j < 0 else [])])


def test_repetitive_texts(make):
    """Periodic texts, one word over and over, and texts made of a few common lines: many equal suffixes in and across documents."""
    rnd = random.Random(17)
    lines = [words(rnd, n, 40) for n in (3, 7, 26, 30, 52)]
    texts = {i: sum((rnd.choice(lines) for _ in range(rnd.randrange(1, 30))), []) for i in range(60)}
    texts |= {60 + i: ["a"] * n for i, n in enumerate((49, 50, 51, 300, 120))} | {70 + i: ["a", "b", "c"][i % 3 :] + ["a", "b", "c"] * (20 + i) for i in range(6)}
    texts = {i: " ".join(w) for i, w in texts.items()}
    got: dict = {}
    for r in suffix_dedup.repeated_passages(make(texts.items())).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
        w, at = texts[r["match_doc_id"]].split(), r["match_start_word"]
        assert w[at : at + 50] == texts[r["doc_id"]].split()[r["start_word"] : r["start_word"] + 50] or r["n_words"] > 50
    assert got == repeated(texts, 50)


def test_passages_edges(make, spark, monkeypatch):
    """Repeated ids with other texts, null ids and texts, clashing columns, the way beyond the broadcast bound."""
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    p, q, r = (words(rnd, 70) for _ in range(3))
    rows = [(1, " ".join(p)), (2, " ".join(words(rnd, 30) + p)), (2, " ".join(q)), (2, " ".join(q)), (3, " ".join(words(rnd, 9) + q + ["end"])), (3, " ".join(["x"] * 500)), (4, None), (None, " ".join(p)), (5, ""), (6, " ".join(r + r)), (6, "short"), (7, " ".join(p))]
    docs = make(rows)
    found = suffix_dedup.repeated_passages(docs)
    got = sorted((x["doc_id"], x["start_word"], x["n_words"], x["match_doc_id"], x["match_start_word"]) for x in found.collect())
    assert got == [(2, 30, 70, 1, 0), (3, 9, 70, 2, 0), (7, 0, 70, 1, 0)]
    wide = docs.select("*", *(F.lit(9).alias(c) for c in ("_id", "_cuts", "text_hash", "cut_hash", "cuts", "at", "bits", "found", "pos")))
    for limit in (suffix_dedup.MAX_CUTS, 0):
        monkeypatch.setattr(suffix_dedup, "MAX_CUTS", limit)
        out = suffix_dedup.without_passages(wide, suffix_dedup.repeated_passages(wide))
        assert out.columns == wide.columns
        texts = sorted((str(x["doc_id"]), x["text"] or "") for x in out.collect())
        assert texts == sorted((str(i), " ".join(t.split()[:30]) + " " if n == 1 else " ".join(t.split()[:9]) + " end" if n == 4 else t or "") for n, (i, t) in enumerate(rows) if n != 11)


def test_passages_beside_an_earlier_lead_in(make):
    """Documents that share 50 to 73 words, of which an earlier third one has only the first, the middle or the last; all words are found."""
    rnd = random.Random(21)
    fresh = lambda n: [f"x{rnd.randrange(10**6)}" for _ in range(n)]
    texts = {}
    for n in range(24):
        both, k = fresh(50 + n), n * 10
        for j, (lo, hi) in enumerate(((0, 30), (8, 42), (20, 50 + n), (0, 49))):
            texts[k + j] = fresh(30) + both[lo:hi] + fresh(30)
        texts[k + 4], texts[k + 5] = fresh(30) + both + fresh(30), fresh(n) + both + fresh(60 - n)
    # a lead-in of many documents, then bodies that two of each have
    lead, bodies = fresh(40), [fresh(35) for _ in range(20)]
    texts |= {1000 + i: fresh(i % 7) + lead + bodies[i % 20] + fresh(40) for i in range(40)}
    texts = {i: " ".join(w) for i, w in texts.items()}
    got: dict = {}
    for r in suffix_dedup.repeated_passages(make(texts.items())).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
        w, at = texts[r["match_doc_id"]].split(), r["match_start_word"]
        assert w[at : at + 50] == texts[r["doc_id"]].split()[r["start_word"] : r["start_word"] + 50]
    assert got == repeated(texts, 50)


def test_minimisers_are_shared():
    rnd = np.random.default_rng(0)
    g = rnd.integers(0, 50, 400, np.uint64)
    of = np.array([0, 0, 7, 60, 61, 300, 400])
    got = set(suffix_dedup.minimisers(g, of, 5, 8).tolist())
    want = set()
    for a, b in zip(of, of[1:]):
        last = b - 5 + 1
        if last <= a:
            continue
        if last - a < 8:
            want.add(a + int(np.argmin(g[a:last])))
        for s in range(a, last - 8 + 1):
            want.add(s + int(np.argmin(g[s : s + 8])))
    assert got == want


def test_cutting(make, corpus):
    docs = make(corpus.items())
    out = {r["doc_id"]: r for r in suffix_dedup.without_passages(docs, suffix_dedup.repeated_passages(docs)).collect()}
    assert set(corpus) - set(out) <= set(repeated(corpus, 50))
    for i in (0, 100, 101, 103, 108):
        assert out[i]["text"] == corpus[i]
    assert out[95]["n_chars"] == len(out[95]["text"]) < len(corpus[95])


def test_pairs_on_nothing(make):
    empty = make([]).where("false")
    assert jaccard_join.jaccard_components(empty, 3, 90, 100).collect() == []
    assert suffix_dedup.repeated_passages(empty).collect() == []


def test_contaminated(spark, make, monkeypatch):
    rnd = random.Random(4)
    items = {i: joined(rnd, n) for i, n in enumerate((12, 18, 40, 60, 11))}
    bench = spark.createDataFrame([(i, t, 7) for i, t in items.items()] + [(98, None, 1), (99, "", 1)], "item_id long, text string, doc_id long")
    sub = lambda t, every: " ".join("zzz" if j % every == every // 2 else w for j, w in enumerate(t.split()))
    texts = {0: joined(rnd, 100), 1: joined(rnd, 30) + " " + items[2] + " " + joined(rnd, 30), 2: items[1].upper() + ".", 3: sub(items[3], 15), 4: joined(rnd, 9) + " " + items[0], 5: sub(items[3], 2), 6: None, 7: "", 8: items[4], 9: " ".join(items[3].split()[20:50]), 10: "x"}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(make(texts.items()), bench).collect()}
    assert got == {(1, 2), (2, 1), (3, 3), (4, 0), (8, 4), (9, 3)}  # item 4 has 11 tokens, all there
    kept = decontaminate.decontaminated(make(texts.items()), bench)
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - {1, 2, 3, 4, 8, 9}
    assert decontaminate.contaminated(make(texts.items()), bench.where("false")).count() == 0
    # the shuffled join beyond the broadcast bound gives the same
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 0)
    monkeypatch.setattr(shared, "MAX_IDS", 0)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(make(texts.items()), bench).collect()} == got
    assert sorted(map(str, decontaminate.decontaminated(make(texts.items()), bench).collect())) == sorted(map(str, kept.collect()))


def test_contaminated_edges(spark, make):
    """Short items whole, repeated and missing ids, a very long text, clashing columns, empty tables."""
    item = [f"q{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, "one"), (2, "Two three."), (3, " ".join(item)), (3, " ".join(item)), (None, "lost item here"), (5, "?!"), (6, None)], "item_id long, text string")
    texts = [(1, "a one b"), (1, "c two Three, two three"), (2, "two x three"), (None, " ".join(item)), (3, "z " * 200_000 + " ".join(item)), (4, None), (5, "lost item here"), (6, "")]
    docs = make(texts)
    got = sorted((r["doc_id"], r["item_id"] or -1, r["at_token"], r["n_equal"], r["n_compared"]) for r in decontaminate.contaminated(docs, bench).collect())
    # an item without an id has no alignment that could be reported
    assert got == [(1, 1, 1, 1, 1), (1, 2, 1, 2, 2), (1, 2, 3, 2, 2), (3, 3, 200_000, 24, 24)]
    for more in ("_bad", "id", "at", "bits", "w", "n_equal"):
        wide = docs.withColumn(more, docs["n"])
        assert sorted(str(r["doc_id"]) for r in decontaminate.decontaminated(wide, bench).collect()) == ["2", "4", "5", "6", "None"]
    assert decontaminate.decontaminated(docs, bench.where("false")).count() == len(texts)
    assert decontaminate.decontaminated(docs.where("false"), bench).collect() == []


def test_seeds_hit_every_accepted_run():
    masks = inspect.signature(decontaminate.contaminated).parameters["masks"].default
    n_patterns, missed = 0, []
    for n in range(12, 25):
        windows = [sum(1 << s + k for k, c in enumerate(m) if c == "1") for m in masks for s in range(n - len(m) + 1)]
        for gone in itertools.combinations(range(n), n - -(-8 * n // 10)):
            whole = ~sum(1 << k for k in gone)
            n_patterns += 1
            if not any(whole & w == w for w in windows):
                missed.append((n, gone))
    assert n_patterns == 41341 and not missed


def test_contaminated_without_seeds(spark, make):
    """All alignments, compared without seeds, give the same rows."""
    rnd = random.Random(12)
    items = {i: [f"i{rnd.randrange(400)}" for _ in range(12 + i % 30)] for i in range(40)}
    texts = {}
    for i in range(240):
        w = list(items[i % 40])
        for k in rnd.sample(range(len(w)), rnd.randrange(len(w) // 3 + 1)):
            w[k] = "zzz%d" % k
        cut = rnd.choice([0, 0, 0, 3])
        texts[i] = [f"t{rnd.randrange(99)}" for _ in range(rnd.randrange(5))] + w[cut:] + [f"t{rnd.randrange(99)}" for _ in range(rnd.randrange(5))]
    texts[240] = [x if k % 4 != 3 else "zzz" for k, x in enumerate(items[3])]  # 15 tokens, each fourth substituted
    want = set()
    for d, w in texts.items():
        for i, b in items.items():
            run = min(24, len(b))
            for at in range(1 - len(b), len(w)):
                eq = [0 <= at + j < len(w) and w[at + j] == x for j, x in enumerate(b)]
                best = max(sum(eq[s : s + run]) for s in range(len(b) - run + 1))
                if best >= 0.8 * run:
                    want.add((d, i, at, best, run))
    bench = spark.createDataFrame([(i, " ".join(b)) for i, b in items.items()], "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contaminated(make((i, " ".join(w)) for i, w in texts.items()), bench).collect()}
    assert got == want and any(r[0] == 240 for r in got)
