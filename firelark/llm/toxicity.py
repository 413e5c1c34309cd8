"""Toxic passages by maximum-scoring segment search.

Method. Tokens (runs of letters, lower case) get the log-odds of toxic against other documents under an informative
Dirichlet prior (the pooled counts, `prior` pseudo-tokens strong, a tenth of the counted ones at most), less two standard errors; so do the beginnings of 4 to 7
letters of longer tokens, in place of tokens too rare to be known. All others, and those beyond the `max_terms`
with the largest z, score `drift`, which is negative. One pass over a text finds all maximal scoring
segments (the stack algorithm of Ruzzo and Tompa, linear time). The best segments of the clean training texts fit
an extreme-value law: P(best > x) = 1 - exp(-K n exp(-lambda x)) for n tokens. A segment is significant if its
expected number by chance is under `e_value`. A document's score is the calibrated probability (logistic in
-log P of its best segment and the sum of the significant segments' scores) fitted on the training rows.

Fitted on at most about `max_rows` labelled rows, chosen by a hash of doc_id; counts are summed on the executors and
only the `max_terms` strongest tokens come to the driver. Scoring reads every whole text once, in map tasks only.

Results of toxicity_scores: doc_id, score (0 to 1), passages (array of start and end token, score, of the significant
segments, in text order). Null, empty and wordless texts have no passages and score the calibrated value of no evidence. Rows
are kept as they are, repeated doc_ids included; other columns are ignored; labels that are null are not learned
from. Without labels of both kinds all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm.shared import discard, small_batches, written

TOKEN = re.compile(r"[^\W\d_]+")
STEMS = (7, 6, 5, 4)
BURST = 3  # a token counts so often in a training text at most: one repetitive text proves little
CACHE = 300_000  # token scores a Python worker remembers


class _Scores(dict):
    """Score of a token: its own, or that of its longest known beginning, or the drift."""

    def __init__(self, terms: dict[str, float], drift: float):
        self.terms, self.drift = terms, drift

    def __missing__(self, word: str) -> float:
        if len(self) > CACHE:
            self.clear()
        terms = self.terms
        x = terms.get(word)
        if x is None:
            x = next((terms[p] for n in STEMS if len(word) > n and (p := word[:n] + "-") in terms), self.drift)
        self[word] = x
        return x


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a score sequence, in order; linear time."""
    hot = np.flatnonzero(scores > 0)
    if not len(hot):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    begin, end = total[hot].tolist(), total[hot + 1].tolist()
    place = hot.tolist()
    # stack entries: first index, last index + 1, total before, total after, the nearest entry below with a smaller total before
    stack: list[list] = []
    for i in range(len(place)):
        s, e, low, top = place[i], place[i] + 1, begin[i], end[i]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= top:
                stack.append([s, e, low, top, j])
                break
            s, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, top - low) for s, e, low, top, _ in stack]


class Model:
    """Token scores, the extreme-value law (lam, k) and the calibration (bias, two weights)."""

    def __init__(self, terms: dict[str, float], drift: float, lam: float = 1.0, k: float = 0.1, weights=(-20.0, 0.0, 0.0), e_value: float = 0.01):
        self.terms, self.drift, self.lam, self.k, self.weights, self.e_value = terms, drift, lam, k, weights, e_value
        self._scores = None

    def __getstate__(self):
        return self.__dict__ | {"_scores": None}

    def of(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = TOKEN.findall((text or "").lower())
        if self._scores is None:
            self._scores = _Scores(self.terms, self.drift)
        return len(words), segments(np.fromiter(map(self._scores.__getitem__, words), np.float64, len(words)))

    def features(self, n: int, segs) -> tuple[float, float]:
        if not segs:
            return 0.0, 0.0
        best = max(s for _, _, s in segs)
        chance = self.k * n * math.exp(-self.lam * best)  # expected number of such segments in clean text
        p = -math.expm1(-chance)
        return -math.log(max(p, 1e-12)), math.log1p(sum(s for _, _, s in self.significant(n, segs)))

    def significant(self, n: int, segs) -> list[tuple[int, int, float]]:
        return [s for s in segs if self.k * n * math.exp(-self.lam * s[2]) < self.e_value]

    def score(self, n: int, segs) -> float:
        a, b = self.features(n, segs)
        w = self.weights
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, w[0] + w[1] * a + w[2] * b))))


def gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """lambda and K of P(best <= x) = exp(-K n exp(-lambda x)) by maximum likelihood over texts of n tokens; a best of 0 (no
    segment) says only that none exceeds 0. Under ten texts with a segment lambda is 1."""
    n = np.maximum(n, 1.0)
    some = best > 0
    x, m, rest = best[some], n[some], float(n[~some].sum())
    rate = lambda lam: (len(x) + 1) / (float((m * np.exp(-lam * x)).sum()) + rest + 1)
    if len(x) < 10 or x.std() < 1e-9:
        return 1.0, rate(1.0)
    lo, hi = 1e-2, 50.0
    for _ in range(80):
        lam = math.sqrt(lo * hi)
        slope = len(x) / lam - x.sum() + rate(lam) * float((m * x * np.exp(-lam * x)).sum())
        lo, hi = (lam, hi) if slope > 0 else (lo, lam)
    return lo, rate(lo)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_terms: int = 5_000, prior: float = 2_000.0, drift: float = -0.3) -> Model:
    """labels: doc_id, toxic (0 or 1), training rows only."""
    labels = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("y"))
    share = min(1.0, max_rows / max(1, labels.count()))
    slots = 1 << 20
    labels = labels.where(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(slots)) < int(share * slots)).distinct()
    # the chosen labels are about max_rows rows of 12 bytes at most: broadcast, so the texts are read where they lie
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(labels), F.col("_id") == F.col("doc_id"))
    train = written(train.select("y", "text"), "labelled")

    def count(batches):
        import pandas as pd

        from collections import Counter

        tally = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for y, text in zip(pdf["y"], pdf["text"]):
                words = Counter(TOKEN.findall((text or "").lower()))
                t = tally[int(y == 1)]
                for w in words:
                    words[w] = min(words[w], BURST)
                t.update(words)
                for w, c in words.items():
                    for n in STEMS:
                        if len(w) > n:
                            t[w[:n] + "-"] += c
        a, b = tally[1], tally[0]
        words = list(a.keys() | b.keys())
        yield pd.DataFrame({"t": pd.Series(words, dtype=object), "a": [a[w] for w in words], "b": [b[w] for w in words]})

    counts = train.mapInPandas(count, "t string, a long, b long").groupBy("t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    tot = counts.where("t not like '%-'").agg(F.sum("a"), F.sum("b")).first()
    counts = counts.where("a + b >= 3")
    na, nb = float(tot[0] or 0), float(tot[1] or 0)
    if not na or not nb:
        discard(train)
        return Model({}, drift)
    prior = min(prior, (na + nb) / 10)
    pr = (F.col("a") + F.col("b")) * (prior / (na + nb))
    odds = lambda c, n: F.log((F.col(c) + pr) / (F.lit(n + prior) - F.col(c) - pr))
    scored = counts.select("t", (odds("a", na) - odds("b", nb)).alias("d"), F.sqrt(1 / (F.col("a") + pr) + 1 / (F.col("b") + pr)).alias("s"))
    # a rise of under three standard errors is chance: only terms beyond it score above the drift
    top = scored.where("d > 3 * s").orderBy(F.desc(F.col("d") / F.col("s")), "t").limit(max_terms).collect()
    model = Model({r["t"]: r["d"] - 2 * r["s"] + drift for r in top if r["d"] - 2 * r["s"] + drift > 0}, drift)

    def best(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for y, text in zip(pdf["y"], pdf["text"]):
                n, segs = model.of(text)
                out.append((int(y == 1), float(n), [s for _, _, s in segs]))
            yield pd.DataFrame({"y": [o[0] for o in out], "n": [o[1] for o in out], "best": [max(o[2], default=0.0) for o in out], "all": [o[2] for o in out]})

    seen = train.mapInPandas(best, "y int, n double, best double, all array<double>").toPandas()
    discard(train)
    clean = seen[seen["y"] == 0]
    model.lam, model.k = gumbel(clean["best"].to_numpy(), clean["n"].to_numpy())
    x = np.array([model.features(n, [(0, 0, s) for s in all_]) for n, all_ in zip(seen["n"], seen["all"])]).reshape(-1, 2)
    model.weights = tuple(logistic(x, seen["y"].to_numpy(float), 0.1))
    return model


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            m, scores, found = held.value, [], []
            none = m.score(0, [])
            for text in batch.column(1).to_pylist():
                n, segs = m.of(text)
                scores.append(m.score(n, segs) if segs else none)
                found.append([{"start": a, "end": b, "score": s} for a, b, s in m.significant(n, segs)] if segs else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, passages array<struct<start:int,end:int,score:double>>")


def held_out(col: str, mod: int, rest: int):
    """crc32 of the id as text, modulo mod, is rest."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def without_toxic(docs: DataFrame, model: Model, reject: float = 0.5) -> DataFrame:
    """docs without those that score `reject` or more, in one pass over them; columns stay as they are."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            got = [held.value.of(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([held.value.score(n, s) < reject for n, s in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
