"""Document quality from line labels of a linear-chain conditional random field.

Method. Every line with a word gets features of itself and of its neighbours (lengths, shares of capitals, digits, symbols
and separators, repeated words and lines, word lengths). A two-label chain (good, bad) scores lines by linear weights and
neighbours by a transition matrix; it is trained on lines that inherit their document's label, by gradient ascent
on the conditional likelihood. Forward-backward gives each line's marginal of being good; a document's evidence is the mean
of the marginals' log-odds and of the marginals, weighted by line length, and a logistic fit on the training documents turns
it into a probability.

Fitted on at most about `max_rows` labelled rows, chosen by a hash of doc_id, of texts up to `max_chars` characters; their
line features (24 numbers a line) come to the driver. Scoring reads every whole text once, in map tasks only.

Results of quality_scores: doc_id, score (0 to 1), n_lines, good_share (of the length). A null, empty or blank text has no
lines and scores the calibrated value of no evidence. Rows are kept as they are, repeated doc_ids included; other columns are
ignored; null labels are not learned from. Without labels of both kinds all scores are the share of good labels (or 0). An
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm.shared import small_batches
from firelark.llm.toxicity import logistic

N_OWN = 12
CHUNK_CHARS = 1 << 20


def _classes() -> np.ndarray:
    """Class of each code point under 1024 (others count as letters): bits 1 capital, 2 digit, 4 symbol, 8 space, 16 bar, 32 stop."""
    t = np.zeros(1024, np.uint8)
    for c in range(1024):
        s = chr(c)
        t[c] = 1 * s.isupper() | 2 * s.isdigit() | 4 * (s in "#*$%&|<>{}[]=~^\\") | 8 * s.isspace() | 16 * (s == "|") | 32 * (s in ".!?,;:")
    return t


_CLASS = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of the lines that have a word, their lengths)."""
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if not lines:
        return np.zeros((0, N_OWN), np.float32), np.zeros(0)
    joined = "".join(lines)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = _CLASS[np.minimum(codes, 1023)]
    cls = np.where(codes > 1023, 0, cls)
    share = lambda bit: np.add.reduceat((cls & bit > 0).astype(np.int32), at) / size
    words = [x.split() for x in lines]
    nw = np.fromiter(map(len, words), np.float64, len(words))
    distinct = np.fromiter((len(set(w)) for w in words), np.float64, len(words))
    seen: set[str] = set()
    dup = np.zeros(len(lines))
    for i, x in enumerate(lines):
        dup[i] = x in seen
        seen.add(x)
    total = sum(map(len, seen))
    bang = np.fromiter((x.count("!!") for x in lines), np.float64, len(lines)) / np.maximum(nw, 1)
    f = np.column_stack((np.ones(len(lines)), np.log1p(size) / 5, share(1), share(2), np.minimum(share(4) * 5, 2), np.minimum(share(16) * 8, 2), share(32) * 5, 1 - distinct / np.maximum(nw, 1), dup, np.minimum(bang, 2), np.minimum((size - nw) / np.maximum(nw, 1) / 6, 3), np.full(len(lines), 1 - total / size.sum())))
    return f.astype(np.float32), size.astype(np.float64)


def with_neighbours(f: np.ndarray) -> np.ndarray:
    """Own features, and the mean of the lines before and after (zeros beyond the ends)."""
    around = np.zeros_like(f)
    around[1:] += f[:-1] / 2
    around[:-1] += f[1:] / 2
    return np.concatenate((f, around), axis=1)


def marginals(u: np.ndarray, t: np.ndarray) -> np.ndarray:
    """P(label 1) of each position of one chain: u, log-odds of label 1 by the features; t, 2 x 2 transition scores.
    Works on log ratios, so long chains neither underflow nor need scaling."""
    n = len(u)
    (e00, e01), (e10, e11) = np.exp(t).tolist()
    x = u.tolist()
    fwd, bwd = [0.0] * n, [0.0] * n
    a = x[0]
    fwd[0] = a
    exp, log = math.exp, math.log
    for i in range(1, n):
        r = exp(max(-40.0, min(40.0, a)))
        a = log((e01 + r * e11) / (e00 + r * e10)) + x[i]
        fwd[i] = a
    b = 0.0
    for i in range(n - 2, -1, -1):
        r = exp(max(-40.0, min(40.0, b + x[i + 1])))
        b = log((e10 + r * e11) / (e00 + r * e01))
        bwd[i] = b
    z = np.clip(np.array(fwd) + np.array(bwd), -40, 40)
    return 1 / (1 + np.exp(-z))


class Model:
    """Line weights, transitions, calibration (bias, weight of the mean log-odds, of the mean marginal)."""

    def __init__(self, weights: np.ndarray, transition: np.ndarray, calibration=(-20.0, 0.0, 0.0)):
        self.weights, self.transition, self.calibration = weights, transition, calibration

    def evidence(self, f: np.ndarray, size: np.ndarray) -> tuple[float, float]:
        """Length-weighted mean log-odds and mean marginal of the lines."""
        if not len(f):
            return 0.0, 0.5
        p = np.clip(marginals(with_neighbours(f) @ self.weights, self.transition), 1e-4, 1 - 1e-4)
        return float(np.average(np.log(p / (1 - p)), weights=size)), float(np.average(p, weights=size))

    def score(self, e: tuple[float, float]) -> float:
        c = self.calibration
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, c[0] + c[1] * e[0] + c[2] * e[1]))))


def train_crf(chains: list[np.ndarray], y: np.ndarray, rounds: int = 150, rate: float = 0.08, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that maximise the mean conditional log-likelihood of all-y chains (Adam)."""
    order = np.argsort([-len(c) for c in chains], kind="stable")
    chains, y = [with_neighbours(chains[i]) for i in order], y[order]
    lens = np.array([len(c) for c in chains])
    live = [int(np.searchsorted(-lens, -i, "left")) for i in range(lens[0])]  # chains longer than i
    at = np.concatenate(([0], np.cumsum(lens)[:-1]))
    x = np.concatenate(chains).astype(np.float64)
    row = [at[:m] + i for i, m in enumerate(live)]
    lab = np.repeat(y, lens)
    w, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    m1, m2 = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    n = len(x)
    lae = np.logaddexp
    for step in range(1, rounds + 1):
        u = x @ w
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[row[0], 1] = u[row[0]]
        for i in range(1, len(row)):
            p = a[row[i] - 1]
            a[row[i]] = lae(p[:, [0]] + t[0], p[:, [1]] + t[1])
            a[row[i], 1] += u[row[i]]
        for i in range(len(row) - 2, -1, -1):
            nx = row[i + 1]
            q = b[nx].copy()
            q[:, 1] += u[nx]
            b[nx - 1] = lae(q[:, [0]] + t[:, 0], q[:, [1]] + t[:, 1])
        z = np.repeat(lae(a[at + lens - 1, 0], a[at + lens - 1, 1]), lens)
        p1 = np.exp(a[:, 1] + b[:, 1] - z)
        grad_w = x.T @ (lab - p1) / n - ridge * w
        inner = np.ones(n, bool)
        inner[at + lens - 1] = False
        i = np.flatnonzero(inner)
        q = b[i + 1].copy()
        q[:, 1] += u[i + 1]
        pair = np.exp(a[i][:, :, None] + t[None] + q[:, None, :] - z[i][:, None, None])
        seen = np.zeros((2, 2))
        seen[0, 0], seen[1, 1] = (lab[i] == 0).sum(), (lab[i] == 1).sum()
        grad_t = (seen - pair.sum(0)) / n - 0.02 * t
        g = np.concatenate((grad_w, grad_t.ravel()))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        w, t = w + move[:-4], t + move[-4:].reshape(2, 2)
    return w, t


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4_000, max_chars: int = 30_000) -> Model:
    """labels: doc_id, quality (0 or 1), training rows only."""
    labels = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("y"))
    share = min(1.0, max_rows / max(1, labels.count()))
    slots = 1 << 20
    labels = labels.where(F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(slots)) < int(share * slots))
    train = labels.join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), F.col("_id") == F.col("doc_id")).where(F.length("text") <= max_chars).select("y", "text")

    def feats(batches):
        import pandas as pd

        for pdf in batches:
            got = [line_features(x or "") for x in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"], "f": [f.tobytes() for f, _ in got], "size": [s.tobytes() for _, s in got]})

    rows = train.mapInPandas(feats, "y int, f binary, size binary").toPandas().sort_values(["y", "f"], kind="stable")
    y = (rows["y"].to_numpy() == 1).astype(float)
    flat = Model(np.zeros(2 * N_OWN), np.zeros((2, 2)))
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.0
        flat.calibration = (30.0 if share == 1 else -30.0, 0.0, 0.0)
        return flat
    chains = [np.frombuffer(f, np.float32).reshape(-1, N_OWN) for f in rows["f"]]
    size = [np.frombuffer(s, np.float64) for s in rows["size"]]
    some = np.array([len(c) > 0 for c in chains])
    model = Model(*train_crf([c for c in chains if len(c)], y[some]))
    x = np.array([model.evidence(f, s) for f, s in zip(chains, size)])
    model.calibration = tuple(logistic(x, y))
    return model


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            m, out = held.value, []
            for text in batch.column(1).to_pylist():
                f, size = line_features(text or "")
                e = m.evidence(f, size)
                out.append((m.score(e), len(f), e[1] if len(f) else 0.0))
            cols = [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.float64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "score", "n_lines", "good_share"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, n_lines long, good_share double")
