"""Quality by co-training two views of a document.

View one is the text's content: hashed words and byte-class shares of the whole
text. View two is the page's metadata: source, language and size facts
(characters, lines, words, mean word and line length) that say nothing about which
words occur. Each view trains a logistic classifier on labelled documents; over
``ROUNDS`` rounds each one labels the unlabelled documents it is most confident
about, and the other learns from them. At the end both views are calibrated
(Platt scaling on labelled rows left out of training) and combined by adding
their calibrated log-odds, weighted by how well each view does there.

Fitting uses a bounded sample (``MAX_LABELLED`` and ``MAX_UNLABELLED``
documents, smallest hashes of the id) as feature vectors of fixed size; scoring
reads every whole text in one pass and needs no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, slices, split_words, text_bytes

MAX_LABELLED, MAX_UNLABELLED = 4_000, 4_000
BUCKETS = 1024
META = 64
#: Rounds, and how many documents of each class a view hands over in a round (share of the unlabelled).
ROUNDS, HANDED = 4, 0.05
CONFIDENT = 0.9


def content_view(text: bytes) -> np.ndarray:
    """Square-rooted shares of hashed words, then shares of byte classes, repeats and marks."""
    out = np.zeros(BUCKETS + 8, np.float32)
    words = split_words(text)
    n = max(1, len(words))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    for w, k in seen.items():
        out[zlib.crc32(w) % BUCKETS] += k
    out[:BUCKETS] = np.sqrt(out[:BUCKETS] / n)
    size = max(1, len(text))
    raw = np.frombuffer(text, np.uint8)
    count = np.bincount(raw, minlength=256)
    out[BUCKETS:] = [count[0x41:0x5B].sum() / size, count[0x30:0x3A].sum() / size, count[0x20] / size,
                     (count[0x21:0x2C].sum() + count[0x5B:0x61].sum() + count[0x7B:0x7F].sum()) / size * 4,
                     count[0x80:].sum() / size, len(seen) / n, max(seen.values(), default=0) / n, 1.0]
    return out


def metadata_view(text: bytes, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source and language, and size facts on a logarithmic scale."""
    out = np.zeros(META, np.float32)
    out[zlib.crc32(b"s:" + (source or "").encode()) % 32] = 1
    out[32 + zlib.crc32(b"l:" + (lang or "").encode()) % 16] = 1
    lines, words = text.count(b"\n") + 1, text.count(b" ") + 1
    log = np.log1p
    out[48:56] = [log(n_chars or 0) / 10, log(len(text)) / 10, log(lines) / 5, log(words) / 10,
                  log(len(text) / lines) / 10, log(len(text) / words) / 3,
                  float(n_chars is None), 1.0]
    # Coarse steps of the two means, so that a linear model can single out a range.
    out[56 + min(7, int(len(text) / words / 2))] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by accelerated gradient steps; the last feature is constant 1."""
    b, v, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    weight = weight / weight.sum()
    rate = 1.0 / (0.25 * float((weight[:, None] * x.astype(np.float64) ** 2).sum()) + ridge)
    prev = b
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        prev, b = b, v - rate * (x.T @ (weight * (p - y)) + ridge * v)
        t, t0 = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = b + (t0 - 1) / t * (b - prev)
    return b


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a margin into log-odds (with a weak prior)."""
    a, c = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - y) * z).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * c])
        h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.0), float(c)


@dataclass
class CoTrained:
    weights: list[np.ndarray]  # one vector a view
    scale: list[tuple[float, float]]
    share: list[float]
    base: float  # log-odds of label 1

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        z = np.full(len(views[0]), self.base)
        for x, b, (a, c), s in zip(views, self.weights, self.scale, self.share, strict=True):
            z = z + s * (a * (x @ b) + c - self.base)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def cotrain(labelled: list[np.ndarray], y: np.ndarray, free: list[np.ndarray], rounds: int = ROUNDS) -> CoTrained:
    """Exchange confident pseudo-labels, then calibrate. A fifth of the labelled
    rows is left out of training for the calibration."""
    cal = np.arange(len(y)) % 5 == 0
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    # Pseudo-labels given to each view by the other: -1 none.
    given = [np.full(len(free[0]), -1.0) for _ in free]
    weights: list[np.ndarray] = []
    for r in range(rounds + 1):
        weights = []
        for v in range(2):
            pick = given[v] >= 0
            x = np.concatenate([labelled[v][~cal], free[v][pick]])
            t = np.concatenate([y[~cal], given[v][pick]])
            w = np.concatenate([np.ones((~cal).sum()), np.full(pick.sum(), 0.5)])
            if len(t) == 0 or t.min() == t.max():
                weights.append(np.zeros(x.shape[1]))
            else:
                weights.append(logistic(x, t, w))
        if r == rounds or not len(free[0]):
            break
        for v in range(2):
            p = 1 / (1 + np.exp(-np.clip(free[v] @ weights[v], -30, 30)))
            other = given[1 - v]
            new = np.flatnonzero(other < 0)
            k = max(1, int(HANDED * len(p)))
            for label, conf in ((1.0, p[new]), (0.0, 1 - p[new])):
                best = new[np.argsort(-conf, kind="stable")[:k]]
                sure = (p if label else 1 - p)[best] >= CONFIDENT
                other[best[sure]] = label
    scale, gain = [], []
    for v in range(2):
        z = labelled[v][cal] @ weights[v]
        a, c = platt(z, y[cal]) if cal.any() else (1.0, 0.0)
        scale.append((a, c))
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        null = 1 / (1 + np.exp(-base))
        loss = -np.mean(np.log(np.clip(np.where(y[cal] == 1, p, 1 - p), 1e-9, 1))) if cal.any() else 1.0
        worst = -np.mean(np.log(np.where(y[cal] == 1, null, 1 - null))) if cal.any() else 1.0
        gain.append(max(0.0, 1 - loss / max(worst, 1e-9)))
    total = sum(gain)
    return CoTrained(weights, scale, [g / total * min(1.0, 2 * max(gain) / total) if total else 0.5 for g in gain], base)


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.col("n_chars").cast("long").alias("n_chars"))


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    texts = list(text_bytes(batch.column(1)))
    meta = zip(texts, *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
    return [np.stack([content_view(t) for t in texts]), np.stack([metadata_view(*m) for m in meta])]


def fit(docs: DataFrame, labels: DataFrame, hold_out: bool = True, max_labelled: int = MAX_LABELLED,
        max_unlabelled: int = MAX_UNLABELLED) -> CoTrained | None:
    """Co-train on the sample; with ``hold_out``, labels of rows whose
    crc32(doc_id) mod 5 is 0 are not looked at. None without labels."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
    if hold_out:
        lab = lab.where(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) != 0)
    lab = lab.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    h = F.xxhash64("doc_id", F.lit(5))
    chosen = lab.orderBy(h, "doc_id").limit(max_labelled)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    if hold_out:
        ids = ids.where(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) != 0)
    free = ids.orderBy(h, "doc_id").limit(max_unlabelled).select("doc_id", F.lit(None).cast("int").alias("quality"))
    # Both samples are bounded by their parameters; a labelled row in both counts as labelled.
    wanted = chosen.unionByName(free).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = _columns(docs).join(F.broadcast(wanted), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                a, b = _views(part)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(5),
                                                  pa.array([x.astype(np.float16).tobytes() for x in a], pa.binary()),
                                                  pa.array([x.tobytes() for x in b], pa.binary())],
                                                 ["doc_id", "quality", "a", "b"])

    got = sorted(rows.mapInArrow(run, "doc_id long, quality int, a binary, b binary").collect(), key=lambda r: (r.doc_id, bytes(r.b)))
    known = [r for r in got if r.quality is not None]
    rest = [r for r in got if r.quality is None]
    if not known:
        return None

    def stack(part):
        return [np.stack([np.frombuffer(bytes(r.a), np.float16).astype(np.float32) for r in part]) if part else np.zeros((0, BUCKETS + 8), np.float32),
                np.stack([np.frombuffer(bytes(r.b), np.float32) for r in part]) if part else np.zeros((0, META), np.float32)]

    return cotrain(stack(known), np.array([r.quality for r in known], float), stack(rest))


def score_documents(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """One row per document: ``doc_id, score, content_score, metadata_score``.
    Null texts count as empty, null metadata as a value of its own. Without a
    model every score is 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                if m is None:
                    three = [np.full(part.num_rows, 0.5)] * 3
                else:
                    views = _views(part)
                    three = [m.score(views)] + [1 / (1 + np.exp(-np.clip(a * (x @ b) + c, -30, 30)))
                                                for x, b, (a, c) in zip(views, m.weights, m.scale, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(s.astype(np.float64)) for s in three]],
                                                 ["doc_id", "score", "content_score", "metadata_score"])

    return _columns(docs).mapInArrow(run, "doc_id long, score double, content_score double, metadata_score double")
