"""Language identification by a byte convolutional network (numpy).

A text is cut into windows of ``WINDOW`` UTF-8 bytes (A-Z lower-cased; the last
one padded with 0). Filters of several widths slide over a window's bytes:
since a byte is one-hot, a filter's response at a position is a sum of one
weight per byte under it. Each filter keeps its maximum over the window (after
a rectifier), and a softmax layer turns the maxima into language
probabilities. A document's probabilities are the normalised products over all
its windows (mean of the logs), so whole texts count.

Training: windows of a bounded sample of labelled documents (``SAMPLE`` a
language, the ones with the smallest hashes of the id in ``SAMPLE`` buckets;
``SAMPLE_WINDOWS`` evenly spaced windows of each), Adam, cross-entropy, on the
driver. Everything else sees every byte of every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_crc, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE, SAMPLE_WINDOWS = 256, 4
EPOCHS, BATCH, RATE = 12, 64, 0.01
#: A prediction for texts that are null or have no letter.
UNDETERMINED = "und"

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows x size bytes, start of each text's windows; one more entry than texts)."""
    n = [-(-len(t) // size) for t in texts]
    buf = b"".join(t.translate(_LOWER).ljust(k * size, b"\0") for t, k in zip(texts, n, strict=True))
    return np.frombuffer(buf, np.uint8).reshape(-1, size), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


@dataclass
class ByteCNN:
    langs: list[str]
    filters: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray  # (filters of all widths, languages)
    out_bias: np.ndarray

    def pooled(self, x: np.ndarray, where: bool = False):
        """Maxima of the filter responses of each window (and their positions)."""
        parts, at = [], []
        for k, w in self.filters.items():
            n = x.shape[1] - k + 1
            r = w[0][x[:, :n]]
            for j in range(1, k):
                r += w[j][x[:, j:j + n]]
            if where:
                at.append(r.argmax(1))
            parts.append(np.maximum(r.max(1) + self.bias[k], 0))
        return (np.concatenate(parts, 1), at) if where else np.concatenate(parts, 1)

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x) @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> ByteCNN:
    """Fit on windows ``x`` with language numbers ``y``; languages weigh equally."""
    g = np.random.default_rng(seed)
    net = ByteCNN(langs, {k: (g.standard_normal((k, 256, FILTERS)) * 0.1).astype(np.float32) for k in WIDTHS},
                  {k: np.zeros(FILTERS, np.float32) for k in WIDTHS},
                  (g.standard_normal((len(WIDTHS) * FILTERS, len(langs))) * 0.1).astype(np.float32),
                  np.zeros(len(langs), np.float32))
    share = np.bincount(y, minlength=len(langs))
    weight = (len(y) / np.maximum(share, 1) / max((share > 0).sum(), 1)).astype(np.float32)
    params = [*net.filters.values(), *net.bias.values(), net.out, net.out_bias]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = g.permutation(len(x))
        for a in range(0, len(x), BATCH):
            pick = order[a:a + BATCH]
            xb, yb = x[pick], y[pick]
            h, at = net.pooled(xb, where=True)
            z = h @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = p.copy()
            d[np.arange(len(yb)), yb] -= 1
            d *= weight[yb][:, None] / len(yb)
            dh = (d @ net.out.T) * (h > 0)
            grads_f, grads_b = [], []
            rows, cols = np.arange(len(yb))[:, None], np.arange(FILTERS)[None, :]
            for i, k in enumerate(net.filters):
                part = dh[:, i * FILTERS:(i + 1) * FILTERS]
                gf = np.zeros_like(net.filters[k])
                for j in range(k):
                    np.add.at(gf[j], (xb[rows, at[i] + j], np.broadcast_to(cols, at[i].shape)), part)
                grads_f.append(gf)
                grads_b.append(part.sum(0))
            t += 1
            for q, grad, mi, vi in zip(params, [*grads_f, *grads_b, h.T @ d, d.sum(0)], m, v, strict=True):
                mi += 0.1 * (grad - mi)
                vi += 0.001 * (grad * grad - vi)
                q -= RATE * (mi / (1 - 0.9 ** t)) / (np.sqrt(vi / (1 - 0.999 ** t)) + 1e-8)
    return net


def fit(docs: DataFrame, lang_col: str = "lang", hold_out: bool = True, sample: int = SAMPLE) -> ByteCNN | None:
    """Train on the sample; with ``hold_out``, rows whose crc32(doc_id) mod 3 is
    1 are not looked at. None when no labelled text remains."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND lang IS NOT NULL AND text != ''")
    if hold_out:
        d = d.where(F.pmod(id_crc(F.col("doc_id")), F.lit(3)) != 1)
    h = F.xxhash64("doc_id", F.lit(11))
    chosen = d.groupBy("lang", F.pmod(h, F.lit(sample)).alias("bucket")).agg(F.min(h).alias("h")).select("lang", "h")
    # At most ``sample`` rows a language, each of which gives SAMPLE_WINDOWS windows: a bounded amount.
    n = F.ceil(F.octet_length("text") / F.lit(WINDOW))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda i: F.floor(
        i * F.greatest(n - 1, F.lit(0)) / F.lit(SAMPLE_WINDOWS - 1)).cast("int")))
    rows = (d.withColumn("h", h).join(F.broadcast(chosen), ["lang", "h"])
            .select("lang", "h", F.explode(starts).alias("w"), F.encode("text", "utf-8").alias("b"))
            .select("lang", "h", "w", F.substring("b", F.col("w") * WINDOW + 1, F.lit(WINDOW)).alias("b"))
            .distinct().orderBy("lang", "h", "w").collect())
    if not rows:
        return None
    langs = sorted({r.lang for r in rows})
    x, _ = windows([bytes(r.b) for r in rows])
    return train(x, np.array([langs.index(r.lang) for r in rows]), langs)


#: Windows held expanded at a time inside a task.
_STEP = 256


def classify(texts: list[str], net: ByteCNN | None) -> list[tuple[str, float]]:
    """(language, probability) of each text."""
    out = [(UNDETERMINED, 0.0)] * len(texts)
    some = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    if not some or net is None:
        return out
    x, start = windows([texts[i].encode() for i in some])
    logs = np.concatenate([net.log_probs(x[a:a + _STEP]) for a in range(0, len(x), _STEP)])
    mean = np.add.reduceat(logs, start[:-1], axis=0) / np.diff(start)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    for i, row in zip(some, p, strict=True):
        k = int(row.argmax())
        out[i] = (net.langs[k], float(row[k]))
    return out


def predict(docs: DataFrame, net: ByteCNN | None) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``. Null texts and texts
    without a letter, and every text when nothing could be learned, are ``und``
    with score 0. Columns other than id and text are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                got = classify(part.column(1).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g[0] for g in got], pa.string()),
                                                  pa.array([g[1] for g in got], pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
