"""Quality classifier: a byte-level convolutional network in numpy.

Each filter looks at WIDTH neighbouring bytes and adds one learned weight per
place and byte value (a convolution over one-hot bytes). Its responses are
max-pooled over chunks of CHUNK positions that overlap by half and together
cover the whole document. The pooled responses, rectified, are averaged over
the chunks and maximised over them; a logistic unit turns both into one
probability. Nothing but the bytes of the text goes in.

Learning reads a bounded, balanced sample: about ``per_class`` labelled
documents of each class of at most MAX_TRAIN_BYTES each, picked by a hash of
the id; the bias is then set back to the classes' true shares. Scoring reads
whole texts, a segment at a time. For scoring, the weights of two neighbouring
places are added up in a table by byte pair.

Results for odd input: null and empty texts score as a document of padding; a
null id is never learned from and is not held out; null labels teach nothing.
Without labels of both classes every text scores the share of label 1 (0.5
without any). Repeated rows score alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, sample_fraction, text_of

WIDTH, FILTERS = 4, 16
HALF = 128           # positions in half a chunk
CHUNK = 2 * HALF
SEGMENT = 256 * HALF  # positions scored at a time
MAX_TRAIN_BYTES = 1 << 16


def to_bytes(text: str) -> np.ndarray:
    data = text.encode("utf-8", "replace")
    return np.frombuffer(data + bytes(max(WIDTH - len(data), 0)), np.uint8)


def _pool(halves: np.ndarray) -> np.ndarray:
    """Chunk maxima from those of half chunks."""
    return np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves


@dataclass
class Net:
    conv: np.ndarray   # WIDTH x 256 x FILTERS
    bias: np.ndarray   # FILTERS
    mean: np.ndarray   # weights of the chunk averages
    peak: np.ndarray   # weights of the chunk maxima
    const: float

    def halves(self, b: np.ndarray, pairs=None) -> np.ndarray:
        """Largest response of each filter in each half chunk."""
        first, second = pairs or self.pairs()
        n, out = len(b) - WIDTH + 1, []
        for at in range(0, n, SEGMENT):
            part = b[at:at + SEGMENT + WIDTH - 1].astype(np.uint16)
            two = (part[:-1] << 8) | part[1:]
            z = first[two[:len(part) - WIDTH + 1]]
            z += second[two[2:len(part) - WIDTH + 3]]
            out.append(np.maximum.reduceat(z, np.arange(0, len(z), HALF), axis=0))
        return np.concatenate(out) + self.bias

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        c = self.conv
        return tuple(np.ascontiguousarray((c[i][:, None, :] + c[i + 1][None, :, :])
                                          .reshape(65536, FILTERS)) for i in (0, 2))

    def logit(self, chunks: np.ndarray) -> float:
        a = np.maximum(chunks, 0)
        return float(self.mean @ a.mean(axis=0) + self.peak @ a.max(axis=0) + self.const)

    def score(self, text: str, pairs=None) -> float:
        x = self.logit(_pool(self.halves(to_bytes(text), pairs)))
        return float(1 / (1 + np.exp(-np.clip(x, -60, 60))))


def constant(share: float) -> Net:
    p = min(max(share, 1e-6), 1 - 1e-6)
    return Net(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32),
               np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32),
               float(np.log(p / (1 - p))))


def train(texts: list[str], labels: list[int], share: float, epochs: int = 6,
          rate: float = 0.02, seed: int = 11) -> Net:
    """Adam on the logistic loss, 16 documents a step; gradients flow through
    the position that won each pool. ``share``: true share of label 1."""
    if len(set(labels)) < 2:
        return constant(share)
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
              np.zeros(FILTERS, np.float32),
              rng.normal(0, 0.3, FILTERS).astype(np.float32),
              rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)
    docs = [to_bytes(t) for t in texts]
    params = [net.conv, net.bias, net.mean, net.peak, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    filters, step = np.arange(FILTERS), 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), 16):
            grads = [np.zeros_like(p) for p in params]
            batch = order[at:at + 16]
            for i in batch:
                b = docs[i]
                n = len(b) - WIDTH + 1
                z = sum(net.conv[j][b[j:j + n]] for j in range(WIDTH))
                starts = np.arange(0, n, HALF)
                padded = np.full((len(starts) * HALF, FILTERS), -np.inf, np.float32)
                padded[:n] = z
                won = padded.reshape(len(starts), HALF, FILTERS).argmax(axis=1) \
                    + starts[:, None]
                halves = z[won, filters] + net.bias
                chunks = _pool(halves)
                if len(halves) > 1:
                    won = np.where(halves[:-1] >= halves[1:], won[:-1], won[1:])
                a = np.maximum(chunks, 0)
                x = net.mean @ a.mean(axis=0) + net.peak @ a.max(axis=0) + params[4][0]
                d = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - labels[i]
                grads[2] += d * a.mean(axis=0)
                grads[3] += d * a.max(axis=0)
                grads[4] += d
                g = np.repeat((d * net.mean / len(a))[None], len(a), axis=0)
                g[a.argmax(axis=0), filters] += d * net.peak
                g = np.where(chunks > 0, g, 0).astype(np.float32)
                grads[1] += g.sum(axis=0)
                for j in range(WIDTH):
                    np.add.at(grads[0][j], (b[won + j], np.broadcast_to(filters, won.shape)), g)
            step += 1
            for k, p in enumerate(params):
                g = grads[k] / len(batch)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p -= (rate * (first[k] / (1 - 0.9 ** step))
                      / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-6)).astype(np.float32)
    seen = min(max(float(np.mean(labels)), 1e-6), 1 - 1e-6)
    true = min(max(share, 1e-6), 1 - 1e-6)
    net.const = float(params[4][0]) + float(np.log(true / (1 - true)) - np.log(seen / (1 - seen)))
    return net


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 600,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Net:
    """Learn from labelled documents for whose id (column ``id``) ``learn`` holds."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")) \
        .filter("id is not null and y is not null").filter(learn)
    counts = {r["y"]: r["n"] for r in
              known.filter("y in (0, 1)").groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    if len(counts) < 2:
        return constant(share)
    part = F.when(F.col("y") == 1, min(1.0, per_class / counts[1])) \
        .otherwise(min(1.0, per_class / counts[0]))
    picked = known.filter("y in (0, 1)").filter(sample_fraction(part, "id")).distinct() \
        .limit(4 * per_class)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")) \
        .filter(F.octet_length("t") <= MAX_TRAIN_BYTES)
    rows = sorted((r["id"], r["y"], r["t"]) for r in
                  texts.join(F.broadcast(picked), "id").limit(8 * per_class).collect())
    return train([t for _, _, t in rows], [y for _, y, _ in rows], share)


def predict(docs: DataFrame, net: Net, text_col: str = "text",
            score_out: str = "score") -> DataFrame:
    """Append the probability of label 1 to every row."""
    def start():
        pairs = net.pairs()
        return lambda texts: [[net.score(t.as_py(), pairs) for t in texts]]

    return map_columns(docs, [text_of(text_col)], start,
                       [T.StructField(score_out, T.DoubleType(), False)])
