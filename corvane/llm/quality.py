"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network on features of whole texts (shares of
character classes, shapes, repetition, hashed words and hashed three-byte grams) by
minimising the non-negative unbiased risk ``prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)])``.
The prior, the share of positives among unlabelled texts, is estimated from the data: for every
set A, prior <= P_u(A) / P_p(A), and the least such ratio over the score tails of a plain
positive-against-unlabelled fit on the surface features is taken. Negative labels are never used.

Training reads at most ``positives`` and ``unlabelled`` distinct ids, those of least hash (of rows sharing
an id, one text); scores are computed for every row from its whole text. Null and empty texts are texts
without words; very long texts count whole; equal texts have equal scores. Without positives every score is 0.5; an empty
table gives no rows. An input column called like the score (``name``) is replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corvane.llm._arrow import Words, arrays, mix, release, slices, spans
from corvane.llm._spark import sample

_CLASS = np.full(256, 15, np.int64)
for _i, _own in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".", ",", "!", "?;:", "#$%&*", "|", "\"'()", "-_/", "<>{}[]=+@^~`\\")):
    _CLASS[[ord(c) for c in _own]] = _i
_CLASS[0x80:] = 14
N_CLASSES = 16
#: Buckets of hashed words and of hashed three-byte grams, after SURFACE features.
SURFACE, WORDS, GRAMS = 57, 128, 64
HASHED = 0.1


def _per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(h[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], float)


def features(texts: pa.Array) -> np.ndarray:
    """One row a text: shares of character classes, word shapes, repetition of words, phrases and lines."""
    w = Words(texts)
    n_docs, size = len(texts), np.diff(w.bounds)
    owner = np.repeat(np.arange(n_docs), size)
    kinds = _CLASS[w.raw]
    shares = np.bincount(owner * N_CLASSES + kinds, minlength=n_docs * N_CLASSES).reshape(n_docs, N_CLASSES) / np.maximum(1, size)[:, None]
    n = np.diff(w.first)
    per = np.maximum(1, n)
    lengths = (w.end - w.start).astype(float)
    head, tail = kinds[w.start], kinds[w.end - 1] if len(w) else kinds[:0]
    same = np.zeros(len(w), bool)
    if len(w):
        same[1:] = w.hash[1:] == w.hash[:-1]
        same[w.first[:-1][n > 0]] = False
    mean = _per_doc(lengths, w.first) / per
    cols = [np.log1p(n), np.log1p(size), mean / 10, np.sqrt(np.maximum(0, _per_doc(lengths**2, w.first) / per - mean**2)) / 10]
    cols += [_per_doc(x, w.first) / per for x in (lengths <= 3, lengths >= 12, lengths >= 25, head == 0, head == 9, tail == 5, tail == 6, tail == 7, tail == 9, tail == 10, tail == 2, same, lengths == 1)]
    cols.append(_distinct(w.hash, w.first) / per)
    gram = 3
    count = np.maximum(0, n - gram + 1)
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - w.first[:-1], count)
    cols.append(_distinct(mix(spans(w.hash, at, at + gram, "word")), first) / np.maximum(1, count))
    # Lines: the words between line breaks, hashed whole.
    if len(w):
        breaks = np.concatenate([[0], np.cumsum(kinds == 4)])
        line = breaks[w.start]
        begin = np.ones(len(w), bool)
        begin[1:] = line[1:] != line[:-1]
        begin[w.first[:-1][n > 0]] = True
        at = np.flatnonzero(begin)
        bounds = np.searchsorted(at, w.first)
        end = np.concatenate([at[1:], [len(w)]])
        line_hash = mix(spans(w.hash, at, end, "alt"))
        n_lines = np.maximum(1, np.diff(bounds))
        words = (end - at).astype(float)
        ended = np.isin(kinds[w.end[end - 1] - 1], (5, 7, 8))
        cols += [np.log1p(np.diff(bounds)), np.log1p(_per_doc(words, bounds) / n_lines), _distinct(line_hash, bounds) / n_lines, _per_doc(ended, bounds) / n_lines, _per_doc(words <= 3, bounds) / n_lines]
    else:
        cols += [np.zeros(n_docs)] * 5
    surface = np.column_stack([shares, np.sqrt(shares), *cols])
    bag = np.bincount(w.doc() * WORDS + (w.hash % np.uint64(WORDS)).astype(np.int64), minlength=n_docs * WORDS).reshape(n_docs, WORDS) / per[:, None]
    low = np.where((w.raw >= 65) & (w.raw <= 90), w.raw + 32, w.raw).astype(np.uint32)
    three = ((low[:-2] * np.uint32(0x9E3779B1)) ^ (low[1:-1] * np.uint32(0x85EBCA77)) ^ (low[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F) >> np.uint32(16)
    inner = owner[2:] == owner[:-2]
    grams = np.bincount((owner[:-2] * GRAMS + (three % np.uint32(GRAMS)).astype(np.int64))[inner], minlength=n_docs * GRAMS).reshape(n_docs, GRAMS) / np.maximum(1, size - 2)[:, None]
    return np.nan_to_num(np.column_stack([surface, np.sqrt(bag), np.sqrt(grams)])).astype(np.float32)


class Net:
    """Features to score: standardise, one tanh layer, one logit.

    The many hashed features weigh ``HASHED`` times as much as the few surface features, so that they decide where
    much is learned from and do not drown the others where little is.
    """

    def __init__(self, x: np.ndarray, hidden: int, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = x.mean(0, dtype=float), x.std(0, dtype=float) + 1e-3
        self.scale[SURFACE:] /= HASHED
        d = x.shape[1]
        self.w = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.state = [(np.zeros_like(p), np.zeros_like(p)) for p in self.w]
        self.t = 0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        self.z, self.h = z, np.tanh(z @ self.w[0] + self.w[1])
        return self.h @ self.w[2] + self.w[3][0]

    def step(self, slope: np.ndarray, rate: float, decay: float) -> None:
        """One Adam step along the risk's slope in each row's logit (rows of the last call to logit)."""
        back = slope[:, None] * self.w[2] * (1 - self.h**2)
        grads = [self.z.T @ back, back.sum(0), self.h.T @ slope, np.array([slope.sum()])]
        self.t += 1
        for i, g in enumerate(grads):
            g = g + decay * self.w[i]
            m, v = self.state[i]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.state[i] = (m, v)
            self.w[i] = self.w[i] - rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def class_prior(p: np.ndarray, u: np.ndarray, seed: int = 5, splits: int = 3) -> float:
    """The share of positives among rows of u, given rows of positives p: a lower bound by one standard error.

    Too high a prior lets a whole kind of bad text pass, too low a one costs few positives, so
    the least of several estimates, each on rows that its fit has not seen, is taken less its error.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    least = 1.0
    for _ in range(splits):
        side_p, side_u = rng.random(len(p)) < 0.5, rng.random(len(u)) < 0.5
        for a, b in ((side_p, side_u), (~side_p, ~side_u)):
            if not a.any() or a.all() or not b.any() or b.all():
                continue
            x, y = np.concatenate([p[a], u[b]]), np.concatenate([np.ones(a.sum()), np.zeros(b.sum())])
            net = Net(x, 16, seed)
            weight = np.where(y == 1, 0.5 / a.sum(), 0.5 / b.sum())
            for _ in range(150):
                net.step((sigmoid(net.logit(x)) - y) * weight, 0.02, 1e-3)
            sp, su = net.logit(p[~a]), net.logit(u[~b])
            cut = np.quantile(sp, np.linspace(0.02, 0.4, 20))
            tail_p, tail_u = (sp[None, :] >= cut[:, None]).mean(1), (su[None, :] >= cut[:, None]).mean(1)
            error = np.sqrt(tail_u * (1 - tail_u) / len(su) + tail_p * (1 - tail_p) / len(sp))
            least = min(least, float(np.min((tail_u - error) / tail_p)))
    return float(np.clip(least, 0.05, 0.98))


def train(p: np.ndarray, u: np.ndarray, prior: float, hidden: int = 32, epochs: int = 60, batch: int = 512, seed: int = 11) -> Net:
    """Minimises the non-negative risk with logistic loss; where the negative part turns below zero its slope is reversed."""
    rng = np.random.Generator(np.random.PCG64(seed))
    net = Net(np.concatenate([p, u]), hidden, seed)
    steps = max(4, len(u) // batch)
    for epoch in range(epochs):
        for _ in range(steps):
            a, b = p[rng.integers(0, len(p), batch)], u[rng.integers(0, len(u), batch)]
            g = net.logit(np.concatenate([a, b]))
            s = sigmoid(g)
            negative = np.mean(np.logaddexp(0, g[batch:])) - prior * np.mean(np.logaddexp(0, g[:batch]))
            plus, minus = np.zeros(2 * batch), np.zeros(2 * batch)
            plus[:batch] = prior * (s[:batch] - 1) / batch
            minus[:batch], minus[batch:] = -prior * s[:batch] / batch, s[batch:] / batch
            net.step(plus + minus if negative >= 0 else -minus, 0.01 if epoch < epochs * 0.7 else 0.003, 1e-4)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from: crc32 of the id as text leaves 1 modulo 3; rows without an id too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        x = features(b["text"])
        yield pa.RecordBatch.from_arrays([b["positive"], arrays(x.ravel(), np.arange(len(x) + 1) * x.shape[1])], ["positive", "x"])


def _gathered(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The features of positive and of unlabelled rows, as they came over Arrow: four bytes each, for the driver's memory is small.

    Rows come in any order; a fixed order makes the fit the same each time.
    """
    got = rows.toArrow().combine_chunks()
    if not got.num_rows:
        return np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32)
    x = pc.list_flatten(got["x"]).to_numpy().reshape(got.num_rows, -1)
    positive = got["positive"].to_numpy()
    p, u = (x[np.flatnonzero(positive == flag)] for flag in (True, False))
    return tuple(y[np.lexsort(y.T[::-1])] if len(y) else y for y in (p, u))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", positives: int = 6000, unlabelled: int = 8000) -> Net | None:
    """The network trained on a bounded sample of docs; None without positives or texts."""
    learn = ~held_out(F.col(doc_id))
    good = sample(labels.where(learn & (F.col(label) == 1)).select(doc_id), positives).withColumn("positive", F.lit(True))
    any_ = sample(docs.where(learn).select(doc_id), unlabelled).withColumn("positive", F.lit(False))
    # Both samples are bounded by the two parameters, so they may be broadcast; one text an id bounds what is gathered.
    texts = docs.select(doc_id, F.col(text).cast("string").alias("text")).join(F.broadcast(good.unionByName(any_)), doc_id)
    texts = texts.groupBy(doc_id, "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("positive", "text")
    p, u = _gathered(texts.mapInArrow(_features, "positive boolean, x array<float>"))
    if not len(p) or not len(u):
        return None
    net = train(p, u, class_prior(p[:, :SURFACE], u[:, :SURFACE]))
    del p, u
    release()
    return net


def score(docs: DataFrame, net: Net | None, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the score (``name``), 0 to 1, higher where a positive is likelier."""
    docs = docs.drop(name)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            s = np.full(b.num_rows, 0.5) if net is None else sigmoid(net.logit(features(b[text])))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*names, name])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, DoubleType())]))
