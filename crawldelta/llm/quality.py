"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.scratch import ship_code, stored

#: Bytes of a chunk and from one chunk to the next; every byte lies in a chunk.
CHUNK = 512
STEP = 448

#: Bytes that a filter sees, and the number of filters.
WIDTH = 6
FILTERS = 16

#: The classifier is fitted on at most this many labelled rows, and on at most
#: this many chunks of each, spread evenly over the whole text.
TRAIN_ROWS = 6000
TRAIN_CHUNKS = 6
EPOCHS = 10

#: Rows with this score or more are predicted to be of label 1.
THRESHOLD = 0.3

#: A byte that ends six bytes seen just before, up to this far back, is read as this symbol.
REPEATED = 256
FARTHEST = 32
_SYMBOLS = 257
_RUN = 6


def symbols(raw: bytes) -> np.ndarray:
    """The bytes as symbols; those that repeat what stands just before become one symbol of their own."""
    b = np.frombuffer(raw, np.uint8)
    out = b.astype(np.int32)
    for lag in range(2, min(FARTHEST, len(b) - _RUN) + 1):
        same = b[lag:] == b[:-lag]
        if len(same) < _RUN:
            break
        two = same[1:] & same[:-1]
        six = two[4:] & two[2:-2] & two[:-4]
        out[lag + _RUN - 1 :][six] = REPEATED
    return out


def chunk_starts(n: int) -> np.ndarray:
    """First symbols of the overlapping chunks of a text of n symbols."""
    return np.arange(0, max(1, n - (CHUNK - STEP)), STEP)


@dataclass
class Network:
    """taps[k, symbol, filter], bias[filter], weights of the pooled filters (mean over chunks, then maximum), and the constant."""

    taps: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    constant: float

    def pairs(self) -> list[np.ndarray]:
        """Taps joined two and two, so that a filter needs half as many look-ups."""
        t = self.taps
        return [(t[k][:, None] + t[k + 1][None]).reshape(-1, t.shape[2]) for k in range(0, WIDTH, 2)]

    def pooled(self, text: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
        """Mean and maximum over all chunks of each chunk's largest activations; zeros for a text shorter than a filter."""
        width = self.taps.shape[2]
        starts = chunk_starts(len(text))
        total, top = np.zeros(width), np.zeros(width)
        group = 256
        for first in range(0, len(starts), group):
            low = starts[first]
            high = min(len(text), starts[min(first + group, len(starts)) - 1] + CHUNK)
            part = text[low:high]
            n = len(part) - WIDTH + 1
            if n <= 0:
                continue
            index = part[:-1] * _SYMBOLS + part[1:]
            act = pairs[0].take(index[:n], axis=0)
            for k in range(1, WIDTH // 2):
                act += pairs[k].take(index[2 * k : 2 * k + n], axis=0)
            begin = starts[first : first + group] - low
            begin = begin[begin < n]
            # Largest activation between two chunk starts, and within the overlap after each.
            body = np.maximum.reduceat(act, begin, axis=0)
            over = np.stack([act[b + STEP : b + CHUNK - WIDTH + 1].max(0, initial=-np.inf) for b in begin])
            peak = np.maximum(np.maximum(body, over) + self.bias, 0)
            total += peak.sum(0)
            top = np.maximum(top, peak.max(0))
        return np.concatenate((total / len(starts), top))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """One probability of label 1 for each whole text; null and empty texts get the network's constant."""
        pairs = self.pairs()
        found = np.zeros((len(texts), 2 * self.taps.shape[2]))
        for i, text in enumerate(texts):
            found[i] = self.pooled(symbols((text or "").encode("utf-8", "surrogatepass")), pairs)
        return 1 / (1 + np.exp(-(found @ self.weights + self.constant)))


def _forward(chunks: np.ndarray, taps: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest activation of each filter in each chunk, and where it is. Padding is symbol -1."""
    n = chunks.shape[1] - WIDTH + 1
    act = np.zeros((len(chunks), n, taps.shape[2]), np.float32)
    padded = np.concatenate((taps, np.zeros((WIDTH, 1, taps.shape[2]), np.float32)), 1)
    for k in range(WIDTH):
        act += padded[k].take(chunks[:, k : k + n], axis=0)
    act[chunks[:, WIDTH - 1 :] < 0] = -np.inf
    where = act.argmax(1)
    best = np.take_along_axis(act, where[:, None], 1)[:, 0]
    return np.where(np.isfinite(best), best + bias, 0).astype(np.float32), where


def fit(samples: list[tuple[list[bytes], int]], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit by Adam on (chunks of one document, label). Without both labels, every score is the share of label 1, or one without rows."""
    rng = np.random.default_rng(seed)
    taps = rng.normal(0, 0.3, (WIDTH, _SYMBOLS, FILTERS)).astype(np.float32)
    labels = np.array([y for _, y in samples], np.float32)
    rate = float(labels.mean()) if len(labels) else 1.0
    odds = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    if not 0 < rate < 1:
        return Network(np.zeros_like(taps), np.zeros(FILTERS), np.zeros(2 * FILTERS), odds)
    docs = []
    for chunks, _ in samples:
        m = np.full((len(chunks), CHUNK), -1, np.int32)
        for i, c in enumerate(chunks):
            s = symbols(c)[:CHUNK]
            m[i, : len(s)] = s
        docs.append(m)
    params = [taps, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), np.array([odds], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for low in range(0, len(order), 48):
            some = order[low : low + 48]
            x = np.concatenate([docs[i] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(docs[i]) for i in some])
            counts = np.bincount(owner, minlength=len(some))[:, None]
            begin = np.concatenate(([0], np.cumsum(counts[:-1, 0])))
            raw, where = _forward(x, params[0], params[1])
            peak = np.maximum(raw, 0)
            mean = np.add.reduceat(peak, begin) / counts
            top = np.maximum.reduceat(peak, begin)
            pooled = np.concatenate((mean, top), 1)
            p = 1 / (1 + np.exp(-(pooled @ params[2] + params[3][0])))
            off = (p - labels[some]) / len(some)
            back = off[:, None] * params[2]
            first = peak >= top[owner]
            into = (back[owner, :FILTERS] / counts[owner] + back[owner, FILTERS:] * first) * (raw > 0)
            grads = [np.zeros_like(params[0]), into.sum(0), pooled.T @ off + 1e-4 * params[2], np.array([off.sum()], np.float32)]
            rows, cols = np.nonzero(into)
            for k in range(WIDTH):
                seen = x[rows, where[rows, cols] + k]
                np.add.at(grads[0][k], (np.maximum(seen, 0), cols), np.where(seen >= 0, into[rows, cols], 0))
            grads[0] += 1e-5 * params[0]
            step += 1
            rate_now = 0.02 * (1 - 0.9 * epoch / epochs)
            for i, g in enumerate(grads):
                m, v = moments[i]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[i] -= rate_now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    return Network(params[0], params[1], params[2].astype(float), float(params[3][0]))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True for the rows whose label is never learnt: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Up to TRAIN_CHUNKS chunks of each text, the first and the last among them."""
    for pdf in batches:
        rows = []
        for text, label in zip(pdf["text"], pdf["quality"]):
            raw = (text or "").encode("utf-8", "surrogatepass")
            starts = chunk_starts(len(raw))
            pick = np.unique(np.linspace(0, len(starts) - 1, min(TRAIN_CHUNKS, len(starts))).round().astype(int))
            rows.append(([raw[s : s + CHUNK] for s in starts[pick]], int(label)))
        yield pd.DataFrame(rows, columns=["chunks", "quality"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Network:
    """Fit on labelled rows that are not held out: a bounded sample in the order of a hash of doc_id.

    Labels that are null or of unknown documents are left out; a document with
    several labels counts as 1 if any is.
    """
    ship_code(docs.sparkSession)
    usable = labels.where("doc_id is not null and quality is not null").where(~held_out())
    known = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "text", "quality")
    chunks = rows.select("text", "quality").mapInPandas(_spread, "chunks array<binary>, quality int")
    found = sorted(((list(map(bytes, r[0])), r[1]) for r in chunks.collect()), key=lambda s: (s[0], s[1]))
    return fit(found)


def scorer(docs: DataFrame, labels: DataFrame) -> Callable[[Column], Column]:
    """A function of the text column that gives the probability of label 1 for the whole text. Other columns play no part."""
    network = train(docs, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(network.scores(texts.tolist()))

    return score


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts get a score too; repeated rows the same one; a null
    doc_id counts as not held out; an empty table gives an empty one.
    """
    scored = docs.select("doc_id", scorer(docs, labels)(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be of label 1, columns unchanged."""
    return docs.where(scorer(docs, labels)(F.col("text")) >= THRESHOLD)
