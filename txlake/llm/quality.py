"""Quality classifier: a byte-level convolutional network in numpy.

Network: ``FILTERS`` learned filters of ``WIDTH`` bytes move over the UTF-8 bytes
of a text in steps of ``STEP``; a filter's response is a sum of learned values,
one per (offset, byte).  The text is covered by overlapping chunks of two
``HALF``-byte halves (each half is the second of one chunk and the first of the
next).  Each filter is max-pooled over a chunk, a linear layer turns the pooled
responses into the chunk's logit, and the mean of the chunks' logits gives the
document's one probability.

Fit: on the driver, by Adam, on labelled rows that are not held out: at most
``MAX_FIT_ROWS`` in the order of a hash of their ids, admitted whole, whatever
their length, while ``MAX_FIT_BYTES`` lasts (a text that does not fit is passed
over, the next one may).  Both bounds are parameters.  Scoring
runs over whole texts of any length in blocks of ``BLOCK`` bytes; the model
(some 100 KB) travels with the tasks.  There is no shuffle.

Defined cases: null and empty texts are scored as one chunk of padding; null ids
are scored (their hash is that of an empty text); equal texts score alike; with
no labelled rows every score is 0.5; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from txlake.llm.common import doc_chunks, held_out, written

WIDTH, FILTERS, STEP = 6, 16, 2
HALF = 256
BLOCK = 1 << 19
FOLDS = 5
MAX_FIT_ROWS = 4_000
MAX_FIT_BYTES = 32 << 20
EPOCHS, BATCH, RATE = 10, 32, 0.01
THRESHOLD = 0.3


def padded(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each padded with at least ``WIDTH`` zero bytes to whole
    halves, and the number of halves of each."""
    raw = [b"" if t is None or t != t else t.encode("utf-8", "surrogatepass") for t in texts]
    halves = np.array([-(-(len(r) + WIDTH) // HALF) for r in raw], dtype=np.int64)
    data = b"".join(r + bytes(int(h) * HALF - len(r)) for r, h in zip(raw, halves, strict=True))
    return np.frombuffer(data, dtype=np.uint8), halves


def responses(table: np.ndarray, buf: np.ndarray, halves: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """(halves, positions, filters) responses of the bytes from ``first`` up to
    ``last``, both at halves.  A filter that would reach into the next text
    stands on padding alone and never responds."""
    last = len(buf) if last is None else min(last, len(buf))
    n = last - first
    tail = buf[first : last + WIDTH]
    tail = np.concatenate((tail, np.zeros(n + WIDTH - len(tail), dtype=np.uint8)))
    out = table[0][tail[0:n:STEP]]
    for k in range(1, WIDTH):
        out += table[k][tail[k : k + n : STEP]]
    out = out.reshape(-1, HALF // STEP, FILTERS)
    ends = np.cumsum(halves) - 1 - first // HALF  # the last half of each text
    out[ends[(ends >= 0) & (ends < len(out))], (HALF - WIDTH) // STEP + 1 :] = -np.inf
    return out


def chunk_rows(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second half of every chunk, and the text of every chunk."""
    n = np.maximum(halves - 1, 1)
    doc = np.repeat(np.arange(len(halves)), n)
    first = np.arange(int(n.sum())) + np.repeat(np.cumsum(halves) - halves - (np.cumsum(n) - n), n)
    second = np.where(np.repeat(halves, n) > 1, first + 1, first)
    return first, second, doc


class Network:
    def __init__(self, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.p = {
            "table": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, dtype=np.float32),
            "out": rng.normal(0, 0.3, FILTERS).astype(np.float32),
            "base": np.zeros(1, dtype=np.float32),
        }

    def logits(self, texts) -> np.ndarray:
        buf, halves = padded(texts)
        if not len(halves):
            return np.empty(0)
        top = np.concatenate(
            [responses(self.p["table"], buf, halves, i, i + BLOCK).max(axis=1) for i in range(0, len(buf), BLOCK)]
        )
        first, second, doc = chunk_rows(halves)
        pooled = np.maximum(np.maximum(top[first], top[second]) + self.p["bias"], 0)
        z = pooled @ self.p["out"] + self.p["base"]
        return np.bincount(doc, weights=z, minlength=len(halves)) / np.bincount(doc, minlength=len(halves))

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))

    def gradients(self, texts, y: np.ndarray) -> dict:
        p = self.p
        buf, halves = padded(texts)
        at, top = [], []
        for i in range(0, len(buf), BLOCK):  # long texts block by block
            r = responses(p["table"], buf, halves, i, i + BLOCK)
            at.append(r.argmax(axis=1))
            top.append(np.take_along_axis(r, at[-1][:, None, :], axis=1)[:, 0])
        at, top = np.concatenate(at), np.concatenate(top)
        first, second, doc = chunk_rows(halves)
        later = top[second] > top[first]
        half = np.where(later, second[:, None], first[:, None])
        pooled = np.maximum(top[first], top[second]) + p["bias"]
        h = np.maximum(pooled, 0)
        z = h @ p["out"] + p["base"]
        n = np.bincount(doc, minlength=len(halves))
        prob = 1 / (1 + np.exp(-np.clip(np.bincount(doc, weights=z) / n, -30, 30)))
        dz = ((prob - y) / len(y) / n)[doc].astype(np.float32)
        dh = dz[:, None] * p["out"] * (pooled > 0)
        where = half * HALF + np.take_along_axis(at[half.ravel()].reshape(*half.shape, FILTERS), np.arange(FILTERS)[None, :, None], axis=2)[:, :, 0] * STEP
        grad = np.zeros_like(p["table"])
        tail = np.concatenate((buf, np.zeros(WIDTH, dtype=np.uint8)))
        filters = np.broadcast_to(np.arange(FILTERS), where.shape)
        for k in range(WIDTH):  # only the winning positions carry a gradient
            flat = tail[where + k].astype(np.int64) * FILTERS + filters
            grad[k] = np.bincount(flat.ravel(), weights=dh.ravel(), minlength=256 * FILTERS).reshape(256, FILTERS)
        return {"table": grad, "bias": dh.sum(axis=0), "out": h.T @ dz, "base": dz.sum(keepdims=True)}

    def train(self, texts: list, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps = 0
        epochs = max(epochs, min(60, -(-epochs * 1_000 // max(1, len(texts)))))  # small samples: more passes
        total = epochs * -(-len(texts) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                part = order[i : i + BATCH]
                steps += 1
                rate = RATE * (1 - 0.9 * steps / total)
                for k, g in self.gradients([texts[j] for j in part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**steps)) / (np.sqrt(s[k] / (1 - 0.99**steps)) + 1e-8)).astype(np.float32)


def admitted(sizes, budget: int) -> list[int]:
    """Positions whose sizes fit the budget, taken in order."""
    out = []
    for i, n in enumerate(sizes):
        if n <= budget:
            out.append(i)
            budget -= n
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, max_bytes: int = MAX_FIT_BYTES) -> Network | None:
    """Network from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)"
    )
    known = known.where(~held_out(F.col("doc_id"), FOLDS)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # the documented bound
    sample = written(
        docs.where(F.col("text").isNotNull())
        .select("doc_id", "text", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("twin"))
        .join(F.broadcast(chosen), "doc_id"),
        "quality_sample",
    )
    order = [F.xxhash64("doc_id"), "doc_id", "twin"]
    sizes = sample.select("doc_id", "twin", "bytes").orderBy(*order).limit(max_rows).toPandas()  # numbers of the bounded sample
    fits = sizes.iloc[admitted(sizes["bytes"].tolist(), max_bytes)][["doc_id", "twin"]]
    if not len(fits):
        return None
    keys = docs.sparkSession.createDataFrame(fits.drop_duplicates(), "doc_id long, twin long")
    rows = (
        sample.join(F.broadcast(keys), ["doc_id", "twin"])
        .groupBy("doc_id", "twin")
        .agg(F.first("text").alias("text"), F.max("quality").alias("quality"))
        .toPandas()  # within both bounds
        .sort_values(["doc_id", "twin"])
    )
    if not len(rows):
        return None
    net = Network()
    net.train(rows["text"].tolist(), rows["quality"].to_numpy(dtype=np.float32))
    return net


def score_udf(net: Network | None):
    """Column function: text -> score."""

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if net is None:
            return pd.Series(np.full(len(texts), 0.5))
        pdf = pd.DataFrame({"text": texts.to_numpy()})
        parts = [net.scores(p["text"]) for p in doc_chunks(pdf, "text")]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_FIT_ROWS
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    score = score_udf(fit(docs, labels, max_rows))
    scored = docs.select("doc_id", score("text").alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def predicted(score: Column) -> Column:
    return (score >= THRESHOLD).cast("int")
