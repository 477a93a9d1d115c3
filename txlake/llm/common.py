"""Helpers shared by the training-data operators.

* ``words`` / ``word_spans``: the word rule of the package (runs of bytes that
  are not 0x20 or 0x09-0x0D, A-Z lower-cased), as a column and in numpy.
* ``span_hashes``: 64-bit hashes of all words of a block, vectorized.
* ``written``: an intermediate table in the folder of ``spark.checkpoint.dir``.
* ``buckets_for``: number of hash buckets from the measured size of an input.
* ``connected_components``: smallest reachable id by alternating star steps.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.sources import materialize

#: Word pattern for Java regular expressions; ``A-Z`` are lower-cased apart.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back."""
    return materialize(df, f"llm_{name}")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts: one column-pruned pass that shuffles one row a task."""
    n = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("n")).first()["n"]
    return int(n or 0)


def buckets_for(n_bytes: int, per_bucket: int, least: int = 12) -> int:
    return max(least, -(-n_bytes // per_bucket))


def held_out(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0 (a null id: crc32 of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def held_out_py(doc_ids, folds: int) -> np.ndarray:
    return np.array(
        [zlib.crc32(b"" if d is None or d != d else str(int(d)).encode()) % folds == 0 for d in doc_ids], dtype=bool
    )


# --- vectorized words --------------------------------------------------------


def joined(texts, fold: bool = True, gap: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of ``texts`` (null: empty) one after another, each followed by
    one ``gap`` byte, with the start and the length of each text."""
    raw = [b"" if t is None or t != t else t.encode("utf-8", "surrogatepass") for t in texts]
    lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    sep = bytes([gap])
    buf = np.frombuffer(sep.join(raw) + sep, dtype=np.uint8)
    starts = np.zeros(len(raw), dtype=np.int64)
    np.cumsum(lens[:-1] + 1, out=starts[1:]) if len(raw) else None
    return (FOLD[buf] if fold else buf), starts, lens


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``buf``, which ends with a space."""
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


_MULT = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mix of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Spans of more bytes are hashed one by one.
LONG_SPAN = 1024


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes (or of 32-bit code points), equal for
    equal content wherever it stands: eight bytes at a time are added to the state,
    which is mixed in between, all spans at once."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    raw = np.ascontiguousarray(buf).view(np.uint8)
    at = np.asarray(starts, dtype=np.int64) * buf.itemsize
    size = np.asarray(ends, dtype=np.int64) * buf.itemsize - at
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(raw) + 1,), strides=(1,))
    h = mix64(size.astype(np.uint64) + np.uint64(_MULT))
    for i in np.flatnonzero(size > LONG_SPAN):
        body = raw[at[i] : at[i] + size[i]].tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(body, digest_size=8).digest(), dtype="<u8")[0]
    left = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    k = 0
    while len(left):
        word = eights[at[left] + 8 * k]
        rest = size[left] - 8 * k
        spare = np.minimum(rest, 8).astype(np.uint64)
        word &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * spare)
        h[left] = mix64((h[left] ^ word) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k + 1))
        left = left[rest > 8]
        k += 1
    return h


def doc_chunks(pdf: pd.DataFrame, text_col: str, chunk_bytes: int = 1 << 19):
    """Slices of ``pdf`` whose texts hold about ``chunk_bytes`` (one text at
    least), so that the arrays of a slice stay bounded but for one long text."""
    size, first = 0, 0
    lens = [0 if t is None or t != t else len(t) for t in pdf[text_col]]
    for i, n in enumerate(lens):
        if size and size + n > chunk_bytes:
            yield pdf.iloc[first:i]
            size, first = 0, i
        size += n
    if first < len(lens):
        yield pdf.iloc[first:]


# --- components --------------------------------------------------------------


def _edge_state(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"]


def connected_components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(id, component) for every id of an edge, the component being the smallest
    id reachable.  Alternating large-star and small-star steps; each step takes
    the minimum of a node's neighbours by a pre-aggregated group, joins it back
    (a hub's edges are split by the skew join) and is written to the shared
    folder, so no node's neighbours are ever gathered in one task."""

    def star(e: DataFrame) -> DataFrame:
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined_ = large.join(low2, "u")
        return (
            joined_.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )

    e = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), f"{name}_edges"
    )
    state = _edge_state(e)
    while state[0]:
        e = written(star(e), f"{name}_star")
        new = _edge_state(e)
        if new == state:
            break
        state = new
    low = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return low.select(F.col("u").alias("id"), "component").union(roots)
