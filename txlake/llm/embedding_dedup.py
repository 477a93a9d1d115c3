"""Embedding near-duplicates through a pivot-permutation index.

Index: about 2 * sqrt(n) reference vectors (pivots) are drawn from the distinct
vectors by hash, a sample bounded by ``MAX_PIVOT_BYTES``, and thinned until no
two are closer than ``SPREAD``, so a dense group keeps a pivot or a few, whatever
its size.  Every vector names, nearest first, its ``PREFIX`` nearest pivots and
all that are about as near as the nearest (by 1 - threshold), more where pivots
are dense; pivots much farther than the nearest (by twice that) are left out.
The inverted list of a pivot holds the vectors that name it.  Retrieval: two
vectors meet when they share a pivot; lists longer than ``BLOCK`` are cut into
blocks and met block by block, and a pair counts at its smallest shared pivot
only.  Verification: cosine in double precision, of all pairs that meet.  Tasks
return sums of links and a spanning forest of each block, never the pairs of a
group.  Equal vectors are collapsed to one class first, so copies cost one row.

Recall of links against brute force is measured in the tests, for isolated pairs
at the threshold and inside a group that holds a third of the rows.  The cosines
inside such a group grow with the square of its size, as its links do.

Defined cases: null, empty and zero vectors, and vectors with null or
non-finite components, link with nothing; vectors of different lengths do not
link; a null id links with nothing, with a null component (kept); repeated rows
of one id are one vector; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import connected_components, written

PREFIX = 10
#: Cosine above which a drawn pivot is dropped for one drawn before it.
SPREAD = 0.7
#: Vectors of a block; lists of more than WIDE blocks are cut into larger ones.
BLOCK, WIDE = 1024, 8
MAX_PIVOT_BYTES = 256 << 20


def thinned(pivots: np.ndarray, spread: float) -> np.ndarray:
    """The pivots, in order, that are no closer than ``spread`` to one kept before."""
    kept = np.empty_like(pivots)
    n = 0
    for p in pivots:
        if not n or (kept[:n] @ p).max() <= spread:
            kept[n] = p
            n += 1
    return kept[:n]


def pivot_prefixes(vectors: np.ndarray, pivots: np.ndarray, prefix: int, margin: float) -> list[np.ndarray]:
    """Numbers of the pivots that each vector names, nearest first."""
    close = vectors @ pivots.T
    best = close.max(axis=1, keepdims=True)
    k = min(prefix, close.shape[1])
    last = -np.partition(-close, k - 1, axis=1)[:, k - 1 : k]
    row, pivot = np.nonzero((close >= best - margin) | ((close >= last) & (close >= best - 2 * margin)))
    order = np.lexsort((pivot, -close[row, pivot], row))
    ends = np.cumsum(np.bincount(row, minlength=len(vectors)))
    return np.split(pivot[order].astype(np.int32), ends[:-1])


def lower_pivots(near, pivot: int, used: np.ndarray) -> np.ndarray:
    """A bit for each pivot of ``used`` below ``pivot``, packed, by row."""
    used = used[used < pivot]
    flat = np.concatenate(near)
    at = np.searchsorted(used, flat)
    hit = used[np.minimum(at, len(used) - 1)] == flat if len(used) else np.zeros(len(flat), dtype=bool)
    bits = np.zeros((len(near), len(used)), dtype=bool)
    bits[np.repeat(np.arange(len(near)), [len(x) for x in near])[hit], at[hit]] = True
    return np.packbits(bits, axis=1)


def unit(rows: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v"))
        .where("vec_id is not null and v is not null")
        .where(finite & F.exists("v", lambda x: x != 0))
    )


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.9,
    prefix: int = PREFIX,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    rows = written(
        valid_vectors(df, id_col, vec_col).select(
            "vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v")).alias("h2")
        ),
        "vec_rows",
    )
    classes = written(
        rows.groupBy("h1", "h2", "vec_id")
        .agg(F.first("v").alias("v"))
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v")),
        "vec_classes",
    )
    parts = [
        _linked(classes.where(F.col("dim") == d["dim"]), d["dim"], d["n"], threshold, prefix)
        for d in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()  # one row per vector length
    ]
    if not parts:
        none = df.select(F.col(id_col).cast("long").alias("vec_id"))
        return none.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = written(found, "vec_found")
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("target <> rep"), "rep", "target", "vec")
    per_class = (
        classes.select("h1", "h2", "rep", "size")
        .join(links, "rep", "left")
        .join(comps.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "h1",
            "h2",
            (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    per_row = (
        rows.select("vec_id", "h1", "h2")
        .join(per_class, ["h1", "h2"])
        .groupBy("vec_id")
        .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
        .withColumnRenamed("vec_id", "_id")
    )
    component = F.coalesce("component_id", "vec_id")
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"))
        .join(per_row, F.col("vec_id") == F.col("_id"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )


def _linked(classes: DataFrame, dim: int, n: int, threshold: float, prefix: int) -> DataFrame:
    """(rep, n, target) parts: linked vectors counted with their copies, and an
    edge towards the smallest member of the block's component."""
    n_pivots = max(1, min(n, math.ceil(2 * math.sqrt(n)), MAX_PIVOT_BYTES // (8 * dim)))
    drawn = classes.orderBy(F.xxhash64("h1", "h2", F.lit(10)), "h1", "h2").limit(n_pivots).select("v").toPandas()
    pivots = thinned(unit(np.array(drawn["v"].tolist(), dtype=np.float64)), SPREAD)

    def describe(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            vecs = unit(np.array(pdf["v"].tolist(), dtype=np.float64))
            near = pivot_prefixes(vecs, pivots, prefix, 1 - threshold)
            yield pd.DataFrame(
                {"rep": pdf["rep"], "size": pdf["size"], "near": near, "v": [x.tobytes() for x in vecs]}
            )

    described = written(
        classes.select("rep", "size", "v").mapInPandas(describe, "rep long, size long, near array<int>, v binary"),
        "vec_described",
    )
    lists = described.select("rep", "size", "near", "v", F.explode("near").alias("pivot"))
    cut = F.ceil(F.count("*") / BLOCK)
    cut = F.greatest(F.least(cut, F.lit(WIDE)), F.ceil(F.count("*") / (BLOCK * WIDE))).cast("int")
    blocks = lists.groupBy("pivot").agg(cut.alias("blocks"))  # one row per pivot
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = (
        lists.join(F.broadcast(blocks), "pivot")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "size", "near", "v", "pivot", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )

    def meet(key, pdf):
        pivot, i, j = int(key[0]), int(key[1]), int(key[2])
        first = pdf[pdf["mine"] == i]
        second = first if i == j else pdf[pdf["mine"] == j]
        out = pd.DataFrame({"rep": np.empty(0, np.int64), "n": np.empty(0, np.int64), "target": np.empty(0, np.int64)})
        if not len(first) or not len(second):
            return out
        arr = lambda p: np.frombuffer(b"".join(p["v"]), dtype=np.float64).reshape(len(p), dim)
        vec_a, vec_b = arr(first), arr(second)
        used = np.intersect1d(np.concatenate(first["near"].tolist()), np.concatenate(second["near"].tolist()))
        low_a, low_b = (lower_pivots(x["near"].tolist(), pivot, used) for x in (first, second))
        base = 0 if i == j else len(first)
        reps = first["rep"].to_numpy() if i == j else np.concatenate((first["rep"], second["rep"]))
        sizes = first["size"].to_numpy() if i == j else np.concatenate((first["size"], second["size"]))
        n, root = np.zeros(len(reps)), np.arange(len(reps))
        rank = np.argsort(np.argsort(reps, kind="stable"), kind="stable")
        strip = max(1, (1 << 20) // len(second))
        for s in range(0, len(first), strip):
            a, b = np.nonzero(vec_a[s : s + strip] @ vec_b.T >= threshold)
            a += s
            if i == j:
                a, b = a[a < b], b[a < b]
            if low_a.shape[1]:
                seen = np.zeros(len(a), dtype=bool)  # the pair met at a smaller pivot
                for q in range(0, len(a), 65536):
                    seen[q : q + 65536] = (low_a[a[q : q + 65536]] & low_b[b[q : q + 65536]]).any(axis=1)
                a, b = a[~seen], b[~seen]
            b = b + base
            n += np.bincount(a, weights=sizes[b], minlength=len(reps)) + np.bincount(b, weights=sizes[a], minlength=len(reps))
            a, b = rank[a], rank[b]  # below, members stand in order of their ids
            while True:  # hang the larger root of each link under the smaller one
                a, b = root[a], root[b]
                a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
                if not len(a):
                    break
                np.minimum.at(root, b, a)
                while (root[root] != root).any():
                    root = root[root]
        label = np.sort(reps, kind="stable")[root[rank]]
        hit = n > 0
        return pd.DataFrame({"rep": reps[hit], "n": n[hit].astype(np.int64), "target": label[hit]})

    return met.groupBy("pivot", "i", "j").applyInPandas(meet, "rep long, n long, target long")


ORACLE = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and vec_id is not null
  and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as u, b.vec_id as w from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select vec_id as u, vec_id as w from v union select r.u, l.w from reach r join links l on r.w = l.u),
comp as (select u, min(w) as c from reach group by u),
n as (select u, count(*) as n from links group by u)
select m.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(c.c, m.vec_id)::bigint as component_id,
       coalesce(m.vec_id = coalesce(c.c, m.vec_id), true) as kept
from embeddings m left join comp c on c.u = m.vec_id left join n on n.u = m.vec_id
"""
