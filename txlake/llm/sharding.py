"""Sharding by sampled splitters.

Documents are ordered by (hash of the text, hash of the id, row), so equal
texts are neighbours.  The order is laid out in ranges: a size-weighted sample
of keys gives quantile splitters, ranges that hold too many rows are subdivided
by further splitters, and each range is one task's sort.  Running sums inside
the ranges plus the sums of earlier ranges give every row its exact byte
position, and ``n_shards`` equal cuts of that line are the shards: law
``bytes``.  The sample only spreads the work; the result does not depend on it.

A cut inside a group of equal texts moves to the nearer end of the group while
the group has at most ``whole_share`` of a shard's bytes; a larger group is cut
at the nearest row, else sizes would not be near equal.

Defined cases: a null text has size 1 and the CRC-32 of no bytes (0); null ids
and repeated rows are ordinary rows (identical rows take neighbouring slots);
an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.llm.common import written

#: Rows of one range (about 60 bytes each), rows of the sample per range.
RANGE_ROWS = 500_000
SAMPLES_PER_RANGE = 32


def _keys(pdf) -> np.ndarray:
    """Sortable fixed-width keys: the three signed longs as big-endian bytes."""
    out = np.empty((len(pdf), 3), dtype=">u8")
    for i, c in enumerate(("h", "g", "row")):
        out[:, i] = pdf[c].to_numpy(dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(out).view("S24").ravel()


def _ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``rows`` with ``part``: how many splitters are not above the key."""
    schema = T.StructType([*rows.drop("part").schema.fields, T.StructField("part", T.IntegerType())])

    def assign(batches):
        for pdf in batches:
            pdf["part"] = np.searchsorted(splitters, _keys(pdf), side="right").astype(np.int32)
            yield pdf

    return rows.drop("part").mapInPandas(assign, schema)


def _sample(rows: DataFrame, weight, total: float, n: int, salt: int) -> pd.DataFrame:
    """About ``n`` keys, each drawn with a chance in proportion to ``weight``."""
    u = F.pmod(F.xxhash64("row", "g", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(u < weight * (n / total)).select("h", "g", "row").toPandas()


def _quantiles(keys: np.ndarray, n: int) -> np.ndarray:
    keys = np.sort(keys)
    if not len(keys) or n < 1:
        return keys[:0]
    return np.unique(keys[(np.arange(1, n + 1) * len(keys)) // (n + 1)])


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_share: float = 0.01,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per
    document.  Only a narrow table without the texts is ordered and moved; the
    driver gets ``SAMPLES_PER_RANGE`` keys and one summary row per range."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(F.col(id_col).cast("string")).alias("g"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard_rows",
    )
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    if not whole["n"]:
        return _result(rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0)))
    # size-weighted splitters, then more of them inside ranges of too many rows
    n_ranges = max(3 * n_shards, -(-whole["n"] // range_rows))
    splitters = _quantiles(
        _keys(_sample(rows, F.col("size"), float(whole["b"]), SAMPLES_PER_RANGE * n_ranges, 0)), n_ranges - 1
    )
    limit, salt = 2 * range_rows, 0
    while True:
        ranged = _ranged(rows, splitters)
        counts = ranged.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("b")).toPandas().sort_values("part")
        over = counts[counts["n"] > limit]
        if over.empty:
            break
        salt += 1
        inside = ranged.where(F.col("part").isin([int(p) for p in over["part"]]))
        pieces = -(-int(over["n"].sum()) // range_rows)
        more = _keys(_sample(inside, F.lit(1.0), float(over["n"].sum()), SAMPLES_PER_RANGE * pieces, salt))
        splitters = np.unique(np.concatenate([splitters, _quantiles(more, 2 * pieces)]))
    # positions: sums before a range (one number per range) and inside it
    before_b = np.concatenate([[0], np.cumsum(counts["b"].to_numpy(dtype=np.int64))[:-1]])
    before_n = np.concatenate([[0], np.cumsum(counts["n"].to_numpy(dtype=np.int64))[:-1]])
    spark = docs.sparkSession
    offsets = spark.createDataFrame(
        pd.DataFrame({"part": counts["part"].astype("int32"), "at_b": before_b, "at_n": before_n})
    )
    order = Window.partitionBy("part").orderBy("h", "g", "row")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = written(
        ranged.repartition(max(len(counts), n_shards), "part")
        .withColumn("in_b", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumn("in_n", F.row_number().over(order) - 1)
        .join(F.broadcast(offsets), "part")  # one row per range
        .select(
            "doc_id", "size", "text_crc32", "h",
            (F.col("at_b") + F.col("in_b")).alias("start"),
            (F.col("at_n") + F.col("in_n")).cast("long").alias("nth"),
        ),
        "shard_placed",
    )
    cuts = _cuts(placed, int(whole["b"]), n_shards, whole_share)
    shard = F.lit(0)
    first = F.lit(0).cast("long")
    for k, (_, nth) in enumerate(cuts, 1):
        shard = F.when(F.col("nth") >= nth, k).otherwise(shard)
        first = F.when(F.col("nth") >= nth, F.lit(nth)).otherwise(first)
    return _result(placed.withColumn("shard", shard).withColumn("slot", F.col("nth") - first))


def _cuts(placed: DataFrame, total: int, n_shards: int, whole_share: float) -> list[tuple[int, int]]:
    """(byte position, number of rows before) of the ``n_shards - 1`` cuts."""
    ideal = [total * k // n_shards for k in range(1, n_shards)]
    end = F.col("start") + F.col("size")
    spans = F.array(*[F.lit(p).cast("long") for p in ideal])
    hit = F.exists(spans, lambda p: (F.col("start") <= p) & (end > p))
    at = placed.where(hit).select("h", "text_crc32", "start", "size", "nth").collect()  # one row per cut at most
    keys = sorted({r["h"] for r in at})
    groups = {
        (r["h"], r["text_crc32"]): r
        for r in placed.where(F.col("h").isin(keys))
        .groupBy("h", "text_crc32")
        .agg(F.min("start").alias("b0"), F.sum("size").alias("b"), F.min("nth").alias("n0"), F.count("*").alias("n"))
        .collect()
    }
    cuts = []
    for p in ideal:
        r = next(x for x in at if x["start"] <= p < x["start"] + x["size"])
        g = groups[r["h"], r["text_crc32"]]
        lo, hi = (r["start"], r["nth"]), (r["start"] + r["size"], r["nth"] + 1)
        if g["b"] <= whole_share * total / n_shards or g["n"] == 1:
            lo, hi = (g["b0"], g["n0"]), (g["b0"] + g["b"], g["n0"] + g["n"])
        cuts.append(lo if p - lo[0] <= hi[0] - p else hi)
    return cuts


def _result(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The documents as Parquet, one folder per shard, in slot order.  Ids must
    be unique and not null here, as they pair a document with its slot."""
    placed = shards.select(F.col("doc_id").alias("_id"), "shard", "slot")
    out = docs.join(placed, docs[id_col] == placed["_id"]).drop("_id")
    out.repartition("shard", F.floor(F.col("slot") / RANGE_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
