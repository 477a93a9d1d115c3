"""Dedup across loads: which rows of a new load does the lake not hold yet?

The lake's clean table is stored in folders by a hash of the id.  A new load reads the
folders of its own ids only, and of these the id column only.  A blocked Bloom filter of
the new ids (one 64-bit word an id, ``BITS`` bits in it) is joined to the stored ids by
word, broadcast behind its measured size; the few that pass are compared exactly.  So the
stored side is scanned and filtered in place and only its candidates move.  Beyond the
broadcast bounds the stored ids are joined by a shuffle instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlake.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, checked_broadcast
from txlake.sources.files import materialize

BUCKET = "id_bucket"
#: Bits an id sets in its word, and ids a word (about 1 % of other ids pass).
BITS, IDS_A_WORD = 4, 5


def id_bucket(key: str, buckets: int) -> Column:
    """Folder of an id; null ids have one, too."""
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(buckets)).cast("int")


def store_by_id(df: DataFrame, path: str, key: str, buckets: int, mode: str = "append") -> None:
    """Write ``df`` into the folders of its ids, each folder by one task."""
    placed = df.withColumn(BUCKET, id_bucket(key, buckets))
    placed.repartition(buckets, BUCKET).write.mode(mode).partitionBy(BUCKET).parquet(path)


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), F.col(key)), F.lit(words)).alias("_word")


def _mask(key: str) -> Column:
    h = F.xxhash64(F.lit("mask"), F.col(key))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom_words(ids: DataFrame, key: str, words: int) -> DataFrame:
    """(_word, _bits): the filter of ``ids``; a pre-aggregated pass."""
    return ids.groupBy(_word(key, words)).agg(F.bit_or(_mask(key)).alias("_bits"))


def candidate_ids(stored: DataFrame, ids: DataFrame, key: str, n_ids: int) -> DataFrame:
    """Stored ids that the filter of ``ids`` lets pass: all of ``ids`` that are stored,
    and a few others."""
    words = max(1, -(-n_ids // IDS_A_WORD))
    table = F.broadcast(bloom_words(ids, key, words))  # at most one row an id
    hit = F.col("_bits").bitwiseAND(_mask(key)) == _mask(key)
    return stored.select(key, _word(key, words)).join(table, "_word").where(hit).select(key)


def dedup_against_lake(
    new: DataFrame,
    lake_path: str,
    key: str,
    buckets: int,
    max_rows: int = DEFAULT_BROADCAST_ROWS * 8,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """The rows of ``new`` (one row an id) whose id the table at ``lake_path`` lacks.
    ``new`` is read several times: pass a written table."""
    spark: SparkSession = new.sparkSession
    touched = new.select(id_bucket(key, buckets).alias("b")).distinct().collect()  # at most one a folder
    stored = spark.read.parquet(lake_path).where(F.col(BUCKET).isin([r["b"] for r in touched])).select(key)
    ids = new.select(key).distinct()
    n = ids.count()
    if n <= max_rows and 32 * n <= max_bytes * IDS_A_WORD:
        obs = Observation()
        found = candidate_ids(stored, ids, key, n)
        size = F.sum(F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 16).alias("b")
        stored = materialize(found, "lake_candidates", obs, F.count(F.lit(1)).alias("n"), size)
        known = checked_broadcast(stored.select(F.col(key).alias("_known")), rows=obs.get["n"], size=int(obs.get["b"] or 0))
    else:
        known = stored.select(F.col(key).alias("_known"))
    return new.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def merge_load(new: DataFrame, lake_path: str, key: str, buckets: int) -> int:
    """Append the rows of a load that the lake lacks; the number of them.  A load that
    is merged again adds nothing."""
    rows = materialize(new, "new_load")
    fresh = materialize(dedup_against_lake(rows, lake_path, key, buckets), "fresh_rows")
    store_by_id(fresh, lake_path, key, buckets)
    return fresh.count()
