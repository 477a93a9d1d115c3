"""Benchmark decontamination by size-partitioned MinHash containment search
(DataFrame functions only).

One hash function orders all word shingles; the smallest hashes of an item are
its MinHash sketch.  An item of n distinct shingles, of which a document must
hold at least need = ceil(percent * n / 100), takes a bottom sketch of
n - need + 1 hashes: a document that misses all of them misses too many, so the
search loses no leak.  Documents are partitioned by the logarithm of their
number of shingles.  A partition is searched for the items that fit its size
(need <= its largest number of shingles) and keeps only hashes not above the
largest sketch hash among these items, whatever the length of the document.

Candidates are verified exactly: the shingles themselves (not hashes) of item
and whole document are intersected.

The benchmark side is broadcast while its measured size is below
``MAX_BROADCAST_BYTES``, and joined by a shuffle beyond it.

Defined cases: shingles are ``width`` words; a text of fewer words is one
shingle of all of them, so an item that short is found only in a document of
exactly these words; texts without words (null, empty) are never found and
never hold anything; rows that share an id count as one document, found if any
of its texts is; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import LOWER, UPPER, WORD, written

MAX_BROADCAST_BYTES = 32 << 20
MAX_BROADCAST_IDS = 1_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _each(ws: Column, width: int, whole, part) -> Column:
    """``part(i)`` for each run of ``width`` words, or ``whole`` of a short text."""
    n = F.size(ws)
    runs = F.transform(F.sequence(F.lit(0), n - width), part)
    return F.when(n >= width, runs).when(n > 0, F.array(whole)).otherwise(F.slice(F.array(whole), 1, 0))


def shingle_hashes(ws: Column, width: int) -> Column:
    return F.array_distinct(
        _each(ws, width, F.xxhash64(F.array_join(ws, " ")), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))
    )


def shingle_texts(ws: Column, width: int) -> Column:
    return F.array_distinct(
        _each(ws, width, F.array_join(ws, " "), lambda i: F.concat_ws(" ", *[F.get(ws, i + k) for k in range(width)]))
    )


def size_class(n: Column) -> Column:
    """0 for one shingle, k for 2^k to 2^(k+1) - 1."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_common): every pair of a document and an item
    with 100 * n_common >= percent * n_item distinct shingles."""
    # texts come first as columns of their own, so that word arrays are made once
    bench = written(
        items.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("ws"))
        .where(F.size("ws") > 0)
        .select("item_id", F.array_sort(shingle_hashes(F.col("ws"), width)).alias("hashes"), shingle_texts(F.col("ws"), width).alias("texts"))
        .withColumn("n", F.size("hashes"))
        .withColumn("need", F.ceil(F.col("n") * percent / 100).cast("int")),
        "bench_items",
    )
    size = bench.agg(F.sum(F.length(F.to_json(F.struct("hashes", "texts")))).alias("b"), F.max("n").alias("n")).first()
    top_class = int(size["n"] or 1).bit_length()  # larger documents are searched alike
    small = (size["b"] or 0) <= MAX_BROADCAST_BYTES
    hint = F.broadcast if small else (lambda df: df)
    classes = F.sequence(size_class(F.col("need")), F.lit(top_class))
    sketch = bench.select(
        "item_id", F.explode(classes).alias("part"), F.expr("slice(hashes, 1, n - need + 1)").alias("low")
    ).select("item_id", "part", F.explode("low").alias("hash"))
    limits = sketch.groupBy("part").agg(F.max("hash").alias("limit"))  # one row per size class
    doc_hashes = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("ws"))
        .where(F.size("ws") > 0)
        .select("doc_id", shingle_hashes(F.col("ws"), width).alias("hashes"))
        .withColumn("part", F.least(size_class(F.size("hashes")), F.lit(top_class)))
        .join(F.broadcast(limits.withColumnRenamed("part", "_part")), F.col("part") == F.col("_part"))
        .select("doc_id", "part", F.expr("filter(hashes, h -> h <= limit)").alias("hashes"))
        .select("doc_id", "part", F.explode("hashes").alias("hash"))
    )
    found = written(doc_hashes.join(hint(sketch), ["part", "hash"]).select("doc_id", "item_id").distinct(), "bench_candidates")
    # exact verification on the candidates' texts
    ids = found.select("doc_id").distinct()
    few = found.count() <= MAX_BROADCAST_IDS
    texts = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t"))
        .join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
        .select("doc_id", words(F.col("_t")).alias("ws"))
        .select("doc_id", shingle_texts(F.col("ws"), width).alias("doc_shingles"))
    )
    pairs = texts.join(F.broadcast(found) if few else found, "doc_id")
    return (
        pairs.join(hint(bench.select("item_id", "texts", "n")), "item_id")
        .select("doc_id", "item_id", F.col("n").alias("n_item"), F.size(F.array_intersect("texts", "doc_shingles")).alias("n_common"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_item").alias("n_item"), F.max("n_common").alias("n_common"))
        .where(F.col("n_common") * 100 >= F.col("n_item") * percent)
    )


ORACLE = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{up}', '{low}'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{up}', '{low}'), '[^\\x20\\x09-\\x0D]+') as ws from benchmark),
ds as (select distinct doc_id, case when len(ws) >= 5 then array_to_string(ws[i:i + 4], ' ') else array_to_string(ws, ' ') end as s
       from d, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as u(i) where len(ws) > 0),
bs as (select distinct item_id, case when len(ws) >= 5 then array_to_string(ws[i:i + 4], ' ') else array_to_string(ws, ' ') end as s
       from b, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as u(i) where len(ws) > 0),
n as (select item_id, count(*) as n_item from bs group by item_id)
select doc_id, item_id, n_item::integer as n_item, count(*)::integer as n_common
from ds join bs using (s) join n using (item_id) group by doc_id, item_id, n_item having count(*) * 100 >= n_item * 80
""".replace("{up}", UPPER).replace("{low}", LOWER)
