"""Document fingerprints: bottom-k sketches of shingle hashes (DataFrame functions only).

A shingle is a run of ``WIDTH`` words (A-Z lower-cased; a text of fewer words is
one shingle of all of them), its hash the first ``DIGITS`` hex digits of the MD5 of
its words joined by a blank.  The sketch of a text holds its ``SKETCH`` smallest
distinct hashes, in order; the fingerprint is their text, joined.

* Sketches merge: the bottom-k of a union is the bottom-k of the parts' sketches.
  A long text is sketched part by part (``PART`` shingles) and only the running
  sketch is kept; ``group_sketches`` merges the documents of a group, whose
  hashes are cut to k in the map tasks before they are shuffled.
* ``resemblance``: share of the union's sketch that both sketches hold.
  ``distinct_shingles``: exact below k, else from the k-th smallest hash.
  ``containment``: resemblance times the union's size over the own size.

``edited_fingerprints`` compares each document with an edit of itself and with the
document after it, by ascending id.  The order is found on ids alone: ranges of
ids are sorted and numbered by offset, without a task that sees all of them.  Each
text is shuffled once, to its own id, and there the part that its predecessor
borrows (a quarter of that one's length at most) is cut off and sent on.

Defined cases: null texts are empty; texts without words have the empty
fingerprint, alike with each other (1) and with nothing else (0); null ids come
after all others; rows with one id and different texts follow each other by a hash
of the text; repeated rows are one document, returned once a row; a single
document is its own next; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import LOWER, UPPER, written

#: White space that ends a word, besides the blank (fixed values).
SPACES = "\t\n\x0b\x0c\r"
WIDTH = 5
SKETCH = 128
#: Hex digits of a hash (even); 48 bits.
DIGITS = 12
#: Shingles of a long text that are hashed and sorted at a time.
PART = 4096
#: Ids of a range that is numbered by one task.
RANGE_IDS = 20_000


def words(text: Column) -> Column:
    """Words of a text: split at white space, A-Z lower-cased."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES + UPPER, " " * len(SPACES) + LOWER)
    return F.array_remove(F.split(plain, " "), "")


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Sketch of the union of two sketched sets."""
    return _smallest(F.concat(a, b), k)


def runs(ws: Column, width: int = WIDTH) -> Column:
    """Number of shingles, repeats included."""
    return F.greatest(F.size(ws) - (width - 1), F.least(F.size(ws), F.lit(1)))


def sketch(
    ws: Column, k: int = SKETCH, width: int = WIDTH, first: Column | int = 0, end: Column | None = None
) -> Column:
    """Sketch of the shingles ``first`` to before ``end`` (all by default) of a text
    given as the column of its words."""
    first = F.lit(first) if isinstance(first, int) else first
    end = runs(ws, width) if end is None else end

    def shingle(i: Column) -> Column:
        return F.substring(F.md5(F.concat_ws(" ", *[F.get(ws, i + j) for j in range(width)])), 1, DIGITS)

    def grown(held: Column, at: Column) -> Column:
        return merge(held, F.transform(F.sequence(at, F.least(at + PART, end) - 1), shingle), k)

    none = F.array().cast("array<string>")
    return F.when(end > first, F.aggregate(F.sequence(first, end - 1, F.lit(PART)), none, grown)).otherwise(none)


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def packed(hashes: Column) -> Column:
    """Half the bytes of the fingerprint, to travel."""
    return F.unhex(fingerprint(hashes))


def unpacked(body: Column) -> Column:
    size = DIGITS // 2
    n = (F.octet_length(body) / size).cast("int")
    each = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.lower(F.hex(F.substring(body, i * size + 1, F.lit(size))))
    )
    return F.when(n > 0, each).otherwise(F.array().cast("array<string>"))


def _shared(union: Column, a: Column, b: Column) -> Column:
    held = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(held / F.size(union))


def resemblance(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of the union of two sets that both hold, 0 to 1."""
    return _shared(merge(a, b, k), a, b)


def distinct_shingles(a: Column, k: int = SKETCH) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    last = F.conv(F.element_at(a, -1), 16, 10).cast("double")
    scale = float((k - 1) * 16**DIGITS)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(scale) / last)


def _contained(near: Column, union: Column, a: Column, k: int) -> Column:
    both = near * distinct_shingles(union, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def containment(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of the first set that the second holds, 0 to 1."""
    return _contained(resemblance(a, b, k), merge(a, b, k), a, k)


def group_sketches(
    docs: DataFrame, group_col: str, text_col: str = "text", k: int = SKETCH, width: int = WIDTH
) -> DataFrame:
    """(group, sketch, distinct_shingles): the merged sketch of each group's texts.

    A group's hashes are made distinct by a pre-aggregated shuffle and numbered by
    a window whose rows beyond k are cut in the map tasks, so a group of a third of
    all rows sends k hashes a task."""
    hashes = (
        docs.select(F.col(group_col).alias("group"), words(F.col(text_col)).alias("_ws"))
        .select("group", F.explode(sketch(F.col("_ws"), k, width)).alias("_hash"))
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy("group").orderBy("_hash"))
    low = hashes.withColumn("_place", place).where(F.col("_place") <= k)
    merged = low.groupBy("group").agg(F.sort_array(F.collect_list("_hash")).alias("sketch"))
    return merged.withColumn("distinct_shingles", distinct_shingles(F.col("sketch"), k))


def successors(idents: DataFrame, key: list[str], order: list[Column], rows: int) -> DataFrame:
    """``idents`` with ``rank`` 1..n by ``order``, written: ranges are sorted and
    numbered in their own tasks, offset by the rows of the ranges before."""
    parts = -(-rows // RANGE_IDS)
    ranged = written(
        idents.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .select(*key, F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")),
        "fingerprint_ids",
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row for each range
        ranged.groupBy("_pid").count().select("_pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return ranged.join(F.broadcast(offsets), "_pid").select(*key, (F.col("_offset") + F.col("_at") + 1).alias("rank"))


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, width: int = WIDTH
) -> DataFrame:
    """One row per document: its fingerprint, that of its edit (the last quarter of
    its code points replaced by the first as many, or all, of the next document)
    and the likeness of its fingerprint to the edit's and to the next document's."""
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        # a document is known by its id as text and a hash of its text
        .select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), F.xxhash64("text").alias("h"), "text")
    )
    idents = written(
        rows.withColumn("n", F.length("text")).groupBy("doc_id", "k", "h", "n").agg(F.count(F.lit(1)).alias("n_rows")),
        "fingerprint_idents",
    )
    total = idents.agg(F.count(F.lit(1)).alias("idents"), F.sum("n_rows").alias("rows")).first()
    order = [F.col("doc_id").asc_nulls_last(), F.col("h").asc()]
    ranked = successors(idents, ["doc_id", "k", "h", "n"], order, max(total["idents"], 1))
    taker = ranked.select(
        F.col("k").alias("taker_k"),
        F.col("h").alias("taker_h"),
        F.floor(F.col("n") / 4).cast("int").alias("need"),
        (F.col("rank") % max(total["idents"], 1) + 1).alias("rank"),
    )
    asked = ranked.select("k", "h", "rank").join(taker, "rank").drop("rank")

    # Kept are the code points before the cut.  Shingles of all but their last word
    # are the text's own; the edit's others begin in the last ``width`` words, so the
    # edit's sketch is that of the kept shingles merged with that of a short tail.
    # Only what the text's sketch holds beyond the kept one travels beside it.
    kept = words(F.expr("left(text, length(text) - length(text) div 4)"))
    whole = F.greatest(F.size(kept) - width, F.lit(0))
    cut = rows.select("k", "h", "text", whole.alias("whole")).select("*", words(F.col("text")).alias("ws"))
    sketched = cut.select(
        "k",
        "h",
        "text",
        sketch(F.col("ws"), k, width, end=F.col("whole")).alias("head"),
        sketch(F.col("ws"), k, width, first=F.col("whole")).alias("rest"),
    )
    beyond = F.array_except(merge(F.col("head"), F.col("rest"), k), F.col("head"))
    # both sides of the last join read this one shuffle
    mine = sketched.select("k", "h", "text", packed(F.col("head")).alias("head"), packed(beyond).alias("rest"))
    own = merge(unpacked(F.col("head")), unpacked(F.col("rest")), k)
    sent = mine.join(asked, ["k", "h"]).select(
        F.col("taker_k").alias("k"),
        F.col("taker_h").alias("h"),
        F.expr("left(text, need)").alias("borrowed"),
        packed(own).alias("next"),
    )
    if total["rows"] != total["idents"]:  # repeated rows send the same
        sent = sent.dropDuplicates(["k", "h"])
    last = words(F.col("kept"))
    open_end = F.when(F.expr("right(kept, 1)").isin(list(SPACES + " ")), F.lit(" ")).otherwise(F.lit(""))
    return (
        mine.join(sent, ["k", "h"])
        .select(
            F.expr("try_cast(k as bigint)").alias("doc_id"),
            F.length("text").cast("long").alias("n_chars"),
            unpacked(F.col("head")).alias("head_"),
            own.alias("a"),
            unpacked(F.col("next")).alias("c"),
            F.expr("left(text, length(text) - length(text) div 4)").alias("kept"),
            "borrowed",
        )
        .select("*", last.alias("last"))
        .select(
            "doc_id",
            "n_chars",
            "head_",
            "a",
            "c",
            F.concat("kept", "borrowed").alias("edited"),
            words(
                F.concat(F.concat_ws(" ", F.slice("last", F.greatest(F.size("last") - width + 1, F.lit(1)), width)), open_end, "borrowed")
            ).alias("tail"),
        )
        .select("doc_id", "n_chars", "a", "c", "edited", merge(F.col("head_"), sketch(F.col("tail"), k, width), k).alias("b"))
        .select("*", merge(F.col("a"), F.col("b"), k).alias("ab"))
        .select("*", _shared(F.col("ab"), F.col("a"), F.col("b")).alias("near_edited"))
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint(F.col("a")).alias("fingerprint"),
            fingerprint(F.col("b")).alias("edited_fingerprint"),
            "near_edited",
            resemblance(F.col("a"), F.col("c"), k).alias("near_next"),
            _contained(F.col("near_edited"), F.col("ab"), F.col("a"), k).alias("kept_edited"),
            distinct_shingles(F.col("a"), k).alias("n_shingles"),
        )
    )


def oracle() -> str:
    """DuckDB SQL for ``edited_fingerprints`` over a table whose ids are unique."""

    def sketched(column: str) -> str:
        folded = f"regexp_extract_all(translate({column}, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"
        runs = f"[array_to_string(ws[i:i + {WIDTH - 1}], ' ') for i in range(1, greatest(len(ws) - {WIDTH - 1}, least(len(ws), 1)) + 1)]"
        hashes = f"[substr(md5(s), 1, {DIGITS}) for s in {runs}]"
        return f"(select list_sort(list_distinct({hashes}))[1:{SKETCH}] from (select {folded} as ws))"

    def near(a: str, b: str) -> str:
        union = f"list_sort(list_distinct({a} || {b}))[1:{SKETCH}]"
        return (
            f"case when len({a}) + len({b}) = 0 then 1.0::double else "
            f"len([x for x in {union} if list_contains({a}, x) and list_contains({b}, x)])::double / len({union}) end"
        )

    def count(a: str) -> str:
        scale = repr(float((SKETCH - 1) * 16**DIGITS))
        return f"case when len({a}) < {SKETCH} then len({a})::double else {scale}::double / ('0x' || {a}[{SKETCH}])::bigint::double end"

    union = f"list_sort(list_distinct(a || b))[1:{SKETCH}]"
    steps = [
        "d as (select doc_id, coalesce(text, '') as text from documents)",
        "n as (select doc_id, text, length(text) as n, coalesce(lead(text) over (order by doc_id),"
        " first_value(text) over (order by doc_id)) as other from d)",
        "e as (select *, left(text, (n - n // 4)::integer) || left(other, (n // 4)::integer) as edited from n)",
        f"s as (select *, {sketched('text')} as a, {sketched('edited')} as b, {sketched('other')} as c from e)",
    ]
    fields = [
        "doc_id",
        "n::bigint as n_chars",
        "sha256(edited) as edited_sha256",
        "array_to_string(a, '') as fingerprint",
        "array_to_string(b, '') as edited_fingerprint",
        f"{near('a', 'b')} as near_edited",
        f"{near('a', 'c')} as near_next",
        f"case when len(a) = 0 then 1.0::double else least(1.0::double, ({near('a', 'b')}) * ({count(union)}) / ({count('a')})) end as kept_edited",
        f"{count('a')} as n_shingles",
    ]
    return reduce(lambda x, y: x + y, ["with ", ", ".join(steps), " select ", ", ".join(fields), " from s"])
