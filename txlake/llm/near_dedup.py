"""MinHash near-duplicates with sequential Bayesian verification.

1. Shingles: the distinct runs of ``width`` words of a whole text, as 64-bit
   hashes (fewer words: the whole sequence as one shingle).  Texts with equal
   sets form one class; only class representatives (smallest id) go on, so a
   group of copies of any size costs one row.
2. Candidates: ``BANDS`` bands of ``BAND_ROWS`` MinHash values.  Members of a
   band bucket are led by the one that meets most others in all its buckets; each
   is first paired with one leader only, that of most of its own buckets.
3. Verification: the signatures are compared in batches; after each batch a pair
   is dropped when the posterior probability that its similarity reaches the
   threshold is below a share of ``MISS`` (uniform prior: a Beta tail; the shares
   of all batches add up to ``MISS``).  The survivors are verified exactly on their full shingle sets, made again from the texts.
4. Components of the verified pairs.  In buckets whose members are still in more
   than one component, the members outside the largest one are paired with a
   random member of it, another one in every bucket and round, while that links
   many of them.  A last round compares all members with those outside the
   bucket's largest component, in chunks: signatures, then bitmaps of the whole
   shingle sets, which bound the similarity from above, so that next to the links
   few pairs leave a chunk; survivors are verified exactly.  Every candidate pair is therefore either inside one
   component or compared; pairs inside one component are never emitted.

A pair at the threshold is missed by all bands with probability 1.2e-7.

Defined cases: null and empty texts have no shingles and link with nothing; a
null id links with nothing and has a null component (kept); rows that share an
id are one node, linked if any of their texts is; repeated rows give repeated
result rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import connected_components, doc_chunks, joined, mix64, span_hashes, word_spans, written

BANDS, BAND_ROWS = 40, 5
N_HASHES = BANDS * BAND_ROWS
BATCH = 20
MISS = 1e-4
#: Ids up to this many are broadcast (8 bytes each) to pick the texts to verify.
MAX_BROADCAST_IDS = 1_000_000
#: Members of a bucket that are compared with as many others at a time.
CHUNK = 32
#: Bits of a set's bitmap: a power of two, ``SET_BITS`` a shingle or more, up to a bound.
SET_BITS, MOST_BITS = 8, 1 << 16

_RNG = np.random.default_rng(6)
_A = _RNG.integers(0, 2**32, N_HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, N_HASHES, dtype=np.uint32)


def shingle_sets(texts, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    buf, starts, lens = joined(texts)
    s, e = word_spans(buf)
    wh = span_hashes(buf, s, e)
    bounds = np.searchsorted(s, np.append(starts, len(buf)))
    first, count = bounds[:-1], np.diff(bounds)
    out = []
    rolled = wh.copy()
    for k in range(1, width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + np.append(wh[k:], np.zeros(min(k, len(wh)), dtype=np.uint64))
    rolled = mix64(rolled)
    for i, n in zip(first, count, strict=True):
        if n >= width:
            out.append(np.unique(rolled[i : i + n - width + 1]))
        elif n:
            h = np.uint64(n)
            for w in wh[i : i + n]:
                h = mix64(np.array([h ^ w]))[0]
            out.append(np.array([h], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """``N_HASHES`` minima of random linear permutations of 32-bit hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(N_HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 512):
        part = _A[:, None] * x[None, i : i + 512]
        part += _B[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


SIGNED = (
    "doc_id long, n_shingles long, s1 long, s2 long, sig binary, bands array<long>"
)


def _signed(width: int):
    def run(batches):
        for pdf in batches:
            for part in doc_chunks(pdf, "text"):
                ids, rows = part["doc_id"], []
                for d, sh in zip(ids, shingle_sets(part["text"], width), strict=True):
                    if not len(sh):
                        rows.append((d, 0, 0, 0, None, None))
                        continue
                    low = signature(sh)
                    bands = mix64(low[0::BAND_ROWS].astype(np.uint64) + (np.arange(BANDS, dtype=np.uint64) << np.uint64(32)))
                    for r in range(1, BAND_ROWS):
                        bands = mix64(bands ^ low[r::BAND_ROWS])
                    s1 = int(np.bitwise_xor.reduce(mix64(sh)).view(np.int64))
                    s2 = int(np.add.reduce(mix64(sh + np.uint64(1))).view(np.int64))
                    rows.append((d, len(sh), s1, s2, low.astype(np.uint16).tobytes(), bands.view(np.int64)))
                out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "s1", "s2", "sig", "bands"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return run


def least_matches(batch: int, n: int, threshold: float, miss: float) -> int:
    """Fewest matches among ``n`` hashes for which the posterior of a uniform
    prior, Beta(m + 1, n - m + 1), still gives similarity >= threshold a chance
    of ``miss`` or more: P = P(Binomial(n + 1, threshold) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def bounds_table(percent: int, miss: float) -> np.ndarray:
    """``miss`` bounds the chance over all batches."""
    each = miss / (N_HASHES // BATCH)
    return np.array([least_matches(BATCH, n, percent / 100, each) for n in range(BATCH, N_HASHES + 1, BATCH)])


def survives(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which rows of two signature matrices pass every batch's bound."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for k, m in enumerate(least):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, cols] == b[alive, cols]).sum(axis=1)
        alive = alive[matches[alive] >= m]
        if not len(alive):
            break
    out = np.zeros(len(a), dtype=bool)
    out[alive] = True
    return out


def _sigs(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.uint16).reshape(-1, N_HASHES)


def _prune(percent: int, miss: float):
    least = bounds_table(percent, miss)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                keep = survives(_sigs(pdf["sig_a"]), _sigs(pdf["sig_b"]), least)
                yield pdf.loc[keep, ["a", "b"]]

    return run


def _exact(percent: int):
    def run(batches):
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["set_a"], pdf["set_b"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pdf.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return run


def set_bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each shingle, at its hash modulo a power of two; as 64-bit words."""
    m = min(MOST_BITS, max(64, 1 << (SET_BITS * len(shingles) - 1).bit_length()))
    bits = np.zeros(m, dtype=np.uint8)
    bits[(shingles & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def can_reach(bits_a: list, n_a: np.ndarray, bits_b: list, n_b: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs (i, j) of two lists of bitmaps, of sets of ``n_a`` and ``n_b``
    shingles, may reach the threshold.  No pair that does is left out: each bit
    that one bitmap has alone is a shingle, at least, that the other set lacks."""
    size_a, size_b = (np.array([len(x) for x in bits], dtype=np.int64) for bits in (bits_a, bits_b))
    size = np.minimum(size_a[i], size_b[j])
    ok = np.zeros(len(i), dtype=bool)

    def folded(bits: list, at: np.ndarray, words: int) -> np.ndarray:
        which, back = np.unique(at, return_inverse=True)
        return np.stack([np.bitwise_or.reduce(bits[k].reshape(-1, words), axis=0) for k in which])[back]

    for words in np.unique(size):
        at = np.flatnonzero(size == words)
        for at in np.array_split(at, -(-len(at) * int(words) // (1 << 20))):  # 8 MB a side at a time
            x, y = folded(bits_a, i[at], words), folded(bits_b, j[at], words)
            common = np.minimum(
                n_a[i[at]] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64),
                n_b[j[at]] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64),
            )
            ok[at] = 100 * common >= percent * (n_a[i[at]] + n_b[j[at]] - common)
    return ok


def _bitmaps(width: int):
    def run(batches):
        for pdf in batches:
            for part in doc_chunks(pdf, "text"):
                sets = shingle_sets(part["text"], width)
                rows = [(int(d), len(s), set_bitmap(s).tobytes()) for d, s in zip(part["doc_id"], sets, strict=True) if len(s)]
                yield pd.DataFrame(rows, columns=["rep", "size", "bits"])

    return run


def _sets(width: int):
    def run(batches):
        for pdf in batches:
            for part in doc_chunks(pdf, "text"):
                sets = [s.tobytes() for s in shingle_sets(part["text"], width)]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("int64").to_numpy(), "shingles": sets})

    return run


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with these ids, each once in the written table ``ids``."""
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)  # 8 bytes each, counted just above
    return docs.join(ids, "doc_id", "left_semi")


def verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    pairs = written(pairs, f"{name}_pairs")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}_ids")
    sets = written(
        _texts_of(docs, ids).mapInPandas(_sets(width), "doc_id long, shingles binary").where(F.length("shingles") > 0),
        f"{name}_sets",
    )
    side = lambda c, s: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(s))
    both = pairs.join(side("a", "set_a"), "a").join(side("b", "set_b"), "b")
    return written(both.mapInPandas(_exact(percent), "a long, b long").distinct(), f"{name}_links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    miss: float = MISS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document.  Texts are
    linked when 100 * intersection >= percent * union of their shingle sets."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(docs.mapInPandas(_signed(width), SIGNED), "near_signed")
    linkable = signed.where("doc_id is not null and n_shingles > 0")
    classes = written(
        linkable.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")),
        "near_classes",
    )
    rows = classes.select(F.posexplode("bands").alias("band", "key"), "rep")
    shared = written(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("low"), F.max("rep").alias("last"))
        .where("low < last")
        .select("key", "n"),
        "near_buckets",
    )
    # only members of buckets of two and more go on
    members = written(rows.join(shared, "key").distinct(), "near_members")
    # a bucket is led by its member that meets most others in all its buckets: in a
    # group of copies that differ here and there, the text they were copied from
    mates = members.groupBy("rep").agg(F.sum("n").alias("mates"))
    lead = F.max(F.struct("mates", (-F.col("rep")).alias("low"))).alias("lead")
    leads = members.join(mates, "rep").groupBy("key").agg(lead).select("key", (-F.col("lead.low")).alias("lead"))
    led = members.select("key", "rep").join(leads, "key")
    sig = lambda c, s: classes.select(F.col("rep").alias(c), F.col("sig").alias(s))

    def surviving(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sig("a", "sig_a"), "a").join(sig("b", "sig_b"), "b")
        return both.mapInPandas(_prune(percent, miss), "a long, b long").distinct()

    # one pair a member: with the leader of most of its buckets
    shares = led.where("rep <> lead").groupBy("rep", "lead").agg(F.count(F.lit(1)).alias("n"))
    best = shares.groupBy("rep").agg(F.max(F.struct("n", (-F.col("lead")).alias("low"))).alias("best"))
    first = best.select(F.col("rep").alias("a"), (-F.col("best.low")).alias("b"))
    links = verify(surviving(first), docs, width, percent, "near_first")
    comps = written(connected_components(links, "a", "b", "near1"), "near_comps")
    salt, tried, linked = 0, 1, 1
    while linked >= 0.05 * tried:
        salt += 1
        pairs = written(_random_leaders(members, comps, salt), f"near_random{salt}")
        tried = pairs.count()
        if not tried:
            break
        more = verify(surviving(pairs), docs, width, percent, f"near_round{salt}")
        linked = more.count()
        if not linked:
            break
        links = links.union(more)
        comps = written(connected_components(links, "a", "b", f"near_r{salt}"), "near_comps")
    # without a bucket of several components there is nothing left to compare
    last = verify(_cross(members, classes, comps, docs, width, percent, miss), docs, width, percent, "near_last") if tried else None
    if last is not None and last.head(1):
        comps = written(connected_components(links.union(last), "a", "b", "near_last"), "near_comps")
    # a row's component is that of its class's representative, or of its own id
    # where another text of the id is linked
    by_class = classes.select("s1", "s2", "rep")
    own = comps.select(F.col("id").alias("rep"), "component")
    nodes = linkable.select("doc_id", "s1", "s2").join(by_class, ["s1", "s2"])
    top = nodes.join(own, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("c"))
    per_id = top.groupBy("doc_id").agg(F.min("c").alias("c"), F.max("c").alias("c2"))
    per_id = _merge_ids(per_id, top)
    result = signed.select("doc_id", "n_shingles").join(per_id.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    component = F.coalesce("c", "doc_id")
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _merge_ids(per_id: DataFrame, top: DataFrame) -> DataFrame:
    """One component per id.  Where rows that share an id fall into several
    components, those components are one."""
    per_id = written(per_id, "near_ids")
    split = per_id.where("c <> c2")
    if not split.head(1):
        return per_id.select("doc_id", "c")
    same = top.join(split.select("doc_id", F.col("c").alias("low")), "doc_id").select(F.col("c").alias("a"), F.col("low").alias("b"))
    merged = connected_components(same, "a", "b", "near_ids").select(F.col("id").alias("c"), "component")
    return per_id.select("doc_id", "c").join(merged, "c", "left").select("doc_id", F.coalesce("component", "c").alias("c"))


def _placed(members: DataFrame, comps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, rep, comp) of the members, and (key, main, all, rest) of the buckets
    that hold more than one component: the largest one, and the numbers of all
    members and of those outside it."""
    placed = members.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("comp")
    )
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"))
    mixed = top.select(
        "key", F.col("top.comp").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("rest")
    ).where("rest > 0")
    return placed, mixed


def _random_leaders(members: DataFrame, comps: DataFrame, salt: int) -> DataFrame:
    placed, mixed = _placed(members, comps)
    open_ = written(placed.join(mixed, "key"), f"near_mixed{salt}")
    lead = (
        open_.where("comp = main")
        .groupBy("key")
        .agg(F.min(F.struct(F.xxhash64("rep", "key", F.lit(salt)).alias("h"), "rep")).alias("lead"))
        .select("key", F.col("lead.rep").alias("b"))
    )
    # one pair a member and round, in a random one of its open buckets
    one = open_.where("comp <> main").groupBy(F.col("rep").alias("a"))
    pick = one.agg(F.min(F.struct(F.xxhash64("rep", "key", F.lit(-salt)).alias("h"), "key")).alias("pick"))
    return pick.select("a", F.col("pick.key").alias("key")).join(lead, "key").select("a", "b")


def _cross(
    members: DataFrame, classes: DataFrame, comps: DataFrame, docs: DataFrame, width: int, percent: int, miss: float
) -> DataFrame:
    """Pairs across components inside one bucket that survive the signatures and the
    bitmaps of their sets."""
    least = bounds_table(percent, miss)
    placed, mixed = _placed(members, comps)
    found_in = written(placed.join(mixed, "key"), "near_open")
    ids = written(found_in.select(F.col("rep").alias("doc_id")).distinct(), "near_open_ids")
    # an id of several texts has a bitmap for each: every combination is compared
    bitmaps = _texts_of(docs, ids).mapInPandas(_bitmaps(width), "rep long, size long, bits binary")
    carried = written(classes.select("rep", "sig", "bands").join(bitmaps, "rep"), "near_open_sets")
    open_ = found_in.join(carried, "rep")

    def chunks(df: DataFrame, size: str, side: str) -> DataFrame:
        """Members of a bucket, ``CHUNK`` or so to a row."""
        part = F.pmod(F.xxhash64("rep"), F.ceil(F.col(size) / CHUNK)).alias("part")
        columns = [F.collect_list(c).alias(f"{c}_{side}") for c in ("rep", "comp", "sig", "bands", "size", "bits")]
        return df.groupBy("key", "band", part).agg(*columns).drop("part")

    def compare(batches):
        for pdf in batches:
            found = []
            for r in pdf.itertuples(index=False):
                x, y = _sigs(r.sig_a), _sigs(r.sig_b)
                i, j = np.nonzero(np.asarray(r.comp_a)[:, None] != np.asarray(r.comp_b)[None, :])
                if not len(i):
                    continue
                # a pair is compared in the first bucket that it shares only
                p, q = np.stack(list(r.bands_a)), np.stack(list(r.bands_b))
                fresh = ~(p[i, : r.band] == q[j, : r.band]).any(axis=1)
                i, j = i[fresh], j[fresh]
                ok = survives(x[i], y[j], least)
                i, j = i[ok], j[ok]
                if len(i):
                    bits_a, bits_b = ([np.frombuffer(b, dtype="<u8") for b in bits] for bits in (r.bits_a, r.bits_b))
                    ok = can_reach(bits_a, np.asarray(r.size_a), bits_b, np.asarray(r.size_b), i, j, percent)
                    i, j = i[ok], j[ok]
                a, b = np.asarray(r.rep_a)[i], np.asarray(r.rep_b)[j]
                found.append(np.stack((np.maximum(a, b), np.minimum(a, b)), axis=1))
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), dtype=np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    both = chunks(open_, "all", "a").join(chunks(open_.where("comp <> main"), "rest", "b"), ["key", "band"])
    return both.mapInPandas(compare, "a long, b long").distinct()


ORACLE = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') as ws from documents),
sets as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 2 then [ws[1]]
         else list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) end as sh from w),
classes as (select list_sort(sh) as sh, min(doc_id) as rep, len(list_sort(sh)) as n from sets where len(sh) > 0 group by list_sort(sh)),
flat as (select rep, n, unnest(sh) as s from classes),
freq as (select s, count(*) as f from flat group by s),
ranked as (select rep, n, s, row_number() over (partition by rep order by f, s) as r from flat join freq using (s)),
prefix as (select rep, n, s from ranked where r <= n - (80 * n + 99) // 100 + 1),
cand as (select distinct a.rep as a, b.rep as b, a.n as na, b.n as nb from prefix a join prefix b using (s)
         where a.rep < b.rep and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
inter as (select a, b, na, nb, count(*) as i from cand join flat x on x.rep = a join flat y on y.rep = b and x.s = y.s group by all),
links as (select a, b from inter where 100 * i >= 80 * (na + nb - i)),
both_ways as (select a as u, b as v from links union all select b, a from links),
reach as (select rep as u, rep as v from classes union select r.u, l.v from reach r join both_ways l on r.v = l.u),
comp as (select u as rep, min(v) as c from reach group by u)
select s.doc_id, len(s.sh)::bigint as n_shingles, coalesce(p.c, s.doc_id)::bigint as component_id,
       s.doc_id = coalesce(p.c, s.doc_id) as kept
from sets s left join classes k on k.sh = list_sort(s.sh) left join comp p using (rep)
"""

