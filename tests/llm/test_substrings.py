"""Repeated passages: suffix arrays and removal against brute force."""

import hashlib
import random

import numpy as np
import pandas as pd
import xxhash
from llm_cases import SF, docs, edge_rows, words

from txlake.llm import substring_dedup
from txlake.llm.common import table
from txlake.llm.suffix_array import permuted_common_prefixes, suffix_array


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        n, k = rng.randrange(1, 70), rng.choice([1, 2, 3, 6, 30])
        t = np.array([rng.randrange(1, k + 1) for _ in range(n)])
        want = sorted(range(n), key=lambda i: t[i:].tolist())
        assert suffix_array(t).tolist() == want
        common = permuted_common_prefixes(t, np.array(want), 5)
        for a, b in zip(want[1:], want, strict=False):
            same = 0
            while same < 5 and max(a, b) + same < n and t[a + same] == t[b + same]:
                same += 1
            assert common[a] == same
    assert len(suffix_array(np.empty(0, dtype=np.int64))) == 0


def brute_force(rows, width=100):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        d, t = rows[i][:2]
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            w = b[k : k + width]
            if w in seen:
                gone[k : k + width] = b"\1" * width
            else:
                seen.add(w)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    result = substring_dedup.remove_repeats(docs(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, result), key=repr) == brute_force(rows)


def test_documents(spark):
    frame = table(spark, SF, "documents")
    result = substring_dedup.remove_repeats(frame).collect()
    assert sorted(map(tuple, result), key=repr) == brute_force([(r.doc_id, r.text) for r in frame.collect()])


def test_edge_rows(spark):
    rng = random.Random(9)
    passage = words(rng, 30)
    rows = [r[:2] for r in edge_rows() if r[0] is not None]
    rows += [(100 + i, words(rng, 20) + " " + passage + " " + words(rng, 20)) for i in range(30)]
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, "x" + passage[:99]), (203, "y" + passage[:100]), (204, "é" * 120)]
    check(spark, rows)
    assert substring_dedup.remove_repeats(docs(spark, [])).collect() == []


def test_spread_anchors_and_small_blocks(spark, monkeypatch):
    """Anchors with many segments are spread over shards; blocks of one text."""
    monkeypatch.setattr(substring_dedup, "SEGMENTS", 4)
    monkeypatch.setattr(substring_dedup, "BLOCK", 500)
    rng = random.Random(4)
    passage = words(rng, 40)
    check(spark, [(i, words(rng, 12) + passage + words(rng, 12)) for i in range(40)])


def test_suffix_array_to_a_depth(monkeypatch):
    """Names sorted by a further induction or by doubling; repeated texts, and
    alphabets of one, two and more bytes."""
    from txlake.llm import suffix_array as module

    rng = random.Random(2)
    for i in range(300):
        monkeypatch.setattr(module, "MAX_LETTERS", (2, 512)[i % 2])
        k = rng.choice([2, 5, 200, 300, 70_000])
        t = np.array([rng.randrange(1, k + 1) for _ in range(rng.randrange(1, 60))] * rng.randrange(1, 5))
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        depth = rng.randrange(1, 12)
        order = suffix_array(t, depth).tolist()
        starts = [t[i : i + depth].tolist() for i in order]
        assert sorted(order) == list(range(len(t))) and starts == sorted(starts)


def in_process(spark, monkeypatch, rows, n_buckets, n_bins, width=100):
    """The steps one after another, without Spark, and the tables between them."""
    made = docs(spark, rows).select("doc_id", "text").coalesce(1).mapInArrow(substring_dedup._blocks, substring_dedup.BLOCKS)
    blocks = made.toPandas()
    asked = pd.concat(substring_dedup._ask(n_buckets, width)([blocks]))

    def fails(*_):
        raise AssertionError("a block is searched for anchors once")

    monkeypatch.setattr(substring_dedup, "Segments", fails)
    answers = pd.concat([substring_dedup._answer(width)(g) for _, g in asked.groupby("bucket")])
    to_sort, send = answers[answers["kind"] == substring_dedup.SORT], substring_dedup._send(n_bins, width)
    sent = pd.concat([send(b, to_sort[to_sort["block"] == k]) for k, b in blocks.groupby("block")])
    marks = pd.concat([substring_dedup._sorted_bin(width)(g) for _, g in sent.groupby("bin")])
    gone, cut = pd.concat([answers[answers["kind"] == substring_dedup.GONE], marks]), substring_dedup._cut(width, False)
    out = pd.concat([cut(b, gone[gone["block"] == k]) for k, b in blocks.groupby("block")])
    found = [(None if pd.isna(d) else int(d), *r) for d, *r in out.itertuples(index=False)]
    return sorted(found, key=repr), blocks, asked, sent, marks


def test_rows_between_blocks_buckets_and_bins(spark, monkeypatch):
    """The parts that meet grow with the blocks and with the buckets, so what a
    block sends must not: one row to a bucket, with the ids its questions name, one
    row to a bin, and a bin one row back; anchors are looked for once."""
    rng = random.Random(6)
    passage = words(rng, 60)
    rows = [(i, words(rng, 30) + passage[: rng.randrange(len(passage))] + words(rng, 5)) for i in range(400)]
    monkeypatch.setattr(substring_dedup, "BLOCK", 20_000)
    n_buckets, n_bins = 64, 8
    found, blocks, asked, sent, marks = in_process(spark, monkeypatch, rows, n_buckets, n_bins)
    assert found == brute_force(rows) and len(blocks) > 5 and sum(r[2] for r in found)
    questions = asked[asked["anchor"].notna()]
    assert not questions.duplicated(["bucket", "block"]).any()
    # as many ids as segments that are asked about at most
    named = questions["ids"].map(len).sum() // 8
    assert named <= questions["anchor"].map(len).sum() // 8 < 2 * len(rows) * n_buckets // len(blocks)
    assert not sent.duplicated(["bin", "block"]).any() and sent["bin"].max() < n_bins
    assert len(marks) <= len(sent)


def test_segments_do_not_depend_on_slabs(spark, monkeypatch):
    rows = [r[:2] for r in edge_rows()] + [(20, "a" * 700), (21, "é" * 60), (22, "xy" * 300)]
    made = docs(spark, rows).select("doc_id", "text").coalesce(1).mapInArrow(substring_dedup._blocks, substring_dedup.BLOCKS)
    block = substring_dedup.Block(next(made.toPandas().itertuples(index=False)))
    whole = substring_dedup.Segments(block, 100)
    assert whole.n.sum() == sum(max(0, len((t or "").encode()) - 99) for _, t in rows)
    for slab, piece in ((1000, 64), (70, 33), (1, 1)):
        monkeypatch.setattr(substring_dedup, "SLAB", slab)
        monkeypatch.setattr(substring_dedup, "PIECE", piece)
        size = min(20_000, int(block.lens.sum())) if slab == 1 else int(block.lens.sum())
        block.body = block.body[:size] + bytes(substring_dedup.GRAM)
        block.lens = np.minimum(block.lens, np.maximum(0, size - block.starts))
        parts = substring_dedup.Segments(block, 100)
        mine = whole.a + whole.n + 99 <= size
        for x in ("doc", "a", "n", "place", "anchor", "content"):
            assert getattr(parts, x)[: mine.sum()].tolist() == getattr(whole, x)[mine].tolist()


def test_passages_of_little_more_than_a_window(spark):
    """Passages of 99 to 110 bytes in different surroundings, so that their one or
    few windows have the anchor at any place, and widths other than 100."""
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(99, 111))) for _ in range(120)]
    around = lambda: "".join(rng.choice("klmnop ") for _ in range(rng.randrange(40)))
    rows = [(i, around() + rng.choice(passages) + around() + rng.choice(passages) + around()) for i in range(300)]
    check(spark, rows)
    for width in (33, 250):
        result = substring_dedup.remove_repeats(docs(spark, rows).repartition(2), width=width).collect()
        assert sorted(map(tuple, result), key=repr) == brute_force(rows, width)


def test_null_and_repeated_ids(spark, monkeypatch):
    """A null id first, then by id; of rows that share an id by a hash of the text."""
    monkeypatch.setattr(substring_dedup, "BLOCK", 2000)
    rng = random.Random(10)
    passage = words(rng, 40)
    large = 2**62
    rows = [(rng.choice([None, None, 1, 2, large, large + 1]), words(rng, rng.randrange(20)) + passage + words(rng, 9)) for _ in range(60)]
    rows += rows[:5] + [(None, None), (None, ""), (1, None)]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode())))
    want = brute_force([(i, t) for i, (_, t) in enumerate(ordered)])
    place = {str(i): d for i, (d, _) in enumerate(ordered)}
    want = sorted(((place[str(i)], *r) for i, *r in want), key=repr)
    for parts in (1, 4):
        result = substring_dedup.remove_repeats(docs(spark, rows).repartition(parts)).collect()
        assert sorted(map(tuple, result), key=repr) == want
