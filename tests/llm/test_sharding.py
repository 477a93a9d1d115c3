"""Shards: near-equal bytes, gapless slots, groups of equal texts."""

import zlib
from collections import defaultdict

from llm_cases import SF, docs, edge_rows

from txlake.llm.common import table
from txlake.llm.sharding import shard_by_bytes, write_shards


def check(rows, result, tolerance):
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in result) == want
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in result:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 16
    assert all(abs(sizes[k] - mean) <= tolerance for k in range(16))


def test_sizes_near_equal(spark):
    frame = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    result = shard_by_bytes(frame).collect()
    check(rows, result, 2 * max(len(t.encode()) + 1 for _, t in rows))


def test_edge_rows_and_overfull_ranges(spark):
    rows = [r[:2] for r in edge_rows()] + [(i, "") for i in range(100, 400)]
    result = shard_by_bytes(docs(spark, rows), range_rows=20).collect()
    check(rows, result, 2 * max(len((t or "").encode()) + 1 for _, t in rows))
    assert sorted(map(tuple, result), key=repr) == sorted(map(tuple, shard_by_bytes(docs(spark, rows)).collect()), key=repr)
    assert shard_by_bytes(docs(spark, [])).collect() == []


def test_groups_stay_whole_or_are_cut_by_bytes(spark):
    rows = [(i, f"text {i // 3} " + "x" * 50) for i in range(3000)] + [(10_000 + i, "copy " * 12) for i in range(1500)]
    result = shard_by_bytes(docs(spark, rows), whole_share=0.05).collect()
    check(rows, result, 600)
    text = dict(rows)
    shards = defaultdict(set)
    for r in result:
        shards[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for t, s in shards.items() if not t.startswith("copy"))


def test_write_shards(spark, tmp_path):
    frame = docs(spark, [(i, "t" * i) for i in range(50)])
    write_shards(frame, shard_by_bytes(frame, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
