"""Near duplicates, decontamination, embeddings: brute force on all pairs."""

import math
import random
import re

import numpy as np
import pytest
from llm_cases import SF, docs, edge_rows, words

from txlake.llm import decontaminate, embedding_dedup, near_dedup
from txlake.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    ws = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if len(ws) < width:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_brute_force(rows, width):
    sets = [(d, shingles(t, width)) for d, t in rows]
    some = [(d, s) for d, s in sets if d is not None and s]
    links = [(a, b) for i, (a, x) in enumerate(some) for b, y in some[:i] if 100 * len(x & y) >= 80 * len(x | y)]
    comp = components({d for d, _ in sets if d is not None}, links)
    return sorted(((d, len(s), comp.get(d), d is None or comp[d] == d) for d, s in sets), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rng = random.Random(width)
    rows = [r[:2] for r in edge_rows()]
    for g in range(12):  # groups of edited copies around the threshold
        ws = words(rng, rng.randrange(6, 120), 5000).split()
        for k in range(12):
            copy = list(ws)
            for _ in range(rng.randrange(0, 1 + len(ws) // 12)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(99)}"
            rows.append((1000 + 50 * g + k, " ".join(copy)))
    result = near_dedup.near_duplicates(docs(spark, rows), width=width).collect()
    assert sorted(map(tuple, result), key=repr) == near_brute_force(rows, width)


def test_near_duplicates_empty_and_shared_ids(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).collect() == []
    rng = random.Random(8)
    a, b = words(rng, 50, 9999), words(rng, 50, 9999)
    rows = [(5, a), (7, a), (7, b), (9, b), (11, None)]
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_hot_group_of_near_copies(spark):
    """One large group whose members differ from each other around the limit."""
    rng = random.Random(2)
    ws = words(rng, 80, 5000).split()
    rows = []
    for i in range(250):
        copy = list(ws)
        for _ in range(rng.randrange(0, 12)):
            copy[rng.randrange(80)] = f"y{rng.randrange(999)}"
        rows.append((i, " ".join(copy)))
    result = near_dedup.near_duplicates(docs(spark, rows), width=2).collect()
    assert sorted(map(tuple, result), key=repr) == near_brute_force(rows, 2)


def test_bitmaps_leave_out_no_link_and_most_others():
    """Sets around the threshold and of any size: no link is lost, few others stay."""
    rng = np.random.default_rng(8)
    near_dedup.MOST_BITS, most = 1 << 12, near_dedup.MOST_BITS  # some bitmaps are full
    try:
        sets = [rng.integers(0, 2**64, n, dtype=np.uint64) for n in (1, 2, 9, 60, 250, 250, 700, 3000)]
        for s in list(sets):
            sets += [np.append(s[rng.random(len(s)) > drop], rng.integers(0, 2**64, k, dtype=np.uint64)) for drop, k in ((0.1, 1), (0.1, len(s) // 9), (0.15, 2), (0.3, 3))]
        sets = [np.unique(s) for s in sets if len(s)]
        bits, size = [near_dedup.set_bitmap(s) for s in sets], np.array([len(s) for s in sets])
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
        common = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
        linked = 100 * common >= 80 * (size[i] + size[j] - common)
        ok = near_dedup.can_reach(bits, size, bits, size, i, j, 80)
        assert linked.sum() > len(sets) and ok[linked].all()
        assert ok[~linked].sum() < 0.1 * (~linked).sum()
    finally:
        near_dedup.MOST_BITS = most


def test_few_pairs_leave_a_group_of_copies_below_the_threshold(spark, monkeypatch):
    """Copies of one text that are alike, but not enough: pairs that are verified stay
    in proportion to the copies, not to their square."""
    rng, checked = random.Random(12), []
    ws = words(rng, 200, 5000).split()
    rows = []
    for k in range(240):
        copy = list(ws)
        for at in rng.sample(range(len(copy)), 8):
            copy[at] = f"y{k}x{at}"
        rows.append((k, " ".join(copy)))
    verify = near_dedup.verify

    def counted(pairs, *args):
        pairs = pairs.persist()
        checked.append(pairs.count())
        return verify(pairs, *args)

    monkeypatch.setattr(near_dedup, "verify", counted)
    result = near_dedup.near_duplicates(docs(spark, rows), width=2).collect()
    assert sorted(map(tuple, result), key=repr) == near_brute_force(rows, 2)
    assert sum(checked) < 4 * len(rows)


def test_bayesian_bounds():
    """The bound keeps all pairs whose posterior chance reaches the miss level."""
    for n in (20, 60, 200):
        m = near_dedup.least_matches(near_dedup.BATCH, n, 0.8, 1e-4)
        tail = lambda k, n=n: sum(math.comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-4 and (m == 0 or tail(m - 1) < 1e-4)


def contaminated_brute_force(rows, items):
    out = set()
    for d, t in rows:
        have = shingles(t, 5)
        for i, u in items:
            q = shingles(u, 5)
            if q and d is not None and 100 * len(q & have) >= 80 * len(q):
                out.add((d, i, len(q), len(q & have)))
    return sorted(out)


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, words(rng, rng.randrange(3, 60), 3000)) for i in range(30)] + [(50, None), (51, ""), (52, "two words")]
    rows = [r[:2] for r in edge_rows()]
    for k, (_, t) in enumerate(items[:30]):
        ws = t.split()
        if k % 3 == 0 and len(ws) > 12:
            ws[rng.randrange(len(ws))] = "changed"
        rows.append((100 + k, words(rng, rng.randrange(0, 900)) + " " + " ".join(ws).upper() + " " + words(rng, 50)))
    rows.append((300, "two  words"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    result = decontaminate.contaminated(docs(spark, rows), bench).collect()
    assert sorted(map(tuple, result)) == contaminated_brute_force(rows, items)
    assert decontaminate.contaminated(docs(spark, []), bench).collect() == []
    assert decontaminate.contaminated(docs(spark, rows), bench.limit(0)).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def vector_brute_force(rows):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = set()
    for n, (a, x) in enumerate(ok):
        for b, y in ok[:n]:
            if a != b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.9:
                links |= {(a, b), (b, a)}
    comp = components({i for i, _, _ in rows if i is not None}, links)
    return sorted(((i, sum(1 for a, _ in links if a == i), comp.get(i), i is None or comp[i] == i) for i, _, _ in rows), key=repr)


def test_embeddings_edge_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=8).astype(np.float32).tolist()
    rows = [
        (1, base, 0), (2, base, None), (3, [2 * x for x in base], 0), (4, [0.0] * 8, 0), (5, None, 0), (6, [], 0),
        (7, [*base[:7], None], 0), (8, [*base[:7], float("nan")], 0), (9, [*base[:7], float("inf")], 0), (None, base, 0),
        (10, base[:4], 0), (11, base[:4], 0), (1, base, 0),
    ]
    rows += [(20 + i, rng.normal(size=8).astype(np.float32).tolist(), 1) for i in range(40)]
    result = embedding_dedup.near_vectors(vectors(spark, rows)).collect()
    assert sorted(map(tuple, result), key=repr) == vector_brute_force(rows)
    assert embedding_dedup.near_vectors(vectors(spark, [])).collect() == []


def test_embeddings_recall_at_the_threshold(spark, monkeypatch):
    """Pairs of cosine 0.9 to 0.95 among unrelated vectors, lists cut in blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    rng = np.random.default_rng(4)
    rows, pairs = [], 400
    for i in range(pairs):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = rng.uniform(0.901, 0.95)
        z = c * x + math.sqrt(1 - c * c) * y
        rows += [(2 * i, x.astype(np.float32).tolist(), 0), (2 * i + 1, z.astype(np.float32).tolist(), 0)]
    rows += [(10_000 + i, rng.normal(size=64).astype(np.float32).tolist(), 0) for i in range(1500)]
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(vectors(spark, rows)).collect()}
    want = {i: n for i, n, _, _ in vector_brute_force(rows)}
    assert all(found[i] <= n for i, n in want.items())
    assert sum(found.values()) >= 0.9 * sum(want.values())


@pytest.mark.parametrize("n, inside", [(1500, 0.9), (6000, 0.9), (6000, 0.8), (24000, 0.9)])
def test_embeddings_recall_inside_a_dense_group(spark, n, inside):
    """A third of the vectors are one group whose cosines lie around ``inside``."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = n // 3
    x[:m] = math.sqrt(inside) * x[-1] + math.sqrt(1 - inside) * x[:m]
    x[m : m + 200] = 0.97 * x[:200] + 0.02 * x[m : m + 200]  # and close pairs in it
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    frame = vectors(spark, [(i, v, 0) for i, v in enumerate(x.tolist())])
    found = np.array([r.n_links for r in embedding_dedup.near_vectors(frame).orderBy("vec_id").collect()])
    v = x.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = np.concatenate([(v[i : i + 2000] @ v.T >= 0.9).sum(axis=1) - 1 for i in range(0, n, 2000)])
    assert (found <= want).all()
    assert found.sum() >= 0.98 * want.sum()


def test_registered_tables_match_brute_force(spark):
    frame = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    result = near_dedup.near_duplicates(frame, width=2).collect()
    assert sorted(map(tuple, result), key=repr) == near_brute_force(rows, 2)
