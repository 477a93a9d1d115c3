"""Bottom-k fingerprints: against a plain version, edges, merging, no Python in the plan."""

import hashlib
import random

from llm_cases import SCHEMA, docs, edge_rows, words
from pyspark.sql import functions as F

from txlake.llm import fingerprints as fp


def plain_sketch(text, k=fp.SKETCH):
    ws = [w for w in "".join(" " if c in fp.SPACES else c for c in text).split(" ") if w]
    ws = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in ws]
    runs = [ws[i : i + 5] for i in range(max(len(ws) - 4, min(len(ws), 1)))]
    return sorted({hashlib.md5(" ".join(r).encode()).hexdigest()[:12] for r in runs})[:k]


def plain_near(a, b, k=fp.SKETCH):
    union = sorted({*a, *b})[:k]
    return len([x for x in union if x in a and x in b]) / len(union) if union else 1.0


def plain(rows):
    """Expected rows of documents whose ids are unique and not null."""
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        other, m = rows[(i + 1) % len(rows)][1], len(t) // 4
        edited = t[: len(t) - m] + other[:m]
        a, b, c = plain_sketch(t), plain_sketch(edited), plain_sketch(other)
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), plain_near(a, b), plain_near(a, c))
    return out


def result(df):
    found = fp.edited_fingerprints(df).collect()
    return [(r.doc_id, (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)) for r in found]


def test_against_plain_version(spark):
    rng = random.Random(3)
    rows = [(10 + 3 * i, words(rng, rng.randrange(0, 14))) for i in range(60)]
    rows += [(500 + i, words(rng, rng.randrange(100, 900))) for i in range(30)]
    blanks = [" a", "a ", "a  b\tc\n d \x0b e f", "A B C D E F G H", "ab cd ef gh ij kl mn ", "é ü 😀 ß a b c d e f g", "x" * 50, "  "]
    rows += [(900 + i, t) for i, t in enumerate(blanks)]
    rows += [(2000, None), (2001, ""), (2002, "the end of it all is here")]
    rng.shuffle(rows)
    assert dict(result(docs(spark, rows))) == plain(rows)


def test_long_text_is_sketched_in_parts(spark):
    rng = random.Random(4)
    rows = [(1, words(rng, 3 * fp.PART + 17, 5000)), (2, words(rng, fp.PART + 4)), (3, "tail of the ring")]
    assert dict(result(docs(spark, rows))) == plain(rows)


def test_edges(spark):
    rows = edge_rows()
    found = result(docs(spark, rows))
    assert len(found) == len(rows)
    assert sorted(str(i) for i, _ in found) == sorted(str(r[0]) for r in rows)
    by_text = {}
    for i, r in found:
        by_text.setdefault((i, r[0]), set()).add(r)
    assert all(len(v) == 1 for v in by_text.values())  # repeated rows agree
    same = [r for i, r in found if i in (4, 5)]
    assert same[0][2] == same[1][2] and len(same[0][2]) == 12 * 56


def test_empty_and_single(spark):
    assert fp.edited_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    [(i, r)] = result(docs(spark, [(7, "one two three four five six seven eight")]))
    assert i == 7 and r == plain([(7, "one two three four five six seven eight")])[7]


def test_sketches_merge(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 200), f"s{i % 3}") for i in range(30)]
    df = docs(spark, rows)
    for r in fp.group_sketches(df, "source").collect():
        every = sorted({h for _, t, s in rows if s == r.group for h in plain_sketch(t, 10**9)})
        assert r.sketch == every[: fp.SKETCH]
        assert abs(r.distinct_shingles / len(every) - 1) < 0.4
    ws = fp.words(F.col("text"))
    one = df.select("doc_id", ws.alias("ws")).select(
        fp.sketch(F.col("ws"), end=F.lit(50)).alias("a"), fp.sketch(F.col("ws"), first=50).alias("b"), fp.sketch(F.col("ws")).alias("c")
    )
    assert all(r.m == r.c for r in one.select(fp.merge(F.col("a"), F.col("b")).alias("m"), "c").collect())


def test_estimates_are_near_the_truth(spark):
    rng = random.Random(8)
    base = [f"v{rng.randrange(10**6)}" for _ in range(4000)]
    part = base[:3000] + [f"u{i}" for i in range(1000)]
    df = spark.createDataFrame([(" ".join(base), " ".join(part))], "x string, y string")
    a = df.select(fp.words(F.col("x")).alias("x"), fp.words(F.col("y")).alias("y")).select(fp.sketch(F.col("x")).alias("a"), fp.sketch(F.col("y")).alias("b"))
    r = a.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")), fp.distinct_shingles(F.col("a"))).first()
    assert abs(r[0] - 0.6) < 0.15 and abs(r[1] - 0.75) < 0.2 and abs(r[2] / 3996 - 1) < 0.35


def test_plan_has_no_python(spark):
    plan = fp.edited_fingerprints(docs(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
