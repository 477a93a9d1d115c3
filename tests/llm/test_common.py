"""Word hashes, and functions that run in processes without the package."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from txlake.llm import alignment, bpe, common, lm, near_dedup, whitening


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def hashes(words, dtype):
    whole = "".join(words)
    buf = np.frombuffer(whole.encode("utf-32-le" if dtype == np.uint32 else "utf-8"), dtype=dtype)
    ends = np.cumsum([len(w) for w in words])
    return common.span_hashes(buf, ends - [len(w) for w in words], ends)


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32])
def test_word_hashes(dtype):
    swap = str.maketrans("ab", "ba")
    words = [thue_morse(n) for n in (64, 1024, 2048, 4096)]
    words += [w.translate(swap) for w in words]
    words += ["", "a", "aa", "a" * 8, "a" * 9, "a" * 1024, "a" * 1025, "b", "ba", "ab", "a\x00", "a\x00\x00"]
    found = hashes(words, dtype)
    assert len(set(found.tolist())) == len(words)
    again = hashes(["zz", *words[::-1], *words], dtype)  # elsewhere, the same
    assert (again[1 : 1 + len(words)][::-1] == found).all() and (again[1 + len(words) :] == found).all()


def test_thue_morse_words_are_told_apart(spark):
    """Words whose polynomial hashes modulo 2^64 are equal, in every operator that hashes words."""
    import random

    from llm_cases import docs

    from txlake.llm import queries
    from txlake.llm.lm import language_model_scores

    one = thue_morse(4096)
    two = one.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"t{i}" for i in range(2))
    rows = [(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, f"{one} {two}"), (4, " ".join(random.Random(1).sample("cdefghij", 5)))]
    table = docs(spark, rows)
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table, width=2, percent=80).collect()}
    assert near[1] == (2, 1) and near[2] == (2, 2)
    tok = bpe._tokenizer(open(queries.tokenizer_path(), encoding="utf-8").read())
    got = {r.doc_id: list(r.ids) for r in bpe.encode_decode(table, queries.tokenizer_path()).collect()}
    assert got == {i: tok.encode(t, add_special_tokens=False).ids for i, t in rows}
    known = {r.doc_id: r.n_tokens for r in language_model_scores(table).collect()}
    assert known == {i: len(t.split()) + 1 for i, t in rows}


TASKS = [
    lm._word_table, lm._second_sums, lm._scores, bpe._split(["x"], 2, "words"), bpe._encode("{}"), near_dedup._signed(5),
    near_dedup._exact(80), alignment._aligned_blocks("{}", b""), alignment._finish, whitening._both_products(np.zeros(2)),
]


def test_task_functions_load_without_the_package(tmp_path):
    path = tmp_path / "tasks"
    path.write_bytes(b"".join(len(b).to_bytes(8, "little") + b for b in map(cloudpickle.dumps, TASKS)))
    code = f"""
import sys
sys.path = [p for p in sys.path if "repo" not in p]
from pyspark import cloudpickle
raw, n = open({str(path)!r}, "rb").read(), 0
while raw:
    size = int.from_bytes(raw[:8], "little")
    cloudpickle.loads(raw[8 : 8 + size])
    raw, n = raw[8 + size :], n + 1
assert not any(m.startswith("txlake") for m in sys.modules)
print(n)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.strip() == str(len(TASKS)), done.stderr
