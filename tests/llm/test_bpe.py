"""BPE: ids and decoded texts equal the tokenizers library."""

import hashlib
import random

import numpy as np
from llm_cases import docs, edge_rows
from tokenizers import Tokenizer

from txlake.llm import bpe
from txlake.llm.queries import tokenizer_path


def reference(texts):
    tok = Tokenizer.from_file(tokenizer_path())
    for t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        yield ids, tok.decode(ids, skip_special_tokens=False)


def test_round_trip_of_edge_rows(spark):
    rows = edge_rows()
    result = bpe.encode_decode(docs(spark, rows), tokenizer_path()).collect()
    want = [(r[0], len(i), i, d) for r, (i, d) in zip(rows, reference([r[1] for r in rows]), strict=True)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in result), key=repr) == sorted(want, key=repr)
    assert bpe.encode_decode(docs(spark, []), tokenizer_path()).collect() == []


def test_digests(spark):
    rng = random.Random(3)
    signs = "ab'strevmld  \n\t12!?.é 　ß中́\U0001f600'"
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(60)))) for i in range(300)]
    got = {r.doc_id: r for r in bpe.token_digests(docs(spark, rows), tokenizer_path()).collect()}
    for (i, _), (ids, text) in zip(rows, reference([t for _, t in rows]), strict=True):
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_words_are_front_coded_without_loss():
    words = sorted(["", "a", "abc", "abd", "b", " the", " then", "é\U0001f600"])
    assert bpe.unpack_words(bpe.pack_words(words)) == words
