"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter, defaultdict

import sentencepiece
from llm_cases import SCHEMA, SF, docs, edge_rows
from tokenizers import Tokenizer

from txlake.llm import alignment, queries
from txlake.llm.bpe import piece_table


def tokenizers():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = f.read()
    tok = Tokenizer.from_str(spec)
    tok.encode_special_tokens = True
    pool, at, size = piece_table(spec)
    return (
        tok,
        [pool[i : i + n].tobytes() for i, n in zip(at, size)],
        sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path()),
    )


def plain(texts):
    tok, bytes_a, model = tokenizers()

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    rows, held = [], Counter()
    for text in texts:
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        sa, sb = [bytes_a[i] for i in a], [piece(i) for i in b]
        if not text or not b"".join(sa) == b"".join(sb) == (" " + text).encode():
            rows.append(None)
            continue
        i = j = 0
        end_a, end_b, links, groups = len(sa[0]), len(sb[0]), [], [([a[0]], [b[0]])]
        while True:
            links.append((a[i], b[j]))
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a and step_b and i + 1 == len(a):
                break
            if step_a and step_b:
                groups.append(([], []))
            if step_a:
                i += 1
                end_a += len(sa[i])
                groups[-1][0].append(a[i])
            if step_b:
                j += 1
                end_b += len(sb[j])
                groups[-1][1].append(b[j])
        held.update(set(links))
        rows.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in r[2])
        sums = sum(held[p] == best[p[0]] for p in r[3]), sum(held[p] for p in r[3])
        out.append((r[0], r[1], len(r[2]), len(r[3]), *sums, hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(df, rows):
    got = alignment.aligned(df, queries.tokenizer_path(), queries.piece_model_path()).collect()
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows]))]
    assert sorted([(r.doc_id, *[r[c] for c in COLUMNS]) for r in got], key=repr) == sorted(want, key=repr)


ODD = [
    "▁", "x▁y z", "a  b   c", "   ", " ", "a ", " a", "tail  \n", "\x00\x01", "nul\x00l", "<s>hi</s> <|endoftext|>", "<unk><0x41>",
    "ﬁ ﬂ", "日本語のテキスト　全角", "éà", "don't we'll I'M", "12,345.67", "﻿bom", "  wide", "🤷🏽‍♀️ ok", "a\tb\r\nc", "x" * 3000, "🙂" * 40,
]


def test_edges_and_odd_texts(spark):
    rows = [(*r, "s")[:2] for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(ODD)]
    check(docs(spark, rows).repartition(3), rows)


def test_empty_table_and_no_text(spark):
    assert alignment.aligned(spark.createDataFrame([], SCHEMA), queries.tokenizer_path(), queries.piece_model_path()).collect() == []
    check(docs(spark, [(1, None), (2, "")]), [(1, None), (2, "")])


def test_documents_in_many_blocks(spark, monkeypatch):
    """Small chunks and blocks: totals still cover all documents."""
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 6000)
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 1500)
    monkeypatch.setattr(alignment, "CACHE_WORDS", 100)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    check(table, rows)


def test_cache_keeps_the_words_of_most_lists(monkeypatch):
    """When the cache is full, words that came often are not encoded again."""
    monkeypatch.setattr(alignment, "CACHE_WORDS", 20)
    asked = []

    def encode(words):
        asked.extend(words)
        return [list(w.encode()) for w in words]

    vocabulary = alignment.Vocabulary([bytes([i]) for i in range(256)], encode)
    for n in range(40):
        words = ["the", "of", *(f"w{n}_{i}" for i in range(5))]
        lists, same = vocabulary.lists(words)
        assert lists.to_pylist() == [list(w.encode()) for w in words] and same.all()
    assert asked.count("the") == asked.count("of") == 1
    assert len(vocabulary.known) == len(vocabulary.count) == len(vocabulary.uses) <= 20 + 2 * 5 + 2
