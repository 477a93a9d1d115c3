"""Cross-tokenizer alignment: where two vocabularies cut a text at the same byte.

Tokenizer A is byte-level and reads a blank and the text, tokenizer B is a piece
model that adds the blank itself.  A pass over the texts, in Arrow columns:

1. Words.  A's words and B's runs (blanks and what follows) are slices of one buffer;
   the distinct ones are encoded once a task and their ids taken back by position.
   A merge never crosses these cuts (``_check`` looks at the vocabularies).
2. Ends.  The lists of ids are flattened; their parent indices give each token its
   document, and cumulative sums of byte lengths, segmented by document, its end.
3. Alignment.  A full outer hash join of both tables on (document, end) yields every
   end.  Each of them closes one overlap of an A and a B token, which running counts
   of the ends before it name; an end of both closes a group.
4. Counts.  ``Table.group_by`` finds the distinct id pairs of each document and the
   number of documents of a block that hold a pair.  Spark adds these up.

A block of texts (``BLOCK_CHARS``) is written once, as one row: the documents'
figures, its distinct pairs, and each document's pairs as positions among these.
Spark sums the pairs over all blocks, marks the commonest partners of each A id, and
sends each block the totals of its own pairs.  So shuffles carry a pair once a block,
however many documents hold it, and no task holds more than a block.

Defined cases: null and empty texts, and texts whose tokens' bytes are not the blank
and the text (for instance with U+2581), have no tokens: zeros and an empty string;
null and repeated ids and repeated rows are documents of their own; strings of
special tokens are plain text; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.bpe import _pack, _unpack, character_classes, gather, piece_table, split_words
from txlake.llm.common import written

BLOCK_CHARS = 8 << 20
CHUNK_CHARS = 1 << 20
#: Distinct words that a task remembers before it forgets those that came once.
CACHE_WORDS = 200_000
BLANK = "▁"

BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, n_pairs array<int>, code binary, times binary, a array<int>, b array<int>, docs array<long>"
)
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Vocabulary:
    """Bytes of each id, and the encoding of distinct slices of text.  What is known is
    kept in flat arrays, a word as its number."""

    def __init__(self, pieces: list[bytes], encode):
        self.pieces, self.encode = pieces, encode
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.pool, self.starts, self.sizes = np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes
        self.size = pa.array(sizes)
        self.name = pa.array([str(i) for i in range(len(pieces))])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int32)
        self.count = np.empty(0, dtype=np.int64)
        self.same = np.empty(0, dtype=bool)
        self.uses = np.empty(0, dtype=np.int32)

    def _forget_rare(self) -> None:
        """The words of most lists are kept, half of ``CACHE_WORDS`` at most; all count anew."""
        most = CACHE_WORDS // 2
        often = np.flatnonzero(self.uses > 1)
        if len(often) > most:
            often = np.sort(often[np.argpartition(-self.uses[often], most)[:most]])
        at = np.cumsum(self.count) - self.count
        words = list(self.known)  # in the order of their numbers
        self.known = {words[k]: i for i, k in enumerate(often.tolist())}
        self.flat = gather(self.flat, at[often], self.count[often])
        self.count, self.same = self.count[often], self.same[often]
        self.uses = np.zeros(len(often), dtype=np.int32)

    def _learn(self, words: list[str]) -> None:
        ids = []
        for i in range(0, len(words), 8192):
            ids += self.encode(words[i : i + 8192])
        count = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(count.sum()))
        # all words at once: their bytes and lengths are those of their pieces
        length = np.add.reduceat(np.append(self.sizes[flat], 0), np.cumsum(count) - count) * (count > 0)
        raw = [w.encode() for w in words]
        same = length == np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        if not same.all() or gather(self.pool, self.starts[flat], self.sizes[flat]).tobytes() != b"".join(raw):
            same = np.array([b"".join([self.pieces[t] for t in i]) == w for i, w in zip(ids, raw, strict=True)], dtype=bool)
        self.known.update(zip(words, range(len(self.count), len(self.count) + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, flat])
        self.count = np.concatenate([self.count, count])
        self.same = np.concatenate([self.same, same])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), dtype=np.int32)])

    def lists(self, words: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        """Ids of each word, and whether their bytes are the word's."""
        if len(self.known) > CACHE_WORDS:
            self._forget_rare()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        self.uses[number] += 1  # ``words`` are distinct
        count = self.count[number]
        at = np.cumsum(self.count) - self.count
        flat = gather(self.flat, at[number], count)
        ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), self.same[number]


def byte_vocabulary(spec: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    tok.no_padding()
    tok.encode_special_tokens = True
    pool, at, size = piece_table(spec)
    pieces = [pool[i : i + n].tobytes() for i, n in zip(at.tolist(), size.tolist(), strict=True)]
    return Vocabulary(pieces, lambda words: [e.ids for e in tok.encode_batch(words, add_special_tokens=False)])


def _piece_bytes(model) -> list[bytes]:
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [
        bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
    ]


def piece_vocabulary(model_bytes: bytes) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=model_bytes)
    alone = model.piece_to_id(BLANK)

    def encode(words: list[str]) -> list[list[int]]:
        # the model adds a word's first blank, but to an empty text
        ids = model.encode([w[1:] for w in words], num_threads=1)
        return [i if i else [alone] for i in ids]

    return Vocabulary(_piece_bytes(model), encode)


def _check(model_bytes: bytes) -> None:
    """Pieces begin with all their blanks, so that no merge joins two runs."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=model_bytes)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if BLANK in piece.lstrip(BLANK):
            raise ValueError(f"piece {piece!r} joins two words")


def _tokens(cuts: np.ndarray, data: pa.Buffer, vocabulary: Vocabulary, starts: np.ndarray):
    """(table of doc, end, id of each token, documents with a slice whose bytes differ).

    ``cuts``: offsets of the slices in the buffer, ``starts``: of the documents."""
    slices = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), data).dictionary_encode()
    lists, same = vocabulary.lists(slices.dictionary.to_pylist())
    codes = slices.indices
    slice_doc = np.searchsorted(starts, cuts[:-1], side="right") - 1
    ids = pc.take(lists, codes)
    parents = pc.list_parent_indices(ids)
    flat = pc.list_flatten(ids)
    doc = pc.take(pa.array(slice_doc.astype(np.int32)), parents)
    ends = pc.cumulative_sum(pc.take(vocabulary.size, flat))
    # segmented: every document counts from its own start (documents that differ are left out)
    before = np.concatenate(([0], ends.to_numpy(zero_copy_only=False)))
    first = np.searchsorted(doc.to_numpy(zero_copy_only=False), np.arange(len(starts)), side="left")
    ends = pc.subtract(ends, pc.take(pa.array(before[first]), doc))
    odd = np.unique(slice_doc[~same[codes.to_numpy(zero_copy_only=False)]])
    return pa.table({"doc": doc, "end": ends, "id": flat}), odd


def _place(table: pa.Table) -> pa.Array:
    """(document, end) as one number, in the same order."""
    doc = table["doc"].combine_chunks().cast(pa.int64())
    return pc.bit_wise_or(pc.shift_left(doc, pa.scalar(32, pa.int64())), table["end"].combine_chunks())


def _joined(table: pa.Table, doc: int, vocabulary: Vocabulary) -> bytes:
    ids = table.filter(pc.equal(table["doc"], doc))["id"].to_pylist()
    return b"".join([vocabulary.pieces[i] for i in ids])


def _before(flag: np.ndarray) -> np.ndarray:
    return np.cumsum(flag) - flag


def _group_texts(ids: np.ndarray, closes: np.ndarray, vocabulary: Vocabulary) -> pa.Array:
    """The ids of each group, joined by commas; ``closes``: the last of a group."""
    offsets = np.concatenate(([0], np.flatnonzero(closes) + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pc.take(vocabulary.name, pa.array(ids))), ",")


def _align(texts: list[str], classes: np.ndarray, va: Vocabulary, vb: Vocabulary) -> tuple[dict, pa.Table]:
    """Figures of each text, and the table (doc, a, b, times) of its linked id pairs."""
    n = len(texts)
    use = [i for i, t in enumerate(texts) if t and BLANK not in t]
    figures = {f: np.zeros(n, dtype=np.int64) for f in FIGURES} | {"groups_sha256": [""] * n}
    none = pa.table({"doc": pa.array([], pa.int32()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "times": pa.array([], pa.int64())})
    if not use:
        return figures, none
    spaced = [" " + texts[i] for i in use]
    _, ch, first, _, counts = split_words(spaced, classes, [])
    width = 1 + (ch >= 0x80).astype(np.int64) + (ch >= 0x800) + (ch >= 0x10000)
    at = np.concatenate(([0], np.cumsum(width)))[first] - np.repeat(np.arange(len(use)), counts)  # without separators
    raw = "".join(spaced).encode()
    data, octets = pa.py_buffer(raw), np.frombuffer(raw, dtype=np.uint8)
    starts = at[np.cumsum(counts) - counts]
    total = len(raw)
    opens = octets == 32
    opens[1:] &= octets[:-1] != 32
    opens[starts] = True
    ta, odd_a = _tokens(np.append(at, total), data, va, starts)
    tb, odd_b = _tokens(np.append(np.flatnonzero(opens), total), data, vb, starts)
    ends = np.append(starts[1:], total)
    drop = [
        d for d in sorted({*odd_a.tolist(), *odd_b.tolist()})
        if not _joined(ta, d, va) == _joined(tb, d, vb) == raw[starts[d] : ends[d]]
    ]
    if drop:
        wrong = pa.array(drop, pa.int32())
        ta, tb = (t.filter(pc.invert(pc.is_in(t["doc"], wrong))) for t in (ta, tb))

    a_id, b_id = (t["id"].to_numpy() for t in (ta, tb))
    ta, tb = (pa.table({"place": _place(t), name: t["id"]}) for t, name in ((ta, "a"), (tb, "b")))
    every = ta.join(tb, "place", join_type="full outer", use_threads=False).sort_by("place")
    is_a, is_b = (pc.is_valid(every[c]).to_numpy().astype(np.int64) for c in ("a", "b"))
    doc = every["place"].to_numpy() >> 32
    common = is_a & is_b
    link_a, link_b = a_id[_before(is_a)], b_id[_before(is_b)]

    group_a = _group_texts(a_id, common[is_a == 1], va)
    group_b = _group_texts(b_id, common[is_b == 1], vb)
    groups = pc.binary_join_element_wise(group_a, group_b, "|")
    n_groups = np.bincount(doc, weights=common, minlength=len(use)).astype(np.int64)
    stops = np.concatenate(([0], np.cumsum(n_groups))).astype(np.int32)
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(stops), groups), ";")
    found = {
        "n_a": np.bincount(doc, weights=is_a, minlength=len(use)),
        "n_b": np.bincount(doc, weights=is_b, minlength=len(use)),
        "n_groups": n_groups,
        "n_links": np.bincount(doc, minlength=len(use)),
    }
    for name, values in found.items():
        figures[name][use] = values.astype(np.int64)
    for i, text, k in zip(use, whole, n_groups, strict=True):
        if k:
            figures["groups_sha256"][i] = hashlib.sha256(text.as_buffer()).hexdigest()
    place = np.array(use, dtype=np.int32)[doc]
    links = pa.table({"doc": place, "a": link_a, "b": link_b})
    pairs = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    return figures, pairs.rename_columns(["doc", "a", "b", "times"])


def _chunks(batches, doc_ids: str, text: str):
    """Lists of ids and texts of about CHUNK_CHARS."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(doc_ids), batch.column(text), strict=True):
            t = t.as_py()
            ids.append(i.as_py())
            texts.append(t)
            size += len(t or "")
            if size >= CHUNK_CHARS:
                yield ids, texts, size
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def _aligned_blocks(spec: str, model: bytes):
    schema = pa.schema(
        [
            ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())),
            *[(f, pa.list_(pa.int64())) for f in FIGURES],
            ("groups_sha256", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int32())),
            ("code", pa.binary()), ("times", pa.binary()),
            ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64())),
        ]
    )

    def block_row(block: int, held: list) -> pa.RecordBatch:
        n = [len(h[0]) for h in held]
        base = np.cumsum([0, *n])
        tables = [t.set_column(0, "doc", pc.add(t["doc"], pa.scalar(int(b), pa.int32()))) for (_, _, t), b in zip(held, base)]
        links = pa.concat_tables(tables).combine_chunks()
        pairs = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])

        def key(t: pa.Table) -> np.ndarray:
            return (t["a"].to_numpy().astype(np.int64) << 32) | t["b"].to_numpy()

        # the commonest pairs get the smallest codes; a document's codes are sent as steps
        pairs = pairs.sort_by([("count_all", "descending"), ("a", "ascending"), ("b", "ascending")])
        code = pc.index_in(pa.array(key(links)), value_set=pa.array(key(pairs))).to_numpy(zero_copy_only=False).astype(np.uint32)
        doc, times = links["doc"].to_numpy(), links["times"].to_numpy()
        order = np.lexsort((code, doc))
        doc, code, times = doc[order], code[order], times[order]
        n_pairs = np.bincount(doc, minlength=base[-1]).astype(np.int32)
        step = code.copy()
        if len(code):
            step[1:] = np.where(doc[1:] == doc[:-1], code[1:] - code[:-1], code[1:])
        row = {
            "block": block,
            "doc_id": list(chain.from_iterable(h[0] for h in held)),
            **{f: np.concatenate([h[1][f] for h in held]) for f in FIGURES},
            "groups_sha256": list(chain.from_iterable(h[1]["groups_sha256"] for h in held)),
            "n_pairs": n_pairs,
            "code": _pack(step),
            "times": _pack(times.astype(np.uint32)),
            "a": pairs["a"].to_numpy(),
            "b": pairs["b"].to_numpy(),
            "docs": pairs["count_all"].to_numpy(),
        }
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

    def run(batches):
        from pyspark import TaskContext

        classes, va, vb = character_classes(), byte_vocabulary(spec), piece_vocabulary(model)
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for ids, texts, n in _chunks(batches, "doc_id", "text"):
            held.append((ids, *_align(texts, classes, va, vb)))
            size += n
            if size >= BLOCK_CHARS:
                yield block_row((part << 32) | seq, held)
                held, size, seq = [], 0, seq + 1
        if held:
            yield block_row((part << 32) | seq, held)

    return run


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """Totals of a block's pairs, put to its documents."""
    totals = np.zeros((2, right.num_rows), dtype=np.int64)
    at = right["code"].to_numpy()
    totals[0, at], totals[1, at] = right["total"].to_numpy(), right["best"].to_numpy()
    out = {f: left[f].combine_chunks().flatten() for f in ("doc_id", *FIGURES)}
    n_pairs = left["n_pairs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    step, times = (_unpack(left[c][0].as_py(), np.uint32).astype(np.int64) for c in ("code", "times"))
    stop = np.concatenate(([0], np.cumsum(n_pairs)))
    run = np.concatenate(([0], np.cumsum(step)))
    code = run[1:] - np.repeat(run[stop[:-1]], n_pairs)  # segmented by document
    for name, value in (("n_best", totals[1]), ("count_sum", totals[0])):
        sums = np.concatenate(([0], np.cumsum(value[code] * times)))
        out[name] = pa.array(sums[stop[1:]] - sums[stop[:-1]])
    out["groups_sha256"] = left["groups_sha256"].combine_chunks().flatten()
    return pa.table(out)


def pair_totals(blocks: DataFrame) -> DataFrame:
    """(a, b, total, best): documents that hold a linked pair, and whether no other
    partner of its A id has more."""
    each = blocks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("p.a", "p.b", "p.docs")
    totals = each.groupBy("a", "b").agg(F.sum("docs").alias("total"))
    # at most one row for each id of B shares an A id
    top = F.max("total").over(Window.partitionBy("a"))
    return totals.select("a", "b", "total", (F.col("total") == top).cast("long").alias("best"))


def aligned(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: tokens, groups and links of its alignment, and how its
    links fare in the whole corpus.  Vocabulary files are read on the driver."""
    with open(byte_path, encoding="utf-8") as f:
        spec = f.read()
    json.loads(spec)
    with open(piece_path, "rb") as f:
        model = f.read()
    _check(model)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(texts.mapInArrow(_aligned_blocks(spec, model), BLOCKS), "align_blocks")
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode(F.arrays_zip("a", "b")).alias("code", "p")).select("asker", "code", "p.a", "p.b")
    replies = asked.join(pair_totals(blocks), ["a", "b"]).select("asker", "code", "total", "best")
    packed = blocks.drop("a", "b", "docs")
    return packed.groupBy("block").cogroup(replies.groupBy("asker")).applyInArrow(_finish, SCHEMA)
