"""BPE encoding and decoding through a distinct-word table.

1. Split: tasks split whole texts into the words of the byte-level pattern,
   vectorized over character classes, in blocks of about ``BLOCK_CHARS``.  A
   block keeps its texts as codes (positions in its own list of distinct words),
   given as the texts arrive, and sends each distinct word once, to the bucket of its hash.
2. Encode: a bucket holds its share of the distinct words of the whole input and
   encodes each of them once, with the tokenizers library.
3. Join back: the buckets' ids return to the blocks that sent the words, and the
   codes put them back by position.
4. Decode: every id is looked up in the id-to-piece table of the vocabulary, the
   pieces' bytes are joined by position and read as UTF-8.

Blocks and buckets are packed (compressed arrays in one row), so that a shuffle
moves a word once per block and never a row per token.  The words of a block
travel sorted, each without what it shares with the one before.  Splitting is
deterministic and runs once for the words and once for the codes, which is less
work than to store the split texts; a lost executor repeats single tasks.

Defined cases: null and empty texts have no tokens; null and repeated ids and
repeated rows are encoded row by row; the special token's string in a text is
that token, as in the library; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import buckets_for, doc_chunks, span_hashes, text_bytes

BLOCK_CHARS = 4 << 20
#: Text bytes for each bucket of distinct words.
BUCKET_BYTES = 8 << 20

SEP, LETTER, NUMBER, OTHER, SPACE, SPECIAL = range(6)
#: Unicode white space (fixed values of the pattern's \\s).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def character_classes() -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    out = np.fromiter(
        (first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8, count=0x110000
    )
    out[WHITE] = SPACE
    return out


def split_words(texts: list[str], classes: np.ndarray, special: list[str]):
    """(characters, word starts, word ends, words of each text) of ``texts``.

    The pattern is contractions | optional blank and letters, digits or other
    signs | white space up to the last one before a word | white space."""
    whole = "\x00".join(texts) + "\x00"
    ch = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    seps = np.cumsum(lens + 1) - 1
    cls = classes[ch]
    cls[seps] = SEP
    own = []
    for token in special:
        at = whole.find(token)
        while at >= 0:
            if (cls[at : at + len(token)] < SPECIAL).all():
                own.append(at)
                cls[at : at + len(token)] = SPECIAL
            at = whole.find(token, at + len(token))
    start = np.ones(len(cls), dtype=bool)
    start[1:] = cls[1:] != cls[:-1]
    start[own] = True
    after = np.append(cls[1:], np.uint8(SEP))
    last = np.flatnonzero((cls == SPACE) & (after >= LETTER) & (after <= OTHER))  # white space before a word
    start[last] = True
    start[last[ch[last] == 32] + 1] = False  # a blank belongs to the word
    quote = np.flatnonzero((ch == 39) & start & (after == LETTER))
    if len(quote):
        one, two = ch[quote + 1], ch[np.minimum(quote + 2, len(ch) - 1)]
        is_ = lambda x, c: x == ord(c)
        short = is_(one, "s") | is_(one, "t") | is_(one, "m") | is_(one, "d")
        long = (is_(one, "r") & is_(two, "e")) | (is_(one, "v") & is_(two, "e")) | (is_(one, "l") & is_(two, "l"))
        start[quote[short | long] + 1] = False
        for at in (quote[short] + 2, quote[long] + 3):
            start[at[cls[at] == LETTER]] = True
    start[seps] = False
    marks = np.flatnonzero(start | (cls == SEP))
    is_word = start[marks]
    first = marks[is_word]
    end = marks[np.flatnonzero(is_word) + 1]
    counts = np.diff(np.searchsorted(first, np.concatenate(([0], seps))))
    return whole, ch, first, end, counts


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, compressed."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a.view(np.uint8)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.empty(0, dtype)


def pack_words(words: list[str]) -> bytes:
    """Sorted words, front-coded: shared lengths, other lengths, other letters."""
    shared, rest, before = [], [], ""
    for w in words:
        k, m = 0, min(len(before), len(w))
        while k < m and before[k] == w[k]:
            k += 1
        shared.append(k)
        rest.append(w[k:])
        before = w
    heads = _pack(np.array(shared, dtype=np.uint32)), _pack(np.array([len(r) for r in rest], dtype=np.uint32))
    body = zstandard.ZstdCompressor(level=9).compress("".join(rest).encode("utf-8", "surrogatepass"))
    sizes = np.array([len(heads[0]), len(heads[1])], dtype="<u4").tobytes()
    return sizes + heads[0] + heads[1] + body


def unpack_words(b: bytes) -> list[str]:
    one, two = np.frombuffer(b[:8], dtype="<u4").tolist()
    shared = _unpack(b[8 : 8 + one], np.uint32).tolist()
    sizes = _unpack(b[8 + one : 8 + one + two], np.uint32).tolist()
    rest = zstandard.ZstdDecompressor().decompress(b[8 + one + two :]).decode("utf-8", "surrogatepass")
    out, at, word = [], 0, ""
    for k, n in zip(shared, sizes, strict=True):
        word = word[:k] + rest[at : at + n]
        at += n
        out.append(word)
    return out


WORDS = "bucket int, block long, body binary"
TEXTS = "block long, kind string, ids array<long>, counts array<int>, body binary"


def _split(special: list[str], n_buckets: int, want: str):
    """``want``: ``words`` (rows of WORDS) or ``texts`` (rows of TEXTS)."""

    def run(batches):
        from pyspark import TaskContext

        classes = character_classes()
        part, seq = TaskContext.get().partitionId(), 0
        held, size = [], 0
        words: list[str] = []  # the block's distinct words by code, in order of arrival
        known, code_of, seen = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64)

        def coded(whole, ch, first, end):
            """Codes of a chunk's words; words that are new to the block join its list."""
            nonlocal known, code_of, seen
            uniq, where, inverse, n = np.unique(span_hashes(ch, first, end), return_index=True, return_inverse=True, return_counts=True)
            at = np.searchsorted(known, uniq)
            old = np.zeros(len(uniq), dtype=bool)
            inside = at < len(known)
            old[inside] = known[at[inside]] == uniq[inside]
            code = np.empty(len(uniq), dtype=np.uint32)
            code[old] = code_of[at[old]]
            code[~old] = len(words) + np.arange(int((~old).sum()), dtype=np.uint32)
            words.extend(whole[first[w] : end[w]] for w in where[~old].tolist())
            known, code_of = np.concatenate((known, uniq[~old])), np.concatenate((code_of, code[~old]))
            order = np.argsort(known)
            known, code_of = known[order], code_of[order]
            seen = np.concatenate((seen, np.zeros(int((~old).sum()), dtype=np.int64)))
            seen[code] += n
            return code[inverse]

        def rows():
            block = (part << 32) | seq
            rank = np.empty(len(words), dtype=np.uint32)  # the commonest words get the smallest codes
            rank[np.argsort(-seen, kind="stable")] = np.arange(len(words), dtype=np.uint32)
            uniq = np.empty(len(words), dtype=np.uint64)
            uniq[code_of] = known
            bucket = (uniq % np.uint64(n_buckets)).astype(np.int64)
            order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
            order = order[np.argsort(bucket[order], kind="stable")]
            if want == "words":
                ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                return pd.DataFrame(
                    [
                        (b, block, pack_words([words[i] for i in order[ends[b] : ends[b + 1]]]))
                        for b in range(n_buckets)
                        if ends[b] < ends[b + 1]
                    ],
                    columns=["bucket", "block", "body"],
                )
            out = [(block, "text", h["ids"], h["counts"], _pack(rank[h["code"]])) for h in held]
            out.append((block, "order", None, None, _pack(rank[order])))
            return pd.DataFrame(out, columns=["block", "kind", "ids", "counts", "body"])

        for pdf in batches:
            for chunk in doc_chunks(pdf, "text"):
                texts = ["" if t is None or t != t else t for t in chunk["text"]]
                whole, ch, first, end, counts = split_words(texts, classes, special)
                ids = [None if d is None or d != d else int(d) for d in chunk["doc_id"]]
                held.append({"code": coded(whole, ch, first, end), "ids": ids, "counts": counts.astype(np.int32)})
                size += len(whole)
                if size >= BLOCK_CHARS:
                    yield rows()
                    held, size, seq = [], 0, seq + 1
                    words.clear()
                    known, code_of, seen = known[:0].copy(), code_of[:0].copy(), seen[:0].copy()
        if held:
            yield rows()

    return run


def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _encode(spec: str):
    made: list = []  # the tokenizer, built once a task

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(_tokenizer(spec))
        tok = made[0]
        number: dict[str, int] = {}
        codes = []
        for body in pdf["body"]:
            words = unpack_words(body)
            codes.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)))
        ids, words = [], list(number)
        for i in range(0, len(words), 8192):
            ids += [e.ids for e in tok.encode_batch(words[i : i + 8192], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((x for e in ids for x in e), dtype=np.uint32, count=int(size.sum()))
        at = np.cumsum(size) - size
        out = []
        for block, bucket, code in zip(pdf["block"], pdf["bucket"], codes, strict=True):
            out.append((block, bucket, _pack(size[code].astype(np.uint32)), _pack(gather(flat, at[code], size[code]))))
        return pd.DataFrame(out, columns=["block", "bucket", "sizes", "flat"])

    return run


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``flat[at : at + size]`` of each pair, joined."""
    total = int(size.sum())
    if not total:
        return flat[:0]
    index = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(total)
    return flat[index]


def piece_table(spec: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id-to-piece table: all pieces' bytes joined, start and size by id.

    A byte-level vocabulary writes a byte as a printable character: bytes that
    print in Latin-1 stand for themselves, the others for 256, 257, ..."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(keep)))}
    model = json.loads(spec)
    piece = {i: bytes(byte_of[c] for c in p) for p, i in model["model"]["vocab"].items()}
    piece |= {t["id"]: t["content"].encode() for t in model["added_tokens"]}
    n = max(piece) + 1
    size = np.array([len(piece.get(i, b"")) for i in range(n)], dtype=np.int64)
    pool = np.frombuffer(b"".join(piece.get(i, b"") for i in range(n)), dtype=np.uint8)
    return pool, np.cumsum(size) - size, size


def _decoded(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


COLUMNS = {
    "n_tokens": "n_tokens long",
    "ids": "ids array<int>",
    "decoded": "decoded string",
    "ids_sha256": "ids_sha256 string",
    "decoded_sha256": "decoded_sha256 string",
}


def _assemble(spec: str, want: list[str]):
    made: list = []  # the piece table, built once a task

    def run(texts: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(piece_table(spec))
        pool, piece_at, piece_size = made[0]
        replies = replies.sort_values("bucket")
        order = _unpack(texts[texts["kind"] == "order"]["body"].iloc[0], np.uint32)
        sizes, flat = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
        for s, f in zip(replies["sizes"], replies["flat"], strict=True):
            sizes.append(_unpack(s, np.uint32))
            flat.append(_unpack(f, np.uint32))
        flat = np.concatenate(flat)
        by_order = np.concatenate(sizes).astype(np.int64)
        size, at = np.empty_like(by_order), np.empty_like(by_order)
        size[order] = by_order
        at[order] = np.cumsum(by_order) - by_order
        out = []
        for doc_ids, counts, body in texts[texts["kind"] == "text"][["ids", "counts", "body"]].itertuples(index=False):
            code = _unpack(body, np.uint32)
            ids = gather(flat, at[code], size[code])
            stop = np.concatenate(([0], np.cumsum(size[code])))[np.concatenate(([0], np.cumsum(counts)))]
            lengths = piece_size[ids]
            text = gather(pool, piece_at[ids], lengths)
            text_stop = np.concatenate(([0], np.cumsum(lengths)))[stop]
            for k, d in enumerate(doc_ids):
                mine = ids[stop[k] : stop[k + 1]]
                raw = text[text_stop[k] : text_stop[k + 1]].tobytes()
                row = {"doc_id": d, "n_tokens": len(mine)}
                if "ids" in want:
                    row["ids"] = mine.astype(np.int32)
                if "decoded" in want:
                    row["decoded"] = _decoded(raw)
                if "ids_sha256" in want:
                    row["ids_sha256"] = hashlib.sha256(mine.astype("<u4").tobytes()).hexdigest()
                if "decoded_sha256" in want:
                    row["decoded_sha256"] = hashlib.sha256(_decoded(raw).encode()).hexdigest()
                out.append(row)
        df = pd.DataFrame(out, columns=["doc_id", *want])
        df["doc_id"] = df["doc_id"].astype("Int64")
        return df

    return run


def encode_decode(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    want: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """(doc_id, *want) per row; ``want`` names columns of ``COLUMNS``.  The
    tokenizer file is read on the driver and travels with the tasks."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    special = [t["content"] for t in json.loads(spec)["added_tokens"]]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_buckets = buckets_for(text_bytes(docs), BUCKET_BYTES)
    replies = (
        docs.mapInPandas(_split(special, n_buckets, "words"), WORDS)
        .groupBy("bucket")
        .applyInPandas(_encode(spec), "block long, bucket int, sizes binary, flat binary")
    )
    texts = docs.mapInPandas(_split(special, n_buckets, "texts"), TEXTS)
    want = list(want)
    schema = "doc_id long, " + ", ".join(COLUMNS[w] for w in want)
    return texts.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(_assemble(spec, want), schema)


def token_digests(docs: DataFrame, tokenizer_path: str, **names) -> DataFrame:
    return encode_decode(docs, tokenizer_path, want=("n_tokens", "ids_sha256", "decoded_sha256"), **names)
