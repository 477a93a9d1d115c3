"""Exact removal of repeated passages with suffix arrays over shards.

A byte goes when a ``WIDTH``-byte string that covers it also starts earlier.

1. Blocks: whole texts as UTF-8, packed by about ``BLOCK`` bytes, in order of id
   and tie inside a block.
2. Anchors: the leftmost smallest hash among the ``GRAM``-byte strings of every
   ``WIDTH``-byte window is the window's anchor.  Equal windows have the same
   anchor at the same place, so shards by anchor lose no match.  Neighbouring
   windows with one anchor form a segment.  A block asks about each different
   (anchor, segment) once: is its copy the first of all, and does the anchor
   have other segments too?  Copies that are not the first are gone entirely.
   This is the only pass that looks for anchors: the answers name the segments
   that are gone and those to be sorted by their place in the block.
3. Shards: the first copies of segments whose anchor has several segments meet
   in bins of shards, whose number follows from the bytes to be sorted.  Equal
   windows agree on a ``CORE``-byte string at one of a few places around their
   anchor, so segments that share none of these strings with another are left
   out.  A shard's suffix array is made by induced sorting; runs of the array
   whose permuted common prefixes reach ``WIDTH`` hold the equal windows, of
   which the earliest stays.  An anchor with very many segments is spread over
   several shards by the hash of the windows.
4. Marks return to the blocks, which cut the texts.

A block sends one row to each bucket and bin, and each of them one row back.
Equal windows are found by 64-bit hashes of anchor and segment together in step
2 (128 bits), and letter by letter in step 3.

Defined cases: null and empty texts have 0 bytes; documents are ordered by id, a
null id first, rows that share an id by a hash of their text, and equal rows one
after another, so all but one of them lose what repeats; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import buckets_for, mix64, written
from txlake.llm.suffix_array import permuted_common_prefixes, suffix_array

WIDTH = 100
GRAM = 32
BLOCK = 8 << 20
#: Text bytes for each bucket of questions; bytes to sort for each bin and shard.
BUCKET_BYTES, BIN_BYTES, SHARD_BYTES = 32 << 20, 8 << 20, 1 << 20
#: Windows whose grams are held at a time, and whose minima stay in a core's cache.
SLAB, PIECE = 1 << 18, 1 << 14
#: Segments of one anchor in one shard.
SEGMENTS = 512
#: Places around an anchor at which segments are compared before they are sorted.
CORES = 8

BLOCKS = "block long, size long, ids binary, null_ids binary, ties binary, lens binary, body binary"
QUESTIONS = "bucket int, block long, ids binary, ties binary, doc binary, a binary, n binary, place binary, anchor binary, content binary"
NOTES = "block long, kind int, bytes long, a binary, n binary, place binary, spread binary, anchor binary"
SENT = "bin int, block long, ids binary, ties binary, doc binary, a binary, n binary, place binary, home binary, body binary"
_BLOCKS, _QUESTIONS, _NOTES, _SENT = ([f.split()[0] for f in x.split(", ")] for x in (BLOCKS, QUESTIONS, NOTES, SENT))
#: Kinds of notes: segments that are gone, and segments to be sorted.
GONE, SORT = 0, 1
#: Odd multipliers of the hashes.
_M = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, which compress better."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""


def _from_planes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, dtype=np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _of_rows(rows: pd.Series, dtype) -> np.ndarray:
    found = [_from_planes(b, dtype) for b in rows]
    return np.concatenate(found) if found else np.empty(0, dtype)


def _sizes(rows: pd.Series, dtype) -> np.ndarray:
    return np.array([len(b) for b in rows], dtype=np.int64) // np.dtype(dtype).itemsize


def _blocks(batches):
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    ids, raw, size = [], [], 0

    def row():
        low = np.iinfo(np.int64).min
        key = np.array([low if i is None else i for i in ids], dtype=np.int64)
        ties = np.array([xxhash.xxh64_intdigest(r) - (1 << 63) for r in raw], dtype=np.int64)
        order = np.lexsort((ties, key))
        lens = np.array([len(raw[i]) for i in order], dtype=np.int64)
        null = np.array([ids[i] is None for i in order], dtype=bool)
        body = zstandard.ZstdCompressor(level=1).compress(b"".join([*(raw[i] for i in order), bytes(GRAM)]))
        values = (part << 32) | seq, size, _planes(key[order]), null.tobytes(), _planes(ties[order]), _planes(lens), body
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], _BLOCKS)

    for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
        text = batch.column(1)
        text = text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary())
        for d, t in zip(batch.column(0).to_pylist(), text.to_pylist(), strict=True):
            t = t or b""
            if ids and size + len(t) > BLOCK:
                yield row()
                ids, raw, size, seq = [], [], 0, seq + 1
            ids.append(d)
            raw.append(t)
            size += len(t)
    if ids:
        yield row()


class Block:
    """A block's documents in order and their bytes, one after another and then
    ``GRAM`` zeros."""

    def __init__(self, r):
        self.ids, self.ties = _from_planes(r.ids, np.int64), _from_planes(r.ties, np.int64)
        self.null = np.frombuffer(r.null_ids, dtype=bool)
        self.lens = _from_planes(r.lens, np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.body = zstandard.ZstdDecompressor().decompress(r.body)

    def documents(self, at: np.ndarray) -> np.ndarray:
        """Document by position; empty texts share their start with the next one."""
        return np.searchsorted(self.starts, at, side="right") - 1

    def table(self, doc: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """Ids and ties of the documents that occur in ``doc``, and ``doc`` by them."""
        used = np.zeros(len(self.ids), dtype=bool)
        used[doc] = True
        number = np.cumsum(used, dtype=np.uint32) - np.uint32(1)
        return _planes(self.ids[used]), _planes(self.ties[used]), _planes(number[doc])


def _grams(raw: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Hashes of the ``GRAM``-byte strings at ``lo`` to ``hi``; ``raw`` goes on
    for ``GRAM`` bytes at least."""
    n = hi - lo + GRAM - 8
    u = np.lib.stride_tricks.as_strided(raw[lo : lo + 8].view("<u8"), shape=(n,), strides=(1,)).copy()
    u ^= u >> np.uint64(29)
    u *= _M[0]
    u ^= u >> np.uint64(32)
    for step, m in ((8, _M[1]), (16, _M[2])):
        later = u[step:]
        u = u[:-step] * m
        u += later
    u ^= u >> np.uint64(32)
    u *= _M[3]
    return u


def _span_hashes(grams: np.ndarray, starts: np.ndarray, size: np.ndarray, longest: int) -> np.ndarray:
    """Hashes of spans of ``GRAM`` to ``longest`` bytes, from the grams that cover them."""
    out = size.astype(np.uint64) * _M[4]
    last = starts + size - GRAM
    for k in range(-(-longest // GRAM)):
        out = (out ^ (out >> np.uint64(31))) * _M[1] + grams[np.minimum(starts + GRAM * k, last)]
    return mix64(out)


class Segments:
    """The segments of a block: document, first window, number of windows, place
    of the anchor after the first window, anchor and content hash."""

    def __init__(self, block: Block, width: int):
        want = width - GRAM + 1
        raw = np.frombuffer(block.body, dtype=np.uint8)
        fits = np.flatnonzero(block.lens >= width)
        begin, last = block.starts[fits], block.starts[fits] + block.lens[fits] - width
        windows = max(0, len(raw) - GRAM - width + 1)
        kinds = np.int32, np.uint32, np.uint16, np.uint16, np.uint64, np.uint64
        found = [[np.empty(0, dtype=t)] for t in kinds]
        for s in range(0, windows if len(fits) else 0, SLAB):
            lo, hi = max(0, s - 1), min(windows, s + SLAB + want)
            grams = _grams(raw, lo, hi + want - 1)
            bits = len(grams).bit_length()
            mask = np.uint64((1 << bits) - 1)
            key = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)  # of equal hashes the leftmost
            where = np.empty(hi - lo, dtype=np.int64)
            for p in range(0, hi - lo, PIECE):
                low, span = key[p : min(p + PIECE, hi - lo) + want - 1], 1
                while span < want:  # minimum over 2, 4, ... and then exactly ``want`` grams
                    step = min(span, want - span)
                    low = np.minimum(low[step:], low[:-step])
                    span += step
                where[p : p + len(low)] = low & mask
            new = np.zeros(hi - lo, dtype=bool)
            np.not_equal(where[1:], where[:-1], out=new[1:])
            new[begin[np.searchsorted(begin, lo) : np.searchsorted(begin, hi)] - lo] = True
            a = np.flatnonzero(new) + lo
            doc = np.searchsorted(begin, a, side="right") - 1
            # the last window of a segment: before the next segment, or the document's last
            b = np.minimum(np.append(a[1:], hi) - 1, last[doc])
            own = (doc >= 0) & (a <= last[doc]) & (a >= s) & (a < s + SLAB)
            doc, a, b = doc[own], a[own] - lo, b[own] - lo
            place = where[a]
            content = _span_hashes(grams, a, b - a + width, 2 * width - GRAM)
            for x, y in zip(found, (fits[doc], a + lo, b - a + 1, place - a, mix64(grams[place]), content), strict=True):
                x.append(y.astype(x[0].dtype, copy=False))
        self.doc, self.a, self.n, self.place, self.anchor, self.content = map(np.concatenate, found)

    def questions(self) -> tuple[np.ndarray, np.ndarray]:
        """The earliest segment of each different (anchor, content), ordered by
        the anchor's first bits, and the segments that repeat one in the block."""
        bits = np.uint64(len(self.a).bit_length())
        order, tied = _ties(self.anchor >> bits, bits)
        i = order[tied]
        i = i[np.lexsort((i, self.content[i], self.anchor[i]))]
        again = i[1:][(self.anchor[i[1:]] == self.anchor[i[:-1]]) & (self.content[i[1:]] == self.content[i[:-1]])]
        repeats = np.zeros(len(self.a), dtype=bool)
        repeats[again] = True
        return order[~repeats[order]], again


def _ties(key: np.ndarray, bits: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``key``, which leaves ``bits`` bits for a place, and whether a
    place of this order shares its key with another."""
    both = np.sort((key << bits) | np.arange(len(key), dtype=np.uint64))
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = (both[1:] ^ both[:-1]) >> bits == 0
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), same[1:] | same[:-1]


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """One of ``parts`` by the first 32 bits of ``key``, ascending with it."""
    return (((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _runs(part: np.ndarray):
    """(part, slice) of each run of equal parts."""
    cut = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else ()
    return [(int(part[x]), slice(x, y)) for x, y in zip(cut[:-1], cut[1:], strict=True)]




def _gone(block: int, a: np.ndarray, n: np.ndarray) -> tuple:
    """A note on the segments that begin at ``a`` and have ``n`` windows."""
    return block, GONE, 0, _planes(a.astype(np.uint32)), _planes(n.astype(np.uint32)), None, None, None


def _ask(n_buckets: int, width: int):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                block = Block(r)
                seg = Segments(block, width)
                first, again = seg.questions()
                rows = []
                if len(again):  # goes through a bucket unseen, to the notes
                    note = _gone(r.block, seg.a[again], seg.n[again])
                    rows.append((r.block % n_buckets, r.block, None, None, None, note[3], note[4], None, None, None))
                doc, a, n, place, anchor, content = (x[first] for x in (seg.doc, seg.a, seg.n, seg.place, seg.anchor, seg.content))
                del seg
                for b, q in _runs(_part(anchor, n_buckets)):
                    rows.append((b, r.block, *block.table(doc[q]), *(_planes(x[q]) for x in (a, n, place)), anchor[q].tobytes(), content[q].tobytes()))
                yield pd.DataFrame(rows, columns=_QUESTIONS)

    return run


def _answer(width: int):
    """Notes on the questions of a bucket: the segments that are not the first of
    all, and those that are and whose anchor has others: over how many shards the
    segments of their anchor are spread."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["anchor"].isna()
        rows = [(r.block, GONE, 0, r.a, r.n, None, None, None) for r in pdf[own].itertuples(index=False)]
        pdf = pdf[~own]
        if len(pdf):
            rows += asked(pdf)
        return pd.DataFrame(rows, columns=_NOTES)

    def asked(pdf: pd.DataFrame) -> list[tuple]:
        anchor, content = (np.frombuffer(b"".join(pdf[c]), dtype=np.uint64) for c in ("anchor", "content"))
        bits = np.uint64(len(anchor).bit_length())
        order, tied = _ties(anchor & ((np.uint64(1) << (np.uint64(64) - bits)) - np.uint64(1)), bits)
        i = np.sort(order[tied])  # all others are the only ones of their anchor
        docs = _sizes(pdf["ids"], np.int64)
        row = np.repeat(np.arange(len(pdf)), _sizes(pdf["doc"], np.uint32))[i]
        doc = _of_rows(pdf["doc"], np.uint32)[i] + (np.cumsum(docs) - docs)[row]
        ids, ties = _of_rows(pdf["ids"], np.int64)[doc], _of_rows(pdf["ties"], np.int64)[doc]
        a, n = _of_rows(pdf["a"], np.uint32)[i], _of_rows(pdf["n"], np.uint16)[i].astype(np.int64)
        place = _of_rows(pdf["place"], np.uint16)[i]
        anchor, content, blocks = anchor[i], content[i], pdf["block"].to_numpy()
        order = np.lexsort((a, blocks[row], ties, ids, content, anchor))
        x, y = anchor[order], content[order]
        new_anchor, new = np.ones(len(order), dtype=bool), np.ones(len(order), dtype=bool)
        new_anchor[1:] = x[1:] != x[:-1]
        new[1:] = new_anchor[1:] | (y[1:] != y[:-1])
        group = np.cumsum(new_anchor) - 1
        different = np.bincount(group, weights=new).astype(np.int64)[group]
        spread = np.empty(len(order), dtype=np.int64)
        spread[order] = np.where(different > 1, -(-different // SEGMENTS), 0)
        first = np.empty(len(order), dtype=bool)
        first[order] = new
        rows = []
        late = np.flatnonzero(~first)
        for k, q in _runs(row[late]):
            rows.append(_gone(blocks[k], a[late[q]], n[late[q]]))
        some = np.flatnonzero(first & (spread > 0))
        for k, q in _runs(row[some]):
            m = some[q]
            size = int(np.where(spread[m] > 1, n[m] * width, n[m] + width).sum())
            rows.append((blocks[k], SORT, size, _planes(a[m]), _planes(n[m].astype(np.uint32)), _planes(place[m]), _planes(spread[m].astype(np.uint32)), anchor[m].tobytes()))
        return rows

    return run


def _send(n_bins: int, width: int):
    def run(blocks: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in blocks.itertuples(index=False) if len(notes) else ():
            block = Block(r)
            a, n, spread = (_of_rows(notes[c], np.uint32).astype(np.int64) for c in ("a", "n", "spread"))
            place = _of_rows(notes["place"], np.uint16).astype(np.int64)
            key = np.frombuffer(b"".join(notes["anchor"]), dtype=np.uint64)
            many = spread > 1
            if many.any():  # windows of widely spread anchors go by their own hash
                of = np.repeat(np.flatnonzero(many), n[many])
                w = a[of] + np.arange(len(of)) - np.repeat(np.cumsum(n[many]) - n[many], n[many])
                part = (_window_hashes(block.body, w, width) % spread[of].astype(np.uint64)).astype(np.uint64)
                new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (part[1:] != part[:-1])))
                of, w, part, m = of[new], w[new], part[new], np.diff(np.append(new, len(w)))
                key = np.concatenate((key[~many], mix64(key[of] + part + np.uint64(1))))
                place = np.concatenate((place[~many], place[of] - (w - a[of])))
                a, n = np.concatenate((a[~many], w)), np.concatenate((n[~many], m))
            key = mix64(key)
            to = _part(key, n_bins)
            order = np.argsort(to, kind="stable")
            a, n, place, home, doc = a[order], n[order], place[order], key[order].astype(np.uint16), block.documents(a[order])
            body = memoryview(block.body)
            for b, q in _runs(to[order]):
                data = b"".join([body[x:y] for x, y in zip(a[q].tolist(), (a[q] + n[q] + width - 1).tolist(), strict=True)])
                packed = (_planes(x[q].astype(t)) for x, t in ((a, np.uint32), (n, np.uint16), (place, np.uint16), (home, np.uint16)))
                rows.append((b, r.block, *block.table(doc[q]), *packed, zstandard.ZstdCompressor(level=1).compress(data)))
        return pd.DataFrame(rows, columns=_SENT)

    return run


def _window_hashes(body: bytes, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows at ``at``, a few thousand bytes of them at a time."""
    raw = np.frombuffer(body, dtype=np.uint8)
    out = np.empty(len(at), dtype=np.uint64)
    for p in range(0, len(at), SLAB):
        chosen = at[p : p + SLAB]
        strings = np.lib.stride_tricks.sliding_window_view(raw, width)[chosen].ravel()
        rolled = np.append(strings, np.zeros(GRAM, dtype=np.uint8))
        grams = _grams(rolled, 0, len(strings) - GRAM + 1)
        out[p : p + SLAB] = _span_hashes(grams, np.arange(len(chosen)) * width, np.full(len(chosen), width), width)
    return out


def _alone(raw: np.ndarray, at: np.ndarray, n: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Segments that share no window with another one: a window that two of them
    share has the anchor at one of ``width`` - ``GRAM`` + 1 places, and with it
    one of ``CORES`` strings that each hold the anchor at a fixed place.  Those
    that share none of these strings are alone.  ``raw`` ends with ``GRAM`` bytes more."""
    places = width - GRAM + 1
    step = -(-places // CORES)
    core, befores = width - step + 1, range(0, places, step)
    found = np.empty((len(befores), len(at)), dtype=np.uint64)
    # windows with the anchor at ``before`` to ``before + step - 1`` hold the core
    fits = np.array([(place >= x) & (place - x + core <= n + width - 1) for x in befores])
    for _, q in _runs(at // SLAB):
        lo, hi = at[q][0], at[q][-1] + n[q][-1] + width - 1
        grams = _grams(raw, lo, hi - GRAM + 1)
        for k, x in enumerate(befores):
            mine = np.flatnonzero(fits[k, q]) + q.start
            found[k, mine] = _span_hashes(grams, at[mine] + place[mine] - x - lo, np.full(len(mine), core), core)
    shared = np.zeros(len(at), dtype=bool)
    for k in range(len(befores)):
        mine = np.flatnonzero(fits[k])
        bits = np.uint64(len(mine).bit_length())
        order, tied = _ties(found[k, mine] >> bits, bits)
        shared[mine[order[tied]]] = True
    return ~shared


def _sorted_bin(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, sizes = _sizes(pdf["ids"], np.int64), _sizes(pdf["doc"], np.uint32)
        doc = _of_rows(pdf["doc"], np.uint32) + np.repeat(np.cumsum(docs) - docs, sizes)
        ids, ties = _of_rows(pdf["ids"], np.int64)[doc], _of_rows(pdf["ties"], np.int64)[doc]
        block = np.repeat(pdf["block"].to_numpy(), sizes)
        a, n, place = (_of_rows(pdf[c], t).astype(np.int64) for c, t in (("a", np.uint32), ("n", np.uint16), ("place", np.uint16)))
        home = _of_rows(pdf["home"], np.uint16).astype(np.int64)
        texts = [zstandard.ZstdDecompressor().decompress(b) for b in pdf["body"]]
        raw = np.frombuffer(b"".join([*texts, bytes(GRAM)]), dtype=np.uint8)
        del texts
        at = np.cumsum(n + width - 1) - (n + width - 1)
        stays = ~_alone(raw, at, n, place, width)
        shards = -(-int((n[stays] + width).sum()) // SHARD_BYTES)
        seg, start = [], []
        for s in range(shards):
            mine = np.flatnonzero(stays & (home * shards >> 16 == s))
            if not len(mine):
                continue
            of, k = _repeated(raw, at[mine], n[mine], a[mine], block[mine], ties[mine], ids[mine], width)
            seg.append(mine[of])
            start.append(a[mine[of]] + k)
        rows = []
        if seg:
            seg, start = np.concatenate(seg), np.concatenate(start)
            order = np.lexsort((start, block[seg]))
            seg, start = seg[order], start[order]
            # neighbouring windows as one
            new = np.ones(len(seg), dtype=bool)
            new[1:] = (start[1:] != start[:-1] + 1) | (block[seg[1:]] != block[seg[:-1]])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(seg)))
            of = block[seg[first]]
            for _, q in _runs(np.cumsum(np.append(True, of[1:] != of[:-1])) - 1) if len(of) else ():
                rows.append(_gone(of[q][0], start[first[q]], many[q]))
        return pd.DataFrame(rows, columns=_NOTES)

    return run


def _repeated(raw, at, n, a, block, ties, ids, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are not the first of their equals, by segment and number in
    it, of segments that begin at ``at``."""
    size = n + width - 1
    # letters 2..257; every segment ends with a 1
    to = np.cumsum(size + 1) - (size + 1)
    t = np.ones(int((size + 1).sum()), dtype=np.uint16)
    inside = np.ones(len(t), dtype=bool)
    inside[to + size] = False
    pieces = [raw[x:y] for x, y in zip(at.tolist(), (at + size).tolist(), strict=True)]
    t[inside] = np.add(np.concatenate(pieces), 2, dtype=np.uint16)
    sa = suffix_array(t, width)
    seg = np.repeat(np.arange(len(n)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    window = to[seg] + k
    number = np.full(len(t), -1)
    number[window] = np.arange(len(window))
    sa = sa[number[sa] >= 0]
    common = permuted_common_prefixes(t, sa, width)
    # equal windows: runs of the array with common prefixes of the whole width
    equal = common[sa] >= width
    tied = np.flatnonzero(equal | np.append(equal[1:], False))
    group, w = np.cumsum(~equal)[tied], number[sa[tied]]
    of, start = seg[w], a[seg[w]] + k[w]
    order = np.lexsort((start, block[of], ties[of], ids[of], group))
    repeat = np.zeros(len(w), dtype=bool)
    repeat[order[1:]] = group[order[1:]] == group[order[:-1]]
    return of[repeat], k[w[repeat]]


def _cut(width: int, with_text: bool):
    def run(blocks: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in blocks.itertuples(index=False):
            block = Block(r)
            a = _of_rows(notes["a"], np.uint32).astype(np.int64)
            end = a + _of_rows(notes["n"], np.uint32) + (width - 1)
            order = np.argsort(a, kind="stable")
            a, end = a[order], np.maximum.accumulate(end[order])
            doc = block.documents(a)
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] > end[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            a, end, doc = a[first], end[np.append(first[1:], len(new)) - 1] if len(first) else end, doc[first]
            spans = np.bincount(doc, minlength=len(block.ids))
            gone = np.bincount(doc, weights=end - a, minlength=len(block.ids)).astype(np.int64)
            edges, used, body = np.column_stack((a, end)).tolist(), 0, memoryview(block.body)
            columns = block.ids.tolist(), block.null.tolist(), block.starts.tolist(), block.lens.tolist(), gone.tolist(), spans.tolist()
            for d, null, at, n, g, s in zip(*columns, strict=True):
                kept, x = [], at
                for y, z in edges[used : used + s]:
                    kept.append(body[x:y])
                    x = z
                used += s
                kept = b"".join([*kept, body[x : at + n]]) if s else body[at : at + n]
                row = (None if null else d, n, g, s, hashlib.sha256(kept).hexdigest())
                rows.append((*row, bytes(kept).decode("utf-8", "replace")) if with_text else row)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = pd.array([x[0] for x in rows], dtype="Int64")
        return out

    return run


def _total(df: DataFrame, col: str) -> int:
    return int(df.agg(F.sum(col)).first()[0] or 0)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, with_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) per row;
    ``width`` must be above ``GRAM`` bytes.  A cut inside a character leaves
    replacement characters in ``kept_text``; the digest is of the bytes."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(docs.mapInArrow(_blocks, BLOCKS), "repeat_blocks")
    n_buckets = buckets_for(_total(blocks, "size"), BUCKET_BYTES)
    questions = blocks.mapInPandas(_ask(n_buckets, width), QUESTIONS)
    answers = written(questions.groupBy("bucket").applyInPandas(_answer(width), NOTES), "repeat_answers")
    n_bins = buckets_for(_total(answers, "bytes"), BIN_BYTES, 64)
    by_block = blocks.groupBy("block")
    to_sort = answers.where(F.col("kind") == SORT).groupBy("block")
    sent = by_block.cogroup(to_sort).applyInPandas(_send(n_bins, width), SENT)
    marks = written(sent.groupBy("bin").applyInPandas(_sorted_bin(width), NOTES), "repeat_marks")
    gone = answers.where(F.col("kind") == GONE).union(marks).select("block", "a", "n").groupBy("block")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return by_block.cogroup(gone).applyInPandas(_cut(width, with_text), schema)
