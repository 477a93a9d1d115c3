"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

``suffix_array`` classifies suffixes as S or L, sorts the leftmost-smaller (LMS)
substrings by one induction, names them, sorts the string of names, and induces
the whole array from the sorted LMS suffixes.  An induction goes through the
letters' buckets in order and moves whole buckets at a time: a suffix's
predecessor takes its place after the suffix, so a stable grouping by letter of
a bucket's predecessors, in order, appends them to their buckets.  Letter and
type stand in one code, so a predecessor is looked up once.  Letters are numbered
anew without gaps.  Work is linear in the text, and one step for each letter.

The string of names is sorted by the same method while its alphabet is small
(``MAX_LETTERS``), and by doubling ranks beyond, as an induction by letters would
then take a step for each name.  A round of doubling sorts only what is still
tied.  ``depth`` bounds how far suffixes are compared: those that agree on
``depth`` letters stand together, in any order.
"""

from __future__ import annotations

import numpy as np

MAX_LETTERS = 512
_NONE = np.empty(0, dtype=np.int64)


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the last one is S."""
    out = np.ones(len(t), dtype=bool)
    np.less(t[:-1], t[1:], out=out[:-1])
    alike = np.flatnonzero(t[:-1] == t[1:])
    if len(alike):  # an equal run takes the type of its last member
        last = np.flatnonzero(np.append(alike[1:] != alike[:-1] + 1, True))
        out[alike] = np.repeat(out[alike[last] + 1], np.diff(last, prepend=-1))
    return out


def _grouped(suffixes: np.ndarray, code: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Suffixes of one type by letter, in order inside; small codes take a radix sort."""
    count = np.bincount(code)
    found = np.flatnonzero(count)
    parts = np.split(suffixes[np.argsort(code, kind="stable")], np.cumsum(count[found])[:-1])
    return list(zip((found >> 1).tolist(), parts, strict=True))


def _pass(code: np.ndarray, size: int, s_type: int, seeds: list[np.ndarray]) -> list[np.ndarray]:
    """One direction of an induction: the suffixes of a type by first letter, L
    by ascending letters and S by descending ones, from the seeds of each letter."""
    waiting: list[list[np.ndarray]] = [[] for _ in range(size)]
    done = [_NONE] * size
    for c in range(size) if s_type == 0 else range(size - 1, -1, -1):
        own, seen = [], []
        todo = np.concatenate(waiting[c]) if waiting[c] else _NONE
        waiting[c] = []
        while len(todo):  # runs of one letter
            own.append(todo)
            before = todo - 1  # the sentinel's code stands before the first suffix
            kind = code.take(before, mode="wrap")
            run = kind == 2 * c + s_type
            other = ((kind & 1) == s_type) & ~run
            seen.append((before[other], kind[other]))
            todo = before[run]
        if s_type and c == 0:
            own = [np.array([len(code) - 1])]  # the sentinel
        if own:
            done[c] = np.concatenate(own) if len(own) > 1 else own[0]
        if len(seeds[c]):
            before = seeds[c] - 1
            kind = code.take(before, mode="wrap")
            other = (kind & 1) == s_type
            seen.append((before[other], kind[other]))
        if not seen:
            continue
        before, kind = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*seen, strict=True))
        if len(before):
            for letter, part in _grouped(before, kind):
                waiting[letter].append(part)
    return done


def _induce(code: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """The array, given the LMS suffixes in order: L suffixes by ascending
    letters, then S suffixes by descending letters."""
    seeds = [_NONE] * size
    for c, part in _grouped(lms, code[lms]):
        seeds[c] = part
    l_part = _pass(code, size, 0, seeds)
    s_part = _pass(code, size, 1, [p[::-1] for p in l_part])
    return np.concatenate([x for c in range(size) for x in (l_part[c], s_part[c][::-1])])


def _sorted_with_places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their places, of ``bits`` bits each: one sort of numbers."""
    both = np.sort((key << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64))
    return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def _by_doubling(names: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names``, whose letters begin at ``at``, exact
    for ``depth`` letters.  A rank is the place of the first suffix that is tied
    with it; key and place are sorted as one number while they fit."""
    n = len(names)
    bits, letters = int(n).bit_length(), int(names.max() + 1).bit_length()
    # to begin with, as many names as fit beside the place
    span = min(n, (64 - bits) // letters)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(span):
        key[: n - k] |= (names[k:] + 1).astype(np.uint64) << np.uint64(letters * (span - 1 - k))
    key, mine = _sorted_with_places(key, bits)
    order, slot, rank = mine.copy(), np.arange(n), np.empty(n, dtype=np.int64)
    while True:
        new = np.ones(len(mine), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(mine)))
        rank[mine] = np.repeat(slot[first], size)
        # ties whose letters so far reach the depth stand as they are
        over = mine[first] + span
        covered = np.where(over < n, at[np.minimum(over, n - 1)] - at[mine[first]], 0)
        tied = np.repeat((size > 1) & (covered < depth), size)
        slot, mine = slot[tied], mine[tied]
        if not len(mine):
            return order
        later = mine + span
        later = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        key = (rank[mine] << bits) | later
        place = int(len(mine)).bit_length()
        if 2 * bits + place <= 64:
            key, by = _sorted_with_places(key.astype(np.uint64), place)
        else:
            by = np.argsort(key, kind="stable")
            key = key[by]
        mine = mine[by]
        order[slot] = mine
        span *= 2


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of integers >= 1; a sentinel 0 is appended and dropped."""
    if not len(t):
        return np.empty(0, dtype=np.int64)
    used = np.zeros(int(t.max()) + 1, dtype=bool)
    used[t] = used[0] = True
    size = int(used.sum())
    number = (np.cumsum(used) - 1).astype(_smallest(size))
    return _sais(np.append(number[t], number[:1]), size, depth or len(t))[1:]


def _smallest(size: int) -> type:
    """The smallest integers below ``size``, of two bytes at least."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def _same_substrings(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the substrings of ``t`` at ``a`` and ``b``, of one length, agree."""
    word, letters = _words(t)
    same = np.ones(len(a), dtype=bool)
    left, offset = np.arange(len(a)), 0
    while len(left):
        rest = np.minimum(length[left] - offset, letters).astype(np.uint64)
        shift = np.uint64(64) - rest * np.uint64(64 // letters)
        differ = (word[a[left] + offset] ^ word[b[left] + offset]) << shift != 0
        same[left[differ]] = False
        offset += letters
        left = left[~differ]
        left = left[length[left] > offset]
    return same


def _words(t: np.ndarray) -> tuple[np.ndarray, int]:
    """By position, so many letters from there on in one word, the first one in
    the lowest bits; the letter 0 stands after the end."""
    top = int(t.max()) if len(t) else 0
    kind, letters = (np.uint8, 8) if top < 1 << 8 else (np.uint16, 4) if top < 1 << 16 else (np.uint32, 2)
    wide = np.zeros(len(t) + letters, dtype=kind)
    wide[: len(t)] = t
    step = wide.itemsize
    return np.lib.stride_tricks.as_strided(wide.view(np.uint8)[:8].view("<u8"), shape=(len(t),), strides=(step,)).copy(), letters


def _sais(t: np.ndarray, size: int, depth: int) -> np.ndarray:
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    is_s = _types(t)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[1:] = is_s[1:] & ~is_s[:-1]
    lms = np.flatnonzero(is_lms)
    code = t.astype(np.uint8 if size <= 1 << 7 else np.uint16 if size <= 1 << 15 else np.int64)
    code += code
    code += is_s
    first = _induce(code, lms, size)
    by_substring = first[is_lms[first]]
    # names: equal LMS substrings, from one LMS place to the next, are equal names
    place = np.cumsum(is_lms, dtype=np.int32).take(by_substring) - 1
    length = (np.append(np.diff(lms), 0) + 1)[place]
    same = length[1:] == length[:-1]
    maybe = np.flatnonzero(same)
    same[maybe] = _same_substrings(t, by_substring[maybe], by_substring[maybe + 1], length[maybe])
    names = np.empty(len(lms), dtype=np.int64)
    names[place] = np.concatenate(([0], np.cumsum(~same)))
    count = int(names.max()) + 1
    if count == len(lms):
        order = np.empty(len(lms), dtype=np.int64)
        order[names] = np.arange(len(lms))
    elif count <= MAX_LETTERS:
        order = _sais(names, count, depth)
    else:
        order = _by_doubling(names, lms, depth)
    return _induce(code, lms[order], size)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """By text position: letters, ``cap`` at most, that a suffix shares with its
    predecessor in ``sa``, the array or some of its suffixes in order (0 for the
    first, and for suffixes that are left out).

    Four letters below 2^16, or eight below 2^8, are packed in a word, and all
    positions are compared side by side, a word a round, while they agree."""
    n = len(t)
    out = np.zeros(n, dtype=np.int64)
    if len(sa) < 2:
        return out
    word, letters = _words(t)
    wide = 64 // letters
    at, other = sa[1:], sa[:-1]
    offset = 0
    while len(at) and offset < cap:
        x, y = at + offset, other + offset
        inside = np.minimum(n - x, n - y)
        differ = word[x] ^ word[y]
        lowest = differ & (~differ + np.uint64(1))
        same = np.full(len(at), letters)
        odd = np.flatnonzero(differ)
        same[odd] = np.frexp(lowest[odd].astype(np.float64))[1] - 1
        same[odd] //= wide
        same = np.clip(np.minimum(same, inside), 0, cap - offset)
        out[at] = offset + same
        on = (same == letters) & (inside > letters)
        at, other, offset = at[on], other[on], offset + letters
    return out
