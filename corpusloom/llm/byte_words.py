"""Words and word n-grams of Arrow text columns as 64-bit hashes, worked out on whole byte buffers.

A batch is handled in pieces of about ``PIECE`` bytes (small enough for the processor's cache), so memory does not depend on the batch
size; a text is never cut, whatever its length, except that very long ones are hashed in several
passes of ``PIECE`` bytes cut between words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 16
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_WRAP = 1 << 16


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return h.view(np.int64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at, raw


class WordHasher:
    """Hashes maximal runs of word bytes; A-Z count as a-z with ``fold_case``.

    ``separators`` are the bytes between words. With ``letters_only`` every ASCII byte that is
    neither letter nor digit separates words too, so that punctuation does not matter.
    """

    def __init__(self, seed: int = 0, letters_only: bool = False, fold_case: bool = True):
        is_word = np.ones(256, bool)
        is_word[list(WHITE_SPACE)] = False
        if letters_only:
            is_word[[b for b in range(128) if not chr(b).isalnum()]] = False
        fold = np.arange(256)
        fold[65:91] += 32 * fold_case
        codes = mix(np.arange(256, dtype=np.uint64) + np.uint64(1), seed + 101)[fold]
        codes[~is_word] = 0
        self.is_word, self.codes = is_word, codes
        powers = np.full(_WRAP, 0x9E3779B97F4A7C15 | 1, np.uint64)
        powers[0] = 1
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(powers)

    def words(self, at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start byte, end byte, index of its text) of every word of consecutive texts."""
        found = [self._piece(at, raw, a, b) for a, b in self._pieces(at, raw)]
        if not found:
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        h, start, end = (np.concatenate(x) for x in zip(*found))
        return h, start, end, np.searchsorted(at, start, "right") - 1

    def _pieces(self, at: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, int]]:
        a, last = int(at[0]), int(at[-1])
        while a < last:
            b = min(a + PIECE, last)
            while b < last and self.is_word[raw[b]]:  # to the end of the word
                run = self.is_word[raw[b:min(b + PIECE, last)]]
                b += len(run) if run.all() else int(np.argmin(run))
            yield a, b
            a = b

    def _piece(self, at, raw, a, b):
        data = raw[a:b]
        word = self.is_word[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        heads = at[np.searchsorted(at, a):np.searchsorted(at, b)] - a
        heads = heads[heads < b - a]
        first[heads] = word[heads]  # a text starts a word of its own
        start = np.flatnonzero(first)
        if not len(start):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        end = np.minimum(np.append(start[1:], b - a), b - a)
        place = np.arange(start[0], b - a) - np.repeat(start, end - start)
        values = self.codes[data[start[0]:]]
        with np.errstate(over="ignore"):
            values *= self.powers[place & (_WRAP - 1)]
            length = np.add.reduceat(word[start[0]:].astype(np.int64), start - start[0])
            h = np.add.reduceat(values, start - start[0]) + length.astype(np.uint64)
        return mix(h), start + a, start + length + a


def text_groups(at: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    n, a = len(at) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def cut_long(at: np.ndarray, raw: np.ndarray, size: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, text of each slice): texts of more than ``size`` bytes as slices cut at white space.

    The slices cover the whole texts, so sums over them are sums over the texts in bounded memory.
    """
    if not len(at) or int(np.diff(at).max(initial=0)) <= size:
        return at, np.arange(len(at) - 1)
    cuts, owner = [int(at[0])], []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        while b - a > size:
            space = np.flatnonzero(np.isin(raw[a + size // 2:a + size], list(WHITE_SPACE)))
            a += size // 2 + int(space[-1]) if len(space) else size
            cuts.append(a)
            owner.append(i)
        cuts.append(b)
        owner.append(i)
    return np.array(cuts, np.int64), np.array(owner, np.int64)


def word_grams(h: np.ndarray, text: np.ndarray, k: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every k consecutive words of a text.

    A text with fewer words gives its whole sequence once if ``whole_if_short``, else nothing.
    """
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    head = np.ones(n, bool)
    head[1:] = text[1:] != text[:-1]
    heads = np.flatnonzero(head)
    sizes = np.diff(np.append(heads, n))
    left = np.repeat(heads + sizes, sizes) - np.arange(n)  # words from here to the text's end
    keep = left >= k
    if whole_if_short:
        keep |= head & (left < k)
    at = np.flatnonzero(keep)
    used = np.minimum(left[at], k)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            part = mix(h[np.minimum(at + j, n - 1)], j + 1)
            out += np.where(j < used, part, np.uint64(0))
        out += used.astype(np.uint64)
    return mix(out, 77), at


def distinct_per_text(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs in that order, as (values, text); ``text`` must be in order."""
    v, t = values.copy(), text
    edges = np.append(np.flatnonzero(np.diff(t, prepend=-1)), len(t))
    for a, b in zip(edges[:-1], edges[1:]):  # one text at a time, which is quicker than a sort by two keys
        v[a:b].sort()
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    return v[keep], t[keep]


def crc32_column(ids) -> np.ndarray:
    """CRC-32 of ids written as decimal text."""
    return np.array([zlib.crc32(str(x).encode()) for x in ids], np.int64)
