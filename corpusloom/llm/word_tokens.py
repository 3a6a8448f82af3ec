"""Token ids of whole texts, with each different word encoded once.

Meant for tokenizers that drop white space and never join characters across it: the ids of a
text are then the ids of its words one after the other. Words are told apart by a 64-bit hash and
then by their bytes, so two words with one hash cannot be mistaken for each other.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from corpusloom.llm.byte_words import WordHasher

# Words that a Python worker remembers; beyond it the memory starts afresh, with the same ids.
REMEMBERED = 1 << 21
# A character that stands between words which are encoded together, and how many words that are.
MARK, TOGETHER = "\x1f", 256
_LOADED: dict[str, "WordEncoder"] = {}


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = WordHasher(5, fold_case=False)
        mark = self._encode_words([MARK, f"a {MARK} b", "a", "b"])
        one = mark[0].ids
        # The id that stands between words encoded together, if this tokenizer has one for it.
        self.mark = one[0] if len(one) == 1 and mark[1].ids == [*mark[2].ids, *one, *mark[3].ids] else None
        self._forget()

    @classmethod
    def load(cls, path: str) -> "WordEncoder":
        """One encoder per Python worker, so that words stay known from task to task."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _forget(self):
        self.known = np.zeros(0, np.uint64)  # hashes in order, and for each its entry
        self.entry = np.zeros(0, np.int64)
        self.text_at, self.text = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        self.ids_at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _learn(self, h, start, end, raw):
        """Encode words whose hash is new."""
        new, first = np.unique(h, return_index=True)
        fresh = first[~np.isin(new, self.known, assume_unique=True)]
        if not len(fresh):
            return
        words = [raw[a:b].tobytes() for a, b in zip(start[fresh], end[fresh])]
        ids, sizes = self._word_ids(words)
        n = len(self.text_at) - 1
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(words), np.uint8)])
        self.text_at = np.append(self.text_at, self.text_at[-1] + np.cumsum(end[fresh] - start[fresh]))
        self.ids = np.concatenate([self.ids, ids])
        self.ids_at = np.append(self.ids_at, self.ids_at[-1] + np.cumsum(sizes))
        at = np.searchsorted(self.known, h[fresh])  # the new hashes are in order too
        self.known = np.insert(self.known, at, h[fresh])
        self.entry = np.insert(self.entry, at, np.arange(n, n + len(fresh)))

    def _word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word). Many words go to the tokenizer as one text, with a mark after each."""
        mark = MARK.encode()
        if self.mark is None or mark in b"".join(words):
            found = [x.ids for x in self._encode_words([w.decode("utf-8", "replace") for w in words])]
            return np.array([*chain.from_iterable(found)], np.int32), np.array([len(x) for x in found], np.int64)
        glue = b" " + mark + b" "
        texts = [glue.join([*words[i:i + TOGETHER], b""]).decode("utf-8", "replace") for i in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.array(x.ids, np.int32) for x in self._encode_words(texts)])
        ends = np.flatnonzero(ids == self.mark)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _encode_words(self, words: list[str]):
        return self.tokenizer.encode_batch_fast(words, add_special_tokens=False)

    def encode(self, at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids per text)."""
        n = len(at) - 1
        h, start, end, text = self.hasher.words(at, raw)
        if not len(h):
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        if len(self.known) > REMEMBERED:
            self._forget()
        self._learn(h, start, end, raw)
        entry = self.entry[np.searchsorted(self.known, h)]
        if self._clash(entry, start, end, raw):
            return self._one_by_one(at, raw)
        sizes = self.ids_at[entry + 1] - self.ids_at[entry]
        total = int(sizes.sum())
        before = np.cumsum(sizes) - sizes
        ids = self.ids[np.arange(total) + np.repeat(self.ids_at[entry] - before, sizes)]
        return ids, np.bincount(text, weights=sizes, minlength=n).astype(np.int64)

    def _clash(self, entry, start, end, raw) -> bool:
        """Whether a word differs from the remembered one with its hash."""
        size = end - start
        if (self.text_at[entry + 1] - self.text_at[entry] != size).any():
            return True
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum()))
        same = raw[place + np.repeat(start - before, size)] == self.text[place + np.repeat(self.text_at[entry] - before, size)]
        return not same.all()

    def _one_by_one(self, at, raw):
        found = [x.ids for x in self._encode_words([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])])]
        return np.fromiter((i for x in found for i in x), np.int64), np.array([len(x) for x in found], np.int64)
