"""Plain, slow versions of the operators."""

import collections
import re


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def jaccard_components(rows):
    """{doc_id: (n_shingles, component_id)} of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    groups = Union(sets)
    for i, s in sets.items():
        shared = collections.Counter()
        for g in s:
            shared.update(j for j in holders[g] if j < i)
        for j, k in shared.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                groups.join(i, j)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def cross_parse(corpus: list, text: list) -> int:
    """Phrases of the greedy parse of ``text`` into longest substrings of ``corpus``."""
    def known(part):
        return any(corpus[i:i + len(part)] == part for i in range(len(corpus) - len(part) + 1))

    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and known(text[i:i + n]) and known(text[i:i + n + 1]):
            n += 1
        count, i = count + 1, i + n
    return count


def smith_waterman(a, b, mismatch=0.5, gap=0.5):
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0.0, h[i - 1][j - 1] + (1.0 if x == y else -mismatch), h[i - 1][j] - gap, h[i][j - 1] - gap)
            best = max(best, h[i][j])
    return best
