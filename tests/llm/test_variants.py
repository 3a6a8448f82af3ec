"""Spelling variants against comparing all words."""

import collections
import random
import re
import zlib

import numpy as np

from corpusloom.llm.permuterm_variants import document_variants, rotation_hashes, spelling_variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, out_of=31, least=7):
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % out_of == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                yield run


def plain_variants(words, least=2, times=10):
    n = {w: c for w, c in collections.Counter(words).items() if c >= least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) if v else None for w, v in near.items()}
    form = {w: b if b and n[b] >= times * n[w] else None for w, b in best.items()}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def collected(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_comparing_all_words(spark):
    draw = random.Random(4)
    bases = ["".join(draw.choice("abcé") for _ in range(draw.randint(1, 9))) for _ in range(40)] + ["aaaa", "aaa", "aaaaa", "aabaa", "ab"]
    words = []
    for b in bases:
        words += [b] * draw.choice([2, 3, 30, 400])
        for _ in range(8):
            i, c = draw.randrange(len(b) + 1), draw.choice("abcéz")
            words += [draw.choice([b[:i] + c + b[i:], b[:i] + c + b[i + 1:], b[:i] + b[i + 1:]])] * draw.choice([1, 2, 25])
    words = [w for w in words if w]
    got = collected(spelling_variants(spark.createDataFrame([(w,) for w in words], "word string").repartition(7)))
    assert got == plain_variants(words) and sum(r[4] > 3 for r in got) > 20 and any(r[1] and r[2] != r[1] for r in got)


def test_a_word_with_every_letter_in_one_place(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = [f"common{c}word" for c in letters for _ in range(2)] + ["commonword"] * 20 + ["commoncword"] * 300
    assert collected(spelling_variants(spark.createDataFrame([(w,) for w in words], "word string"))) == plain_variants(words)


def test_long_words(spark):
    """Around the length from which keys are hashed, and far beyond it."""
    draw = random.Random(2)
    words = []
    for size in (62, 63, 64, 65, 66, 200):
        base = "".join(draw.choice("abc") for _ in range(size))
        words += [base] * 50 + [base[:-1]] * 3 + [base[1:] + "z"] * 2 + [base[:30] + "é" + base[31:]] * 4 + [base[:40] + "x" + base[40:]] * 2
    words += ["q" * 100_000] * 30 + ["q" * 99_999] * 2 + ["q" * 500 + "r" + "q" * 99_499] * 2
    got = collected(spelling_variants(spark.createDataFrame([(w,) for w in words], "word string").repartition(4)))
    assert got == plain_variants(words)


def test_rotation_hashes_agree_with_their_texts():
    long, short = np.array([ord(c) for c in "abcabcabd"]), np.array([ord(c) for c in "abcbcabd"])
    skipped, whole = rotation_hashes(long, True).tolist(), rotation_hashes(short, False).tolist()
    assert len(set(map(tuple, skipped + whole))) == 9 + 9 - 1 and skipped[3] == whole[3]


def test_whole_documents(documents):
    draw = random.Random(8)
    vocabulary = ["Strassenbahn", "Straßenbahn", "overhead", "OVERHEAD", "overhéad", "señorita", "senorita", "façades", "facades", "letters", "better", "seventh"]
    rows = [(i % 50 if i % 9 else None, draw.choice([" ", ", ", "-", "\n", "×"]).join(draw.choices(vocabulary, k=40))) for i in range(400)]
    rows += [(7, None), (8, ""), (9, " \t "), (10, "short words only"), (11, "x" * 50_000), (11, "x" * 50_000)]
    got = collected(document_variants(documents(rows)))
    assert got == plain_variants(plain_words(rows))
    held = {r[0]: r for r in got}
    assert held["straßenbahn"][5] is None and len(held) > 15 and any(r[1] for r in got)
    assert collected(document_variants(documents(rows), out_of=3, least_length=3, times=2)) == plain_variants(plain_words(rows, 3, 3), times=2)


def test_odd_rows_and_empty_tables(documents, odd_rows, spark):
    assert collected(document_variants(documents(odd_rows))) == plain_variants(plain_words([r[:2] for r in odd_rows]))
    assert collected(document_variants(documents([]))) == []
    assert collected(spelling_variants(spark.createDataFrame([(None,), ("",), ("",), ("a",), ("a",)], "word string"))) == [("a", None, "a", 2, 0, None)]
