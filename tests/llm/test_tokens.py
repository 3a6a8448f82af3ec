"""Packing, word encoding and token counts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.best_fit_packing import best_fit_packing, pack_lengths
from corpusloom.llm.byte_words import text_buffer
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.token_counts import allocate, line_spans, load_encoding, section_token_counts
from corpusloom.llm.word_tokens import WordEncoder

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = ["Hello, World! it's 42 o'clock", "", None, "  lead and trail \n", "ÀÉî ΣΑΣ naïve é   nbsp　wide", "<|endoftext|> a<|startoftext|>b",
         "x" * 500 + " y", "don't 's 't 're", "漢字かな 😀😀", "a\x00b \x0b\x0c\r c", "'s't 'll"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_word_encoder_equals_whole_texts(plain):
    encoder = WordEncoder(PATH)
    for texts in (TEXTS, TEXTS[::-1] + ["Hello, World! again"]):
        ids, counts = encoder.encode(*text_buffer(pa.array(texts)))
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_word_encoder_tells_colliding_words_apart(plain):
    encoder = WordEncoder(PATH)
    encoder.hasher.codes[:] = 0  # words of one length have one hash
    ids, counts = encoder.encode(*text_buffer(pa.array(["cat dog", "dog cat"])))
    assert ids.tolist() == [i for t in ("cat dog", "dog cat") for i in plain.encode(t, add_special_tokens=False).ids]


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences)


def test_packing_holds_every_piece(documents, odd_rows, plain):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, "word " * (i % 37)) for i in range(300)]
    got = best_fit_packing(documents(rows).repartition(3), PATH, capacity=64).collect()
    want = []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 64):
            cut = ids[k:k + 64]
            want.append((i, k // 64, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert check_packing(got, 64) <= -(-sum(r.length for r in got) // 64) * 1.02 + 1
    assert best_fit_packing(documents([]), PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_length_as_often_as_it_occurs(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([10, 64, 500]))
    counts = np.zeros(capacity + 1, np.int64)
    for length in rng.integers(1, capacity + 1, 60):
        counts[length] += rng.integers(1, 50)
    plan = pack_lengths(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    for times, lengths in plan:
        assert times > 0 and sum(lengths) <= capacity
        for n in lengths:
            used[n] += times
    assert (used == counts).all()
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    assert sum(t for t, _ in plan) <= max(least * 1.25 + 2, (counts[capacity // 2 + 1:]).sum())


def test_exact_complements_are_found():
    counts = np.zeros(101, np.int64)
    for n, k in ((60, 5), (40, 2), (25, 2), (15, 2), (20, 1), (10, 2)):
        counts[n] = k
    assert sorted(sum(x) for t, x in pack_lengths(counts, 100) for _ in range(t)) == [100] * 5


def test_lines_equal_split():
    for text in ("", "a", "a\n", "\n", "a\nb", "a\n\nb\n"):
        raw = np.frombuffer(text.encode(), np.uint8)
        start, end = line_spans(raw)
        assert [text[a:b] for a, b in zip(start, end)] == (text.splitlines(keepends=True) or [""])


def slow_allocate(token_end, start, end, rule):
    counts, outside, before = [0.0] * len(start), 0.0, 0
    for stop in token_end:
        over = [max(0, min(stop, e) - max(before, s)) for s, e in zip(start, end)]
        own = [i for i, v in enumerate(over) if v]
        if rule == "share":
            for i in own:
                counts[i] += over[i] / (stop - before)
            outside += 1 - sum(over) / (stop - before)
        else:
            pick = None
            if own and rule == "most":
                pick = max(own, key=lambda i: (over[i], -i))
            elif own and rule == "first" and start[own[0]] <= before:
                pick = own[0]
            elif own and rule == "last" and end[own[-1]] >= stop:
                pick = own[-1]
            if pick is None:
                outside += 1
            else:
                counts[pick] += 1
        before = stop
    return counts, outside


@pytest.mark.parametrize("rule", ["first", "last", "most", "share"])
def test_allocation_equals_brute_force(rule):
    rng = np.random.default_rng(3)
    for _ in range(80):
        token_end = np.cumsum(rng.integers(1, 5, rng.integers(1, 20)))
        edges = np.sort(rng.integers(0, token_end[-1] + 1, 2 * rng.integers(1, 6)))
        start, end = edges[::2], edges[1::2]
        counts, _, outside = allocate(token_end, start, end, rule)
        want, beyond = slow_allocate(token_end.tolist(), start.tolist(), end.tolist(), rule)
        assert counts.tolist() == pytest.approx(want) and outside == pytest.approx(beyond)


@pytest.fixture(scope="module")
def encoding():
    import public_tokenizers

    return tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_counts_add_up_to_documents(documents, odd_rows, encoding):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = section_token_counts(documents(rows), *encoding).collect()
    enc, _ = load_encoding(*encoding)
    text = {i: t for i, t in rows if i is not None}
    for i, t in text.items():
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.section)
        copies = sum(1 for j, _ in rows if j == i)
        assert sum(r.n_tokens for r in mine) == copies * len(enc.encode_ordinary(t or ""))
        assert {r.doc_tokens for r in mine} == {len(enc.encode_ordinary(t or ""))}
        if copies == 1:
            assert "".join((t or "")[r.start_char:r.end_char] for r in mine) == (t or "")
    assert section_token_counts(documents([]), *encoding).collect() == []


def test_given_sections(documents, encoding):
    docs = documents([(1, "título: naïve text about things"), (2, None), (3, "x")]).withColumn(
        "fields", F.when(F.col("doc_id") == 1, F.expr("array(struct(0 AS start, 7 AS end), struct(8 AS start, 99 AS end))")))
    got = {(r.doc_id, r.section): r for r in section_token_counts(docs, *encoding, rule="first", sections="fields").collect()}
    assert (got[1, 0].start_char, got[1, 0].end_char, got[1, 1].end_char) == (0, 7, 31)
    enc, _ = load_encoding(*encoding)
    assert sum(r.n_tokens for k, r in got.items() if k[0] == 1) == len(enc.encode_ordinary("título: naïve text about things"))
    assert got[3, -1].n_tokens == 1 and (2, 0) not in got
    with pytest.raises(ValueError):
        section_token_counts(docs, *encoding, rule="none")


def test_words_encoded_together_have_their_own_ids():
    import public_tokenizers

    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.mark is not None
    plain = lambda words: [encoder.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids for w in words]
    words = [f"word{i}'s".encode() for i in range(700)] + ["Größe,".encode(), "漢字😀".encode(), b"...", b"x" * 3000, b"'ll"]
    for some in (words, words[:1], [*words[:5], b"odd\x1fword", b"\x1f"], [b"\xc3", b"\xff\xfeab"]):
        ids, sizes = encoder._word_ids(some)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == plain(some)
