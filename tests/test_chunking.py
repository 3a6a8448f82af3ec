"""Chunk packing: fixed cases and properties."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.functions import chunking as C
from corpusloom.functions.chunking import pack_text, split_line, unit_length
from corpusloom.functions.text import WS_CHARS
from corpusloom.operators.chunks import chunk_text

CASES = {
    "blank only": (" \n\t\n　\n", 4, []),
    "empty": ("", 4, []),
    "line at the limit": ("a" * 16 + "\nb", 4, ["a" * 16, "b"]),
    "long line then short ones": ("aa bb cc dd ee ff gg\nx\ny", 2, ["aa bb", "cc dd", "ee ff", "gg", "x\ny"]),
    "word over the limit": ("aaaaaaaaaaaa bb", 2, ["aaaaaaaa", "aaaa", "bb"]),
    "word at the limit": ("aaaaaaaa b cc", 2, ["aaaaaaaa", "b cc"]),
    "trailing spaces": ("  ab  \n  cd  ", 4, ["ab  \n  cd"]),
    "control characters are content": ("\x1c\nab", 4, ["\x1c\nab"]),
    "other white space is trimmed": (" ab ", 4, ["ab"]),
    "newlines are not counted": ("abcd\nabcd\nabcd", 2, ["abcd\nabcd", "abcd"]),
    "pairs count twice": ("\U0001F600" * 4 + "\nb", 2, ["\U0001F600" * 4, "b"]),
    "pairs are not split": ("\U0001F600" * 5, 2, ["\U0001F600" * 4, "\U0001F600"]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    text, limit, want = CASES[name]
    assert pack_text(text, limit, 4, "utf16") == want


def test_cases_in_spark(spark):
    rows = [(n, text, limit) for n, (text, limit, _) in CASES.items()]
    for limit in {r[2] for r in rows}:
        df = spark.createDataFrame([r for r in rows if r[2] == limit], "name string, text string, m int")
        got = {}
        for r in chunk_text(df, limit, keep=("name",)).orderBy("name", "chunk_pos").collect():
            got.setdefault(r["name"], []).append(r["chunk_text"])
        for name, (_, m, want) in CASES.items():
            if m == limit:
                assert got.get(name, []) == want, name


def test_code_points(spark):
    df = spark.createDataFrame([("a", "\U0001F600" * 8 + "\nb")], "name string, text string")
    by_point = chunk_text(df, 2, keep=("name",), units="codepoint").collect()
    assert sorted(r["chunk_text"] for r in by_point) == sorted(["\U0001F600" * 8, "b"])


@pytest.mark.parametrize("limit", [0, -1])
def test_limit_below_one_is_refused(spark, limit):
    df = spark.createDataFrame([("a", "b")], "name string, text string")
    with pytest.raises(ValueError):
        chunk_text(df, limit, keep=("name",))


TEXT = st.text(alphabet="ab \n\t\U0001F600　", max_size=200)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 6))
def test_properties(text, limit):
    chunks = pack_text(text, limit, 4, "utf16")
    kept = "".join(ch for ch in text if ch not in WS_CHARS)
    assert "".join(ch for c in chunks for ch in c if ch not in WS_CHARS) == kept
    for c in chunks:
        assert unit_length(c, "utf16") <= limit * 4 + c.count("\n")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \U0001F600", max_size=100), st.integers(4, 12))
def test_split_line_bound(line, size):
    for piece in split_line(line, size, "utf16"):
        assert unit_length(piece, "utf16") <= size


def test_golden_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for limit, want in ((8191, 200), (64, 2607), (8, 17466)):
        assert chunk_text(docs, limit, keep=("doc_id",)).count() == want


def test_pieces_are_python_strings_for_few_texts_at_a_time():
    at_once = []

    def cut(text):
        at_once.append(text)
        return [text] * 3

    texts = pa.array([f"t{i}" if i % 5 else None for i in range(3 * C.SLICE + 7)])
    lists = C._lists(texts, cut)
    assert lists.to_pylist() == [None if t is None else [t] * 3 for t in texts.to_pylist()]
    assert C._lists(texts[:0], cut).type == lists.type and len(at_once) == texts.drop_null().__len__()
