import pytest

# Columns that the operators use inside, as extra columns of the input.
CLASHING = "_text string, _rank bigint, node bigint, key bigint, text_sha256 string, score double, label int, _key binary, n bigint, h bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text, ...) with extra columns whose names clash."""

    def make(rows):
        wide = [(*r, *[None] * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(wide, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        for part in CLASHING.split(", "):
            name, kind = part.split(" ")
            df = df.selectExpr("*", f"cast(NULL AS {kind}) AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty, blank, very long, tied and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "no id here at all my friend"), (None, None), (4, long), (5, long + " end"),
        (6, "same text of seven words for ties"), (7, "same text of seven words for ties"), (7, "same text of seven words for ties"),
        (8, "x" * 3000), (9, "é ü ß 漢字 😀"), (10, "12345 67890"), (11, "Same  text of seven words\nfor ties"),
    ]
