"""Column expressions over names and text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when lines are tested for
# blankness and chunks are trimmed (Unicode White_Space).
WS_CLASS = (
    r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]),
)

# Token estimate and default chunk limit.
CHARS_PER_TOKEN = 4
DEFAULT_MAX_TOKENS = 8191


def is_blank(c: Column) -> Column:
    """NULL, empty or white space only."""
    return F.coalesce(~c.rlike(f"[^{WS_CLASS}]"), F.lit(True))


def trim_ws(c: Column) -> Column:
    """Strip Unicode white space at both ends (SQL ``trim`` strips only spaces)."""
    return F.regexp_replace(c, rf"^[{WS_CLASS}]+|[{WS_CLASS}]+\z", "")


def text_units(c: Column, units: str = "utf16") -> Column:
    """Length in UTF-16 code units, or in code points with ``units='codepoint'``."""
    if units == "codepoint":
        return F.length(c)
    return (F.octet_length(F.encode(c, "UTF-16LE")) / 2).cast("int")


def token_estimate(c: Column, chars_per_token: int = CHARS_PER_TOKEN, units: str = "utf16") -> Column:
    """ceil(length / chars_per_token)."""
    return F.ceil(text_units(c, units) / F.lit(chars_per_token)).cast("int")


def words(c: Column) -> Column:
    """Lower-cased runs of letters and digits, in text order."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def content_lines(c: Column) -> Column:
    """Lines of the text that hold something other than white space."""
    return F.filter(F.split(c, "\n", -1), lambda line: line.rlike(f"[^{WS_CLASS}]"))


def stem(c: Column) -> Column:
    """File name without directory and without its last extension."""
    return F.regexp_replace(F.substring_index(c, "/", -1), r"\.[^.]*\z", "")


def result_name(c: Column) -> Column:
    return F.concat(stem(c), F.lit(".md"))


def index_key(file_name: Column, pos: Column) -> Column:
    """Hex SHA-1 of file name and chunk position: the same chunk always gets the same key."""
    return F.sha1(F.concat_ws("\u0001", file_name, pos.cast("string")).cast("binary"))


def empty_strings() -> Column:
    return F.array().cast("array<string>")
