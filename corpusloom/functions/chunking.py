"""Packing text into token-bounded chunks.

A text whose estimate fits the limit never leaves the JVM. Only over-long texts are
sent to the Arrow helper below, because greedy packing carries a running total that
restarts at every cut.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    CHARS_PER_TOKEN,
    DEFAULT_MAX_TOKENS,
    WS_CHARS,
    content_lines,
    token_estimate,
    trim_ws,
)


def runs(costs: list[int], limit: int):
    """Cut a sequence greedily into (start, end) runs whose cost stays within ``limit``.

    A single item above the limit always forms a run of its own.
    """
    start = total = 0
    for i, cost in enumerate(costs):
        if i > start and total + cost > limit:
            yield start, i
            start, total = i, 0
        total += cost
    if costs:
        yield start, len(costs)


def unit_length(text: str, units: str) -> int:
    if units == "utf16" and not text.isascii():
        return len(text.encode("utf-16-le", "surrogatepass")) // 2
    return len(text)


def cut_word(word: str, size: int, units: str) -> list[str]:
    """Pieces of at most ``size`` units; a surrogate pair is never split."""
    if unit_length(word, units) == len(word):
        return [word[i:i + size] for i in range(0, len(word), size)]
    costs = [2 if ord(ch) > 0xFFFF else 1 for ch in word]
    return [word[a:b] for a, b in runs(costs, size)]


def split_line(line: str, size: int, units: str) -> list[str]:
    """Pack the words of one line into pieces of at most ``size`` units (plus one space)."""
    parts = [w for w in line.split(" ") if w]
    lengths = [unit_length(w, units) for w in parts]
    out: list[str] = []
    for a, b in runs([n + 1 for n in lengths], size):
        if b - a == 1 and lengths[a] > size:
            out.extend(cut_word(parts[a], size, units))
        else:
            out.append(" ".join(parts[a:b]))
    return [piece.strip(WS_CHARS) for piece in out]


def pack_text(text: str, max_tokens: int, chars_per_token: int, units: str) -> list[str]:
    lines = [line for line in text.split("\n") if line.strip(WS_CHARS)]
    costs = [-(-unit_length(line, units) // chars_per_token) for line in lines]
    out: list[str] = []
    for a, b in runs(costs, max_tokens):
        if b - a == 1 and costs[a] > max_tokens:
            out.extend(split_line(lines[a], max_tokens * chars_per_token, units))
        else:
            out.append("\n".join(lines[a:b]).strip(WS_CHARS))
    return out


# Texts whose pieces are Python strings at once.
SLICE = 64


def _lists(texts: pa.Array, cut) -> pa.Array:
    """``cut`` of every text; NULL stays NULL. Pieces are Python strings for a few texts at a time and Arrow buffers after that."""
    kind = pa.list_(pa.string())
    parts = [
        pa.array([None if t is None else cut(t) for t in texts.slice(k, SLICE).to_pylist()], kind)
        for k in range(0, len(texts), SLICE)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _positive(max_tokens: int, chars_per_token: int) -> None:
    if int(max_tokens) < 1 or int(chars_per_token) < 1:
        raise ValueError("token limit and characters per token must be at least 1")


def pack_udf(max_tokens: int = DEFAULT_MAX_TOKENS, chars_per_token: int = CHARS_PER_TOKEN, units: str = "utf16"):
    """Arrow UDF: text to its chunks; NULL stays NULL at no cost."""
    _positive(max_tokens, chars_per_token)

    @F.arrow_udf("array<string>")
    def pack(texts: pa.Array) -> pa.Array:
        return _lists(texts, lambda t: pack_text(t, max_tokens, chars_per_token, units))

    return pack


def split_line_udf(max_chars: int, units: str = "utf16"):
    """Arrow UDF: one long line to its pieces."""
    _positive(max_chars, 1)

    @F.arrow_udf("array<string>")
    def pieces(lines: pa.Array) -> pa.Array:
        return _lists(lines, lambda t: split_line(t, max_chars, units))

    return pieces


def with_chunks(df, text: str, out: str, max_tokens: int = DEFAULT_MAX_TOKENS,
                chars_per_token: int = CHARS_PER_TOKEN, units: str = "utf16"):
    """Add ``out``: the ordered chunks of ``text``. One pass over the rows, no shuffle."""
    _positive(max_tokens, chars_per_token)
    cost = F.aggregate(
        "_lines", F.lit(0).cast("bigint"),
        lambda acc, line: acc + token_estimate(line, chars_per_token, units).cast("bigint"),
    )
    staged = df.withColumn("_lines", content_lines(F.col(text))).withColumn(
        "_cost", F.coalesce(cost, F.lit(0).cast("bigint")),
    )
    fits = F.col("_cost") <= F.lit(max_tokens)
    packed = pack_udf(max_tokens, chars_per_token, units)(F.when(~fits, F.col(text)))
    whole = F.when(F.col("_cost") == 0, F.array().cast("array<string>")).otherwise(
        F.array(trim_ws(F.array_join("_lines", "\n"))),
    )
    return (
        staged.withColumn("_packed", packed)
        .withColumn(out, F.when(fits, whole).otherwise(F.col("_packed")))
        .drop("_lines", "_cost", "_packed")
    )

