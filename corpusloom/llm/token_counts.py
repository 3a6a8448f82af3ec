"""Token counts of fields or sections by offset-mapped attribution.

A whole document is encoded once. Its byte-level tokens cover its bytes without gaps, so running sums of
their lengths are their offsets; an interval join with the sections' spans gives each section its tokens. A
token that lies in several sections is allocated by a named rule, so the counts of a document's sections
add up to the tokens of the document, which counting each section by itself would not do.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import text_buffer

#: first: the section of the token's first byte; last: of its last byte; most: the one with most of its
#: bytes, the earlier one on a tie; share: all of them, in proportion to their bytes.
RULES = ("first", "last", "most", "share")
_LOADED: dict = {}


def load_encoding(ranks_path: str, pattern: str):
    """(encoding, byte length of each token), once per Python worker."""
    key = (ranks_path, pattern)
    if key not in _LOADED:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _LOADED[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _LOADED[key]


def line_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the lines of a text, each with its line feed."""
    if not len(raw):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    ends = np.flatnonzero(raw == 10) + 1
    if not len(ends) or ends[-1] < len(raw):
        ends = np.append(ends, len(raw))
    return np.concatenate([[0], ends[:-1]]), ends


def allocate(token_end: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(tokens per section, crossing tokens per section, tokens in no section).

    Tokens are [0, token_end[0]), [token_end[0], token_end[1]) ...; sections [start, end) are in order and do
    not overlap, but may leave gaps and may be empty.
    """
    n = len(start)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(token_end):
        return counts, crossing, 0.0
    token_start = np.concatenate([[0], token_end[:-1]])
    filled = np.flatnonzero(end > start)
    if not len(filled):
        return counts, crossing, float(len(token_end))
    lo, hi = start[filled], end[filled]
    first = np.searchsorted(hi, token_start, "right")  # the first section that ends after the token's start
    last = np.searchsorted(lo, token_end, "left") - 1  # the last one that begins before its end
    inside = (first == last) & (lo[np.minimum(first, len(lo) - 1)] <= token_start) & (token_end <= hi[np.minimum(first, len(lo) - 1)])
    counts += np.bincount(filled[first[inside]], minlength=n)
    outside = 0.0
    for i in np.flatnonzero(~inside):
        a, b = int(first[i]), int(last[i])
        if a > b:
            outside += 1
            continue
        over = np.minimum(hi[a:b + 1], token_end[i]) - np.maximum(lo[a:b + 1], token_start[i])
        of = filled[a:b + 1]
        crossing[of] += 1
        if rule == "share":
            counts[of] += over / (token_end[i] - token_start[i])
            outside += 1 - over.sum() / (token_end[i] - token_start[i])
        elif rule == "most":
            counts[of[over.argmax()]] += 1
        elif rule == "first" and lo[a] <= token_start[i]:
            counts[of[0]] += 1
        elif rule == "last" and hi[b] >= token_end[i]:
            counts[of[-1]] += 1
        else:
            outside += 1
    return counts, crossing, outside


def section_token_counts(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most", sections: str | None = None,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, start_char, end_char, n_tokens, n_crossing, doc_tokens), one row per section of each row of ``docs``.

    ``sections`` names a column of arrays of structs (start, end) in code points, in order and without overlap;
    without it the sections are the lines of the text. ``section`` counts from 0; tokens in none of the given
    sections are a row with section -1. ``ranks_path`` and ``pattern`` describe a byte-level tokenizer.

    - A NULL or empty text has no tokens; by lines it is one empty section. A NULL array is no section.
    - Spans beyond the text end with it. NULL and repeated ids are kept; each row is counted by itself.
    - An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
        *([F.transform(sections, lambda s: s["start"].cast("bigint")).alias("_starts"), F.transform(sections, lambda s: s["end"].cast("bigint")).alias("_ends")] if sections else []),
    )

    def count(raw, starts, ends, encoding, sizes):
        """Rows (section, start, end, tokens, crossing) of one text."""
        ids = np.array(encoding.encode_ordinary(raw.tobytes().decode("utf-8", "replace")), np.int64)
        token_end = np.cumsum(sizes[ids])
        # Byte offsets of code points: positions of bytes that do not continue one.
        heads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        if sections:
            lo, hi = (heads[np.clip(np.array(v or [], np.int64), 0, len(heads) - 1)] for v in (starts, ends))
        else:
            lo, hi = line_spans(raw)
        counts, crossing, outside = allocate(token_end, lo, hi, rule)
        number = np.arange(len(lo))
        at = [np.searchsorted(heads, v) for v in (lo, hi)]
        if outside > 1e-9:
            return (np.append(number, -1), np.append(at[0], 0), np.append(at[1], 0), np.append(counts, outside), np.append(crossing, 0)), len(ids)
        return (number, *at, counts, crossing), len(ids)

    def run(batches):
        encoding, sizes = load_encoding(ranks_path, pattern)
        for batch in batches:
            at, raw = text_buffer(batch.column("text"))
            starts = batch.column("_starts").to_pylist() if sections else [None] * batch.num_rows
            ends = batch.column("_ends").to_pylist() if sections else [None] * batch.num_rows
            rows, parts, totals = [], [], []
            for i in range(batch.num_rows):
                part, total = count(raw[at[i]:at[i + 1]], starts[i], ends[i], encoding, sizes)
                rows.append(np.full(len(part[0]), i))
                totals.append(np.full(len(part[0]), total))
                parts.append(part)
            if not parts:
                continue
            section, lo, hi, counts, crossing = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(np.concatenate(rows))), pa.array(section.astype(np.int32)), pa.array(lo.astype(np.int64)),
                 pa.array(hi.astype(np.int64)), pa.array(counts.astype(np.float64)), pa.array(crossing.astype(np.int64)), pa.array(np.concatenate(totals).astype(np.int64))],
                ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"],
            )

    return slim.mapInArrow(
        run, "doc_id bigint, section int, start_char bigint, end_char bigint, n_tokens double, n_crossing bigint, doc_tokens bigint",
    )
