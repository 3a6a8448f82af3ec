"""Pages to Markdown-like text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import is_blank, trim_ws

# Applied in order over the whole page.
PAGE_RULES = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?i)<h1\b[^>]*>", "\n# "),
    (r"(?i)<h2\b[^>]*>", "\n## "),
    (r"(?i)<h3\b[^>]*>", "\n### "),
    (r"(?i)<h[4-6]\b[^>]*>", "\n#### "),
    (r"(?i)<li\b[^>]*>", "\n- "),
    (r"(?i)<t[dh]\b[^>]*>", " | "),
    (r"(?i)</?(?:p|br|div|tr|ul|ol|table|h[1-6]|article|section|nav)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
    (r"[ \t]+", " "),
    (r" *\n *", "\n"),
    (r"\n+", "\n"),
)


def page_text(html: Column) -> Column:
    return trim_ws(reduce(lambda c, rule: F.regexp_replace(c, *rule), PAGE_RULES, html))


def extract_text(pages: DataFrame, html: str = "html", out: str = "text", model=None) -> DataFrame:
    """Text of every page with headings and list items marked.

    ``model`` may be an Arrow UDF for formats that regular expressions cannot read.
    A page without text gets a ``reject_reason``.
    """
    body = page_text(F.col(html)) if model is None else model(F.col(html))
    return pages.withColumn(out, body).withColumn(
        "reject_reason", F.when(is_blank(F.col(out)), "no text extracted"),
    )
