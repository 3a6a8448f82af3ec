"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_rows(df: DataFrame, keep: tuple[str, ...], array: Column | str, pos: str, value: str) -> DataFrame:
    """One row per array element with its position; no row for an empty or NULL array.

    The outer form is used because the optimizer gives the plain one a size filter on the
    array and pushes it down to the scan, where a costly array (words, chunks, vectors)
    would be worked out a second time.
    """
    column = F.col(array) if isinstance(array, str) else array
    return df.select(*keep, F.posexplode_outer(column).alias(pos, value)).filter(F.col(pos).isNotNull())
