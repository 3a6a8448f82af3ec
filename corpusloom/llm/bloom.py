"""A Bloom filter of fixed size over 64-bit keys: built by Spark, sent to the tasks, asked in numpy.

It only spares work: a key that was put in is always found, and a filter that has filled up merely
lets more rows pass. Its size is a parameter, so what is broadcast does not grow with the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BITS = 1 << 25


def build_bloom(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The filter as bits/64 words. Keys are bigint and already hashes."""
    k = F.col(key)
    places = F.array(F.pmod(k, F.lit(bits)), F.pmod(F.shiftrightunsigned(k, 29), F.lit(bits)))
    words = (
        keys.select(F.explode(places).alias("_bit"))
        .selectExpr("shiftrightunsigned(_bit, 6) AS word", "shiftleft(1L, cast(_bit % 64 AS int)) AS mask")
        .groupBy("word").agg(F.expr("bit_or(mask)").alias("mask"))
        .toArrow()  # at most bits/64 rows
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy()
    return out


def in_bloom(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the (signed) keys may have been put in."""
    bits = len(words) * 64
    found = np.ones(len(keys), bool)
    for place in (keys % bits, (keys.view(np.uint64) >> np.uint64(29)).view(np.int64) % bits):
        found &= (words[place >> 6].view(np.uint64) >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


