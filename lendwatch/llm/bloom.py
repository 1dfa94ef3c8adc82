"""Rows that may have one of many ids, told by a Bloom filter of bounded size before a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LARGEST = 1 << 27  # bits: 16 MB at most, which more ids fill up without losing one
_BITS_PER_ID = 12
_PROBES = 6


def _positions(one: np.ndarray, two: np.ndarray, bits: int) -> np.ndarray:
    """The places of each id: two hashes give as many as are wanted."""
    step = two.astype(np.uint64) | np.uint64(1)
    return (one.astype(np.uint64)[:, None] + step[:, None] * np.arange(_PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def narrowed(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` may be among ``ids`` of that name; every row that is stays.

    A join with ``ids`` must follow. Only the ids pass through Python, whatever else the rows hold.
    NULL is never among the ids.
    """
    spark = rows.sparkSession
    wanted = ids.filter(F.col(column).isNotNull()).select(column)
    bits = 1 << 10
    while bits < min(wanted.count() * _BITS_PER_ID, _LARGEST):
        bits *= 2

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_positions(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits))
            words, first = np.unique(at >> np.uint64(6), return_index=True)
            masks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(masks.view(np.int64))], ["word", "mask"])

    def hashes():
        return F.xxhash64(F.lit(1), column).alias("one"), F.xxhash64(F.lit(2), column).alias("two")

    marked = wanted.select(*hashes()).mapInArrow(mark, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[marked.column(0).to_numpy()] = marked.column(1).to_numpy()
    known = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def may_be(one: pd.Series, two: pd.Series) -> pd.Series:
        at = _positions(one.to_numpy(), two.to_numpy(), bits)
        words = known.value.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)]
        return pd.Series(((words >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1))

    return rows.filter(F.col(column).isNotNull()).filter(may_be(*hashes()))
