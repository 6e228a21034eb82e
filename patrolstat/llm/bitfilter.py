"""Bit filters of bounded size: what a later exact join would drop need not be shuffled."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import mixed

MAX_FILTER_BITS = 27
_KEY = np.uint64(0xD6E8FEB86659FD93)


def slot_of(bits: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    h = first.view(np.uint64)
    if second is not None:
        h = h ^ (second.view(np.uint64) * _KEY)
    return mixed(h) >> np.uint64(64 - bits)


def filter_of(wanted: DataFrame, at_most: int | None = None) -> tuple[np.ndarray, int]:
    """A one-hash bit filter of the rows (one or two longs); at most ``2 ** MAX_FILTER_BITS`` bits.

    Past that size it lets more through, which costs time: what it is used on is joined exactly later.
    ``at_most``: a known bound of the rows, which saves counting them.
    """
    n = wanted.count() if at_most is None else at_most
    bits = min(MAX_FILTER_BITS, max(16, math.ceil(math.log2(16 * max(1, n)))))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = slot_of(bits, *[c.to_numpy() for c in b.columns])
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(
                (np.uint64(1) << (slot & np.uint64(63))).view(np.int64))], ["word", "mask"])

    rows = (wanted.mapInArrow(words, "word long, mask long")
            .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    return table.view(np.uint64), bits


def passes(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def near(df: DataFrame, column: str, wanted: DataFrame, without: bool = False, at_most: int | None = None) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in ``wanted`` (a column of longs), and a few others:
    what an exact join would drop, dropped before its shuffle.  ``without``: the remaining rows."""
    table, bits = filter_of(wanted, at_most)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(passes(table, slot_of(bits, b.column(at).to_numpy())) != without))

    return df.mapInArrow(run, df.schema)
