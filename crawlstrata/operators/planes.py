"""Rows whose key is in a set of keys, found without moving the other rows.

A plane of bits, two words with three bits each for every key, lets through the rows that may be in the set. The
few it lets through in vain are found on the key columns alone and left out by a join that Spark can broadcast.
So wide columns are read where they lie and only rows of the set go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from crawlstrata.session import stage

# A smaller set is joined as it is: Spark sends it to the tasks where its own size limit allows.
SMALL_SET = 50_000
# Bits for each key, and the largest plane that is sent to the tasks. A larger set is joined by shuffling.
KEY_BITS = 24
MAX_PLANE_BYTES = 32 << 20


def spread_bits(h: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits mixed."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def words_and_masks(h: np.ndarray, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two words of the plane that a key's hash belongs to, and its bits in them."""
    out, one, six = [], np.uint64(1), np.uint64(63)
    for turn in (1, 2):
        h = spread_bits(h + np.uint64(turn))
        mask = one << (h >> np.uint64(58)) | one << ((h >> np.uint64(52)) & six) | one << ((h >> np.uint64(46)) & six)
        out.append(((h & np.uint64(words - 1)).astype(np.int64), mask))
    return out


def _plane(hashes: DataFrame, words: int) -> np.ndarray:
    """The plane of all hashes: tasks make the bits, which are united before the driver gets each word once."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, mask in words_and_masks(batch.column(0).to_numpy().view(np.uint64), words):
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], ["word", "bits"])

    united = hashes.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    plane = np.zeros(words, np.uint64)
    plane[united["word"].to_numpy()] = united["bits"].to_numpy().view(np.uint64)
    return plane


def may_hold(keys: DataFrame, columns: list[str], n: int, max_bytes: int = MAX_PLANE_BYTES) -> Column:
    """A condition that holds for all rows whose `columns` are among the `n` keys, and for few others.

    More keys than a plane of `max_bytes` has room for make it hold for more others.
    """
    words = 1 << 10
    while words * 64 < n * KEY_BITS and words * 16 <= max_bytes:
        words *= 2
    held = keys.sparkSession.sparkContext.broadcast(_plane(keys.select(F.xxhash64(*columns)), words).tobytes())

    @F.arrow_udf(BooleanType())
    def holds(hashes: pa.Array) -> pa.Array:
        plane = np.frombuffer(held.value, np.uint64)
        h, out = hashes.to_numpy().view(np.uint64), np.ones(len(hashes), bool)
        for word, mask in words_and_masks(h, words):
            out &= (plane[word] & mask) == mask
        return pa.array(out)

    return holds(F.xxhash64(*columns))


def rows_of_keys(rows: DataFrame, keys: DataFrame, small: int = SMALL_SET, max_bytes: int = MAX_PLANE_BYTES) -> DataFrame:
    """The rows whose key, all columns of `keys`, is one of the distinct `keys`; null equals null.

    `keys` should be a written table: it is counted, and read again. Between `small` keys and those that a
    plane of `max_bytes` holds, only rows of the set, and none of the rest, may be moved by what follows.
    """
    columns = keys.columns

    same = reduce(and_, [F.col(f"rows.{c}").eqNullSafe(F.col(f"keys.{c}")) for c in columns])

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.alias("rows").join(right.alias("keys"), same, how)

    n = keys.count()
    if n <= small or n * KEY_BITS > max_bytes * 8:
        return joined(rows, keys, "left_semi")
    likely = rows.filter(may_hold(keys, columns, n))
    in_vain = stage(joined(likely.select(*columns), keys, "left_anti").distinct())
    return joined(likely, in_vain, "left_anti")

