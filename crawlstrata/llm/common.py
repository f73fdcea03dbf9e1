"""What the corpus operators share: whole texts in bounded batches, and words as 64-bit hashes.

Every operator reads `id` and `text` columns by the names it is given, takes only those columns along
and gives its own names to the rest, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.session import prepare

# Characters of text handled at once in a task; a longer text is handled alone.
PIECE_CHARS = 1 << 19
# ASCII white space, and an odd multiplier for word hashes.
SPACE = " \t\n\x0b\x0c\r"
ODD = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, classes: int) -> Column:
    """crc32 of the id as text, modulo `classes`: decides what is held out."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % classes


def spread(id_column: str) -> Column:
    """A number in [0, 1) that depends on the id only."""
    return F.pmod(F.xxhash64(F.lit("spread"), F.col(id_column)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of about PIECE_CHARS characters, with their texts (null: empty)."""
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        start, held = 0, 0
        for i, t in enumerate(texts):
            if held and held + len(t) > PIECE_CHARS:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def letter_table() -> np.ndarray:
    """For each code point below 65,536 its lower-case form, or 0 if it is no letter."""
    out = np.zeros(1 << 16, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def letters(texts: list[str], low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with non-letters as 0, each text followed by a 0, and the texts' starts."""
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    out = low[np.minimum(codes, np.uint32(0xFFFF))]
    rare = np.flatnonzero(codes > 0xFFFF)
    if len(rare):
        kinds, back = np.unique(codes[rare], return_inverse=True)
        out[rare] = np.array([ord(chr(k).lower()[0]) if chr(k).isalpha() else 0 for k in kinds], np.uint32)[back]
    return out, starts


def word_spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; the last value is false."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[0::2], edges[1::2]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of codes that depends on its content only."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * powers(n, ODD), out=total[1:])
    back = powers(n, pow(ODD, -1, 1 << 64))
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def sorted_lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `wanted` in the sorted `keys`, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def sums_by_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of values per text."""
    return np.bincount(owner, weights=values, minlength=n)
