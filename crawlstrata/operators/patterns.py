"""Which one of many given strings a text holds.

Strings that fit in a task are sent to all of them as one automaton, which reads every text once. More strings stay
a table: a bit plane of their first characters tells where in a text one may begin, and only these places are
joined to the strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstrata.operators.planes import spread_bits
from crawlstrata.session import stage

# Characters of all strings that a task holds as an automaton: some 100 MB.
MAX_AUTOMATON_CHARS = 1 << 20
# The characters by which longer strings are looked up; shorter ones are looked up whole.
GRAM = 8
# Bits of the plane: 16 a string, up to 32 MB.
MAX_PLANE_BITS = 1 << 28


def sole_string(texts: DataFrame, strings: DataFrame, span: int | None = None, max_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """(text, string) of the `texts` that hold exactly one of the `strings`, in their first `span` characters if given.

    Both tables have one column, `texts` of distinct values. Empty and null strings are in no text, nor is anything
    in a null text; a string that is part of another is a string of its own. The automaton adds no shuffle; above
    `max_chars` characters of strings, only the places of a text where one may begin are shuffled.
    """
    text, string = texts.columns[0], strings.columns[0]
    known = strings.filter(F.col(string) != "").select(string).distinct()
    size = known.agg(F.coalesce(F.sum(F.char_length(string)), F.lit(0)).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    named = texts.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    if size.chars <= max_chars:
        found = _by_automaton(named, [row[0] for row in known.collect()], span)
    else:
        found = _by_plane(named, known.select(F.col(string).alias("string")), size.n, span)
    return found.select(F.col("text").alias(text), F.col("string").alias(string))


def _by_automaton(texts: DataFrame, strings: list[str], span: int | None) -> DataFrame:
    held = texts.sparkSession.sparkContext.broadcast(strings)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for string in held.value:
            automaton.add_word(string, string)
        automaton.make_automaton()

        def sole(text: str) -> str | None:
            first = None
            for _, string in automaton.iter(text):
                if first is None:
                    first = string
                elif string != first:
                    return None
            return first

        for batch in batches:
            if len(automaton):
                sites = pa.array([sole(text[:span]) for text in batch.column(0).to_pylist()], pa.string())
                keep = sites.is_valid()
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), sites.filter(keep)], ["text", "string"])

    return texts.mapInArrow(find, "text string, string string")


def window_hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each length up to GRAM, a 64-bit hash of the codes of that length from every place on."""
    h = np.zeros(len(codes), np.uint64)
    for size in range(1, min(GRAM, len(codes)) + 1):
        h = h[: len(codes) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 :].astype(np.uint64) + np.uint64(1)
        yield spread_bits(h + np.uint64(size))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _by_plane(texts: DataFrame, strings: DataFrame, n: int, span: int | None) -> DataFrame:
    bits = 1 << 10
    while bits < min(16 * n, MAX_PLANE_BITS):
        bits *= 2
    mask = np.uint64(bits - 1)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [int([*window_hashes(codes_of(s[:GRAM]))][-1][0] & mask) for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], ["at"])

    marks = strings.mapInArrow(mark, "at long").groupBy(F.shiftright("at", 6).alias("word"))
    words = marks.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()  # at most bits / 64 rows
    plane = np.zeros(bits // 64, np.uint64)
    plane[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    held = texts.sparkSession.sparkContext.broadcast(plane.tobytes())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plane = np.frombuffer(held.value, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(0).to_pylist():
                head = text[:span]
                for size, h in enumerate(window_hashes(codes_of(head)), 1):
                    bit = h & mask
                    hit = (plane[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)
                    out += [(text, int(at) + 1, head[at : at + size]) for at in np.flatnonzero(hit)]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            types = [pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["text", "at", "gram"])

    gram = F.substring("string", 1, GRAM)
    # Written, so that a join with a frequent gram can be split.
    sizes = stage(strings.select(gram.alias("gram"), F.char_length("string").alias("size")).distinct())
    hits = texts.mapInArrow(places, "text string, at int, gram string").join(sizes, "gram")
    head = F.col("text") if span is None else F.substring("text", 1, span)
    cut = hits.select("text", F.substring(head, F.col("at"), F.col("size")).alias("string")).filter(F.char_length("string") > 0)
    found = cut.distinct().join(strings, "string").groupBy("text").agg(F.min("string").alias("string"), F.max("string").alias("_other"))
    return found.filter("string = _other").select("text", "string")
