"""Exact copies by two passes over Bloom filters.

The first pass marks in bit planes the places that one document's hash has set and those that a second
one has set too; the second pass finds the hashes whose places were all set twice. Only those can be
repeated, and only those rows are shuffled; every other row passes straight through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.session import scratch, stage

SEGMENT_WORDS = 4096  # 64-bit words in a piece of a plane that travels as one row
BLOCK_WORDS = 8  # a hash sets bits in one block of 512
PROBES = 6
KEYS = 1 << 16  # by so many values of two bytes of its own, a digest belongs to a slice


def normal_text(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def places(digests: list[bytes], words: int) -> np.ndarray:
    """The bit numbers of each digest, PROBES per row, within one block."""
    parts = np.frombuffer(b"".join(d[:16] for d in digests), "<u8").reshape(-1, 2)
    block = parts[:, 0] % np.uint64(words // BLOCK_WORDS)
    bits = (parts[:, 1:2] >> (np.arange(PROBES, dtype=np.uint64) * np.uint64(9))[None, :]) & np.uint64(511)
    return block[:, None] * np.uint64(512) + bits


def add(once: np.ndarray, twice: np.ndarray, at: np.ndarray) -> None:
    """Set each row's places in `once`, and in `twice` where another row had set them."""
    flat = np.sort(at, axis=1)
    fresh = np.ones(flat.shape, bool)
    fresh[:, 1:] = flat[:, 1:] != flat[:, :-1]
    bits, count = np.unique(flat[fresh], return_counts=True)
    word, one = bits >> np.uint64(6), np.uint64(1) << (bits & np.uint64(63))
    again = (count > 1) | ((once[word] & one) != 0)
    np.bitwise_or.at(twice, word[again], one[again])
    np.bitwise_or.at(once, word, one)


def filter_words(rows: int, bits_per_row: int, max_bytes: int) -> int:
    """64-bit words of one plane: a whole number of segments, at most `max_bytes`."""
    segments = math.ceil(max(rows, 1) * bits_per_row / 64 / SEGMENT_WORDS)
    return max(1, min(segments, max_bytes // (8 * SEGMENT_WORDS))) * SEGMENT_WORDS


def repeated_plane(digests: DataFrame, words: int) -> np.ndarray:
    """The plane of places set by two rows or more, from a table with one binary column."""
    slots = max(1, math.isqrt(digests.rdd.getNumPartitions()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for batch in batches:
            if batch.num_rows:
                add(once, twice, places(batch.column(0).to_pylist(), words))
        slot = TaskContext.get().partitionId() % slots
        for s in range(words // SEGMENT_WORDS):
            part = slice(s * SEGMENT_WORDS, (s + 1) * SEGMENT_WORDS)
            if once[part].any():
                yield pa.RecordBatch.from_pydict(
                    {"segment": pa.array([s], pa.int32()), "slot": pa.array([slot], pa.int32()),
                     "once": [once[part].tobytes()], "twice": [twice[part].tobytes()]}
                )

    def merge(part: pa.Table) -> pa.Table:
        once, twice = np.zeros(SEGMENT_WORDS, np.uint64), np.zeros(SEGMENT_WORDS, np.uint64)
        for a, b in zip(part["once"], part["twice"], strict=True):
            a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
            twice |= b | (once & a)
            once |= a
        return part.slice(0, 1).select(["segment", "slot"]).append_column(
            "once", pa.array([once.tobytes()], pa.binary())
        ).append_column("twice", pa.array([twice.tobytes()], pa.binary()))

    schema = "segment int, slot int, once binary, twice binary"
    # Merged within slots of the tasks first: a group holds about the square root of their number.
    merged = digests.mapInArrow(build, schema).groupBy("segment", "slot").applyInArrow(merge, schema)
    merged = merged.groupBy("segment").applyInArrow(merge, schema).select("segment", "twice")
    plane = np.zeros(words, np.uint64)
    for row in merged.collect():  # at most the plane's bound
        plane[row.segment * SEGMENT_WORDS : (row.segment + 1) * SEGMENT_WORDS] = np.frombuffer(row.twice, np.uint64)
    return plane


def plane_of(digests: DataFrame, words: int) -> np.ndarray:
    """The plane of places set by any row of a table with one binary column: a plain Bloom filter."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plane = np.zeros(words, np.uint64)
        for batch in batches:
            if batch.num_rows:
                at = places(batch.column(0).to_pylist(), words).ravel()
                np.bitwise_or.at(plane, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        found = np.flatnonzero(plane)
        yield pa.RecordBatch.from_pydict({"word": pa.array(found), "bits": pa.array(plane[found].view(np.int64))})

    plane = np.zeros(words, np.uint64)
    set_words = digests.mapInArrow(build, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for row in set_words.collect():  # at most the filter's bound
        plane[row.word] = np.uint64(row.bits & (2**64 - 1))
    return plane


def probed(batches: Iterator[pa.RecordBatch], digest: str, words: int, plane: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of the batches whose digest may be in the plane."""
    for batch in batches:
        if batch.num_rows:
            at = places(batch.column(batch.schema.get_field_index(digest)).to_pylist(), words)
            yield batch.filter(pa.array(((plane[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)))


def maybe_repeated(rows: DataFrame, digest: str, words: int, held: Broadcast[np.ndarray]) -> DataFrame:
    """`rows` with `_maybe`: whether the digest may occur twice, told by the plane that is `held`."""
    at_digest = rows.columns.index(digest)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = held.value
        for batch in batches:
            if batch.num_rows:
                at = places(batch.column(at_digest).to_pylist(), words)
                hit = ((twice[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], [*batch.schema.names, "_maybe"])

    return rows.mapInArrow(probe, rows.withColumn("_maybe", F.lit(True)).schema)


def marked_in_slices(digests: DataFrame, bits_per_row: int, max_filter_bytes: int) -> DataFrame:
    """The rows of a written table `_id`, `_sha`, `_key` with `_maybe`: whether the digest may occur twice.

    Each slice of the digests has planes of its own, so planes are equally full whatever the number of rows. A slice is a
    range of `_key`, by which the table's files are sorted: its passes read only their part of each file. Its rows are
    written and its plane is given up before the next slice begins.
    """
    spark, rows = digests.sparkSession, digests.count()
    slices = min(KEYS, max(1, math.ceil(rows * bits_per_row / 8 / max_filter_bytes)))
    words = filter_words(math.ceil(rows / slices), bits_per_row, max_filter_bytes)
    edges = [KEYS * k // slices for k in range(slices + 1)]
    paths = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = digests.filter((F.col("_key") >= low) & (F.col("_key") < high)).drop("_key")
        held = spark.sparkContext.broadcast(repeated_plane(part.select("_sha"), words))
        marked = maybe_repeated(part, "_sha", words, held)
        paths.append(scratch(spark, "marked"))
        marked.write.parquet(paths[-1])
        held.destroy()
    return spark.read.schema(marked.schema).parquet(*paths)


def exact_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", bits_per_row: int = 12, max_filter_bytes: int = 32 << 20
) -> DataFrame:
    """One row per row of `docs`: `id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when they are identical with every run of white space as one space; null is empty.
    The smallest id of equal texts stays, null ids last. Of rows that agree in both id and text one
    stays. An empty table gives no rows; other columns are not read.

    Texts are read once; what follows handles their digests. A plane of the filter is broadcast: it has
    `bits_per_row` bits per row and at most `max_filter_bytes`. A table with more rows than that
    serves (22 million by default) is gone over in slices of its digests, so that only possible copies are
    shuffled at any size. Groups of any size are summed within tasks before the shuffle, and the table of
    groups is written before it is joined, so a large group's rows can be split.
    """
    hashed = docs.select(F.col(id).alias("_id"), F.sha2(normal_text(F.col(text)), 256).alias("_hex"))
    key = F.conv(F.substr("_hex", F.lit(-4)), 16, 10).cast("int").alias("_key")
    digests = stage(hashed.select("_id", F.unhex("_hex").alias("_sha"), key).sortWithinPartitions("_key"))
    marked = marked_in_slices(digests, bits_per_row, max_filter_bytes)
    result = lambda keep, size, kept: [
        F.col("_id").alias(id), keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    ]
    single = marked.filter(~F.col("_maybe")).select(*result(F.col("_id"), F.lit(1).cast("long"), F.lit(True)))
    rows = marked.filter("_maybe").groupBy("_sha", "_id").agg(F.count(F.lit(1)).alias("_rows"))
    rows = stage(rows)
    groups = stage(rows.groupBy("_sha").agg(F.min("_id").alias("_keep"), F.sum("_rows").alias("_size")))
    shared = (
        rows.join(groups, "_sha")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .select(*result(F.col("_keep"), F.col("_size"), F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)))
    )
    return single.unionByName(shared)
