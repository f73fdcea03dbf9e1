"""Documents packed into token sequences with little padding.

Bounded-space online packing: each partition keeps a fixed number of open windows. A document's full
windows leave at once; its rest goes to the open window where the least room stays, and when none fits
the fullest window is emitted. Windows left at the end are merged across partitions, cut where a sequence is full.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import pieces
from crawlstrata.session import stage

# Id 0 ends a document; the string that the vocabulary has as its own id.
END_OF_DOCUMENT = 0
SPECIAL = {"<|endoftext|>": 50256}
# Sequence numbers of a partition start here, so that they are unique in the table.
PER_PARTITION = 1 << 36
MERGE_FAN = 8
BATCH_WINDOWS = 64


def byte_bpe(path: str, ranks_path: str | None = None) -> Callable[[str], np.ndarray]:
    """The encoder of a byte-level BPE vocabulary in a JSON file.

    With the same vocabulary as ranks, texts are encoded by these, several times as fast, but for texts that the
    quicker encoder refuses: its pattern cannot go back over a million blanks in a row. The file is read when it is needed.
    """

    @cache
    def tokenizer():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def whole(text: str) -> np.ndarray:
        return np.array(tokenizer().encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks_path is None:
        return whole
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    quick = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def encode(text: str) -> np.ndarray:
        try:
            return quick.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return whole(text)

    return encode


def default_encoder() -> Callable[[str], np.ndarray]:
    """The encoder of the public 50k byte-level vocabulary, found where the task runs."""
    import public_tokenizers

    return byte_bpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


class OpenWindows:
    """At most `limit` windows with room, by the room that each has left."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.items: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, item) -> list[tuple[int, list]]:
        """Put an item of `length` into the window it fits best; returns windows that are emitted by it."""
        emitted = []
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) == self.limit:
                _, fullest = self.rooms.pop(0)
                emitted.append((fullest, self.items.pop(fullest)))
            room, window = self.size, self.made
            self.made += 1
            self.items[window] = []
        self.items[window].append((self.size - room, item))
        if room == length:
            emitted.append((window, self.items.pop(window)))
        else:
            insort(self.rooms, (room - length, window))
        return emitted


def _pieces_of(tokens: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, len(tokens), size):
        yield start, min(size, len(tokens) - start)


def _ids_of(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The ids of each row as a view of the table's own; as lists of Python's numbers they take nine times the room."""
    found = []
    for chunk in lists.chunks:
        ids, edges = chunk.values.to_numpy().view("<u4"), chunk.offsets.to_numpy()
        found += [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return found


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    open_windows: int = 1024,
    encoder: Callable[[], Callable[[str], np.ndarray]] = default_encoder,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: `id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset` (and `ids`).

    A document is the ids of its text (null: none) and END_OF_DOCUMENT, so each has a token at least; it is
    cut into pieces of `size` and a rest. Pieces of a sequence follow one another without gap from 0, and
    every id lies in one piece. Repeated rows and null ids are documents of their own, a text of any length
    makes as many pieces as it needs, an empty table makes none. Other columns are not read. `ids` holds
    the token ids; without it only their checksum is carried.

    A task holds `open_windows` windows. What is open at a task's end is merged with that of others:
    MERGE_FAN tasks at a time, each group leaving one window that is not full, until one group is left.
    So leftovers of any number of tasks are handled in bounded groups, and pieces are cut anew only there.
    Numbers of sequences are unique, not dense.
    """
    if not 0 < size < 1 << 16:
        raise ValueError("size must be between 1 and 65,535")
    names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", "ids"]
    read = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    numbers = {c: F.lit(0).cast("long").alias(c) for c in names[1:7]}
    schema = read.select(
        "_id", *numbers.values(), F.lit(False).alias("open"), F.lit(None).cast("array<int>").alias("ids")
    ).schema

    def rows_of(windows: list[tuple[int, list]], is_open: bool, first: int, id_type: pa.DataType) -> pa.RecordBatch:
        flat = [
            (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, first + window, offset, is_open,
             ids.view(np.int32) if with_ids or is_open else None)
            for window, items in windows for offset, (doc, start, ids, total) in items
        ]
        types = [id_type, *[pa.int64()] * 6, pa.bool_(), pa.list_(pa.int32())]
        columns = zip(*flat, strict=True) if flat else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, windows = encoder(), OpenWindows(size, open_windows)
        first, id_type = TaskContext.get().partitionId() * PER_PARTITION, pa.int64()
        for batch, texts in pieces(batches, "_text"):
            done, id_type = [], batch.column(0).type
            for doc, one in zip(batch.column(0).to_pylist(), texts, strict=True):
                tokens = np.append(encode(one), END_OF_DOCUMENT).astype("<u4")
                for start, length in _pieces_of(tokens, size):
                    done += windows.place(length, (doc, start, tokens[start : start + length].copy(), len(tokens)))
            yield rows_of(done, False, first, id_type)
        yield rows_of(sorted(windows.items.items()), True, first, id_type)

    def merge(final: bool) -> Callable[[pa.Table], pa.Table]:
        def run(rows: pa.Table) -> pa.Table:
            """The open windows one after another, cut into full ones and a last."""
            order = pc.sort_indices(rows, [("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist()
            names_of = np.unique(rows["sequence_id"].to_numpy())
            total = int(np.sum(rows["length"].to_numpy()))
            windows: dict[int, list] = {}
            at = 0
            ids, *others = _ids_of(rows["ids"]), *(rows[c].to_pylist() for c in ("_id", "start", "doc_tokens"))
            for row in order:
                tokens, done = ids[row], 0
                doc, start, of = (c[row] for c in others)
                while done < len(tokens):
                    part = tokens[done : done + size - at % size]
                    windows.setdefault(at // size, []).append((at % size, (doc, start + done, part, of)))
                    at, done = at + len(part), done + len(part)
            full = total // size
            numbered = [(int(names_of[k]), items) for k, items in windows.items()]
            kind = rows.schema.field("_id").type
            # A batch travels whole, so it holds a few windows.
            parts = [rows_of(numbered[k : min(k + BATCH_WINDOWS, full)], False, 0, kind) for k in range(0, full, BATCH_WINDOWS)]
            return pa.Table.from_batches([*parts, rows_of(numbered[full:], not final, 0, kind)])

        return run

    placed = stage(read.mapInArrow(place, schema))
    parts = [placed.filter(~F.col("open"))]
    left, span = placed.filter("open"), PER_PARTITION
    groups = (left.agg(F.max("sequence_id")).first()[0] or 0) // PER_PARTITION + 1
    while True:
        groups, span = -(-groups // MERGE_FAN), span * MERGE_FAN
        last = groups <= 1
        group = F.lit(0) if last else F.floor(F.col("sequence_id") / F.lit(span))
        merged = left.groupBy(group.alias("_group")).applyInArrow(merge(last), schema)
        if last:
            parts.append(merged)
            break
        merged = stage(merged)
        parts.append(merged.filter(~F.col("open")))
        left = merged.filter("open")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(F.col("_id").alias(id), *names[1:7], *(["ids"] if with_ids else []))
