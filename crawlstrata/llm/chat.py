"""Conversations as token sequences with a loss mask over what the assistant says.

Offset-aligned masks: a whole conversation is rendered by the template, encoded once with offsets, and the
sorted spans of the assistant's texts are intersected with the tokens' spans by binary search. The marks of the
template are tokens of their own, so no token reaches over the edge of a text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlstrata.session import stage

# The marks of the template, and the string that the vocabulary has as its own id.
BEGIN, ASK, ASKED, DONE = "<s>", "[INST]", "[/INST]", "</s>"
ROLE, TEXT, TURN = "[ROLE]", "[TEXT]", "[/TURN]"
MARKS = (BEGIN, ASK, ASKED, DONE, ROLE, TEXT, TURN)
CONTROLS = (*MARKS, "<|endoftext|>")
# A control string inside a text gets one more backslash after its first character than it has.
_RESTS = {start: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == start) for start in "<["}
ESCAPED = "|".join(rf"(?:(?<={re.escape(start)})(?=\\*(?:{rests})))" for start, rests in _RESTS.items())
UNESCAPED = "|".join(rf"(?:(?<={re.escape(start)})\\(?=\\*(?:{rests})))" for start, rests in _RESTS.items())
BARE = "|".join(map(re.escape, MARKS))

Encoder = Callable[[str], tuple[np.ndarray, np.ndarray, np.ndarray]]


def escape(text: str) -> str:
    """A text in which no control string is left; `unescape` gives the text back."""
    return re.sub(ESCAPED, r"\\", text)


def unescape(text: str) -> str:
    return re.sub(UNESCAPED, "", text)


def render(turns: list[tuple[str, str]], begin: bool = True) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the sorted spans of the assistant's texts in it."""
    parts, spans, at = [BEGIN] if begin else [], [], len(BEGIN) if begin else 0
    for role, text in turns:
        text = escape(text)
        if role == "assistant":
            spans.append((at, at + len(text)))
            part = f"{text}{DONE}"
        elif role == "user":
            part = f"{ASK}{text}{ASKED}"
        else:
            part = f"{ROLE}{escape(role)}{TEXT}{text}{TURN}"
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The roles and texts that `render` was given."""
    at, role, opened = 0, "assistant", 0
    for mark in re.finditer(BARE, formatted):
        if mark[0] in (ASK, ROLE, BEGIN):
            opened = mark.end()
            role = {ASK: "user"}.get(mark[0], "assistant")
        elif mark[0] == TEXT:
            role, opened = unescape(formatted[opened : mark.start()]), mark.end()
        else:
            yield role, unescape(formatted[opened : mark.start()])
            role, opened = "assistant", mark.end()
        at = mark.end()
    if at != len(formatted):
        raise ValueError("the conversation does not end with a mark")


def inside(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens lie within a span: the last span that begins at or before a token is found by binary search."""
    if not spans or not len(starts):
        return np.zeros(len(starts), bool)
    first, last = np.array(spans, np.int64).T
    # Empty spans share their start with nothing, as a mark follows each.
    at = np.searchsorted(first, starts, "right") - 1
    return (at >= 0) & (ends <= last[np.maximum(at, 0)]) & (ends > starts)


def read_loss(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> Iterator[str]:
    """The texts under the mask, unescaped; the tokens of one character may share its span."""
    starts, ends = starts[loss], np.maximum.accumulate(ends[loss]) if loss.any() else ends[loss]
    if len(starts):
        cuts = np.flatnonzero(starts[1:] > ends[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(starts)], strict=True):
            yield unescape(formatted[starts[a] : ends[b - 1]])


def byte_bpe(path: str) -> Encoder:
    """The encoder of a byte-level BPE vocabulary, with the marks as tokens of their own after its last id."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(mark, normalized=False, special=True) for mark in MARKS])

    def encode(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, np.int32).reshape(-1, 2)
        return np.array(found.ids, np.int32), spans[:, 0], spans[:, 1]

    return encode


def default_encoder() -> Encoder:
    """The encoder of the public 50k byte-level vocabulary, found where the task runs."""
    import public_tokenizers

    return byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))


def _in_segments(long: DataFrame, order: list[str], chars: Column, most: int) -> DataFrame:
    """`_segment` for each row: the characters before it in its conversation, divided by `most`.

    The rows are dealt by ranges of (conversation, order), so that many tasks share one conversation, and
    each range adds what the ranges before it hold: one number for each range and conversation.
    """
    ranged = stage(
        long.withColumn("_chars", chars).repartitionByRange("_conv", *order).withColumn("_range", F.spark_partition_id())
    )
    held = ranged.groupBy("_conv", "_range").agg(F.sum("_chars").alias("_held"))
    ranges = Window.partitionBy("_conv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = stage(held.select(F.col("_conv").alias("_c"), F.col("_range").alias("_r"), F.coalesce(F.sum("_held").over(ranges), F.lit(0)).alias("_before")))
    within = Window.partitionBy("_conv", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    told = ranged.join(before, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r")))
    place = F.coalesce(F.sum("_chars").over(within), F.lit(0)) + F.col("_before")
    return told.withColumn("_segment", F.floor(place / F.lit(most)).cast("int"))


def format_chats(
    turns: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    max_chars: int = 1 << 20,
    encoder: Callable[[], Encoder] = default_encoder,
) -> DataFrame:
    """One row per conversation: `id`, `segment`, `whole`, `formatted`, `ids`, `starts`, `ends`, `loss`.

    `formatted` begins with BEGIN; a user's text stands between ASK and ASKED, an assistant's ends with DONE, any
    other role is written out. `ids` are its tokens, `starts` and `ends` their code points in it, `loss` is
    true for tokens of the assistant's texts, and false for every mark.

    Rows go by `turn`, those of one turn by role and a digest of the text, null turns first; repeated
    rows are turns of their own. A null text or role is empty. Rows with a null id are one conversation. An
    empty text has no tokens, an empty table no rows. Other columns are not read.

    A conversation of more than `max_chars` characters comes in several rows, numbered by `segment`, cut
    between turns and encoded in different tasks; only the first has BEGIN, so together they are the same string and
    the same tokens. `whole` tells that a row is the whole conversation. One turn is never cut.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    read = turns.select(
        F.col(id).alias("_conv"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).withColumn("_digest", F.xxhash64("_text"))
    order = ["_turn", "_role", "_digest", "_text"]
    chars = F.char_length("_text").cast("long") + F.char_length("_role") + 1
    rows = F.sort_array(F.collect_list(F.struct(*order))).alias("_turns")
    # Only long conversations are listed, and Spark sees the size of the list before it chooses the joins.
    sizes = read.groupBy("_conv").agg(F.sum(chars).alias("_size"))
    long_ones = stage(sizes.filter(F.col("_size") > max_chars).select(F.col("_conv").alias("_long")))
    gathered = [(read, F.lit(0), True)]
    if not long_ones.isEmpty():
        same = F.col("_conv").eqNullSafe(F.col("_long"))
        segmented = _in_segments(read.join(long_ones, same, "left_semi"), order, chars, max_chars)
        gathered = [(read.join(long_ones, same, "left_anti"), F.lit(0), True), (segmented, F.col("_segment"), False)]
    # Long conversations are dealt by segment, not by conversation.
    groups = [
        (df.withColumn("_segment", segment) if whole else df.repartition("_conv", "_segment"))
        .groupBy("_conv", "_segment").agg(rows).withColumn("_whole", F.lit(whole))
        for df, segment, whole in gathered
    ]
    joined = groups[0] if len(groups) == 1 else groups[0].unionByName(groups[1])
    names = ["_conv", "segment", "whole", "formatted", "ids", "starts", "ends", "loss"]
    lists = [F.lit(None).cast(t).alias(c) for c, t in zip(names[4:], ["array<int>"] * 3 + ["array<boolean>"], strict=True)]
    schema = joined.select(
        "_conv", F.col("_segment").alias("segment"), F.col("_whole").alias("whole"), F.lit("").alias("formatted"), *lists
    ).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = encoder()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                conv, segment, turns_of, whole = one.columns
                said = [(t["_role"], t["_text"]) for t in turns_of[0].as_py()]
                formatted, spans = render(said, begin=segment[0].as_py() == 0)
                ids, starts, ends = encoded(formatted)
                arrays = [pa.array([a], pa.list_(pa.int32())) for a in (ids, starts, ends)]
                loss = pa.array([inside(spans, starts, ends)], pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays([conv, segment, whole, pa.array([formatted]), *arrays, loss], names)

    return joined.select("_conv", "_segment", "_turns", "_whole").mapInArrow(encode, schema).withColumnRenamed("_conv", id)


def digests(formatted: DataFrame, id: str = "conv_id") -> DataFrame:
    """`n_turns`, `turns_sha256`, `loss_chars`, `loss_sha256`, `formatted_chars` of each conversation of `format_chats`.

    All of it is read back from the formatted string, the offsets and the mask. A digest over a conversation in
    several rows is taken as they stream by in order, one row at a time. No conversation makes no row.
    """
    names = [id, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    read = formatted.select(F.col(id).alias("_conv"), "segment", "whole", "formatted", "starts", "ends", "loss")
    blank = {"turns_sha256": F.lit(""), "loss_sha256": F.lit("")}
    schema = read.select("_conv", *[blank.get(c, F.lit(0).cast("long")).alias(c) for c in names[1:]]).schema

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        state: list | None = None
        kind = pa.int64()

        def closed(rows: list) -> pa.RecordBatch:
            flat = [(conv, n, turns.hexdigest(), m, loss.hexdigest(), chars) for conv, n, turns, m, loss, chars in rows]
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*flat, strict=True), types, strict=True)], schema.names)

        for batch in batches:
            kind, done = batch.column(0).type, []
            for i in range(batch.num_rows):
                conv, segment, _, text, starts, ends, loss = (c[i] for c in batch.columns)
                if segment.as_py() == 0:
                    done += [state] if state else []
                    state = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                elif state is None:
                    state = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = text.as_py()
                for role, said in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                spans = [a.values.to_numpy(zero_copy_only=False) for a in (starts, ends, loss)]
                for said in read_loss(text, *spans):
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            if done:
                yield closed(done)
        if state:
            yield closed([state])

    cut = read.filter(~F.col("whole")).repartition("_conv").sortWithinPartitions("_conv", "segment")
    return read.filter("whole").mapInArrow(digest, schema).unionByName(cut.mapInArrow(digest, schema)).withColumnRenamed("_conv", id)
