"""Vectors as short codes: each part of a vector by its nearest entry in that part's codebook.

The codebooks are fitted over all rows, in whole numbers. Norm-of-sum bounds save most of the exact scans: a
part keeps its entry, a lower bound on the distance to every other entry and the round in which that bound was
taken. The codebooks of all rounds are kept, so a later round lowers the bound by how far the other entries
really are from where they were in that round, not by the sum of their moves in between. Only where the exact
distance to the own entry does not stay below is the part scanned again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstrata.session import stage

# Bounds are lowered, and distances raised, by this share, which is far over what rounding takes.
SLACK = 1e-9


def integers(vectors: list, parts: int, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which vectors are usable, and those as whole numbers, downward.

    A component beyond what keeps a vector's squared distances below 2^62 counts as the last that does.
    """
    usable, out = np.zeros(len(vectors), bool), []
    for i, v in enumerate(vectors):
        if v is None or not len(v) or len(v) % parts or v.null_count:
            continue
        x = v.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all():
            most = isqrt((1 << 62) // len(x)) // 2
            with np.errstate(over="ignore"):
                out.append(np.clip(np.floor(x * scale), -most, most).astype(np.int64))
            usable[i] = True
    return usable, out


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all entries."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    if x.shape[1] * reach * reach < 1 << 51:  # every sum is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row (ties: the lower), its squared distance, and a lower bound of the others' distances."""
    d = distances(x, entries)
    own = d.argmin(1)
    rows = np.arange(len(x))
    best = d[rows, own]
    if d.shape[1] == 1:
        return own, best, np.full(len(x), np.inf)
    d[rows, own] = np.iinfo(np.int64).max
    return own, best, np.sqrt(d.min(1).astype(np.float64)) * (1 - SLACK)


def net_moves(history: list[np.ndarray], part: int) -> np.ndarray:
    """For each earlier round and entry: the largest net way of any other entry since that round."""
    now = history[-1][part]
    out = np.zeros((len(history), len(now)))
    for stamp, books in enumerate(history):
        way = np.sqrt(((now - books[part]).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        if len(way) > 1:
            order = np.argsort(way)
            out[stamp] = way[order[-1]]
            out[stamp, order[-1]] = way[order[-2]]
    return out


def assign(
    x: np.ndarray, history: list[np.ndarray], own: np.ndarray | None, low: np.ndarray | None, stamp: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries, squared distances, bounds, their rounds and the number of scans of the rows of x (rows, parts, positions)."""
    n, parts, _ = x.shape
    now = len(history) - 1
    error, scans = np.zeros((n, parts), np.int64), np.zeros(n, np.int32)
    if own is None:
        own, low, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts)), np.full((n, parts), -1, np.int16)
    else:
        own, low, stamp = own.copy(), low.copy(), stamp.copy()
    for p in range(parts):
        again = stamp[:, p] < 0
        kept = np.flatnonzero(~again)
        if len(kept):
            entries = own[kept, p]
            error[kept, p] = ((x[kept, p] - history[now][p][entries]) ** 2).sum(1)
            bound = low[kept, p] - net_moves(history, p)[stamp[kept, p], entries]
            again[kept] = ~(np.sqrt(error[kept, p].astype(np.float64)) * (1 + SLACK) < bound)
        rows = np.flatnonzero(again)
        if len(rows):
            own[rows, p], error[rows, p], low[rows, p] = scan(x[rows, p], history[now][p])
            stamp[rows, p] = now
            scans[rows] += 1
    return own, error, low, stamp, scans


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
) -> tuple[DataFrame, list[np.ndarray]]:
    """`id`, `code`, `error`, `scans` and the `carry` columns of each kept row, and the codebooks of all rounds.

    A component x counts as floor(`scale` * x). A codebook begins as that part of the vectors with the `entries`
    smallest ids (ties by vector, null ids not among them as long as there are others), then `rounds` times every
    part goes to its nearest entry (ties: the lower) and every used entry to the floor of its parts' mean. `code`
    has two hex digits a part, `error` is the sum of squared distances, `scans` counts exact scans.

    Dropped are rows whose vector is null, empty, has a null or non-finite component or a length that is no
    multiple of `parts`, or another length than the kept vector of the smallest id. Repeated rows and
    null ids are rows of their own; with fewer rows than `entries` there are as many entries; an empty table gives
    none. Components too large for 64-bit distances (524,288 for 64 of them) count as the largest that are not.

    The state of a round is a table in the shared folder, rows stay where they are, and only sums per
    entry (`parts` x `entries` x positions numbers) are added up; the codebooks sent to the tasks have that size.
    """
    if not 1 <= entries <= 256 or parts < 1 or not 0 <= rounds <= 100:
        raise ValueError("entries must be 1 to 256, parts at least 1 and rounds at most 100")
    carried = [f"_c{i}" for i in range(len(carry))]
    read = vectors.select(F.col(id).alias("_id"), F.col(vector).alias("_v"), *(F.col(c).alias(n) for c, n in zip(carry, carried, strict=True)))
    kept_schema = read.select("_id", *carried, F.lit(None).cast("array<bigint>").alias("_x")).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            usable, out = integers([column[i].values for i in range(len(column))], parts, scale)
            rows = batch.filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *rows.columns[2:], pa.array(out, pa.list_(pa.int64()))], kept_schema.names
            )

    kept = stage(read.mapInArrow(whole, kept_schema))
    by_id = [F.col("_id").asc_nulls_last(), F.col("_x").asc()]
    first = kept.select("_id", "_x").orderBy(*by_id).first()
    length = len(first["_x"]) if first else parts
    kept = kept.filter(F.size("_x") == length)
    smallest = kept.select("_id", "_x").orderBy(*by_id).limit(entries).collect()
    books = np.array([row["_x"] for row in smallest], np.int64).reshape(len(smallest), parts, length // parts).transpose(1, 0, 2)
    history = [books]
    if not len(smallest):
        return _finished(kept.select("_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).alias("scans"), *carried), id, carry, carried), history

    state_names = ["_own", "_low", "_stamp", "_scans"]
    state_types = ["binary", "binary", "binary", "int"]
    blank = [F.lit(None).cast(t).alias(c) for c, t in zip(state_names, state_types, strict=True)]
    sums_of = [F.lit(None).cast("int").alias("_part"), F.lit(None).cast("array<bigint>").alias("_sums")]
    state_schema = kept.select("_id", *carried, "_x", *blank, *sums_of).schema
    done_schema = kept.select("_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).alias("scans"), *carried).schema

    def states(batch: pa.RecordBatch, past: list[np.ndarray]) -> tuple:
        """The rows of a batch as whole numbers, with their entries, distances, bounds, rounds and scans."""
        n, at = batch.num_rows, batch.schema.get_field_index
        x = batch.column(at("_x")).flatten().to_numpy(zero_copy_only=False).reshape(n, parts, -1)
        if at("_own") < 0:
            found, before = (None, None, None), 0
        else:
            found = tuple(
                np.frombuffer(b"".join(batch.column(at(c)).to_pylist()), t).reshape(n, parts)
                for c, t in zip(state_names, (np.uint8, np.float64, np.int16), strict=False)
            )
            before = batch.column(at("_scans")).to_numpy()
        *result, scans = assign(x, past, *found)
        return x, *result, scans + before

    def one_round(past: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, k, m = past[-1].shape
            sums, kinds = np.zeros((parts, k, m + 1), np.int64), None
            for batch in batches:
                if not batch.num_rows:
                    continue
                kinds = [c.type for c in batch.columns[: 1 + len(carried)]]
                x, own, _, low, stamp, scans = states(batch, past)
                for p in range(parts):
                    np.add.at(sums[p, :, :m], own[:, p], x[:, p])
                    sums[p, :, m] += np.bincount(own[:, p], minlength=k)
                packed = [pa.array([row.tobytes() for row in a], pa.binary()) for a in (own, low, stamp)]
                none = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.list_(pa.int64()))]
                x_column = batch.column(batch.schema.get_field_index("_x"))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: 1 + len(carried)], x_column, *packed, pa.array(scans, pa.int32()), *none], state_schema.names
                )
            if kinds is not None:
                empty = [pa.nulls(parts, t) for t in (*kinds, pa.list_(pa.int64()), *[pa.binary()] * 3, pa.int32())]
                added = [pa.array(range(parts), pa.int32()), pa.array(list(sums.reshape(parts, -1)), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*empty, *added], state_schema.names)

        return run

    def last_round(past: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                _, own, error, _, _, scans = states(batch, past)
                code = pa.array([row.tobytes().hex() for row in own])
                numbers = [pa.array(error.sum(1)), pa.array(scans, pa.int32())]
                yield pa.RecordBatch.from_arrays([batch.column(0), code, *numbers, *batch.columns[1 : 1 + len(carried)]], done_schema.names)

        return run

    state = kept
    for _ in range(rounds):
        written = stage(state.mapInArrow(one_round(list(history)), state_schema))
        each = written.filter(F.col("_part").isNotNull()).select("_part", F.posexplode("_sums").alias("_at", "_value"))
        added = np.zeros((parts, books.shape[1], books.shape[2] + 1), np.int64)
        flat = added.reshape(parts, -1)
        for part, at, value in each.groupBy("_part", "_at").agg(F.sum("_value")).collect():
            flat[part, at] = value
        total, count = added[:, :, :-1], added[:, :, -1:]
        history.append(np.where(count > 0, total // np.maximum(count, 1), history[-1]))
        state = written.filter(F.col("_part").isNull()).drop("_part", "_sums")
    return _finished(state.mapInArrow(last_round(list(history)), done_schema), id, carry, carried), history


def _finished(rows: DataFrame, id: str, carry: tuple[str, ...], carried: list[str]) -> DataFrame:
    return rows.select(F.col("_id").alias(id), "code", "error", "scans", *(F.col(n).alias(c) for c, n in zip(carry, carried, strict=True)))


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all components as decimal numbers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """`label_error`: `error` added up over the rows of a label, null labels together.

    Errors are added up before they are shuffled, and the written totals are joined back: Spark sends them to
    the tasks only if they are small, and splits a label's rows if they are not. A total beyond 64 bits is null.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    totals = stage(coded.groupBy(F.col(label).alias("_label")).agg(total.alias("label_error")))
    return coded.join(totals, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
