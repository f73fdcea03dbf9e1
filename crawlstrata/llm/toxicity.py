"""Toxicity by two Kneser-Ney word models, one of toxic and one of ordinary documents.

A document's score compares its log-likelihoods under both, by the word. Each model backs off from word
pairs to the number of histories that a word follows in its class, and from there to word counts that
both share and that are taken over all documents, so an expression too rare in a class tells nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import (
    ODD, fold, letter_table, letters, mix, pieces, sorted_lookup, span_hashes, spread, sums_by_text, word_spans,
)
from crawlstrata.session import stage

BEGIN = np.uint64(1)  # the history of a text's first word
# What a class's count loses: a constant, and so many times what the counts of both classes lead to expect.
DISCOUNT = 3
WORD_FACTOR = 2.5
PAIR_FACTOR = 1.5
# A history's pairs tell on their own where each class has so many of them.
MIN_HISTORY = 10
# Counts that travel as one row, and groups in which tasks' counts are added up first.
SEGMENT, SLOTS = 4096, 64
# A document's mean is taken as if so many words more told nothing, so that few words prove little.
PRIOR_WORDS = 20


@dataclass
class Model:
    """Sorted hashes and what each adds to the log ratio of toxic to ordinary; bounded by `max_entries` each."""

    words: np.ndarray
    word_ratio: np.ndarray
    unseen_ratio: float
    pairs: np.ndarray
    pair_ratio: np.ndarray
    histories: np.ndarray
    history_ratio: np.ndarray
    base_rate: float
    knots: np.ndarray  # mean log ratios, rising
    shares: np.ndarray  # toxic shares at the knots, rising


def words_of(texts: list[str], low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, lower case) of all texts in order, and the text of each."""
    codes, text_starts = letters(texts, low)
    starts, ends = word_spans(codes != 0)
    return span_hashes(codes, starts, ends), np.searchsorted(text_starts, starts, side="right") - 1


def histories_of(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    before = np.concatenate(([BEGIN], words[:-1])) if len(words) else words
    return np.where(np.diff(owner, prepend=-1) != 0, BEGIN, before)


def pair_hash(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(history * np.uint64(ODD) + word)


def pair_counts(learn: DataFrame) -> DataFrame:
    """`h`, `w` (hashes), `t`, `o`: in how many toxic and ordinary rows of `_text`, `_toxic` word w follows h."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = letter_table()
        for batch, texts in pieces(batches, "_text"):
            words, owner = words_of(texts, low)
            history = histories_of(words, owner)
            pair = pair_hash(history, words)
            once = np.unique(mix(pair + owner.astype(np.uint64) * np.uint64(ODD)), return_index=True)[1]
            history, words, pair, owner = history[once], words[once], pair[once], owner[once]
            toxic = batch.column(batch.schema.get_field_index("_toxic")).to_numpy(zero_copy_only=False).astype(bool)[owner]
            _, first, group = np.unique(pair, return_index=True, return_inverse=True)
            n = len(first)
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(history[first].view(np.int64)), "w": pa.array(words[first].view(np.int64)),
                "t": pa.array(np.bincount(group[toxic], minlength=n)), "o": pa.array(np.bincount(group[~toxic], minlength=n)),
            })

    rows = learn.mapInArrow(count, "h long, w long, t long, o long")
    return rows.groupBy("h", "w").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def shared_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How often each of the sorted hashes occurs in all rows of `_text`, and the number of all words.

    Tasks send their counts in segments of SEGMENT words, so their rows do not grow with the vocabulary they
    have met; segments are added up within slots of tasks first, so that a group stays small.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, low = held.value, letter_table()
        total = np.zeros(-(-(len(known) + 1) // SEGMENT) * SEGMENT, np.int64)
        for _, texts in pieces(batches, "_text"):
            words, _ = words_of(texts, low)
            at, there = sorted_lookup(known, words)
            total[1 : len(known) + 1] += np.bincount(at[there], minlength=len(known))
            total[0] += len(words)
        parts = total.reshape(-1, SEGMENT)
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(np.arange(len(parts), dtype=np.int32)),
            "slot": pa.array(np.full(len(parts), TaskContext.get().partitionId() % SLOTS, np.int32)),
            "counts": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(SEGMENT, np.int64)
        for counts in part["counts"]:
            total += np.frombuffer(counts.as_py(), np.int64)
        return part.slice(0, 1).select(["segment", "slot"]).append_column("counts", pa.array([total.tobytes()], pa.binary()))

    schema = "segment int, slot int, counts binary"
    summed = docs.mapInArrow(count, schema).groupBy("segment", "slot").applyInArrow(add, schema)
    out = np.zeros(-(-(len(vocabulary) + 1) // SEGMENT) * SEGMENT, np.int64)
    for row in summed.groupBy("segment").applyInArrow(add, schema).collect():  # the bounded vocabulary
        out[row.segment * SEGMENT : (row.segment + 1) * SEGMENT] = np.frombuffer(row.counts, np.int64)
    return out[1 : len(vocabulary) + 1], int(out[0])


def cutoff(counts: DataFrame, column: str, least: int, max_entries: int) -> int:
    """The smallest count from `least` on that at most `max_entries` rows reach."""
    reached = counts.groupBy(F.least(F.col(column), F.lit(10_000)).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
    by, total = {r.c: r.n for r in reached}, 0  # at most 10,000 rows
    for c in range(10_000, least - 1, -1):
        total += by.get(c, 0)
        if total > max_entries:
            return c + 1
    return least


def fit_models(learn: DataFrame, docs: DataFrame, max_entries: int) -> Model:
    """Both models from the rows of `learn` (`_text`, `_toxic`) and the shared counts from those of `docs`.

    A class's count is discounted by DISCOUNT and by a multiple of what the shared counts lead to expect
    of it. So rare expressions, and those that are only somewhat more frequent in a class, say because it has
    more texts in their language, are left to the shared counts, which tell nothing of the class.
    """
    pairs = stage(pair_counts(learn))
    follows = stage(pairs.groupBy("w").agg(F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o")))
    of_class = follows.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("o"), F.lit(0)).alias("o")).first()
    often = lambda rows: rows.withColumn("c", F.greatest("t", "o"))
    kept = often(follows).filter(F.col("c") >= cutoff(often(follows), "c", DISCOUNT + 1, max_entries)).toPandas()
    order = np.argsort(kept["w"].to_numpy().view(np.uint64))
    words, n_toxic, n_ordinary = (kept[c].to_numpy()[order] for c in ("w", "t", "o"))
    words = words.view(np.uint64)
    shared, total = shared_counts(docs, words)
    base = (shared + 1.0) / (total + len(words) + 1.0)

    def lower(n: np.ndarray, of: int) -> tuple[np.ndarray, float]:
        """Probability of each word by the histories it follows, and the share of the shared counts."""
        own = np.maximum(n - DISCOUNT - WORD_FACTOR * of * base, 0) / max(of, 1)
        rest = max(1 - own.sum(), 1e-9)
        return own + rest * base, rest

    p_toxic, rest_toxic = lower(n_toxic, of_class.t)
    p_ordinary, rest_ordinary = lower(n_ordinary, of_class.o)

    # Pairs tell where both classes know their history from some documents.
    by_history = stage(pairs.groupBy("h").agg(F.sum("t").alias("ht"), F.sum("o").alias("ho")).filter(
        (F.col("ht") >= MIN_HISTORY) & (F.col("ho") >= MIN_HISTORY)
    ))
    known = stage(often(pairs).filter(F.col("c") > DISCOUNT).join(by_history, "h"))
    strong = known.filter(F.col("c") >= cutoff(known, "c", DISCOUNT + 1, max_entries)).drop("c").toPandas()
    h, w = (strong[c].to_numpy().view(np.uint64) for c in "hw")
    t, o, ht, ho = (strong[c].to_numpy().astype(float) for c in ("t", "o", "ht", "ho"))
    histories, at_h = np.unique(h, return_inverse=True)
    at_w, in_words = sorted_lookup(words, w)
    both = (t + o) / np.maximum(ht + ho, 1)

    def upper(n: np.ndarray, of: np.ndarray, p: np.ndarray, rest: float) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each pair's word after its history, and the share of the words' counts by history."""
        own = np.maximum(n - DISCOUNT - PAIR_FACTOR * of * both, 0) / np.maximum(of, 1)
        left = np.maximum(1 - np.bincount(at_h, weights=own, minlength=len(histories)), 1e-9)
        below = np.where(in_words, p[at_w], rest / (total + len(words) + 1.0)) if len(p) else np.full(len(n), 1e-9)
        return own + left[at_h] * below, left

    pair_toxic, left_toxic = upper(t, ht, p_toxic, rest_toxic)
    pair_ordinary, left_ordinary = upper(o, ho, p_ordinary, rest_ordinary)
    keys = pair_hash(h, w)
    order = np.argsort(keys)
    return Model(
        words, np.log(p_toxic / p_ordinary).astype(np.float32), float(np.log(rest_toxic / rest_ordinary)),
        keys[order], np.log(pair_toxic / pair_ordinary)[order].astype(np.float32),
        histories, np.log(left_toxic / left_ordinary).astype(np.float32), 0.0, np.zeros(0), np.zeros(0),
    )


def mean_ratios(texts: list[str], model: Model, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log ratio of toxic to ordinary of each text, and its number of words."""
    words, owner = words_of(texts, low)
    history = histories_of(words, owner)
    n = np.bincount(owner, minlength=len(texts))
    ratio = np.full(len(words), model.unseen_ratio)
    at, there = sorted_lookup(model.words, words)
    ratio[there] = model.word_ratio[at[there]]
    at, there = sorted_lookup(model.histories, history)
    ratio[there] += model.history_ratio[at[there]]
    at, there = sorted_lookup(model.pairs, pair_hash(history, words))
    ratio[there] = model.pair_ratio[at[there]]
    return sums_by_text(ratio, owner, len(texts)) / (n + PRIOR_WORDS), n


def with_ratio(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `_ratio` and `_words` in place of `_text`."""
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))
    keep = [c for c in docs.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, low = Model(*held.value), letter_table()
        for batch, texts in pieces(batches, "_text"):
            ratio, n = mean_ratios(texts, model, low)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns, pa.array(ratio), pa.array(n.astype(np.int64))], [*keep, "_ratio", "_words"]
            )

    return docs.mapInArrow(run, docs.select(*keep, F.lit(0.0).alias("_ratio"), F.lit(0).cast("long").alias("_words")).schema)


def calibrate(ratio: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising toxic shares over rising ratios: neighbours out of order are pooled until none are."""
    order = np.argsort(ratio, kind="stable")
    blocks: list[list[float]] = []  # toxic rows, rows, sum of ratios
    for r, t in zip(ratio[order], toxic[order], strict=True):
        blocks.append([float(t), 1.0, float(r)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t2, n2, r2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + n2, blocks[-1][2] + r2]
    return np.array([r / n for _, n, r in blocks]), np.array([t / n for t, n, _ in blocks])


def scores(ratio: np.ndarray, words: np.ndarray, model: Model) -> np.ndarray:
    """Toxic share at a ratio; a hundredth of it ranks documents with equal shares. Without words the base rate."""
    if not len(model.knots):
        return np.full(len(ratio), model.base_rate)
    share = np.interp(ratio, model.knots, model.shares)
    middle = model.knots[np.searchsorted(model.shares, 0.5).clip(0, len(model.knots) - 1)]
    score = 0.99 * share + 0.01 / (1 + np.exp(-np.clip((ratio - middle) * 100, -50, 50)))
    return np.where(words > 0, score, model.base_rate)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    toxic: str = "toxic",
    per_class: int = 6000,
    calibration: int = 6000,
    max_entries: int = 400_000,
    limit: float = 0.3,
) -> DataFrame:
    """One row per row of `docs`: `id`, `held_out`, `score`, `predicted` (1 from `limit` on), `ratio`, `n_words`.

    Learns from labelled ids whose crc32 as text is not 2 modulo 4; those that are 2, and a null id, are
    held out. The models are fitted on about `per_class` ids of each class at most, drawn by id from the
    remainders 0 and 1, and the score on about `calibration` ids of remainder 3; the sampled ids are what is
    broadcast to pick the texts; as many are taken of the larger class as of the smaller. The shared counts are of all rows. A model keeps the pairs and words that
    exceed DISCOUNT in a class, or a higher count where over `max_entries` do. An id labelled more than once is toxic if
    any label says so. A null or empty text scores the base rate, as do all texts where a class is missing.
    Repeated rows score alike; an empty table gives no rows; other columns are not read.
    """
    remainder: Column = fold(id, 4)
    marks = stage(
        labels.filter(F.col(toxic).isNotNull() & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("_label_id")).agg((F.max(toxic) > 0).alias("_toxic"))
        .withColumn("_part", fold("_label_id", 4)).filter("_part <> 2")
    )
    sizes = {(r[0], r[1]): r[2] for r in marks.groupBy(F.col("_part") == 3, "_toxic").agg(F.count(F.lit(1))).collect()}
    n_calibration = sizes.get((True, True), 0) + sizes.get((True, False), 0)
    share = F.when(F.col("_part") == 3, calibration / max(n_calibration, 1))
    # As many of either class, so that both models are equally rich.
    fit_on = min(per_class, sizes.get((False, True), 0), sizes.get((False, False), 0))
    for kind in (True, False):
        share = share.when(F.col("_toxic") == kind, fit_on / max(sizes.get((False, kind), 0), 1))
    picked = F.broadcast(marks.filter(spread("_label_id") < share))  # bounded by 2 * per_class + calibration ids
    read = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    sample = stage(read.join(picked, F.col("_id") == F.col("_label_id")).select("_part", "_toxic", "_text"))
    held_out = F.coalesce(remainder == 2, F.lit(True)).alias("_held_out")
    all_docs = docs.select(F.col(id).alias("_id"), held_out, F.col(text).alias("_text"))
    if fit_on:
        model = fit_models(sample.filter("_part <> 3").select("_toxic", "_text"), all_docs.select("_text"), max_entries)
        tried = with_ratio(sample.filter("_part = 3").select("_toxic", "_text"), model).toPandas()
    else:
        empty = np.zeros(0)
        model = Model(empty.astype(np.uint64), empty, 0.0, empty.astype(np.uint64), empty, empty.astype(np.uint64), empty, 0.0, empty, empty)
        tried = None
    labelled = sum(sizes.values())
    model.base_rate = (sizes.get((True, True), 0) + sizes.get((False, True), 0)) / labelled if labelled else 0.0
    if tried is not None and len(tried := tried[tried["_words"] > 0]):
        model.knots, model.shares = calibrate(tried["_ratio"].to_numpy(), tried["_toxic"].to_numpy())
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*held.value)
        for batch in batches:
            ratio, words = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_ratio", "_words"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores(ratio, words, model))], [*batch.schema.names, "_score"]
            )

    rated = with_ratio(all_docs, model)
    scored = rated.mapInArrow(finish, rated.withColumn("_score", F.lit(0.0)).schema)
    return scored.select(
        F.col("_id").alias(id), F.col("_held_out").alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= limit).cast("int").alias("predicted"), F.col("_ratio").alias("ratio"), F.col("_words").alias("n_words"),
    )
