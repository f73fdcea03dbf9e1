"""Quality rules on text statistics, and an isolation forest over them.

Rule statistics are counted per document. Trees over random splits of small samples isolate unusual
statistics in few steps; the mean path length gives a score. There is a forest for the form of the words
and one for repetition, and the scores above which a document is rejected are calibrated on labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import pieces, spread
from crawlstrata.session import stage

# The characters that count as symbols, and the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The forests and the features that each splits on.
FORESTS = {"form": [0, 1, 2], "repetition": [3, 4, 5]}
BINS = 4096
# A threshold is used only if it catches this many times the share of bad rows that it costs of the good.
LEAST_GAIN = 5
SEED = 20


def _repeated_words(ids: np.ndarray, window: int) -> int:
    """Words in windows that stand at two places or more, told by exact ranks doubled in length."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    ranks, length = ids, 1
    while length < window:
        step = min(length, window - length)
        pairs = ranks[: len(ranks) - step] * np.int64(len(ids) + 1) + ranks[step:]
        ranks, length = np.unique(pairs, return_inverse=True)[1], length + step
    again = np.bincount(ranks)[ranks] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_counts(text: str) -> tuple[int, int, int, int, int, int, int]:
    """COUNTS of one text, its lines with a word and its distinct words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space only
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    spaces = len(data) - sum(map(len, words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(map(data.count, (bytes([c]) for c in SYMBOLS)))
    return (
        len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), _repeated_words(ids, WINDOW),
        len(lines), len(number),
    )


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`_id`, COUNTS, `n_lines` and `n_distinct` of every row; a null text has no words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            rows = np.array([text_counts(t) for t in texts], np.int64).reshape(len(texts), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], names)

    names = ["_id", *COUNTS, "n_lines", "n_distinct"]
    read = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    schema = read.select("_id", *(F.lit(0).cast("long").alias(c) for c in names[1:])).schema
    return read.mapInArrow(count, schema)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The statistics that the trees split on, one row per document."""
    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    lines = np.maximum(counts["n_lines"], 1)
    return np.stack(
        [
            counts["word_chars"] / words,
            counts["n_symbols"] / chars,
            counts["n_symbols"] / words,
            counts["n_dup_lines"] / lines,
            counts["n_repeat_words"] / words,
            # Distinct words fall with the length of a text, so they are told in proportion to its root.
            np.log1p(counts["n_distinct"]) - 0.75 * np.log1p(counts["n_words"]),
        ],
        axis=1,
    )


def _usual_depth(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, random: np.random.Generator, depth: int) -> np.ndarray:
    """One tree as an array of nodes: feature (-1: leaf), split, and path length at a leaf.

    Node i has the children 2i + 1 and 2i + 2.
    """
    nodes = np.zeros((2 ** (depth + 1) - 1, 3))
    nodes[:, 0] = -1
    todo = [(0, rows, 0)]
    while todo:
        i, part, level = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        able = np.flatnonzero(high > low)
        if level == depth or len(part) < 2 or not len(able):
            nodes[i, 2] = level + _usual_depth(len(part))
            continue
        feature = random.choice(able)
        split = random.uniform(low[feature], high[feature])
        nodes[i, :2] = feature, split
        left = part[:, feature] <= split
        todo += [(2 * i + 1, part[left], level + 1), (2 * i + 2, part[~left], level + 1)]
    return nodes


def fit_forest(rows: np.ndarray, trees: int, sample: int) -> np.ndarray:
    """`trees` trees, each over `sample` rows drawn without replacement."""
    random = np.random.default_rng(SEED)
    depth = max(1, int(np.ceil(np.log2(max(2, sample)))))
    return np.stack([
        grow(rows[random.choice(len(rows), min(sample, len(rows)), replace=False)], random, depth) for _ in range(trees)
    ])


def anomaly(forest: np.ndarray, rows: np.ndarray, sample: int) -> np.ndarray:
    """Score of each row: 1 if it is isolated at once, about 0.5 if it is as usual as any."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for nodes in forest:
        at = np.zeros(len(rows), np.int64)
        while True:
            feature = nodes[at, 0].astype(np.int64)
            inner = feature >= 0
            if not inner.any():
                break
            right = rows[every, feature] > nodes[at, 1]
            at = np.where(inner, 2 * at + 1 + right, at)
        total += nodes[at, 2]
    return 2.0 ** (-total / len(forest) / max(_usual_depth(sample), 1e-9))


def scored(stats: DataFrame, forests: dict[str, np.ndarray], sample: int) -> DataFrame:
    """`stats` with `score_` and the name of each forest."""
    names = [f"score_{k}" for k in forests]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(batch.schema.get_field_index(c)).to_numpy() for c in [*COUNTS, "n_lines", "n_distinct"]}
            rows = features(counts)
            out = [pa.array(anomaly(forest, rows[:, FORESTS[k]], sample)) for k, forest in forests.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, *names])

    return stats.mapInArrow(score, stats.withColumns({c: F.lit(0.0) for c in names}).schema)


def threshold(good: np.ndarray, bad: np.ndarray, max_loss: float) -> float:
    """The score from which on most bad rows lie, with at most `max_loss` of the good rows there.

    `good` and `bad` count labelled rows by score, in BINS bins over 0 to 1. The largest gain of the share of bad over
    that of good rows wins, the higher score at a tie; without a gain worth it, nothing reaches it.
    """
    if not bad.sum():
        return np.inf
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where((lost <= max_loss) & (caught > LEAST_GAIN * lost), caught - lost, 0.0)
    best = BINS - 1 - int(np.argmax(gain[::-1]))
    return best / BINS if gain[best] > 0 else np.inf


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    quality: str = "quality",
    trees: int = 100,
    sample: int = 256,
    max_loss: float = 0.005,
) -> DataFrame:
    """One row per row of `docs`: `id`, COUNTS, `base_failed`, `kept`, and `score_` of each forest.

    `base_failed`: under MIN_WORDS words, or over MAX_REPEAT_PERCENT of them repeated. Other documents are
    rejected when the score of a forest reaches its threshold; that is chosen over all labelled rows (quality
    0 is bad, repeated labels of an id count as the worst) so that each forest loses at most `max_loss` of the good.

    The forests are fitted on at most about `trees * sample` documents that passed the base rules, drawn by
    id from the labelled ones, or from all where none is labelled; 25,600 rows of six numbers by default. Without
    documents to fit on nothing but the base rules rejects. Null and empty texts have no words and fail the
    base rules. Repeated rows and null ids are judged like any other row; an empty table gives no rows;
    other columns are not read.
    """
    stats = stage(statistics(docs, id, text))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    marks = labels.filter(F.col(quality).isNotNull()).groupBy(F.col(label_id).alias("_label_id")).agg(F.min(quality).alias("_quality"))
    labelled = stage(stats.filter(~base_failed).join(marks, F.col("_id") == F.col("_label_id")).drop("_label_id"))
    fit = labelled
    n = fit.count()
    if not n:
        fit = stats.filter(~base_failed)
        n = fit.count()
    bound = trees * sample
    drawn = fit.filter(spread("_id") < bound / max(n, 1)) if n > bound else fit
    rows = drawn.select("_id", *COUNTS, "n_lines", "n_distinct").toPandas().sort_values(["_id", "n_words", "word_chars"])  # about `bound` rows
    names = [f"score_{k}" for k in FORESTS]
    if len(rows):
        values = features({c: rows[c].to_numpy() for c in rows.columns[1:]})
        forests = {k: fit_forest(values[:, columns], trees, sample) for k, columns in FORESTS.items()}
        tried = stage(scored(labelled, forests, sample))
        limits = {}
        for name in names:
            bins = F.least(F.floor(F.col(name) * BINS), F.lit(BINS - 1)).cast("int")
            counted = tried.groupBy(bins.alias("bin"), (F.col("_quality") == 0).alias("bad")).agg(F.count(F.lit(1)).alias("n"))
            by = np.zeros((2, BINS), np.int64)
            for row in counted.collect():  # at most two rows per bin
                by[int(row.bad), row.bin] = row.n
            limits[name] = threshold(by[0], by[1], max_loss)
        judged = scored(stats, forests, sample)
    else:
        limits, judged = dict.fromkeys(names, np.inf), stats.withColumns({c: F.lit(0.0) for c in names})
    kept = ~base_failed
    for name, limit in limits.items():
        kept = kept & (F.col(name) < F.lit(float(limit)))
    return judged.select(F.col("_id").alias(id), *COUNTS, base_failed.alias("base_failed"), kept.alias("kept"), *names)
