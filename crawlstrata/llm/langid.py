"""Language of documents by sparse multinomial logistic regression on character n-grams.

N-grams of one to four characters are hashed, weighed by TF-IDF with document frequencies counted over
all learning documents, and fitted by follow-the-regularised-leader with an elastic net, which leaves most
weights at zero. A temperature fitted on documents kept out of the fit calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import fold, letter_table, letters, mix, pieces, spread
from crawlstrata.session import stage

UNKNOWN = "und"
ORDERS = 4
DIMENSIONS = 1 << 15
SEED = 4


@dataclass
class Model:
    """What a prediction needs; about DIMENSIONS * (languages + 1) numbers."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMENSIONS x languages
    bias: np.ndarray
    temperature: float


def grams(codes: np.ndarray) -> np.ndarray:
    """Hashed n-grams of a text whose words are divided by 0; those with no letter are left out."""
    # Only the first of several non-letters counts, so that punctuation and digits weigh nothing.
    codes = codes[(codes != 0) | (np.concatenate(([1], codes[:-1])) != 0)].astype(np.uint64)
    found, h = [], np.zeros(len(codes), np.uint64)
    for order in range(1, ORDERS + 1):
        if len(codes) < order:
            break
        h = h[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1 :] + np.uint64(order)
        inner = codes[: len(h)] != 0 if order == 1 else np.ones(len(h), bool)
        found.append((mix(h[inner]) & np.uint64(DIMENSIONS - 1)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def vectors(texts: list[str], low: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Of each text the n-grams present and their damped counts; None without a letter."""
    codes, starts = letters(texts, low)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if not codes[a:b].any():
            yield None
            continue
        count = np.bincount(grams(codes[a:b]), minlength=DIMENSIONS)
        at = np.flatnonzero(count)
        yield at, 1 + np.log(count[at])


def weighed(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length one."""
    x = tf * idf[at]
    return x / (np.sqrt((x * x).sum()) or 1.0)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many documents each n-gram is, and how many have a letter. A task sends one row per n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, total = letter_table(), np.zeros(DIMENSIONS + 1, np.int64)
        for _, texts in pieces(batches, "_text"):
            for found in vectors(texts, low):
                if found is not None:
                    total[found[0]] += 1
                    total[DIMENSIONS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(at), "n": pa.array(total[at])})

    counted = docs.select(F.col(text).alias("_text")).mapInArrow(count, "gram long, n long")
    df = np.zeros(DIMENSIONS + 1, np.int64)
    summed = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # at most DIMENSIONS + 1 rows
    df[summed["gram"].to_numpy()] = summed["n"].to_numpy()
    return df[:DIMENSIONS], int(df[DIMENSIONS])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray, classes: int, epochs: int, rate: float, l1: float, l2: float
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after passes over `rows` of (n-grams, term weights, class) in a fixed random order."""
    z, n = np.zeros((DIMENSIONS + 1, classes)), np.zeros((DIMENSIONS + 1, classes))
    random = np.random.default_rng(SEED)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((1 + np.sqrt(n[at])) / rate + l2)
        return np.where(np.abs(z[at]) > l1, w, 0.0)

    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at, tf, label = rows[i]
            x = np.append(weighed(at, tf.astype(float), idf), 1.0)
            at = np.append(at, DIMENSIONS)
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / rate * w
            n[at] += g * g
    w = weights(np.arange(DIMENSIONS + 1))
    return w[:DIMENSIONS], w[DIMENSIONS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits, between 0.05 and 20, with the smallest log loss; 1 without rows."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20, 241)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(
    docs: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 1200,
    chars_per_language: int = 1 << 24,
    epochs: int = 3,
    rate: float = 0.5,
    l1: float = 0.02,
    l2: float = 0.1,
) -> Model | None:
    """The model learnt from rows where `learn` holds and `lang` is given; None if there are none.

    Document frequencies are counted over all of these. The regression is fitted on about `per_language`
    documents and `chars_per_language` characters of each language at most, drawn by id, a fifth of which fits
    the temperature instead; ids decide on both, so a repeated row falls on the same side. One task fits it, so the
    driver holds the counts and the weights only.
    """
    usable = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    chars = F.sum(F.char_length(text)).alias("chars")
    sizes = {r.lang: (r.n, r.chars) for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n"), chars).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    df, n = document_frequencies(usable, text)
    idf = np.log((1 + n) / (1 + df)) + 1
    shares = {k: min(1.0, per_language / count, chars_per_language / max(1, chars)) for k, (count, chars) in sizes.items()}
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, shares[k])])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = letter_table()
        for batch, texts in pieces(batches, "_text"):
            found = list(vectors(texts, low))
            pick = pa.array([f is not None for f in found])
            found = [f for f in found if f is not None]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["_lang", "_apart"]).filter(pick).columns, pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
                ["lang", "apart", "at", "tf"],
            )

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {k: i for i, k in enumerate(languages)}
        rows, apart = [], []
        for batch in batches:
            for k in range(batch.num_rows):
                at, tf = (batch.column(c)[k].values.to_numpy().copy() for c in (2, 3))
                (apart if batch.column(1)[k].as_py() else rows).append((at, tf, number[batch.column(0)[k].as_py()]))
        values = lambda r: weighed(r[0], r[1].astype(float), idf)
        # In one order, whatever order the tasks gave them.
        rows.sort(key=lambda r: (r[2], len(r[0]), float((x := values(r)).sum()), float(x.max())))
        weights, bias = fit_ftrl(rows, idf, len(languages), epochs, rate, l1, l2)
        logits = np.array([values(r) @ weights[r[0]] + bias for r in apart]).reshape(-1, len(languages))
        temperature = fit_temperature(logits, np.array([label for *_, label in apart], np.int64))
        yield pa.RecordBatch.from_pydict(
            {"weights": [weights.astype(np.float32).tobytes()], "bias": [bias.tobytes()], "temperature": [temperature]}
        )

    drawn = usable.filter(spread(id) < share[F.col(lang)]).select(
        F.col(lang).alias("_lang"), (F.pmod(F.xxhash64(F.lit("apart"), F.col(id)), F.lit(5)) == 0).alias("_apart"),
        F.col(text).alias("_text"),
    )
    rows = drawn.mapInArrow(sample, "lang string, apart boolean, at array<int>, tf array<float>").repartition(1)
    fitted = rows.mapInArrow(learnt, "weights binary, bias binary, temperature double").first()
    weights = np.frombuffer(bytes(fitted.weights), np.float32).reshape(DIMENSIONS, len(languages))
    return Model(languages, idf.astype(np.float32), weights, np.frombuffer(bytes(fitted.bias)), fitted.temperature)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`docs` with `_lang_pred` and `_score`: the likeliest language and its calibrated probability.

    Without a letter, a text, or a model: UNKNOWN with score 0. Ties go to the first language by name.
    The columns of `docs` must not start with `_` in these two names.
    """
    held = docs.sparkSession.sparkContext.broadcast(model and astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, low = held.value and Model(*held.value), letter_table()
        for batch, texts in pieces(batches, text):
            names, scores = [], []
            for found in vectors(texts, low):
                if found is None or model is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, tf = found
                p = softmax((weighed(at, tf, model.idf) @ model.weights[at] + model.bias) / model.temperature)
                best = int(np.argmax(p))
                names.append(model.languages[best])
                scores.append(float(min(p[best], 1.0)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "_lang_pred", "_score"],
            )

    return docs.mapInArrow(run, docs.withColumns({"_lang_pred": F.lit(""), "_score": F.lit(0.0)}).schema)


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """One row per row of `docs`: `id`, `held_out`, `lang_pred`, `score`.

    Learns from rows with a language whose crc32 of the id as text is no multiple of 5; these are not held
    out. A null id is held out and never learnt from. Null and empty texts and texts without a letter get
    UNKNOWN and score 0, as does every text where nothing can be learnt. Repeated rows are predicted alike;
    an empty table gives no rows; only the three named columns are read.
    """
    held_out = F.coalesce(fold(id, 5) == 0, F.lit(True))
    model = fit(docs, ~held_out, id, text, lang, **options)
    read = docs.select(F.col(id).alias("_id"), held_out.alias("_held_out"), F.col(text).alias("_text"))
    return predict(read, model, "_text").select(
        F.col("_id").alias(id), F.col("_held_out").alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score")
    )
