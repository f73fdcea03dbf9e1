"""Lines that many documents share are dropped everywhere but in one of them.

Lines are exploded with their position, hashed under their normal form, counted per distinct document,
dropped over the threshold, and the rest is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.common import SPACE
from crawlstrata.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; texts of ASCII only take the quicker way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """All rows of `docs` with the text left over and `_n_lines`, `_n_dropped`.

    A line whose key has at least `min_chars` code points and stands in at least `min_docs` distinct
    documents stays only in the largest id among them. A null text is one empty line. Rows with the same
    id count as one document; null ids count as one document too, the smallest. Repeated rows stay, each
    with its own text. If every line goes, the text is empty. An empty table gives an empty table. Other
    columns pass through; names starting with `_` are the operator's.

    Only 16-byte digests of long lines are counted and joined; a line found everywhere is first summed
    up within each task, and the table of dropped lines is written before it is joined, so that a hot
    line's rows can be split. Texts are shuffled once, by document, to meet their dropped positions.
    """
    known = docs.withColumn("_x", F.xxhash64(text))
    lines = (
        known.select(F.col(id).alias("_id"), "_x", F.posexplode(lines_of(F.col(text))).alias("_at", "_line"))
        .withColumn("_trimmed", F.btrim("_line", F.lit(SPACE)))
        .filter(F.char_length("_trimmed") >= min_chars)
        .select("_id", "_x", "_at", F.unhex(F.md5(ascii_lower(F.col("_trimmed")))).alias("_hash"))
    )
    found = lines.groupBy("_hash").agg(
        (F.count_distinct("_id") + F.max(F.col("_id").isNull().cast("int"))).alias("_docs"), F.max("_id").alias("_keeper")
    )
    over = stage(found.filter(F.col("_docs") >= min_docs).select("_hash", "_keeper"))
    dropped = (
        lines.join(over, "_hash")
        .filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_x")
        .agg(F.collect_set("_at").alias("_dropped"))
    )
    split = lines_of(F.col(text))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.coalesce("_dropped", F.array().cast("array<int>")))
    return (
        known.join(dropped, known[id].eqNullSafe(dropped["_id"]) & (known["_x"] == dropped["_x"]), "left")
        .select(
            *[known[c] for c in docs.columns if c != text],
            F.array_join(F.transform(kept, lambda at: F.get(split, at)), "\n").alias(text),
            F.size(split).cast("long").alias("_n_lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("_n_dropped"),
        )
    )
