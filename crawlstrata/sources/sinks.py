"""Result files: counts, site edges, adjacency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_counts(counts: DataFrame, path: str) -> None:
    """key TAB count lines in key order over the part files; an existing folder is replaced."""
    key, count = counts.columns[0], counts.columns[1]
    counts.orderBy(key).select(F.col(key), F.col(count)).write.mode("overwrite").csv(path, sep="\t")


def write_site_edges(edges: DataFrame, path: str) -> None:
    """Source,Target,Weight lines of the non-zero edges, by source then target."""
    (
        edges.filter(F.col("weight") != 0)
        .orderBy("source", "target")
        .select(F.col("source").alias("Source"), F.col("target").alias("Target"), F.col("weight").alias("Weight"))
        .write.mode("overwrite")
        .csv(path, header=True)
    )


def adjacency_lines(adjacency: DataFrame) -> DataFrame:
    """`src TAB [t1, t2]` text of an adjacency table."""
    targets = F.array_join(F.col("dst").cast("array<string>"), ", ")
    return adjacency.select(F.concat(F.col("src").cast("string"), F.lit("\t["), targets, F.lit("]")).alias("value"))


def write_adjacency(adjacency: DataFrame, path: str) -> None:
    adjacency_lines(adjacency).write.mode("overwrite").text(path)
