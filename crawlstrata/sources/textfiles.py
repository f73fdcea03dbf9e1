"""Text inputs of the link-graph jobs: URL lists, adjacency, prefixes, seeds, site tables.

Each reader is a parse of `value` lines, so it also runs on lines that come from a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.schema import PREFIXES

# A site id that is never used.
UNUSED_SITE_ID = "go"
# A separator no line holds: the CSV reader then skips the header and keeps lines whole.
WHOLE_LINE = "\u0001"


def _lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(path)


def _position() -> list:
    """Columns that order the lines of one file: block start, then order inside the block."""
    return [F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]


def parse_url_list(lines: DataFrame) -> DataFrame:
    """First blank-separated token of every non-empty line."""
    return lines.filter(F.col("value") != "").select(F.split("value", r"\s+", 2)[0].alias("url"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_url_list(_lines(spark, path))


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """(src, dst list) of `id [t1, t2]` lines; of a repeated src the last line counts.

    Last means greatest `line_no`, which must order the lines.
    """
    numbers = F.transform(F.regexp_extract_all("value", F.lit("[0-9]+"), 0), lambda n: n.cast("long"))
    rows = lines.select(numbers.alias("n"), "line_no").filter(F.size("n") > 0)
    return (
        rows.select(F.col("n")[0].alias("src"), F.slice("n", 2, F.greatest(F.size("n") - 1, F.lit(0))).alias("dst"), "line_no")
        .groupBy("src")
        .agg(F.max_by("dst", "line_no").alias("dst"))
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Adjacency of a folder's `part*` files, ordered by file name, then by line."""
    lines = _lines(spark, path, "part*").select(
        "value",
        F.struct(F.col("_metadata.file_name").alias("file"), *_position()).alias("line_no"),
    )
    return parse_adjacency(lines)


def read_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """(id, prefix) of `id,url` lines."""
    return spark.read.schema(PREFIXES).csv(path)


def parse_seeds(lines: DataFrame) -> DataFrame:
    """Distinct hosts, one per line."""
    return lines.filter(F.col("value") != "").select(F.col("value").alias("host")).distinct()


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return parse_seeds(_lines(spark, path))


def parse_site_meta(lines: DataFrame) -> DataFrame:
    """(code, url, approved day, line_no) of tab-separated lines that have at least two fields."""
    fields = F.split(F.trim("value"), "\t")
    day = F.substring(F.regexp_replace(F.trim(F.get("f", F.lit(4))), "-", ""), 1, 8)
    return lines.select(fields.alias("f"), "line_no").filter(F.size("f") > 1).select(
        F.trim(F.get("f", F.lit(0))).alias("code"),
        F.trim(F.get("f", F.lit(3))).alias("url"),
        day.alias("approved"),
        "line_no",
    )


def read_site_meta(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Site table of a tab-separated file, its header line skipped."""
    reader = spark.read.option("sep", WHOLE_LINE).option("header", header).option("quote", "")
    rows = reader.schema("value string").csv(path)
    return parse_site_meta(rows.select("value", F.struct(*_position()).alias("line_no")))


def parse_site_ids(lines: DataFrame) -> DataFrame:
    """Distinct site ids, one per line, without the unused one."""
    return (
        lines.filter((F.col("value") != "") & (F.col("value") != UNUSED_SITE_ID))
        .select(F.col("value").alias("site_id"))
        .distinct()
    )


def read_site_ids(spark: SparkSession, path: str) -> DataFrame:
    return parse_site_ids(_lines(spark, path))
