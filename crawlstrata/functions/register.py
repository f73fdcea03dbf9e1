"""Expressions made available to Spark SQL by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.functions.keys import DOMAIN_NAME, site_label

# The blanks that host_name of a column strips too: the characters up to and including the space.
_BLANKS = f"decode(unhex('{''.join(f'{i:02X}' for i in range(33))}'), 'UTF-8')"
_HOST = f"try_parse_url(btrim(url, {_BLANKS}), 'HOST')"

# SQL bodies of the functions; each is inlined into the calling query's plan.
SQL_FUNCTIONS = {
    "host_name": (
        "url STRING",
        f"CASE WHEN rlike({_HOST}, r'{DOMAIN_NAME}') THEN regexp_replace({_HOST}, r'^www\\.', '') END",
    ),
    "date_unit": (
        "date STRING, unit STRING",
        "CASE WHEN length(date) < 8 OR unit IS NULL THEN NULL "
        "WHEN unit = 'year' THEN substring(date, 1, 4) "
        "WHEN unit = 'month' THEN substring(date, 5, 2) "
        "WHEN unit = 'day' THEN substring(date, 7, 2) ELSE date END",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Create `host_name(url)` and `date_unit(date, unit)` as temporary SQL functions."""
    for name, (arguments, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}")


def register_site_codes(spark: SparkSession, meta: DataFrame, view: str = "site_codes") -> None:
    """Create `site_code(label)`: the code of the site whose URL has this label, null where there is none.

    The body reads the view `view`, made from the site table with one row per label; of repeated labels the
    last line counts. Spark turns the look-up into a join with the query that calls it.
    """
    codes = meta.select(site_label("url").alias("label"), "code", "line_no").filter(F.col("label").isNotNull())
    codes.groupBy("label").agg(F.max_by("code", "line_no").alias("code")).createOrReplaceTempView(view)
    body = f"SELECT max(code) FROM {view} WHERE {view}.label = site_code.wanted"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION site_code(wanted STRING) RETURNS STRING RETURN ({body})")
