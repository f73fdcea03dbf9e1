"""Payload, charset, digest and markup expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crawlstrata.functions.keys import strip_blanks

# The end of an HTTP header, the charset assumed when none is named.
HEADER_END = "\r\n\r\n"
DEFAULT_CHARSET = "ISO-8859-1"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latin1(c) -> Column:
    """Bytes as text, one character per byte, so text positions are byte positions."""
    return F.decode(_col(c), "ISO-8859-1")


def utf8(c) -> Column:
    """Bytes as UTF-8 text with malformed sequences replaced."""
    return F.make_valid_utf8(_col(c).cast("string"))


def content_hash(c) -> Column:
    """MD5 of content, in hex."""
    return F.md5(_col(c))


def key_file_name(date, key) -> Column:
    """Name of a capture's text file: its date and the SHA-1 of its key."""
    return F.concat(_col(date), F.sha1(_col(key).cast("binary")), F.lit(".txt"))


def clean_anchor(text) -> Column:
    """Anchor text trimmed, runs of blanks made one space, all but letters , ' dropped."""
    single = F.regexp_replace(strip_blanks(text), r"[ \t\n\x0B\f\r]+", " ")
    return F.regexp_replace(single, "[^ A-Za-z,']+", "")


def strip_tags(text) -> Column:
    """Delete everything between < and >, on one line each."""
    return F.regexp_replace(_col(text), "<.*?>", "")


def _header_map(head: Column) -> Column:
    """Header lines as a map with lower-case names; repeated headers are joined with commas."""
    unfolded = F.regexp_replace(head, r"\r\n[ \t]+", " ")
    lines = F.filter(F.split(unfolded, "\r\n"), lambda line: F.instr(line, ":") > 1)
    fields = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.trim(F.substr(line, F.instr(line, ":") + 1)).alias("value"),
        ),
    )
    names = F.array_distinct(F.transform(fields, lambda f: f["name"]))
    values = F.transform(
        names,
        lambda n: F.array_join(F.transform(F.filter(fields, lambda f: f["name"] == n), lambda f: f["value"]), ", "),
    )
    return F.map_from_arrays(names, values)


def parse_http(records: DataFrame, payload: str = "payload", url: str = "url") -> DataFrame:
    """Split HTTP messages: adds http_status (-1 if none), http_headers and content (the body)."""
    is_http = F.col(url).startswith("http://") | F.col(url).startswith("https://")
    text = latin1(payload)
    end = F.when(is_http, F.instr(text, HEADER_END)).otherwise(0)
    split = records.withColumn("_head_end", F.coalesce(end, F.lit(0))).withColumn(
        "_head", F.when(F.col("_head_end") > 0, F.substr(text, F.lit(1), F.col("_head_end") - 1))
    )
    status = F.regexp_extract("_head", r"^HTTP/[0-9]+\.[0-9]+ +([0-9]{3})", 1)
    parsed = F.coalesce(status, F.lit("")) != ""
    body_at = F.col("_head_end") + len(HEADER_END)
    first_line_end = F.instr("_head", "\r\n")
    fields = F.when(first_line_end > 0, F.substr("_head", first_line_end + 2)).otherwise("")
    return split.select(
        *records.columns,
        F.when(parsed, status.cast("int")).otherwise(-1).alias("http_status"),
        F.when(parsed, _header_map(fields)).alias("http_headers"),
        F.when(parsed, F.substr(payload, body_at)).otherwise(F.col(payload)).alias("content"),
    )


def charset_of(content_type) -> Column:
    """Charset named by a Content-Type value, lower-case, null if none."""
    name = F.lower(F.regexp_extract(_col(content_type), r"(?i);\s*charset\s*=\s*[\"']?([^\s;\"']+)", 1))
    return F.when(name != "", name)


@F.pandas_udf(StringType())
def _decode_rare(content: pd.Series, charset: pd.Series) -> pd.Series:
    def decode(body, name):
        if body is None:
            return None
        try:
            return bytes(body).decode(name, "replace")
        except LookupError:
            return bytes(body).decode(DEFAULT_CHARSET)

    return pd.Series([decode(b, c) for b, c in zip(content, charset)], dtype=object)


def decode_text(content, charset) -> Column:
    """Bytes as text by a named charset; unknown or missing names mean ISO-8859-1.

    Latin-1 and UTF-8 decode in the JVM; only rows in another charset are sent to Python.
    """
    content = _col(content)
    name = F.coalesce(F.lower(_col(charset)), F.lit(DEFAULT_CHARSET.lower()))
    is_latin1 = name.isin("iso-8859-1", "iso8859-1", "latin1", "latin-1")
    is_utf8 = name.isin("utf-8", "utf8")
    rare = ~is_latin1 & ~is_utf8
    return (
        F.when(is_latin1, latin1(content))
        .when(is_utf8, utf8(content))
        .otherwise(_decode_rare(F.when(rare, content), F.when(rare, name)))
    )


def decode_as(content, charset: str) -> Column:
    """Bytes as text by one charset known beforehand."""
    name = charset.lower()
    if name == DEFAULT_CHARSET.lower():
        return latin1(content)
    if name == "utf-8":
        return utf8(content)
    return decode_text(content, F.lit(name))


def html_text_decode(captures: DataFrame) -> DataFrame:
    """Adds `text`: the body of HTML captures decoded by the charset of their HTTP Content-Type."""
    is_html = F.lower("content_type").contains("html")
    charset = charset_of(F.element_at("http_headers", F.lit("content-type")))
    return captures.withColumn("text", decode_text(F.when(is_html, F.col("content")), charset))
