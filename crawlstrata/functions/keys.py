"""URL keys, hosts and paths as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Protocols a URL may have to be keyed.
SCHEMES = ["http", "https", "ftp", "file", "mailto"]

# Scheme, host, port, path and query of a URL; user and fragment are not kept.
URL_SHAPE = (
    r"(?s)^(?:[uU][rR][lL]:)?([A-Za-z][A-Za-z0-9+.-]*):"
    r"(?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:@]*)(?::([0-9]{0,9}))?(?=[/?#]|$)|(?!//))"
    r"([^?#]*)(\?[^#]*)?(?:#.*)?$"
)

# The longest file type, the shape of a valid domain name (no IPv4, labels of 1-63).
MAX_FILE_TYPE = 8
LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
DOMAIN_NAME = rf"^(?=.{{1,254}}$)(?:{LABEL}\.)*(?![0-9]){LABEL}\.?$"

_BLANKS = "".join(map(chr, range(33)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c) -> Column:
    """Trim spaces and control characters at both ends."""
    return F.trim(_col(c), F.lit(_BLANKS))


def collapse_dot_segments(path: Column) -> Column:
    """Resolve `.` and `..` segments of a path; a `..` with nothing to remove stays."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)

    def step(done: Column, part: Column) -> Column:
        poppable = (F.size(done) > 1) & (F.element_at(done, -1) != "..")
        return (
            F.when(part == ".", done)
            .when((part == "..") & poppable, F.slice(done, F.lit(1), F.size(done) - 1))
            .otherwise(F.array_append(done, part))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    resolved = F.array_join(kept, "/")
    return F.when(last.isin(".", "..") & ~resolved.endswith(".."), F.concat(resolved, F.lit("/"))).otherwise(resolved)


def _url_parts(url) -> tuple[Column, Column, Column, Column, Column]:
    """(valid, host, port, path, query with its mark) of a URL, from one pass of one pattern."""
    parts = F.split(F.regexp_replace(strip_blanks(url), URL_SHAPE, "$1\0$2\0$3\0$4\0$5"), "\0")
    scheme, host, port, path, query = (F.get(parts, F.lit(i)) for i in range(5))
    valid = (
        (F.size(parts) == 5)
        & F.lower(scheme).isin(SCHEMES)
        & ((host == "") | (F.rtrim(host, F.lit(".")) != ""))
    )
    port = F.when(port != "", port.try_cast("int").cast("string"))
    dotted = path.contains("/.") | path.startswith("./")
    return valid, host, port, F.when(dotted, collapse_dot_segments(path)).otherwise(path), query


def _reverse_labels(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(F.rtrim(host, F.lit(".")), r"\.")), ".")


def url_key(url) -> Column:
    """Reversed-host key: host labels reversed, port if written, path and query; null if malformed."""
    valid, host, port, path, query = _url_parts(url)
    port = F.coalesce(F.concat(F.lit(":"), port), F.lit(""))
    return F.when(valid, F.concat(_reverse_labels(host), port, path, query))


def url_host(url) -> Column:
    """Host of a well-formed URL as written, else null."""
    valid, host, _, _, _ = _url_parts(url)
    return F.when(valid, host)


def key_domain(key) -> Column:
    """Text of a key before its first slash, port included."""
    return F.substring_index(_col(key), "/", 1)


def key_to_host(key) -> Column:
    """`http://` and the host of a key in reading order, with its port."""
    domain = key_domain(key)
    ports = F.split(domain, ":")
    port = F.when(F.coalesce(F.get(ports, F.lit(1)), F.lit("")) != "", F.concat(F.lit(":"), F.get(ports, F.lit(1))))
    return F.concat(F.lit("http://"), _reverse_labels(F.get(ports, F.lit(0))), F.coalesce(port, F.lit("")))


def _host_only(key: Column) -> Column:
    return key.rlike("^[^/]*/*$")


def key_to_url(key) -> Column:
    """URL of a key; a key that ends in its host's slash loses it."""
    key = _col(key)
    rest = F.substr(key, F.length(key_domain(key)) + 1)
    return F.when(_host_only(key), key_to_host(key)).otherwise(F.concat(key_to_host(key), rest))


def base_path(key) -> Column:
    """Host and first path segment of a key."""
    key = _col(key)
    return F.when(_host_only(key), key_domain(key)).otherwise(F.substring_index(key, "/", 2))


def file_type(key) -> Column:
    """File-name extension of a key's last segment, '' when there is none worth the name."""
    key = _col(key)
    name = F.rtrim(F.substring_index(key, "/", -1), F.lit("."))
    ending = F.substring_index(name, ".", -1)
    usable = name.contains(".") & (F.length(ending) <= MAX_FILE_TYPE) & ~ending.rlike(r"^\p{Nd}$")
    return F.when(key.isNull(), None).when(usable, ending).otherwise("")


def host_name(url) -> Column:
    """Host of a URL without its leading `www.`; null if there is none or it is no domain name."""
    host = F.try_parse_url(strip_blanks(url), F.lit("HOST"))
    plain = F.when(host.startswith("www."), F.substr(host, F.lit(5))).otherwise(host)
    return F.when(host.rlike(DOMAIN_NAME), plain)


def site_label(url) -> Column:
    """Second-last label of the lower-cased host; the input where there is no such label."""
    url = _col(url)
    labels = F.split(F.rtrim(F.lower(url_host(url)), F.lit(".")), r"\.")
    return F.when(F.size(labels) >= 2, F.element_at(labels, -2)).otherwise(url)
