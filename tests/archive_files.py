"""Small archive files for the reader tests."""

import gzip


def arc_record(url, date, kind, body, ip="10.0.0.1", length=None):
    length = len(body) if length is None else length
    return f"{url} {ip} {date} {kind} {length}\n".encode() + body + b"\n"


def arc_file(records, compressed=True):
    head = arc_record("filedesc://x.arc", "20040101000000", "text/plain", b"1 0 test\nURL IP Date Type Length\n", "0.0.0.0")
    return members([head, *records], compressed)


def warc_record(kind, fields, body, version="WARC/1.0"):
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{version}\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def members(parts, compressed=True):
    return b"".join(gzip.compress(p) if compressed else p for p in parts)


def http(body, kind="text/html", status="200 OK"):
    return f"HTTP/1.1 {status}\r\nContent-Type: {kind}\r\n\r\n".encode() + body
