"""Records of one ARC or WARC byte stream, read forward without holding the file."""

from __future__ import annotations

import io
import re
import zlib

# How the formats begin, and an ARC header line (5 fields in v1, 10 in v2).
GZIP_MAGIC = b"\x1f\x8b"
ARC_MAGIC = b"filedesc:"
WARC_MAGIC = b"WARC/"
ARC_DATE = re.compile(rb"^[0-9]+$")
MEMBER = b"\x1f\x8b\x08"
# Bytes in which the head of an HTTP message is looked for, and the largest payload that a row can hold.
HEAD = 1 << 16
LARGEST = (1 << 31) - (1 << 20)
# Read step for payloads that are counted but not kept.
STEP = 1 << 20


class Damaged(OSError):
    """A gzip member that cannot be decoded to its end."""


class Members(io.RawIOBase):
    """The decoded bytes of a file of gzip members, which can go on behind a damaged one.

    `raw` stands at byte `at` of the file; members that begin at byte `stop` or later are not read.
    """

    def __init__(self, raw, at: int = 0, stop: int | None = None):
        self.raw, self.held = raw, b""
        self.decoder, self.used = None, b""
        self.at, self.stop = at, stop

    def readable(self):
        return True

    def _more(self) -> bool:
        more = self.raw.read(STEP)
        self.held += more
        self.at += len(more)
        return bool(more)

    def readinto(self, into) -> int:
        while True:
            if self.decoder is None:
                if len(self.held) < 2 and self._more():
                    continue
                if not self.held.strip(b"\0") or (self.stop is not None and self.at - len(self.held) >= self.stop):
                    return 0
                self.decoder, self.used = zlib.decompressobj(31), b""
            if not self.held and not self._more():
                self.decoder = None
                raise Damaged("EOFError")
            try:
                data = self.decoder.decompress(self.held, len(into))
            except zlib.error as problem:
                raise Damaged(type(problem).__name__) from problem
            # What a damaged member still holds is searched for the next one, so it is kept for a while.
            rest = self.decoder.unconsumed_tail or self.decoder.unused_data
            self.used = (self.used + self.held[: len(self.held) - len(rest)])[-STEP:]
            self.held = rest
            if self.decoder.eof:
                self.decoder = None
            if data:
                into[: len(data)] = data
                return len(data)

    def skip(self) -> bool:
        """Go to the next member behind the damaged one; False if there is none."""
        self.decoder, self.held, self.used = None, (self.used + self.held)[1:], b""
        while (at := self.held.find(MEMBER)) < 0:
            self.held = self.held[-len(MEMBER) + 1 :]
            if not self._more():
                return False
        self.held = self.held[at:]
        return True


class Counted:
    """A readable stream that knows how many decoded bytes were taken from it."""

    def __init__(self, raw, at: int = 0, stop: int | None = None):
        head = raw.peek(2)[:2]
        self.members = Members(raw, at, stop) if head == GZIP_MAGIC else None
        self.stream = io.BufferedReader(self.members) if self.members else raw
        self.taken = 0

    def skip(self) -> bool:
        """Leave a damaged gzip member for the next one, if the file has members."""
        if self.members is None or not self.members.skip():
            return False
        self.stream.detach()
        self.stream = io.BufferedReader(self.members)
        return True

    def line(self) -> bytes:
        text = self.stream.readline()
        self.taken += len(text)
        return text

    def block(self, length: int, limit: int | None):
        """The next `length` bytes (None if what they hold is over the limit) and how many there were.

        The limit is that of the body: the head of an HTTP message does not count. Below 0 nothing is kept.
        """
        limit = LARGEST if limit is None else min(limit, LARGEST)
        if limit < 0:
            return None, self._pass(length, 0)
        head = self.stream.read(min(length, limit if length <= limit else HEAD))
        body = length
        if length > limit and head.startswith(b"HTTP/"):
            ends = [at + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (at := head.find(mark)) >= 0]
            body -= min(ends, default=0)
        if body <= limit:
            data = head + self.stream.read(length - len(head))
            self.taken += len(data)
            return data, len(data)
        return None, self._pass(length, len(head))

    def _pass(self, length: int, found: int) -> int:
        """Read over what follows the `found` bytes of a payload; how many there were in all."""
        while found < length:
            data = self.stream.read(min(STEP, length - found))
            if not data:
                break
            found += len(data)
        self.taken += found
        return found


def _text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("iso-8859-1")


def _row(source_file, offset, kind, **fields):
    row = dict.fromkeys(
        ("record_type", "url", "ip", "capture_date", "content_type", "payload_length", "headers", "payload", "error")
    )
    row.update(source_file=source_file, source_offset=offset, format=kind, **fields)
    return row


def _limit(row: dict, keep_limit, wants):
    """The limit of a record's body: none of it is kept where the head already tells that the record is not wanted."""
    return keep_limit if wants is None or wants(row) else -1


def _arc_header(line: bytes):
    parts = line.split()
    if len(parts) in (5, 10) and ARC_DATE.match(parts[2]) and parts[-1].isdigit():
        return parts
    return None


def _payload_error(length: int, found: int) -> str | None:
    if found != length:
        return "short payload"
    return "too large to hold" if length > LARGEST else None


def _arc(stream: Counted, source_file: str, first: bytes, keep_limit, wants):
    """ARC records; a bad header line gives one error row, then the next good header is sought."""
    line, offset, lost = first, stream.taken - len(first), False
    while line:
        header = _arc_header(line)
        if header is None:
            if line.strip() and not lost:
                lost = True
                yield _row(source_file, offset, "arc", error="bad header")
        else:
            lost = False
            length = int(header[-1])
            row = _row(
                source_file,
                offset,
                "arc",
                record_type="filedesc" if header[0].startswith(ARC_MAGIC) else "response",
                url=_text(header[0]),
                ip=_text(header[1]),
                capture_date=_text(header[2]),
                content_type=_text(header[3]),
                payload_length=length,
            )
            row["payload"], found = stream.block(length, _limit(row, keep_limit, wants))
            yield row | {"error": _payload_error(length, found)}
        offset = stream.taken
        line = stream.line()


# WARC header fields that have their own column.
WARC_FIELDS = {
    "warc-type": "record_type",
    "warc-target-uri": "url",
    "warc-date": "capture_date",
    "warc-ip-address": "ip",
    "content-type": "content_type",
}


def _warc(stream: Counted, source_file: str, first: bytes, keep_limit, version: bytes, wants):
    """WARC records of every type; headers end at the first blank line.

    A record of another version is read too, and marked. What lies between records is one error row.
    """
    line, offset, lost = first, stream.taken - len(first), False
    while line:
        if line.startswith(WARC_MAGIC):
            other, lost = not line.startswith(version), False
            fields, headers, length = {}, {}, None
            name = None
            line = stream.line()
            while line.strip():
                if line[:1] in b" \t" and name:
                    headers[name] = (headers[name] + " " + _text(line).strip()).strip()
                else:
                    name, _, value = _text(line).partition(":")
                    name, value = name.strip(), value.strip()
                    headers[name] = value
                line = stream.line()
            for key, value in headers.items():
                lowered = key.lower()
                if lowered in WARC_FIELDS:
                    fields[WARC_FIELDS[lowered]] = value
                elif lowered == "content-length" and value.isdigit():
                    length = int(value)
            if fields.get("url", "").startswith("<"):
                fields["url"] = fields["url"].strip("<>")
            if length is None:
                yield _row(source_file, offset, "warc", headers=headers, error="bad header", **fields)
            else:
                row = _row(source_file, offset, "warc", headers=headers, payload_length=length, **fields)
                row["payload"], found = stream.block(length, _limit(row, keep_limit, wants))
                yield row | {"error": "other version" if other else _payload_error(length, found)}
        elif line.strip() and not lost:
            lost = True
            yield _row(source_file, offset, "warc", error="bad header")
        offset = stream.taken
        line = stream.line()


def _kind_of(first: bytes, inside: bool) -> str | None:
    """The format that a file, or a member `inside` one, begins with."""
    if first.startswith(WARC_MAGIC):
        return "warc"
    return "arc" if first.startswith(ARC_MAGIC) or (inside and _arc_header(first)) else None


def read_records(
    raw, source_file: str, keep_limit=None, version: bytes = WARC_MAGIC, at: int = 0, stop: int | None = None, first_offset: int = 0, wants=None
):
    """Rows of one archive file, its format told by its first bytes.

    A gzip member that cannot be decoded gives an error row, and reading goes on with the next member; any
    other failure to read ends the file with an error row. Of a split, `raw` stands at a member that begins at byte
    `at`, `stop` is where the members of the next one begin, and offsets count from `first_offset`.
    """
    stream, kind = None, None
    try:
        stream = Counted(raw if hasattr(raw, "peek") else io.BufferedReader(raw), at, stop)
        stream.taken = first_offset
        while True:
            try:
                first = stream.line()
                kind = kind or _kind_of(first, at > 0)
                if kind == "arc":
                    yield from _arc(stream, source_file, first, keep_limit, wants)
                elif kind == "warc":
                    yield from _warc(stream, source_file, first, keep_limit, version, wants)
                elif first:
                    yield _row(source_file, first_offset, None, error="unknown format")
                return
            except Damaged as problem:
                yield _row(source_file, stream.taken, kind, error=f"unreadable: {problem}")
                if not stream.skip():
                    return
    except (OSError, EOFError, zlib.error) as problem:
        yield _row(source_file, stream.taken if stream else first_offset, None, error=f"unreadable: {type(problem).__name__}")


# A gzip file inside a payload may stand in the archive byte by byte, but not for longer than a stored block of deflate,
# as the next block begins with five bytes of its own. What can be decoded for longer is a member of the archive.
TELLING = 2 << 16


def _follows(held: bytes, at: int, ended: bool) -> bool | None:
    """Whether members with records can be decoded from `at` on for TELLING bytes, or to the end of the file.

    None: more bytes are needed to tell.
    """
    first = at
    while at - first <= TELLING:
        if held[at : at + 1] in (b"", b"\0") and not held[at:].strip(b"\0"):
            return at > first if ended else None
        decoder, head, step = zlib.decompressobj(31), b"", at
        while not decoder.eof:
            if step - first > TELLING and head:
                return True
            part = held[step : step + (1 << 14)]
            if not part:
                return False if ended else None
            step += len(part)
            try:
                while part and not decoder.eof:
                    data = decoder.decompress(part, 1 << 16)
                    if data and not head:
                        head = data[: 1 << 12]
                        if _kind_of(head.split(b"\n", 1)[0], True) is None:
                            return False
                    part = decoder.unconsumed_tail
            except zlib.error:
                return False
        if not head:
            return False
        at = step - len(decoder.unused_data)
    return True


def first_member(raw, at: int) -> int | None:
    """Where the first member that begins at byte `at` or later begins, where `raw` stands at `at`; None if there is none.

    A member of the archive itself is told from bytes that only look like one by the members that follow it.
    Only the bytes that tell are held.
    """
    held, base, ended, seen = b"", at, False, 0
    while True:
        found = held.find(MEMBER, seen)
        if found < 0:
            keep = max(0, len(held) - len(MEMBER) + 1)
            held, base, seen = held[keep:], base + keep, 0
            told: bool | None = None
        else:
            told = _follows(held, found, ended)
            if told:
                return base + found
        if told is False:
            seen = found + 1
        elif ended:
            return None
        else:
            if found > 0:
                held, base, seen = held[found:], base + found, 0
            more = raw.read(STEP)
            held, ended = held + more, not more
