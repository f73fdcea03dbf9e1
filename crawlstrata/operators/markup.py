"""Links, text and replay copies of single HTML pages; Spark hands them over in Arrow batches."""

from __future__ import annotations

import re
from html import unescape

# What ends a block of text.
BLOCKS = frozenset(
    "html head body title meta link script style noscript section nav article main aside header footer h1 h2 h3 h4 h5 h6 "
    "p ul ol li dl dt dd pre div blockquote hr address figure figcaption form fieldset table caption thead tbody "
    "tfoot colgroup col tr th td video audio canvas details summary menu frameset frame noframes br".split()
)
# Elements whose content is no markup, and those of them whose content is not shown.
RAW = frozenset(("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"))
UNSEEN = frozenset(("script", "style", "iframe", "noembed", "noframes"))

# Protocols a link may have once it is absolute.
LINK_SCHEMES = frozenset(("http", "https", "ftp", "file", "mailto"))

# Blanks that become a space, and spaces that become one.
BLANKS = "\t\n\r\f\x0b\xa0"
MANY_SPACES = re.compile(" {2,}")
# A tag ends at the first > that is in no quoted value; quotes count only after an equals sign.
ATTRIBUTES = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[\"'])*+"
TOKEN = re.compile(rf"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})>|<[!?/][^>]*>", re.DOTALL)
PLAIN_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>", re.DOTALL)
TAG_START = re.compile("</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(\s*=\s*)(\"[^\"]*\"|'[^']*'|[^\s>]*)|[^\s=>\"'/]+")
SCHEME = re.compile(r"([a-zA-Z][a-zA-Z0-9+.-]*):")
ORIGIN = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*")
PATH = re.compile(r"[^?#]*")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
# A page in one pass: text and what follows it, an element whose content is no markup, a tag (slash, name, attributes) or
# what has no name. The last group takes the rest of a page from the first tag on that has no end.
RAW_ELEMENT = "|".join(
    rf"{''.join(f'[{c}{c.upper()}]' for c in name)}(?=[\s/>]){ATTRIBUTES}>(?:[^<]++|<(?!/(?i:{name})[\s/>]))*+" for name in sorted(RAW)
)
RAW_INITIALS = "".join(sorted({c for name in RAW for c in (name[0], name[0].upper())}))
PARTS = re.compile(
    rf"((?:[^<]++|<(?![a-zA-Z!?/]))*+)(?:(<(?=[{RAW_INITIALS}])(?:{RAW_ELEMENT}))|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})>|<!--.*?(?:--!?>|\Z)|<[!?/][^>]*>|(<.*)|\Z)",
    re.DOTALL,
)


class Tags:
    """The tags and comments of a page, one after another, in time that grows with its length.

    Where no `>` follows, nothing but a comment can. A tag whose quotes swallow every later `>` makes
    quotes count for nothing in the rest of the page, so that no such search is made twice. Without
    `comments`, what a comment holds is read as if it stood outside.
    """

    def __init__(self, html: str, comments: bool = True):
        self.html, self.last, self.pattern, self.comments = html, html.rfind(">"), TOKEN, comments

    def next(self, at: int):
        """The next match from `at` on, or None."""
        while (at := self.html.find("<", at)) >= 0:
            if not self.comments and self.html.startswith("<!--", at):
                at += 4
                continue
            if at > self.last:
                at = self.html.find("<!--", at) if self.comments else -1
                return TOKEN.match(self.html, at) if at >= 0 else None
            found = self.pattern.match(self.html, at)
            if found is None and self.pattern is TOKEN and TAG_START.match(self.html, at):
                self.pattern = PLAIN_TOKEN
                found = self.pattern.match(self.html, at)
            if found is not None:
                return found
            at += 1
        return None


def tokens(html: str):
    """(kind, name, text) in page order: `text`, `open` (text is the attributes), `close`.

    A page whose tags all have an end is cut up by one expression; others are read tag by tag.
    """
    parts = PARTS.findall(html)
    if any(part[5] for part in parts[-2:]):
        yield from _tokens_one_by_one(html)
        return
    for text, raw, slash, name, attributes, _ in parts:
        if text:
            yield "text", None, text
        if raw:
            tag = TOKEN.match(raw)
            name = tag.group(2).lower()
            yield "open", name, tag.group(3)
            if len(raw) > tag.end() and name not in UNSEEN:
                yield "text", None, raw[tag.end() :]
        elif slash:
            yield "close", name.lower(), None
        elif name:
            yield "open", name.lower(), attributes


def _tokens_one_by_one(html: str):
    """As `tokens`, whatever the page is like."""
    at, tags = 0, Tags(html)
    while found := tags.next(at):
        if found.start() > at:
            yield "text", None, html[at : found.start()]
        at = found.end()
        slash, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if slash:
            yield "close", name, None
            continue
        yield "open", name, attributes
        if name in RAW:
            end = RAW_END[name].search(html, at)
            stop = end.start() if end else len(html)
            if stop > at and name not in UNSEEN:
                yield "text", None, html[at:stop]
            at = stop
    if at < len(html):
        yield "text", None, html[at:]


def attribute(attributes: str, wanted: str) -> str | None:
    """Value of the first attribute of that name, '' if it has none, None if it is not there."""
    for found in ATTRIBUTE.finditer(attributes):
        name, _, value = found.groups()
        if (name or found.group()).lower() == wanted:
            if not value:
                return ""
            return unescape(value[1:-1] if value[0] in "\"'" else value)
    return None


def _collapse(path: str) -> str:
    """Resolve `.` and `..` segments; a `..` with nothing to remove stays."""
    done: list[str] = []
    parts = path.split("/")
    for part in parts:
        if part == ".." and len(done) > 1 and done[-1] != "..":
            done.pop()
        elif part != ".":
            done.append(part)
    if parts[-1] in (".", "..") and done[-1] != "..":
        done.append("")
    return "/".join(done)


def _place(origin: str, rest: str) -> str:
    """A URL of its origin and the rest, the path of which may hold dot segments."""
    if "/." not in rest:
        return origin + rest
    path = PATH.match(rest).group()
    return origin + _collapse(path) + rest[len(path) :]


def absolute(base: str, link: str) -> str:
    """`link` resolved against `base`, '' if that gives no usable URL."""
    link = link.strip()
    if named := SCHEME.match(link):
        scheme = named.group(1).lower()
        if scheme not in LINK_SCHEMES:
            return ""
        link = scheme + link[len(scheme) :]
        full = ORIGIN.match(link)
        return _place(full.group(), link[full.end() :]) if full else link
    found = ORIGIN.match(base)
    if not found:
        return ""
    origin, path = found.group(), PATH.match(base, found.end()).group()
    if not link:
        return base
    if link.startswith("//"):
        return absolute("", base.split(":", 1)[0] + ":" + link)
    if link[0] == "#":
        return base.split("#", 1)[0] + link
    if link[0] == "?":
        return origin + path + link
    return _place(origin, link if link[0] == "/" else path[: path.rfind("/") + 1] + link if path else "/" + link)


def _clean(parts: list[str]) -> str:
    text = "".join(parts)
    for blank in BLANKS:
        text = text.replace(blank, " ")
    return (MANY_SPACES.sub(" ", text) if "  " in text else text).strip(" ")


def links_of(html: str, page_url: str) -> list[tuple[str, str]]:
    """(target, anchor) of each anchor; target is '' where it is not usable. The first base counts."""
    found, base, text = [], None, None
    for kind, name, value in tokens(html):
        if kind == "text":
            if text is not None:
                text.append(unescape(value))
        elif name == "a":
            text = None
            if kind == "open" and (href := attribute(value, "href")) is not None:
                text = []
                found.append((href, text))
        elif name == "base":
            if kind == "open" and base is None:
                base = attribute(value, "href") or None
        elif text is not None and name in BLOCKS:
            text.append(" ")
    against = (absolute(page_url, base) if base else "") or page_url
    return [(absolute(against, href), _clean(parts)) for href, parts in found]


def text_of(html: str) -> str:
    """Text as a reader sees it; blocks and line breaks are set apart by a blank."""
    parts = []
    for kind, name, value in tokens(html):
        if kind == "text":
            parts.append(unescape(value))
        elif name in BLOCKS:
            parts.append(" ")
    return _clean(parts)


# Attributes that hold a URL, by tag; any tag may have a background.
REPLAY_ATTRIBUTES = {
    "frame": ("src",),
    "meta": ("url",),
    "link": ("href",),
    "script": ("src",),
    "img": ("src",),
    "input": ("src",),
    "a": ("href",),
    "area": ("href",),
    "object": ("codebase", "cdata"),
    "applet": ("codebase", "archive"),
    "embed": ("src",),
    "iframe": ("src",),
}
ANY_TAG_ATTRIBUTE = "background"
UNTOUCHED = ("mailto:", "javascript:")

REPLAY_NAME = re.compile("[a-zA-Z][a-zA-Z0-9]*")
CSS_URL = re.compile(r"(url\(\s*)([\"']?)([^\"'()\s]+)(\2\s*\))", re.IGNORECASE)
CSS_IMPORT = re.compile(r"(@import\s+)([\"'])([^\"']+)(\2)", re.IGNORECASE)
BASE_HREF = re.compile(r"\bhref\s*=\s*[\"']?([^\s\"'>]+)", re.IGNORECASE)


def declared_base(html: str) -> str | None:
    """The address of the first base element that has one, as written."""
    tags, at = Tags(html), 0
    while found := tags.next(at):
        at = found.end()
        if (found.group(2) or "").lower() == "base" and not found.group(1) and (href := BASE_HREF.search(found.group(3))):
            return href.group(1)
    return None


def replay_copy(html: str, page_url: str, prefix: str) -> str:
    """The page with its links led through `prefix` (server, archive and time); all else is kept."""
    declared = declared_base(html)
    base = (absolute(page_url, declared) if declared else "") or page_url
    css_base = base.replace("&amp;", "&")

    def replayed(link: str, against: str) -> str:
        if link.strip().lower().startswith(UNTOUCHED) or link.startswith(prefix):
            return link
        url = absolute(against, link)
        return prefix + url if url else link

    def attributes_of(name, attributes):
        wanted = REPLAY_ATTRIBUTES.get(name.lower(), ())
        if not wanted and ANY_TAG_ATTRIBUTE not in attributes.lower():
            return attributes

        def rewritten(pair):
            key, equals, value = pair.groups()
            if not value or (key.lower() not in wanted and key.lower() != ANY_TAG_ATTRIBUTE):
                return pair.group()
            quote = value[0] if value[0] in "\"'" else ""
            link = value[1:-1] if quote else value
            return f"{key}{equals}{quote}{replayed(link, base)}{quote}" if link else pair.group()

        return ATTRIBUTE.sub(rewritten, attributes)

    def style(found):
        before, quote, link, after = found.groups()
        return f"{before}{quote}{replayed(link, css_base)}{after}"

    parts, at, tags = [], 0, Tags(html, comments=False)
    while found := tags.next(at):
        slash, name, attributes = found.groups()
        if name is None or slash or not REPLAY_NAME.fullmatch(name) or not attributes[:1].isspace():
            parts.append(html[at : found.end()])
        else:
            parts.append(html[at : found.start(3)] + attributes_of(name, attributes) + ">")
        at = found.end()
    return CSS_IMPORT.sub(style, CSS_URL.sub(style, "".join([*parts, html[at:]])))
