"""Small HTML helper used inside Arrow functions: a light tree and the few lookups the boards need."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

# Elements without content, and elements whose text is not shown.
VOID_TAGS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)
HIDDEN_TAGS = frozenset(["script", "style", "template"])
# Words that mark a description block, and its least length.
DESCRIPTION_WORDS = ("Kami membuka lowongan", "Tanggung Jawab", "Kualifikasi", "Persyaratan")
DESCRIPTION_MIN_CHARS = 100


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """Descendant elements in document order."""
        pending = [iter(self.children)]
        while pending:
            node = next(pending[-1], None)
            if node is None:
                pending.pop()
            elif isinstance(node, Element):
                yield node
                pending.append(iter(node.children))

    def texts(self) -> Iterator[str]:
        """Visible text nodes in document order."""
        pending = [iter(self.children)]
        while pending:
            node = next(pending[-1], None)
            if node is None:
                pending.pop()
            elif isinstance(node, str):
                yield node
            elif node.tag not in HIDDEN_TAGS:
                pending.append(iter(node.children))

    def text(self, glue: str) -> str | None:
        return glue.join(filter(None, (t.strip() for t in self.texts()))) or None

    def ancestors(self) -> Iterator[Element]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def attr(self, name: str) -> str | None:
        return self.attrs.get(name, "").strip() or None


class _Builder(HTMLParser):
    """Builds the tree: an end tag closes up to its start tag, or nothing if that is not open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", {}, None)
        self.open_tags: dict[str, int] = {}
        self.buffer: list[str] = []

    def flush(self, *_: str) -> None:
        if self.buffer:
            self.here.children.append("".join(self.buffer))
            self.buffer.clear()

    handle_comment = handle_decl = unknown_decl = handle_pi = flush

    def handle_data(self, data: str) -> None:
        self.buffer.append(data)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.flush()
        node = Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.children.append(node)
        if tag not in VOID_TAGS:
            self.here = node
            self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        if not self.open_tags.get(tag):
            return
        while True:
            closed = self.here
            self.here = closed.parent or self.root
            self.open_tags[closed.tag] -= 1
            if closed.tag == tag:
                return


# One well-formed piece of markup. Most pages consist of nothing else and are then read piece by
# piece, several times faster than by the tolerant parser, which takes every other page.
_NAME = r"[a-zA-Z][a-zA-Z0-9:_-]*+"
_ATTR = r"""\s++([a-zA-Z_:@][\w:.@-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'=<>`/]++)(?!/)))?+"""
_ATTRS = re.compile(_ATTR)
_PIECE = re.compile(
    rf"""(?P<text>[^<]++)|<(?P<start>{_NAME})(?P<attrs>(?:{re.sub(r"[(](?![?])", "(?:", _ATTR)})*+)\s*+(?P<own>/?)>"""
    rf"""|</(?P<end>{_NAME})\s*+>|<!--(?!-?>)(?:(?!--).)*+-->|<!doctype\b[^>]*+>""",
    re.S | re.I,
)
_RAW = {tag: re.compile(rf"(.*?)</{tag}\s*+>", re.S | re.I) for tag in ("script", "style")}


def _pieces(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of well-formed markup; ValueError at anything else."""
    at = 0
    while at < len(html):
        piece = _PIECE.match(html, at)
        if piece is None:
            raise ValueError(at)
        at = piece.end()
        kind = piece.lastgroup
        if kind == "text":
            yield "text", piece["text"], ""
        elif kind == "end":
            yield "end", piece["end"].lower(), ""
        elif kind == "own":
            name = piece["start"].lower()
            yield ("own" if piece["own"] else "start"), name, piece["attrs"]
            if name in _RAW and not piece["own"]:
                raw = _RAW[name].match(html, at)
                if raw is None:
                    raise ValueError(at)
                at = raw.end()
                yield "raw", raw[1], ""
                yield "end", name, ""
        else:
            yield "other", "", ""


def parse(html: str) -> Element:
    builder = _Builder()
    try:
        for kind, name, attrs in _pieces(html):
            if kind == "text":
                builder.handle_data(unescape(name))
            elif kind == "raw":
                builder.handle_data(name)
            elif kind == "end":
                builder.handle_endtag(name)
            elif kind == "other":
                builder.flush()
            else:
                pairs = [(n.lower(), unescape(a or b or c)) for n, a, b, c in _ATTRS.findall(attrs)] if attrs else []
                (builder.handle_starttag if kind == "start" else builder.handle_startendtag)(name, pairs)
    except ValueError:
        return parse_any(html)
    builder.flush()
    return builder.root


def parse_any(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder.flush()
    return builder.root


def visible_texts(html: str) -> list[str]:
    """Visible text nodes of a page; without a tree where its markup needs none."""
    if "<" not in html:
        return [unescape(html)]
    try:
        # Templates hide all that is below them, which takes the tree to know.
        if "<template" not in html.lower():
            return [unescape(name) for kind, name, _ in _pieces(html) if kind == "text"]
    except ValueError:
        pass
    return list(parse(html).texts())


# Element tests ---------------------------------------------------------------

Test = Callable[[Element], bool]


def tag(name: str) -> Test:
    return lambda e: e.tag == name


def cls(name: str) -> Test:
    return lambda e: name in e.attrs.get("class", "").split()


def has(attr: str) -> Test:
    return lambda e: attr in e.attrs


def contains(attr: str, part: str) -> Test:
    return lambda e: part in e.attrs.get(attr, "")


def ends(attr: str, part: str) -> Test:
    return lambda e: e.attrs.get(attr, "").endswith(part)


def every(*tests: Test) -> Test:
    return lambda e: all(t(e) for t in tests)


def within(outer: Test, inner: Test) -> Test:
    return lambda e: inner(e) and any(outer(a) for a in e.ancestors())


def child_of(outer: Test, inner: Test) -> Test:
    return lambda e: inner(e) and e.parent is not None and outer(e.parent)


def first(node: Element, *tests: Test) -> Element | None:
    """First descendant that passes the earliest test any descendant passes."""
    return next((e for t in tests for e in node.walk() if t(e)), None)


# Page readers ----------------------------------------------------------------


def lines(html: str) -> list[str]:
    split = (line.strip() for text in visible_texts(html) for line in text.splitlines())
    return [line for line in split if line]


def plain_text(html: str) -> str | None:
    return "\n".join(" ".join(line.split()) for line in lines(html)) or None


def keyword_block(html: str) -> str | None:
    return described(parse(html))


def described(root: Element) -> str | None:
    """Description block of a rendered detail page, found by its keywords."""
    main = first(root, tag("main"), tag("article"))
    if main is None:
        return None
    pieces: list[str] = []
    blocks: list[tuple[int, int]] = []
    # A keyword lies inside one piece, and a block is a stretch of the pieces: none is put together before one is found.
    for block, start, end in _stretches(main, pieces):
        if block.tag in ("div", "section"):
            blocks.append((start, end))
    sizes, marked = [0], [0]
    for piece in pieces:
        sizes.append(sizes[-1] + len(piece))
        marked.append(marked[-1] + any(word in piece for word in DESCRIPTION_WORDS))
    # Blocks end in another order than they begin in; of those that begin together the outer one comes first.
    for start, end in sorted(blocks, key=lambda b: (b[0], -b[1])):
        if sizes[end] - sizes[start] + end - start - 1 > DESCRIPTION_MIN_CHARS and marked[end] > marked[start]:
            return plain_text("\n".join(pieces[start:end]))
    return None


def _stretches(root: Element, pieces: list[str]) -> Iterator[tuple[Element, int, int]]:
    """Every visible element below with its stretch of ``pieces``, the visible texts in order, which are gathered on the way."""
    pending = [(root, iter(root.children), 0)]
    while pending:
        element, children, start = pending[-1]
        node = next(children, None)
        if node is None:
            pending.pop()
            if element is not root:
                yield element, start, len(pieces)
        elif isinstance(node, str):
            if text := node.strip():
                pieces.append(text)
        elif node.tag not in HIDDEN_TAGS:
            pending.append((node, iter(node.children), len(pieces)))


def meta_description(html: str) -> str | None:
    if "<meta" not in html.lower():
        return None
    meta = first(parse(html), lambda e: e.tag == "meta" and e.attrs.get("name") == "description")
    return None if meta is None else meta.attr("content")
