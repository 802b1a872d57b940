"""Secret scan: three fixed patterns, and literals assigned to names that sound secret.

Method of the second part: lex source and configuration syntax into name-literal pairs (assignments, keyed entries,
markup elements, command flags), carry constants through names and concatenations, and score each literal by the
sensitive words in the names it reaches. Lines are lexed only in texts that hold such a word.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from postlake.llm.common import table

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more starts where any run does
KINDS = ("assign", "access", "hex", "literal")

#: Words of names and how strongly each says that the value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "secrets": 0.8, "token": 0.8, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 0.9, "bearer": 0.7, "auth": 0.5, "signature": 0.4, "salt": 0.4,
}
#: Pairs of neighbouring words of a name that count as one sensitive word.
PAIRS = {("api", "key"), ("private", "key"), ("access", "key"), ("secret", "key"), ("auth", "key"), ("encryption", "key"), ("signing", "key"), ("client", "secret")}
#: Words that turn a sensitive name into a plain one: the name of a field, a limit, a place.
HARMLESS = {"name", "field", "label", "length", "len", "limit", "count", "max", "min", "type", "url", "uri", "path", "file", "env", "prompt", "hint", "policy", "expiry", "ttl", "id"}
PLACEHOLDER = re.compile(r"(?i)change.?me|example|placeholder|dummy|your[_-]|todo|redacted|none|null|true|false|undefined|x{4,}|\*{3,}|\.{3,}|<[^>]*>|\$\{|\{\{|%\(|process\.env|os\.environ|getenv")
LEAST_SCORE = 0.55
LEAST_CHARS = 8

#: Every text with a name that can reach LEAST_SCORE: its words, and pairs with whatever ``words_of`` splits at between them.
MAYBE = re.compile("|".join([w for w, x in SENSITIVE.items() if x >= LEAST_SCORE] + [f"{a}[^A-Za-z0-9]*{b}" for a, b in sorted(PAIRS)]), re.IGNORECASE)
#: What a token begins with. No alternative goes back over a stretch that a later token could scan again: names, tags and flags are
#: possessive, and where a comment or string has no end is looked up once (``Lexer``).
LEX = re.compile(
    r"""(?P<open>/\*|<!--|(?:(?<![\w$])[bBrRuUfF]{1,2})?(?P<quote>\"{3}|'{3}|["'`]))
    |(?P<element><(?P<tag>[A-Za-z_][\w.:-]*+)[^<>\n]*+>(?P<inner>[^<>\n]++)</(?P=tag)>)
    |(?P<flag>(?<![\w-])--(?P<flagname>[A-Za-z][\w-]*+)(?:=|\x20++)(?P<flagvalue>[^\s"'-][^\s"']*+))
    |(?P<name>[A-Za-z_$][\w$]*+(?:(?:\.|->|::|-)[A-Za-z_$][\w$]*+)*+)
    |(?P<op>:=|=>|==|!=|<=|>=|\+=|[=:+])
    |(?P<line>\n)
    |(?P<other>[^\s])""",
    re.VERBOSE,
)
CLOSES = {"/*": "*/", "<!--": "-->"}
#: Up to the end of a string on one line, or of one over several.
ENDS = {'"': re.compile(r'(?:\\.|[^"\\\n])*+"', re.DOTALL), "'": re.compile(r"(?:\\.|[^'\\\n])*+'", re.DOTALL), "`": re.compile(r"(?:\\.|[^`\\])*+`", re.DOTALL)}
STOPS = {'"': re.compile(r'(?:\\.|[^"\\\n])*+', re.DOTALL), "'": re.compile(r"(?:\\.|[^'\\\n])*+", re.DOTALL), "`": re.compile(r"(?:\\.|[^`\\])*+", re.DOTALL)}
BARE = re.compile(r"[^\s\"'`,;#<>(){}\[\]]+")
#: Without a digit a bare value has to look less like a word.
UNWORDLY = re.compile(r"[-_+/.@!%^~]|[a-z][A-Z]")
BLOCK = re.compile(r"[|>][-+0-9]*[^\S\n]*\n")


@dataclass(frozen=True)
class Literal:
    start: int
    end: int
    text: str


def words_of(name: str) -> list[str]:
    parts = re.split(r"[^A-Za-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name))
    return [p.lower() for p in parts if p]


def sensitivity(name: str) -> float:
    """0 to 1 by the words of the name; a harmless last word takes most of it away."""
    words = words_of(name)
    found = max([SENSITIVE.get(w, 0.0) for w in words] + [1.0 for pair in zip(words, words[1:]) if pair in PAIRS] + [0.0])
    return found * (0.3 if words and words[-1] in HARMLESS else 1.0)


def strength(text: str) -> float:
    """0 to 1: does the value look like a secret. Length, entropy, kinds of characters; placeholders get 0."""
    if len(text) < LEAST_CHARS or PLACEHOLDER.search(text) or text.isspace():
        return 0.0
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9\\s]"))
    spaces = text.count(" ") / n
    return max(0.0, min(1.0, entropy / 3.5) * (0.7 + 0.1 * kinds) - 3 * spaces)


@dataclass(frozen=True, slots=True)
class Token:
    """A piece of source; ``inner`` is what a string, element or flag holds, ``name`` the tag or flag."""

    kind: str
    start: int
    end: int
    text: str
    inner: tuple[int, int] = (0, 0)
    name: str = ""


class Lexer:
    """Tokens of a text in one pass, comments left out. An opening mark without an end is a sign like others."""

    def __init__(self, text: str):
        self.text = text
        # From where to where it is known that a mark finds no end: a search that failed is not done again further on.
        self.dead: dict[str, tuple[int, int]] = {}

    def close(self, mark: str, start: int) -> int | None:
        """End of the comment or string that opened before ``start``."""
        low, high = self.dead.get(mark, (0, -1))
        if low <= start <= high:
            return None
        if mark in ENDS:
            if m := ENDS[mark].match(self.text, start):
                return m.end()
            # Escapes fall in the same places from any quote on this stretch, so none of them closes either.
            self.dead[mark] = (start, STOPS[mark].match(self.text, start).end())
            return None
        end = self.text.find(CLOSES.get(mark, mark), start)
        if end < 0:
            self.dead[mark] = (start, len(self.text))
            return None
        return end + len(CLOSES.get(mark, mark))

    def tokens(self) -> list[Token]:
        out, at, text = [], 0, self.text
        while m := LEX.search(text, at):
            kind, at = m.lastgroup, m.end()
            if kind in ("open", "quote"):
                mark = m.group("quote") or m.group("open")
                end = self.close(mark, m.end())
                if end is None and len(mark) == 3 and mark not in CLOSES:
                    mark, at = mark[0], m.end() - 2
                    end = self.close(mark, at)
                if end is None:
                    # The letters before a quote are a name then; the sign alone goes on.
                    sign = m.end() - len(m.group("quote") or m.group("open"))
                    if m.start() < sign:
                        out.append(Token("name", m.start(), sign, text[m.start() : sign]))
                    at = sign + 1
                    out.append(Token("other", sign, at, text[sign:at]))
                    continue
                if mark not in CLOSES:
                    out.append(Token("string", m.start(), end, text[m.start() : end], (at, end - len(mark))))
                at = end
            elif kind in ("element", "flag"):
                name, inner = ("tag", "inner") if kind == "element" else ("flagname", "flagvalue")
                out.append(Token(kind, m.start(), m.end(), m.group(), m.span(inner), m.group(name)))
            elif kind in ("tag", "inner", "flagname", "flagvalue"):
                raise AssertionError(kind)
            else:
                out.append(Token(kind, m.start(), m.end(), m.group()))
        return out


def assignments(text: str) -> Iterator[tuple[str, list[Literal | str | None]]]:
    """Name and value of every assignment; the value is a list of literals and names that are joined, None between elements of a list.

    Names are targets (also keys in brackets), keys, tags, flags, and functions called with a literal; an attribute that names a
    key gives that name to the value beside it. A value goes on over line ends around a plus, inside brackets and after a
    backslash; a block value takes the more indented lines below it.
    """
    tokens = Lexer(text).tokens()
    i, n, bare_end = 0, len(tokens), 0

    def kind(k: int) -> str:
        return tokens[k].kind if k < n else "end"

    def literal(k: int) -> Literal:
        start, end = tokens[k].inner
        return Literal(start, end, text[start:end])

    def sign(k: int, signs: str) -> bool:
        return kind(k) in ("op", "other") and tokens[k].text in signs

    def over(k: int, lines: bool) -> int:
        while (lines and kind(k) == "line") or (sign(k, "\\") and kind(k + 1) == "line"):
            k += 1 if kind(k) == "line" else 2
        return k

    def is_op(k: int) -> bool:
        return kind(k) == "op" and tokens[k].text in ("=", ":", ":=", "=>", "+=")

    def assigned(k: int) -> bool:
        return kind(k) in ("name", "string") and is_op(k + 1)

    def value_from(k: int) -> tuple[list[Literal | str | None], int]:
        value: list[Literal | str | None] = []
        depth, k = 0, over(k, False)
        while True:
            if sign(k, "(["):
                depth, k = depth + 1, over(k + 1, True)
                continue
            quoted = kind(k) == "string"
            if quoted or kind(k) == "name":
                value.append(literal(k) if quoted else tokens[k].text)
                k += 1
            elif not (depth and sign(k, ")]")):
                return value, k
            while depth and sign(j := over(k, True), ")]"):
                depth, k = depth - 1, j + 1
            after, plus = over(k, depth > 0), over(k, True)
            if sign(plus, "+"):
                k = over(plus + 1, True)
                # A line that begins with a plus may be one of a patch.
                if not depth and any(kind(x) == "line" for x in range(after, plus)) and assigned(k):
                    return value, k
            elif depth and sign(after, ","):
                value.append(None)
                k = over(after + 1, True)
            elif quoted and kind(after) == "string":
                k = after  # neighbouring strings are one
            else:
                return value, k

    def bare(k: int, op: Token) -> list[Literal]:
        """An unquoted value: with a digit, or set without a blank and no plain word. What lies inside an earlier one is part of that."""
        nonlocal bare_end
        if k >= n or kind(k) == "line" or tokens[k].start < bare_end:
            return []
        found = BARE.match(text, tokens[k].start)
        bare_end = found.end() if found else bare_end
        if not found or len(found.group()) < LEAST_CHARS:
            return []
        tight = op.text == "=" and op.end == tokens[k].start
        good = re.search("[0-9]", found.group()) or (tight and UNWORDLY.search(found.group()))
        return [Literal(found.start(), found.end(), found.group())] if good else []

    def block(k: int) -> list[Literal]:
        """The lines of a block value: those more indented than the line of its key."""
        head = BLOCK.match(text, tokens[k].start) if k < n else None
        if not head:
            return []
        indent = lambda line: len(line) - len(line.lstrip(" \t"))
        own = text[text.rfind("\n", 0, tokens[k].start) + 1 : tokens[k].start]
        out, at = [], head.end()
        while at < len(text):
            stop = text.find("\n", at)
            stop = len(text) if stop < 0 else stop
            line = text[at:stop]
            if line.strip():
                if indent(line) <= indent(own):
                    break
                low = at + indent(line)
                out.append(Literal(low, low + len(line.strip()), line.strip()))
            at = stop + 1
        return out

    while i < n:
        t = tokens[i]
        if t.kind in ("element", "flag"):
            yield t.name, [Literal(*t.inner, text[slice(*t.inner)])]
        elif assigned(i) or (t.kind == "string" and sign(i + 1, "]") and is_op(i + 2)):
            name, at = t.text if t.kind == "name" else literal(i).text, i + 1 if is_op(i + 1) else i + 2
            op, k = tokens[at], at + 1
            # A type between the name and its value: name: Type = value
            if op.text == ":" and kind(k) == "name" and kind(k + 1) == "op" and tokens[k + 1].text == "=":
                k += 2
            value, _ = value_from(k)
            if not any(isinstance(v, Literal) for v in value):
                value = bare(at + 1, op) or (block(at + 1) if op.text == ":" else []) or value
            if op.text == "+=":
                value = [name, *value]
            # key="password" value="…": the attribute beside it holds the value.
            if words_of(name)[-1:] in (["key"], ["name"], ["id"]) and len(value) == 1 and isinstance(value[0], Literal) and assigned(k + 1) and words_of(tokens[k + 1].text)[-1:] in (["value"], ["content"]):
                yield value[0].text, value_from(k + 3)[0]
            yield name, value
        elif t.kind == "name" and sign(i + 1, "(") and kind(i + 2) == "string" and sensitivity(t.text) >= LEAST_SCORE:
            yield t.text, value_from(i + 1)[0]
        i += 1


def reached(value: tuple) -> list[Literal]:
    """All literals of a value, through the values of its names, in order and each place once."""
    out: dict[tuple[int, int], Literal] = {}
    met: set[int] = set()
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, Literal):
            out.setdefault((x.start, x.end), x)
        elif id(x) not in met:
            met.add(id(x))
            todo += reversed(x)
    return list(out.values())


def assigned_literals(text: str) -> list[tuple[Literal, str, float]]:
    """Literals that reach a sensitive name, with that name and their score; constants are followed through names.

    An expression keeps all its literals, however many, each with its own place; elements of a list are scored one by one. A name
    that is added to again and again is scored once, with all it has got.
    """
    held: dict[str, tuple] = {}  # values as they were assigned: literals and other values, followed only from sensitive names
    growing: dict[str, tuple] = {}
    best: dict[tuple[int, int], tuple[Literal, str, float]] = {}

    def score(name: str, value: tuple) -> None:
        for element in value:
            parts = reached(element)
            worth = sensitivity(name) * strength("".join(p.text for p in parts))
            if worth >= LEAST_SCORE:
                for p in parts:
                    at = (p.start, p.end)
                    if p.end > p.start and (at not in best or best[at][2] < worth):
                        best[at] = (p, name, worth)

    for name, value in assignments(text):
        elements: list[list] = [[]]
        for v in value:
            if v is None:
                elements.append([])
            elif isinstance(v, Literal):
                elements[-1].append(v)
            elif held.get(v):
                elements[-1].append(held[v])
        elements = [x for x in elements if x]
        before, itself = held.get(name), name in value
        # Another name's value alone is that value, not one around it.
        alone = len(elements) == 1 and len(elements[0]) == 1 and not isinstance(elements[0][0], Literal)
        held[name] = elements[0][0] if alone else tuple(tuple(x) for x in elements)
        if held[name] is before or sensitivity(name) < LEAST_SCORE:
            continue
        grown = growing.pop(name, None)
        if itself:
            growing[name] = held[name]
            continue
        if grown is not None:
            score(name, grown)
        score(name, held[name])
    for name, value in growing.items():
        score(name, value)
    return sorted(best.values(), key=lambda x: x[0].start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, whole matches, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[tuple[str, float]]]:
    """Base spans, all spans, and (name, score) of the literals among them."""
    base = base_spans(text)
    literals = assigned_literals(text) if MAYBE.search(text) else []
    return base, sorted(base + [(p.start, 3, p.end) for p, _, _ in literals]), [(name, round(score, 4)) for _, name, score in literals]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus counts per kind, base_sha256, spans, and the names and scores of the literals.

    Spans are code points, end exclusive; an assignment's span is its whole match. Base spans always stay. NULL texts count as empty and
    have no spans (the digest of the empty text); NULL ids and repeated rows are rows like others; columns of
    the result's names are replaced; an empty table gives an empty table.
    """
    own = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string(), "n_literal": pa.int64(), "literal_names": pa.list_(pa.string()), "literal_scores": pa.list_(pa.float64())}
    kept = docs.drop(*own)
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(at).to_pylist():
                base, every, literals = scan_text(text or "")
                n = Counter(k for _, k, _ in every)
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                out.append((n[0], n[1], n[2], digest, written(every), n[3], [x for x, _ in literals], [s for _, s in literals]))
            columns = [list(c) for c in zip(*out)] or [[] for _ in own]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, own.values()))], [*batch.schema.names, *own])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    fields += ["n_assign long", "n_access long", "n_hex long", "base_sha256 string", "spans string", "n_literal long", "literal_names array<string>", "literal_scores array<double>"]
    return kept.mapInArrow(run, ", ".join(fields))


def op1_secret_scan(spark, sf_dir):
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal")


QUERIES = {"op1_secret_scan": op1_secret_scan}
SQL: dict[str, str] = {}
