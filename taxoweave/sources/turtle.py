"""Turtle statements from numbered lines.

A file's lines come sorted; prefixes hold for the lines after them, so a file is read in one
stream, a statement at a time, and memory is bounded by its longest statement."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
#: Characters of a statement beyond which it is given up as broken.
LONGEST = 1 << 24

# The tokens of the Turtle grammar.
TOKEN = re.compile(
    r"""(?P<space>[ \t\r\n]+|\#[^\n]*)
|(?P<iri><(?:[^\x00-\x20<>"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*>)
|(?P<long>\"{3}(?:\"{0,2}(?:[^"\\]|\\.))*\"{3}|'{3}(?:'{0,2}(?:[^'\\]|\\.))*'{3})
|(?P<string>"(?!"")(?:[^"\\\n\r]|\\.)*"|'(?!'')(?:[^'\\\n\r]|\\.)*')
|(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
|(?P<type>\^\^)
|(?P<blank>_:\w(?:[\w.\-\u00B7]*[\w\-\u00B7])?)
|(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+)(?![\w:]))
|(?P<name>(?:[^\W\d_](?:[\w.\-\u00B7]*[\w\-\u00B7])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])(?:(?:[\w:.\-\u00B7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%])*(?:[\w:\-\u00B7]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?\#@%]))?)?)
|(?P<word>[A-Za-z]+)
|(?P<mark>[.;,\[\]()])""",
    re.VERBOSE | re.DOTALL
)
# Escapes of one character.
ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
ESCAPED = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)
OPEN_LONG = re.compile(r'"""|\'\'\'')

SCHEMA = "s string, p string, o string, o_kind string, o_datatype string, o_lang string, source_file string, line long, error string"
NAMES = ["s", "p", "o", "o_kind", "o_datatype", "o_lang", "source_file", "line", "error"]


class Broken(Exception):
    """A statement that is none."""


def unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        if m[3]:
            if m[3] not in ESCAPES:
                raise Broken(f"unknown escape \\{m[3]}")
            return ESCAPES[m[3]]
        code = int(m[1] or m[2], 16)
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            raise Broken(f"no character {m[0]}")
        return chr(code)

    return ESCAPED.sub(one, text) if "\\" in text else text


def blank_scope(file: str) -> str:
    """Blank nodes of different files are different: their labels start with this."""
    return f"_:f{zlib.crc32(file.encode()):08x}_"


def resolved(base: str, iri: str) -> str:
    """An IRI relative to the base; Turtle's `<>` and `<#x>` keep the base as it is."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:", iri) or not base:
        return iri
    if iri.startswith("#") or not iri:
        return base.split("#")[0] + iri
    from urllib.parse import urljoin

    return urljoin(base, iri)


class Reader:
    """Statements of one file, fed line by line."""

    def __init__(self, file: str):
        self.file, self.prefixes, self.base, self.scope = file, {}, "", blank_scope(file)
        self.tokens, self.first, self.bad, self.made = [], None, None, 0
        self.open: list[str] = []  # lines of a long string that goes on

    def feed(self, number: int, line: str, last: bool = False) -> Iterator[tuple]:
        """Rows of `SCHEMA` of the statements that end with this line."""
        text, at = line + ("" if last else "\n"), 0
        if self.open:
            self.open.append(text)
            if self.open[0][:3] not in text and not last and self.held <= LONGEST:
                self.held += len(text)
                return
            text, self.open = "".join(self.open), []
        while at < len(text):
            m = TOKEN.match(text, at)
            if m is None and not last and OPEN_LONG.match(text, at):
                self.first = number if self.first is None else self.first
                if len(text) - at <= LONGEST:
                    self.open, self.held = [text[at:]], len(text) - at
                    return
            if m is None:
                self.first = number if self.first is None else self.first
                self.bad = self.bad or f"unexpected {text[at:at + 20]!r}"
                at += 1
                continue
            at = m.end()
            if m.lastgroup == "space":
                continue
            self.first = number if self.first is None else self.first
            self.tokens.append((m.lastgroup, m[0]))
            ends_line = not text[at:].split("#")[0].strip()
            if m[0] == "." and (not self.bad or ends_line) or self._directive():
                yield from self._statement()
        if sum(len(t) for _, t in self.tokens) > LONGEST:
            self.bad = self.bad or "statement too long"
            yield from self._statement()
        if last and (self.tokens or self.bad):
            self.bad = self.bad or "no end of statement"
            yield from self._statement()

    def _directive(self) -> bool:
        """Whether the tokens are a whole SPARQL-style PREFIX or BASE, which has no dot."""
        first = self.tokens[0]
        if first[0] != "word" or self.tokens[-1][0] != "iri":
            return False
        return (first[1].lower(), len(self.tokens)) in (("prefix", 3), ("base", 2))

    def _statement(self) -> Iterator[tuple]:
        tokens, bad, first = self.tokens, self.bad, self.first
        self.tokens, self.bad, self.first, triples = [], None, None, []
        if not bad:
            try:
                triples = self._parsed(tokens)
            except (Broken, IndexError) as e:
                bad = str(e) if isinstance(e, Broken) else "statement ends too early"
        if bad:
            yield (None, None, None, None, None, None, self.file, first, f"{bad}: {' '.join(t for _, t in tokens)[:200]}")
            return
        for s, p, o in triples:
            yield (s[0], p[0], *o, self.file, first, None)

    def _parsed(self, tokens: list[tuple[str, str]]) -> list[tuple]:
        kind, text = tokens[0]
        if kind == "at" and text in ("@prefix", "@base") or kind == "word" and text.lower() in ("prefix", "base"):
            self._declare(text.lower().strip("@"), tokens[1:-1] if kind == "at" else tokens[1:])
            return []
        out: list[tuple] = []
        at = 0
        if tokens[0][1] == "[" and tokens[1][1] != "]":
            subject, at = self._node(tokens, 0, out)
            if tokens[at][1] != ".":
                at = self._properties(tokens, at, subject, out)
        else:
            subject, at = self._node(tokens, 0, out)
            if subject[1] == "literal":
                raise Broken("a literal is no subject")
            at = self._properties(tokens, at, subject, out)
        if tokens[at][1] != "." or at != len(tokens) - 1:
            raise Broken(f"unexpected {tokens[at][1]!r}")
        return out

    def _declare(self, what: str, tokens: list[tuple[str, str]]) -> None:
        if not tokens or tokens[-1][0] != "iri" or len(tokens) != (2 if what == "prefix" else 1):
            raise Broken(f"no {what}")
        iri = resolved(self.base, unescaped(tokens[-1][1][1:-1]))
        if what == "base":
            self.base = iri
        elif tokens[0][0] == "name" and tokens[0][1].endswith(":"):
            self.prefixes[tokens[0][1][:-1]] = iri
        else:
            raise Broken("no prefix")

    def _properties(self, tokens: list, at: int, subject: tuple, out: list) -> int:
        while True:
            if tokens[at] == ("word", "a"):
                verb, at = (RDF + "type", "uri", None, None), at + 1
            else:
                verb, at = self._node(tokens, at, out)
            if verb[1] != "uri":
                raise Broken("a predicate is a URI")
            while True:
                value, at = self._node(tokens, at, out)
                out.append((subject, verb, value))
                if tokens[at][1] != ",":
                    break
                at += 1
            if tokens[at][1] != ";":
                return at
            while tokens[at][1] == ";":
                at += 1
            if tokens[at][1] in (".", "]"):
                return at

    def _new(self) -> tuple:
        self.made += 1
        return (f"{self.scope}-{self.made}", "blank", None, None)

    def _node(self, tokens: list, at: int, out: list) -> tuple[tuple, int]:
        """((text, kind, datatype, language), place after it)."""
        kind, text = tokens[at]
        at += 1
        if kind == "iri":
            return (resolved(self.base, unescaped(text[1:-1])), "uri", None, None), at
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix not in self.prefixes:
                raise Broken(f"unknown prefix {prefix!r}")
            return (self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local), "uri", None, None), at
        if kind == "blank":
            return (self.scope + text[2:], "blank", None, None), at
        if kind in ("string", "long"):
            body = unescaped(text[3:-3] if kind == "long" else text[1:-1])
            if tokens[at][0] == "at":
                return (body, "literal", None, tokens[at][1][1:]), at + 1
            if tokens[at][0] == "type":
                datatype, at = self._node(tokens, at + 1, out)
                if datatype[1] != "uri":
                    raise Broken("a datatype is a URI")
                return (body, "literal", datatype[0], None), at
            return (body, "literal", None, None), at
        if kind == "number":
            name = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return (text, "literal", XSD + name, None), at
        if kind == "word" and text in ("true", "false"):
            return (text, "literal", XSD + "boolean", None), at
        if text == "[":
            node = self._new()
            if tokens[at][1] != "]":
                at = self._properties(tokens, at, node, out)
            if tokens[at][1] != "]":
                raise Broken("no ]")
            return node, at + 1
        if text == "(":
            items = []
            while tokens[at][1] != ")":
                item, at = self._node(tokens, at, out)
                items.append(item)
            rest = (RDF + "nil", "uri", None, None)
            for item in reversed(items):
                node = self._new()
                out.append((node, (RDF + "first", "uri", None, None), item))
                out.append((node, (RDF + "rest", "uri", None, None), rest))
                rest = node
            return rest, at + 1
        raise Broken(f"unexpected {text!r}")


def statements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `SCHEMA` from (file, line_no, line), whole files in order of lines."""
    reader, last = None, 0
    for batch in batches:
        rows: list[tuple] = []
        for file, number, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if reader is None or reader.file != file:
                if reader is not None:
                    rows += reader.feed(last, "", last=True)
                reader = Reader(file)
            rows += reader.feed(number + 1, line.removeprefix("\ufeff") if number == 0 else line)
            last = number + 1
        yield _batch(rows)
    if reader is not None:
        yield _batch(list(reader.feed(last, "", last=True)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
    kinds = [pa.int64() if n == "line" else pa.string() for n in NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


LOCAL = re.compile(r"[A-Za-z_][A-Za-z0-9_-]*")
ODD_IRI = re.compile(r'[\x00-\x20<>"{}|^`\\]')


def written_iri(iri: str, prefixes: dict[str, str]) -> str:
    """Prefixed where that is plain, else in brackets with characters that don't belong there escaped."""
    for name, full in prefixes.items():
        if iri.startswith(full) and LOCAL.fullmatch(iri, len(full)):
            return f"{name}:{iri[len(full):]}"
    return "<" + ODD_IRI.sub(lambda m: f"\\u{ord(m[0]):04X}", iri) + ">"


QUOTED = str.maketrans({"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"})


def turtle_text(batches: Iterator[pa.RecordBatch], prefixes: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Lines of one Turtle file from sorted (s, p, o, o_kind, o_datatype, o_lang); the statements of
    a subject follow each other."""
    before, waiting = None, ""
    out = [f"@prefix {name}: <{full}> ." for name, full in prefixes.items()]
    node = lambda x: x if x.startswith("_:") else written_iri(x, prefixes)
    for batch in batches:
        for s, p, o, kind, datatype, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            value = node(o) if kind in ("uri", "blank") else '"' + o.translate(QUOTED) + '"' + (
                f"@{lang}" if lang else f"^^{written_iri(datatype, prefixes)}" if datatype else ""
            )
            pair = f"{'a' if p == RDF + 'type' else node(p)} {value}"
            if before is not None:
                out.append(waiting + (" ;" if s == before else " ."))
            waiting = f"    {pair}" if s == before else f"{node(s)} {pair}"
            before = s
        yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        out = []
    out += [] if before is None else [waiting + " ."]
    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
