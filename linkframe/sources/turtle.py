"""Turtle text of *schema documents* (SHACL shapes), bounded by a size cap.

A Turtle file cannot be split, so bulk data comes in as N-Triples instead (see
``ntriples.read_ntriples``), which Spark reads in parallel.
"""

import re
from typing import NamedTuple
from urllib.parse import urljoin

from linkframe import vocab as V
from linkframe.errors import SourceError


class Term(NamedTuple):
    kind: str
    value: str
    datatype: str = ""
    lang: str = ""


_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
      | (?P<iri><[^\x00-\x20<>"{}|^`]*>)
      | (?P<text>\"{3}(?:(?:\"{1,2})?(?:[^"\\]|\\.))*\"{3} | '{3}(?:(?:'{1,2})?(?:[^'\\]|\\.))*'{3}
                 | "(?:[^"\\\n]|\\.)*" | '(?:[^'\\\n]|\\.)*')
      | (?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
      | (?P<number>[+-]?(?:\d+\.?\d*[eE][+-]?\d+|\.\d+[eE][+-]?\d+|\d*\.\d+|\d+))
      | (?P<blank>_:[\w\-.]*[\w\-])
      | (?P<name>(?:[^\W\d_][\w\-.]*)?:(?:[\w:%\-]|\\.|\.(?=[\w:%\-\\.]))*)
      | (?P<word>[A-Za-z]+)
      | (?P<mark>\^\^|[.;,\[\]()])
    """,
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.DOTALL)
_CONTROL = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(text):
    def char(match):
        code = match[1]
        return chr(int(code[1:], 16)) if code[0] in "uU" and len(code) > 1 else _CONTROL.get(code, code)

    return _ESCAPE.sub(char, text)


def _tokens(text):
    at = 0
    while at < len(text):
        match = _TOKEN.match(text, at)
        if match is None:
            raise SourceError(f"Turtle: cannot read {text[at:at + 30]!r}", "query")
        at = match.end()
        if match.lastgroup != "skip":
            yield match.lastgroup, match[0]
    yield "end", ""


class _Reader:
    def __init__(self, text, base):
        self.tokens = list(_tokens(text))
        self.at = 0
        self.base = base or ""
        self.prefixes = {}
        self.blanks = 0
        self.out = []

    def peek(self):
        return self.tokens[self.at]

    def take(self, expected=None):
        kind, text = self.tokens[self.at]
        if expected is not None and text != expected:
            raise SourceError(f"Turtle: expected {expected!r}, found {text!r}", "query")
        self.at += 1
        return kind, text

    def document(self):
        while self.peek()[0] != "end":
            kind, text = self.peek()
            keyword = text.lstrip("@").lower()
            if kind in ("lang", "word") and keyword in ("prefix", "base"):
                self.directive(keyword, dotted=kind == "lang")
                continue
            anonymous = text == "["
            subject = self.node()
            if not (anonymous and self.peek()[1] == "."):
                self.properties(subject)
            self.take(".")
        return self.out

    def directive(self, keyword, dotted):
        self.take()
        prefix = self.take()[1] if keyword == "prefix" else None
        target = urljoin(self.base, self.take()[1][1:-1])
        if keyword == "prefix":
            self.prefixes[prefix[:-1]] = target
        else:
            self.base = target
        if dotted:
            self.take(".")

    def properties(self, subject):
        while True:
            predicate = self.node()
            while True:
                self.out.append((subject, predicate, self.node()))
                if self.peek()[1] != ",":
                    break
                self.take()
            while self.peek()[1] == ";":
                self.take()
                if self.peek()[1] not in (";", ".", "]"):
                    break
            else:
                return

    def node(self):
        kind, text = self.take()
        if kind == "iri":
            return Term(V.IRI, urljoin(self.base, _unescape(text[1:-1])))
        if kind == "name":
            prefix, local = text.split(":", 1)
            if prefix not in self.prefixes:
                raise SourceError(f"Turtle: unknown prefix {prefix!r}", "query")
            return Term(V.IRI, self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local))
        if kind == "blank":
            return Term(V.BNODE, text)
        if kind == "number":
            name = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return Term(V.LITERAL, text, V.XSD + name)
        if kind == "text":
            return self.literal(text)
        if kind == "word" and text == "a":
            return Term(V.IRI, V.RDF_TYPE)
        if kind == "word" and text in ("true", "false"):
            return Term(V.LITERAL, text, V.XSD + "boolean")
        if text == "[":
            node = self.fresh()
            if self.peek()[1] != "]":
                self.properties(node)
            self.take("]")
            return node
        if text == "(":
            return self.collection()
        raise SourceError(f"Turtle: unexpected {text!r}", "query")

    def literal(self, quoted):
        width = 3 if quoted[:3] in ('"""', "'''") else 1
        value = _unescape(quoted[width:-width])
        kind, text = self.peek()
        if kind == "lang":
            self.take()
            return Term(V.LITERAL, value, V.RDF_LANG_STRING, text[1:].lower())
        if text == "^^":
            self.take()
            return Term(V.LITERAL, value, self.node().value)
        return Term(V.LITERAL, value, V.XSD + "string")

    def collection(self):
        items = []
        while self.peek()[1] != ")":
            items.append(self.node())
        self.take(")")
        rest = Term(V.IRI, V.RDF + "nil")
        for item in reversed(items):
            node = self.fresh()
            self.out += [(node, Term(V.IRI, V.RDF + "first"), item), (node, Term(V.IRI, V.RDF + "rest"), rest)]
            rest = node
        return rest

    def fresh(self):
        self.blanks += 1
        return Term(V.BNODE, f"_:anon{self.blanks}")


def parse(text, base=""):
    """``[(s, p, o)]`` of a Turtle document, each a ``Term``."""
    return _Reader(text, base).document()
