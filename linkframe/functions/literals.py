"""SPARQL text rendering of single terms: escaping, quoting, IRI references."""

import re

from linkframe.naming import has_scheme

_STRING_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_NOT_IN_IRIREF = re.compile(r'[\x00-\x20<>"{}|^`\\]')
_IRI_SHAPE = re.compile(r"https?://|urn:")


def escape_string(value):
    return "".join(_STRING_ESCAPES.get(ch, ch) for ch in str(value))


def string_literal(value):
    return f'"{escape_string(value)}"'


def iri_ref(value):
    """``<iri>`` with every character the grammar forbids percent-encoded."""
    return "<" + _NOT_IN_IRIREF.sub(lambda m: "%%%02X" % ord(m[0]), str(value)) + ">"


def iri_shaped(value):
    """Narrow test for bare values: only http(s) and urn count, lower case."""
    return isinstance(value, str) and _IRI_SHAPE.match(value) is not None


__all__ = ["escape_string", "string_literal", "iri_ref", "iri_shaped", "has_scheme"]
