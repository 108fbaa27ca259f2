"""``{{tag}}`` parameters of native queries.

For Spark SQL every tag becomes a named parameter marker whose value travels
apart from the text, so no value can change the query. ``render_terms`` writes
values into SPARQL text instead, for text that is sent elsewhere.
"""

import logging
import re
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from linkframe.functions.literals import iri_ref, iri_shaped, string_literal

log = logging.getLogger(__name__)

_TAG = re.compile(r"\{\{\s*([^{}\s](?:[^{}]*[^{}\s])?)\s*\}\}")


class Value:
    """A parameter value: the plain values in it, which render themselves in SPARQL."""

    def plain(self):
        raise NotImplementedError

    def sparql(self):
        return ", ".join(map(_sparql_text, self.plain())) or None


@dataclass(frozen=True)
class Scalar(Value):
    value: object

    def plain(self):
        return [] if self.value is None else [self.value]


@dataclass(frozen=True)
class Date(Scalar):
    """A date as it was entered."""

    value: str


@dataclass(frozen=True)
class TemporalUnit(Scalar):
    """The name of a unit of time."""


@dataclass(frozen=True)
class DateRange(Value):
    start: str
    end: str

    def plain(self):
        return [f"{self.start}/{self.end}"]


@dataclass(frozen=True)
class Several(Value):
    values: tuple

    def plain(self):
        return [p for v in self.values for p in as_value(v).plain()]


@dataclass(frozen=True)
class Unsupported(Value):
    """A value no query text can hold: a field filter, card, snippet or table."""

    what: str = ""

    def plain(self):
        log.warning("parameter values of this kind are not supported: %s", self.what)
        return []


def as_value(given):
    """Any given value in its class; a mapping with ``value`` stands for that."""
    if isinstance(given, Value):
        return given
    if isinstance(given, dict) and "value" in given:
        return as_value(given["value"])
    return Several(tuple(given)) if isinstance(given, (list, tuple)) else Scalar(given)


#: By type, the first that fits; a bool is an int as well.
_SPARQL_TEXT = (
    (bool, lambda v: str(v).lower()),
    ((int, float, Decimal), str),
)


def _sparql_text(value):
    for kinds, text in _SPARQL_TEXT:
        if isinstance(value, kinds):
            return text(value)
    return iri_ref(value) if iri_shaped(value) else string_literal(value)


def parameter_values(template_tags, parameters):
    """Tag name -> value, from tag declarations and a list of given parameters."""
    given = {}
    for parameter in parameters or []:
        target = parameter.get("target")
        if target and target[-1][0] == "template-tag":
            given[target[-1][1]] = parameter.get("value")
    return {name: given.get(name, tag.get("default")) for name, tag in (template_tags or {}).items()}


def _replace_tags(text, render):
    """One pass over the text: a value that looks like a tag stays a value."""
    left = []

    def one(match):
        rendered = render(match[1])
        if rendered is None:
            left.append(match[1])
            return match[0]
        return rendered

    result = _TAG.sub(one, text)
    if left:
        log.warning("placeholders without a value remain: %s", sorted(set(left)))
    return result


def render_terms(text, values):
    """Write values into SPARQL text; a tag without a value keeps its placeholder."""
    return _replace_tags(text, lambda tag: as_value(values.get(tag)).sparql())


def bind_parameters(text, values):
    """``(text with :markers, {marker: value})`` for ``spark.sql(text, args)``."""
    args = {}

    def render(tag):
        items = as_value(values.get(tag)).plain()
        if not items:
            return None
        name = re.sub(r"\W", lambda m: f"_{ord(m[0]):x}_", tag)
        markers = [f"p_{name}_{i}" for i in range(len(items))]
        args.update(zip(markers, map(_sql_value, items)))
        return ", ".join(f":{m}" for m in markers)

    return _replace_tags(text, render), args


def _sql_value(value):
    known = (str, bool, int, float, Decimal, date, datetime)
    return value if isinstance(value, known) else str(value)
