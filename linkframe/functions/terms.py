"""RDF terms as Spark columns.

A term is ``struct<kind, value, datatype, lang>``. None of the four fields of a
bound term is NULL (``''`` stands for "has none"), so two terms are the same
term exactly when the structs are equal; an unbound variable is a NULL struct.
All functions here are plain column expressions and stay inside codegen.
"""

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkframe import vocab as V

TERM_TYPE = "struct<kind:string,value:string,datatype:string,lang:string>"
XSD_STRING = V.XSD + "string"


def _term(kind, value, datatype, lang, bound):
    built = F.struct(
        kind.alias("kind"), value.alias("value"), datatype.alias("datatype"), lang.alias("lang")
    )
    return built if bound else F.when(value.isNotNull(), built)


def _col(x):
    return x if isinstance(x, Column) else F.lit(x)


# Makers of terms. ``bound=True`` states that the value is never NULL, which
# spares a test per row and lets the optimiser see through the struct.


def rebuilt(term):
    """The same term, known never to be NULL: a struct made here is none, whatever it is made of."""
    return F.struct(*(term[part].alias(part) for part in ("kind", "value", "datatype", "lang")))


def iri_term(value, bound=False):
    return _term(F.lit(V.IRI), _col(value), F.lit(""), F.lit(""), bound)


def literal_term(value, datatype=XSD_STRING, lang="", bound=False):
    return _term(F.lit(V.LITERAL), _col(value).cast("string"), _col(datatype), _col(lang), bound)


def lang_term(value, lang, bound=False):
    tag = F.coalesce(lang, F.lit(""))
    return _term(F.lit(V.LITERAL), value, F.lit(V.RDF_LANG_STRING), tag, bound)


def node_term(node, bound=False):
    """Term of a resource stored as plain text (``_:x`` marks a blank node)."""
    kind = F.when(node.startswith("_:"), F.lit(V.BNODE)).otherwise(F.lit(V.IRI))
    return _term(kind, node, F.lit(""), F.lit(""), bound)


def node_key(term):
    """Text of the resource a term denotes; NULL for literals."""
    return F.when(term["kind"] != V.LITERAL, term["value"])


def is_iri(term):
    return term["kind"] == V.IRI


def is_literal(term):
    return term["kind"] == V.LITERAL


def text(term):
    """STR(): lexical form or IRI; a blank node has none."""
    return F.when(term["kind"] != V.BNODE, term["value"])


def lang(term):
    """LANG(): '' for an untagged literal, NULL for anything that is no literal."""
    return F.when(is_literal(term), term["lang"])


def datatype(term):
    return F.when(is_literal(term), F.when(term["datatype"] == "", XSD_STRING).otherwise(term["datatype"]))


def number(term):
    """Numeric value of a literal with a numeric datatype, else NULL."""
    numeric = is_literal(term) & term["datatype"].isin(V.NUMERIC_DATATYPES)
    return F.when(numeric, term["value"].try_cast("double"))


def exact_integer(term):
    """Value of an integer literal of up to 38 digits, else NULL: a double holds only 53 bits."""
    written = is_integer(term) & term["value"].rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.when(written, F.trim(term["value"]).try_cast("decimal(38,0)"))


def is_integer(term):
    return is_literal(term) & term["datatype"].isin(V.INTEGER_DATATYPES)


def instant(term):
    dated = is_literal(term) & term["datatype"].isin(V.INSTANT_DATATYPES)
    return F.when(dated, term["value"].try_cast("timestamp"))


def boolean(term):
    flag = F.lower(term["value"])
    typed = is_literal(term) & (term["datatype"] == V.XSD + "boolean")
    return F.when(typed & flag.isin("true", "1"), F.lit(True)).when(
        typed & flag.isin("false", "0"), F.lit(False)
    )


def plain_string(term):
    """Text of an untagged string literal, else NULL."""
    plain = is_literal(term) & term["datatype"].isin(XSD_STRING, "") & (term["lang"] == "")
    return F.when(plain, term["value"])


def sort_key(term):
    """Total order of terms: blank nodes, IRIs, then literals by value."""
    rank = (
        F.when(term["kind"] == V.BNODE, 0).when(term["kind"] == V.IRI, 1).otherwise(2)
    )
    num = number(term)
    when = F.unix_micros(instant(term)).cast("double")
    family = F.when(num.isNotNull(), 0).when(when.isNotNull(), 1).otherwise(2)
    # Integers that are the same double are told apart by their exact value.
    key = F.struct(rank.alias("rank"), family.alias("family"), F.coalesce(num, when).alias("num"),
                   exact_integer(term).alias("exact"), term["value"].alias("text"),
                   term["datatype"].alias("datatype"), term["lang"].alias("lang"))
    return F.when(term.isNotNull(), key)


def equals(term, value, as_iri=False):
    """``term = value``: NULL when the comparison is a type error."""
    if as_iri:
        return F.when(term.isNotNull(), is_iri(term) & (term["value"] == value))
    same = _compared(lambda a, b: a == b, term, value)
    return F.when(is_literal(term), same).when(term.isNotNull(), F.lit(False))


def compare(term, op, value):
    """Ordering comparison; NULL (a type error) unless both sides share a family."""
    result = _compared(_OPS[op], term, value)
    if op in (">", ">=") and isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        result = result & ~F.isnan(number(term))  # which Spark sorts above all numbers
    if isinstance(value, str) and looks_temporal(value):
        result = F.coalesce(_OPS[op](instant(term), F.lit(value).try_cast("timestamp")), result)
    return result


def _compared(test, term, value):
    """Two integers compare exactly, any other pair of numbers as doubles; with NaN every test is false."""
    if isinstance(value, (float, Decimal)) and value != value:
        return F.when(number(term).isNotNull(), F.lit(False))
    loose = test(_comparable(term, value), _literal(value))
    if isinstance(value, bool) or not isinstance(value, int) or abs(value) >= 10**38:
        return loose
    return F.coalesce(test(exact_integer(term), F.lit(str(value)).cast("decimal(38,0)")), loose)


def _comparable(term, value):
    if isinstance(value, bool):
        return boolean(term)
    if isinstance(value, (int, float, Decimal)):
        return number(term)
    return plain_string(term)


def _literal(value):
    if isinstance(value, bool):
        return F.lit(value)
    if isinstance(value, (int, float, Decimal)):
        return number_literal(value)
    return F.lit(str(value))


def number_literal(value):
    """A number as a literal; a whole number beyond 64 bits compares as a double."""
    if isinstance(value, int) and not -(1 << 63) <= value < (1 << 63):
        return F.lit(float(value))
    return F.lit(value)


_OPS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def apply_operator(op, left, right):
    return _OPS[op](left, right)


def looks_temporal(value):
    """Is the text an ISO date or date-time (so it may meet a temporal column)?"""
    return re.fullmatch(r"\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)?)?", value) is not None
