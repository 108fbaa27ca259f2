"""Filter clauses as column expressions with SPARQL's three-valued logic.

An unbound variable and a type error are both NULL, which ``and``/``or``/``not``
treat exactly as SPARQL treats an error, and which a filter drops.
"""

from functools import reduce

from pyspark.sql import functions as F

from linkframe.naming import has_scheme
from linkframe.plans.bindings import TermBinding
from linkframe.plans.ir import Logical


def predicate(node, resolve):
    """``resolve`` maps a field reference to (binding, holds_iris)."""
    if isinstance(node, Logical):
        parts = [predicate(p, resolve) for p in node.parts]
        if node.op == "not":
            return ~parts[0]
        if node.op == "and":
            return reduce(lambda a, b: a & b, parts)
        return reduce(lambda a, b: a | b, parts)
    binding, holds_iris = resolve(node.field)
    return _TESTS[node.op](binding, holds_iris, node)


def narrowing(node, resolve):
    """A plain ``value = text`` every row passing the condition must meet, or None.

    It adds nothing to the result, but unlike the full comparison of terms it
    reaches the scan, where statistics and Bloom filters skip row groups.
    """
    if isinstance(node, Logical) or node.op != "=" or not all(isinstance(v, str) for v in node.values):
        return None
    binding, _ = resolve(node.field)
    if not isinstance(binding, TermBinding) or binding.node:
        return None
    lexical = binding.value["value"]
    return lexical == node.values[0] if len(node.values) == 1 else lexical.isin(list(node.values))


def wanted_texts(parts, place):
    """Texts one of which a field must have, by ``place(field)`` (None: no such place), for the conditions that say so."""
    found = {}
    for node in parts:
        if isinstance(node, Logical) or node.op != "=" or not all(isinstance(v, str) for v in node.values):
            continue
        key = place(node.field)
        if key is not None:
            found.setdefault(key, list(node.values))
    return found


def _equals_any(binding, holds_iris, node):
    tests = []
    for value in node.values:
        if value is None:
            tests.append(~binding.is_bound())
        else:
            tests.append(binding.equals(value, as_iri=holds_iris and has_scheme(value)))
    return reduce(lambda a, b: a | b, tests)


def _differs_from_all(binding, holds_iris, node):
    tests = []
    for value in node.values:
        if value is None:
            tests.append(binding.is_bound())
        else:
            tests.append(~binding.equals(value, as_iri=holds_iris and has_scheme(value)))
    return reduce(lambda a, b: a & b, tests)


def _ordering(binding, _holds_iris, node):
    return binding.compare(node.op, node.values[0])


def _between(binding, _holds_iris, node):
    low, high = node.values
    return binding.compare(">=", low) & binding.compare("<=", high)


def _text_test(method):
    def test(binding, _holds_iris, node):
        text, needle = binding.text(), F.lit(str(node.values[0]))
        if not node.case_sensitive:
            text, needle = F.lower(text), F.lower(needle)
        return getattr(text, method)(needle)

    return test


_TESTS = {
    "=": _equals_any,
    "!=": _differs_from_all,
    ">": _ordering,
    ">=": _ordering,
    "<": _ordering,
    "<=": _ordering,
    "between": _between,
    "starts-with": _text_test("startswith"),
    "ends-with": _text_test("endswith"),
    "contains": _text_test("contains"),
    "is-null": lambda binding, _h, _n: ~binding.is_bound(),
    "not-null": lambda binding, _h, _n: binding.is_bound(),
}
