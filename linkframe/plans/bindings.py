"""What a query variable is in a DataFrame.

A binding names the column(s) that hold a variable and knows how each query
operation reads them. Three encodings exist:

* ``ValueBinding``  a native Spark column of a mapped table,
* ``KeyBinding``    the native key of a resource; its IRI is only built when it
  is shown, so filters and joins run on the key and reach the scan,
* ``TermBinding``   a term struct or resource text from a triple table.
"""

import re
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe import vocab as V
from linkframe.functions import terms

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_INTEGRAL_RANGE = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _unless_unbound(column, outcome):
    """A fixed outcome for bound rows, unknown for unbound ones."""
    return F.when(column.isNotNull(), F.lit(outcome))


def _unknown():
    return F.lit(None).cast("boolean")


@dataclass(frozen=True)
class ValueBinding:
    column: str
    dtype: T.DataType
    lang_column: str | None = None
    declared: str | None = None

    @property
    def columns(self):
        return [self.column] + ([self.lang_column] if self.lang_column else [])

    @property
    def value(self):
        return F.col(self.column)

    def is_bound(self):
        return self.value.isNotNull()

    def text(self):
        return self.value.cast("string")

    def equals(self, value, as_iri=False):
        if as_iri and not isinstance(self.dtype, T.StringType):
            return _unless_unbound(self.value, False)
        if self._no_number(value):
            return _unless_unbound(self.value, False)
        operand = self._operand(value)
        return _unknown() if operand is None else self._if_untagged(self.value == operand)

    def compare(self, op, value):
        if self._no_number(value):
            return _unless_unbound(self.value, False)
        operand = self._operand(value)
        if operand is None:
            return _unknown()
        test = terms.apply_operator(op, self.value, operand)
        if op in (">", ">=") and isinstance(self.dtype, (T.FloatType, T.DoubleType)):
            # Spark sorts NaN above all numbers. Beside the comparison, which still reaches the scan.
            test = test & ~F.isnan(self.value)
        return self._if_untagged(test)

    def _if_untagged(self, test):
        """A tagged literal never compares with a plain one (a type error)."""
        if self.lang_column is None:
            return test
        return F.when(F.coalesce(F.col(self.lang_column), F.lit("")) == "", test)

    def _operand(self, value):
        """The literal in the column's own family; None if they never compare."""
        if isinstance(value, bool):
            return F.lit(value) if isinstance(self.dtype, T.BooleanType) else None
        if isinstance(value, (int, float, Decimal)):
            return terms.number_literal(value) if isinstance(self.dtype, T.NumericType) else None
        if isinstance(self.dtype, T.StringType):
            return F.lit(str(value))
        if isinstance(self.dtype, _TEMPORAL) and terms.looks_temporal(str(value)):
            # A date that no calendar has (2020-13-45) is no value: it equals nothing and is in no order.
            return F.lit(str(value)).try_cast(self.dtype)
        return None

    def _no_number(self, value):
        """NaN equals nothing and is in no order, not even with itself."""
        return isinstance(value, (float, Decimal)) and value != value and isinstance(self.dtype, T.NumericType)

    def language_is(self, lang):
        if self.lang_column is None:
            return None
        tag = F.coalesce(F.col(self.lang_column), F.lit(""))
        return self.value.isNull() | F.lower(tag).isin(lang.lower(), "")

    def sort_key(self):
        return self.value

    def shown(self):
        return self.value

    def base_type(self):
        if isinstance(self.dtype, T.BooleanType):
            return V.BOOLEAN
        if isinstance(self.dtype, _INTEGRAL):
            return V.INTEGER
        if isinstance(self.dtype, T.NumericType):
            return V.FLOAT
        if isinstance(self.dtype, T.DateType):
            return V.DATE
        if isinstance(self.dtype, _TEMPORAL):
            return V.DATETIME
        return V.TEXT

    @property
    def numeric(self):
        return isinstance(self.dtype, T.NumericType)


def key_iri(prefix, values, types):
    """IRI of a key. Where a key has several parts its texts are percent-encoded, so that none holds the slash between them."""
    parts = [F.lit(prefix)]
    for i, (value, dtype) in enumerate(zip(values, types)):
        text = value.cast("string")
        if len(values) > 1 and isinstance(dtype, T.StringType):
            text = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
        parts += ([F.lit("/")] if i else []) + [text]
    return F.concat(*parts)


@dataclass(frozen=True)
class KeyBinding:
    """Resource of one mapped class, held as its native key column(s)."""

    key_columns: tuple
    key_types: tuple
    class_iri: str
    prefix: str
    hashed: bool = False
    unique: bool = False

    @property
    def columns(self):
        return list(self.key_columns)

    @property
    def value(self):
        return self.shown()

    def is_bound(self):
        if self.hashed:
            return F.lit(True)
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.key_columns])

    def shown(self):
        if self.hashed:
            # By position, so that the hash does not depend on column names.
            cells = [F.col(c).alias(str(i)) for i, c in enumerate(self.key_columns)]
            row = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
            return F.concat(F.lit(self.prefix), F.sha2(row, 256))
        return key_iri(self.prefix, [F.col(c) for c in self.key_columns], self.key_types)

    text = shown
    sort_key = shown

    def equals(self, value, as_iri=True):
        if not as_iri:
            return self._fixed(False)
        if not self.hashed and all(type(t) in _INTEGRAL_RANGE for t in self.key_types):
            return self._key_equals(value)
        if not self.hashed and [type(t) for t in self.key_types] == [T.StringType]:
            if not value.startswith(self.prefix):
                return self._fixed(False)
            return F.col(self.key_columns[0]) == value[len(self.prefix):]
        return self.shown() == value

    def _fixed(self, outcome):
        return F.when(self.is_bound(), F.lit(outcome))

    def _key_equals(self, iri):
        """Compare on the key: the IRI is cut at compile time, the scan sees ``key = 5``."""
        if not str(iri).startswith(self.prefix):
            return self._fixed(False)
        parts = str(iri)[len(self.prefix):].split("/")
        if len(parts) != len(self.key_columns):
            return self._fixed(False)
        test = None
        for name, dtype, part in zip(self.key_columns, self.key_types, parts):
            bits = _INTEGRAL_RANGE[type(dtype)]
            canonical = re.fullmatch(r"0|-?[1-9][0-9]*", part)
            if not canonical or not -(1 << bits) <= int(part) < (1 << bits):
                return self._fixed(False)
            one = F.col(name) == F.lit(int(part)).cast(dtype)
            test = one if test is None else test & one
        return test

    def compare(self, op, value):
        return _unknown()

    def language_is(self, lang):
        return None

    def base_type(self):
        return V.URL

    numeric = False


@dataclass(frozen=True)
class TermBinding:
    """A term struct column, or (``node=True``) a resource stored as text."""

    column: str
    node: bool = False
    declared: str | None = None

    @property
    def columns(self):
        return [self.column]

    @property
    def value(self):
        return terms.node_term(F.col(self.column)) if self.node else F.col(self.column)

    def node_key(self):
        return F.col(self.column) if self.node else terms.node_key(F.col(self.column))

    def is_bound(self):
        return F.col(self.column).isNotNull()

    def text(self):
        return terms.text(self.value)

    def equals(self, value, as_iri=False):
        if self.node:
            return F.col(self.column) == value if as_iri else _unless_unbound(F.col(self.column), False)
        return terms.equals(self.value, value, as_iri)

    def compare(self, op, value):
        return _unknown() if self.node else terms.compare(self.value, op, value)

    def language_is(self, lang):
        if self.node:
            return None
        return self.value.isNull() | F.lower(terms.lang(self.value)).isin(lang.lower(), "")

    def sort_key(self):
        return terms.sort_key(self.value)

    def shown(self):
        return F.col(self.column) if self.node else F.col(self.column)["value"]

    def base_type(self):
        return V.URL if self.node else self.declared

    numeric = False


def with_columns(binding, mapping):
    """The same binding after its columns were renamed by ``mapping``."""
    if isinstance(binding, KeyBinding):
        return replace(binding, key_columns=tuple(mapping[c] for c in binding.key_columns))
    if isinstance(binding, ValueBinding):
        lang = mapping[binding.lang_column] if binding.lang_column else None
        return replace(binding, column=mapping[binding.column], lang_column=lang)
    return replace(binding, column=mapping[binding.column])
