"""Aggregates as mergeable parts.

Every aggregate is a set of partial columns, a rule to merge them, and a final
expression. Spark combines partials before each shuffle; the merge rule also
lets a query aggregate by foreign key *before* it joins (see plans.build).
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkframe import vocab as V
from linkframe.errors import UnsupportedClause
from linkframe.functions import terms
from linkframe.plans.bindings import KeyBinding, TermBinding, ValueBinding

_SUM_TYPE = {t: T.LongType() for t in (T.ByteType, T.ShortType, T.IntegerType, T.LongType)}
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Part:
    """One partial column: how to compute it and how two of them combine."""

    column: Column
    merge: str | None          # None: cannot be combined from partial results


@dataclass(frozen=True)
class Aggregate:
    parts: dict                # name -> Part
    result: Column
    binding: object

    @property
    def mergeable(self):
        return all(p.merge for p in self.parts.values())

    def computed(self):
        return [p.column.alias(n) for n, p in self.parts.items()]

    def merged(self):
        return [_MERGE[p.merge](n).alias(n) for n, p in self.parts.items()]


def row_count(name, names):
    n = names.new("n")
    return Aggregate({n: Part(F.count(F.lit(1)), "sum")}, F.coalesce(F.col(n), F.lit(0)),
                     ValueBinding(name, T.LongType()))


def distinct_count(binding, name, names):
    n = names.new("n")
    columns = binding.columns
    term = F.col(columns[0]) if len(columns) == 1 else F.when(binding.is_bound(), F.struct(*columns))
    return Aggregate({n: Part(F.count_distinct(term), None)}, F.col(n), ValueBinding(name, T.LongType()))


def bound_count(binding, name, names):
    n = names.new("n")
    return Aggregate({n: Part(F.count(F.when(binding.is_bound(), F.lit(1))), "sum")},
                     F.coalesce(F.col(n), F.lit(0)), ValueBinding(name, T.LongType()))


def sum_or_avg(op, binding, name, names):
    if isinstance(binding, TermBinding):
        return _term_sum(op, binding, name, names)
    if not binding.numeric:
        return _never(binding, name, names)
    s, n = names.new("s"), names.new("n")
    total = Part(F.sum(binding.value), "sum")
    if op == "sum":
        dtype = _SUM_TYPE.get(type(binding.dtype), T.DoubleType())
        if isinstance(binding.dtype, T.DecimalType):
            dtype = T.DecimalType(38, binding.dtype.scale)
        return Aggregate({s: total}, F.col(s).cast(dtype), ValueBinding(name, dtype))
    count = Part(F.count(binding.value), "sum")
    mean = F.when(F.col(n) > 0, F.col(s).cast("double") / F.col(n))
    return Aggregate({s: total, n: count}, mean, ValueBinding(name, T.DoubleType()))


def _never(binding, name, names):
    """Adding up what is no number is a type error: the result is unbound."""
    m = names.new("m")
    return Aggregate({m: Part(F.max(F.lit(None).cast("double")), "max")}, F.col(m),
                     ValueBinding(name, T.DoubleType()))


def _term_sum(op, binding, name, names):
    term = binding.value
    number, integer = terms.number(term), terms.is_integer(term)
    s, i, bad, real, n = (names.new(x) for x in ("s", "i", "bad", "real", "n"))
    exact = F.when(integer, term["value"].try_cast("decimal(38,0)"))
    parts = {
        s: Part(F.sum(number), "sum"),
        n: Part(F.count(number), "sum"),
        bad: Part(F.max(term.isNotNull() & number.isNull()), "max"),
    }
    usable = ~F.col(bad) & (F.col(n) > 0)
    if op == "avg":
        return Aggregate(parts, F.when(usable, F.col(s) / F.col(n)), ValueBinding(name, T.DoubleType()))
    if binding.declared == V.FLOAT:
        return Aggregate(parts, F.when(usable, F.col(s)), ValueBinding(name, T.DoubleType()))
    parts[i] = Part(F.sum(exact), "sum")
    parts[real] = Part(F.max(number.isNotNull() & ~integer), "max")
    total = F.when(F.col(real), terms.literal_term(F.col(s), V.XSD + "double")).otherwise(
        terms.literal_term(F.col(i), V.XSD + "integer")
    )
    return Aggregate(parts, F.when(usable, total), TermBinding(name, declared=binding.declared))


def least_or_greatest(op, binding, name, names):
    m = names.new("m")
    function = F.min if op == "min" else F.max
    if isinstance(binding, TermBinding):
        # The order key leads, so one struct minimum finds the term itself.
        keyed = F.when(binding.is_bound(), F.struct(binding.sort_key().alias("k"), binding.value.alias("t")))
        return Aggregate({m: Part(function(keyed), op)}, F.col(m)["t"],
                         TermBinding(name, declared=binding.declared))
    if isinstance(binding, KeyBinding) and len(binding.key_columns) == 1:
        # IRIs order as text; the key travels along, so the result can be joined on.
        pair = F.struct(binding.shown().alias("iri"), F.col(binding.key_columns[0]).alias("key"))
        return Aggregate({m: Part(function(F.when(binding.is_bound(), pair)), op)}, F.col(m)["key"],
                         replace(binding, key_columns=(name,), unique=False))
    if isinstance(binding, KeyBinding):
        return Aggregate({m: Part(function(binding.shown()), op)}, F.col(m),
                         ValueBinding(name, T.StringType()))
    return Aggregate({m: Part(function(binding.value), op)}, F.col(m), ValueBinding(name, binding.dtype))


def aggregate(op, binding, name, names):
    """Aggregate ``binding`` (never None here) into a column called ``name``."""
    if op == "count":
        return bound_count(binding, name, names)
    if op == "distinct":
        return distinct_count(binding, name, names)
    if op in ("sum", "avg"):
        return sum_or_avg(op, binding, name, names)
    if op in ("min", "max"):
        return least_or_greatest(op, binding, name, names)
    raise UnsupportedClause(f"aggregation {op!r} is not supported")
