"""Query results: lazy DataFrames plus column metadata, and result typing."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.plans.bindings import TermBinding

# Exactly these pairs of observed types promote; any other mix shows as text.
_PROMOTIONS = {
    frozenset([V.INTEGER, V.FLOAT]): V.FLOAT,
    frozenset([V.DATE, V.DATETIME]): V.DATETIME,
}
_SPARK_TYPE = {V.INTEGER: "bigint", V.FLOAT: "double", V.BOOLEAN: "boolean"}
_OBSERVABLE = [V.INTEGER, V.FLOAT, V.BOOLEAN, V.DATE, V.DATETIME, V.TIME, V.URL, V.TEXT]


@dataclass(frozen=True)
class ResultColumn:
    name: str
    display_name: str
    base_type: str


class QueryResult:
    """Result of a structured query.

    ``to_df()`` types term columns from all their values, which takes one
    aggregation over the result; ``to_df("declared")`` trusts the catalog and
    stays lazy, ``"text"`` shows lexical forms, ``"terms"`` the raw structs.
    Columns of mapped tables are typed already and never need a pass.
    """

    def __init__(self, frame):
        self._frame = frame
        self._observed = None

    @property
    def names(self):
        return [o.name for o in self._frame.outputs]

    def to_df(self, typing="observed"):
        df, outputs = self._frame.df, self._frame.outputs
        if typing == "terms":
            return df.select(*[o.binding.value.alias(o.name) for o in outputs])
        types = {}
        if typing == "observed":
            types = self._observe()
        elif typing == "declared":
            types = {o.name: o.binding.base_type() for o in outputs}
        elif typing != "text":
            raise ValueError(f"unknown typing {typing!r}")
        return df.select(*[_shown(o, types.get(o.name)).alias(o.name) for o in outputs])

    def columns(self):
        """Name, display name and logical type of every column."""
        observed = self._observe()
        return [ResultColumn(o.name, o.name, observed[o.name]) for o in self._frame.outputs]

    def _observe(self):
        if self._observed is None:
            open_ended = [o for o in self._frame.outputs if _is_term(o.binding)]
            found = observe_types(self._frame.df, {o.name: o.binding.value for o in open_ended})
            self._observed = {
                o.name: found.get(o.name) or o.binding.base_type() for o in self._frame.outputs
            }
        return self._observed


def _is_term(binding):
    return isinstance(binding, TermBinding) and not binding.node


def _shown(output, base_type):
    binding = output.binding
    if not _is_term(binding):
        return binding.shown()
    return typed_cell(binding.value, base_type)


def typed_cell(term, base_type):
    """One cell in the type of its column; text columns keep the lexical form."""
    if base_type == V.BOOLEAN:
        return F.lower(term["value"]) == "true"
    if base_type in _SPARK_TYPE:
        return term["value"].try_cast(_SPARK_TYPE[base_type])
    return term["value"]


def cell_type(term):
    """Logical type of one term; a number outside its Spark type counts as text."""
    datatype = term["datatype"]
    result = F.when(term["kind"] == V.IRI, V.URL).when(term["kind"] == V.BNODE, V.TEXT)
    for base, names in V.RESULT_DATATYPES.items():
        matches = datatype.isin([V.XSD + n for n in names])
        if base in (V.INTEGER, V.FLOAT):
            matches = matches & term["value"].try_cast(_SPARK_TYPE[base]).isNotNull()
        result = result.when(matches, base)
    return F.when(term.isNotNull(), result.otherwise(V.TEXT))


def observe_types(df, terms):
    """Logical type of each term column, from every row, in one aggregation.

    Only one flag per column and type is aggregated, so the pass returns a
    single row of fixed width however many rows or datatypes there are.
    """
    if not terms:
        return {}
    flags, places = [], []
    for name, term in terms.items():
        kind = cell_type(term)
        for base in _OBSERVABLE:
            flags.append(F.coalesce(F.bool_or(kind == base), F.lit(False)).alias(f"f{len(flags)}"))
            places.append((name, base))
    row = df.agg(*flags).first()
    seen = {name: set() for name in terms}
    for (name, base), present in zip(places, row):
        if present:
            seen[name].add(base)
    return {name: resolve_types(kinds) for name, kinds in seen.items()}


def resolve_types(kinds):
    if len(kinds) == 1:
        return next(iter(kinds))
    return _PROMOTIONS.get(frozenset(kinds), V.TEXT)


def ask(df):
    """One row, one column: does the DataFrame have any row at all?"""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("boolean"))
