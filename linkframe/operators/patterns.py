"""Graph patterns over a triple table, for native queries in the DataFrame API.

``match(source, ("?s", "a", iri), ("?s", prop, "?v"))`` gives a DataFrame with
one term column per variable; ``optional`` left-joins a further pattern. All
else is plain Spark: filter with ``functions.terms``, ``unionByName`` for UNION,
``groupBy`` for GROUP BY, and so on.

A pattern position is a variable (``"?x"``), an IRI (text; ``"a"`` is rdf:type)
or, as object, any Python literal wrapped in ``Literal``.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.errors import InvalidQuery, UnsupportedClause
from linkframe.functions import terms
from linkframe.operators import solutions
from linkframe.plans.frame import Names

# Column metadata: the variable stands in subject or predicate position.
RESOURCE = "linkframe.resource"


@dataclass(frozen=True)
class Literal:
    value: object
    datatype: str | None = None
    lang: str = ""

    def term(self):
        if self.lang:
            return terms.lang_term(F.lit(str(self.value)), F.lit(self.lang))
        known = {bool: "boolean", int: "integer", float: "double"}
        datatype = self.datatype or V.XSD + known.get(type(self.value), "string")
        text = str(self.value).lower() if isinstance(self.value, bool) else str(self.value)
        return terms.literal_term(text, datatype)


def _variable(x):
    return x[1:] if isinstance(x, str) and x.startswith("?") else None


def match(source, *patterns):
    """All ways the patterns hold together: joins on the variables they share."""
    if not patterns:
        raise InvalidQuery("match needs at least one pattern")
    result = None
    waiting = _stars(source, patterns)
    while waiting:
        # Next, patterns that share a variable with what is joined already.
        linked = [i for i, star in enumerate(waiting) if result is None or set().union(*map(_variables, star)) & set(result.columns)]
        if not linked:
            raise UnsupportedClause("the patterns fall apart: no shared variable links them")
        star = waiting.pop(linked[0])
        whole = _whole(source, star, waiting)
        if whole is not None:
            triples, pattern, other = whole
            waiting.remove(other)
            rows = _pattern(source, pattern, triples)
        else:
            rows = _pattern(source, star[0]) if len(star) == 1 else _star(source, star)
        result = rows if result is None else natural_join(result, rows)
    return result


def _stars(source, patterns):
    """Patterns about one variable that one table answers, together; each other pattern alone."""
    stars = {}
    for i, (s, p, o) in enumerate(patterns):
        place = i
        if _variable(s) is not None and _variable(p) is None and _variable(o) != _variable(s):
            constant = o if isinstance(o, str) and _variable(o) is None else None
            table = source.table_of(_predicate(p), constant)
            if table is not None:
                place = (s, table)
        star = stars.setdefault(place, [])
        # A predicate or variable that comes again is a condition of its own.
        if any(_predicate(p) == _predicate(q[1]) or (_variable(o) is not None and o == q[2]) for q in star):
            star = stars.setdefault(i, [])
        star.append((s, p, o))
    return list(stars.values())


def _whole(source, star, waiting):
    """(triples, a pattern for all triples of a variable, the other star) if ``star`` and another say no more of a variable
    than its class and that it has triples, and the class's table gives both at once; else None."""
    for other in waiting:
        for typed, free in ((star, other), (other, star)):
            (s, p, target), pattern = typed[0], free[0]
            if len(typed) > 1 or len(free) > 1 or _variable(s) is None or pattern[0] != s or _variable(pattern[1]) is None:
                continue
            if _predicate(p) == V.RDF_TYPE and isinstance(target, str) and _variable(target) is None:
                triples = source.described(target)
                if triples is not None:
                    return triples, pattern, other
    return None


def _star(source, star):
    """Rows of patterns about one variable, from one scan of the table that has their properties."""
    constants = {_predicate(p): o for _, p, o in star if _variable(o) is None}
    table = source.table_of(*next((_predicate(p), o if isinstance(o, str) else None) for _, p, o in star))
    only = {p: [str(o.value) if isinstance(o, Literal) else o] for p, o in constants.items() if p != V.RDF_TYPE}
    columns = {_predicate(p): f"o{i}" for i, (_, p, _) in enumerate(star)}
    rows = source.wide(table, "s", columns, only)
    shown = [terms.node_term(F.col("s"), bound=True).alias(_variable(star[0][0]), metadata={RESOURCE: True})]
    for _, p, o in star:
        name = columns[_predicate(p)]
        rows = rows.where(F.col(name).isNotNull())
        if _variable(o) is None:
            wanted = _constant(o)
            for part in ("kind", "value", "datatype", "lang"):
                rows = rows.where(F.col(name)[part] == wanted[part])
        else:
            shown.append(terms.rebuilt(F.col(name)).alias(_variable(o)))
    return rows.select(*shown)


def optional(df, source, *patterns):
    """OPTIONAL: left join patterns to solutions. A shared variable that a row of
    ``df`` leaves unbound takes its value from the pattern."""
    if len(patterns) == 1:
        s, p, o = (_variable(x) for x in patterns[0])
        plain = s in df.columns and p is None and o is not None and o not in df.columns
        if plain and not df.schema[s].nullable:
            return _optional_property(df, source, s, _predicate(patterns[0][1]), o)
    return optional_join(df, match(source, *patterns))


def natural_join(left, right):
    """Compatible pairs of two sets of solutions, as of a group ``{ left } { right }``."""
    return solutions.join(left, right, _shared(left, right))


def optional_join(left, right):
    """``left`` OPTIONAL ``right`` for sets of solutions."""
    return solutions.left_join(left, right, _shared(left, right))


def minus(left, right):
    """``left`` MINUS ``right``; solutions without a common variable take nothing away."""
    return solutions.minus(left, right, _parts(left, right))


def _optional_property(df, source, subject, prop, name):
    """One property of a variable: the (salted) left join of the triple table."""
    names = Names()
    for column in df.columns:
        names.new(column)
    key = names.new("node")
    keyed = df.withColumn(key, terms.node_key(F.col(subject)))
    return source.left_join(keyed, key, prop, names.new(name), names).drop(key)


def exists(df, source, *patterns):
    """FILTER EXISTS."""
    right = match(source, *patterns)
    return solutions.semi_join(df, right, _shared(df, right), "left_semi")


def not_exists(df, source, *patterns):
    """FILTER NOT EXISTS."""
    right = match(source, *patterns)
    return solutions.semi_join(df, right, _shared(df, right), "left_anti")


def values(spark, **columns):
    """VALUES: an inline table of terms, one keyword per variable; None is UNDEF."""
    names = list(columns)
    if len({len(v) for v in columns.values()}) != 1:
        raise InvalidQuery("the columns of VALUES differ in length")
    rows = [F.struct(*[_value(columns[n][i]).alias(n) for n in names])
            for i in range(len(columns[names[0]]))]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _predicate(x):
    return V.RDF_TYPE if x == "a" else x


def _variables(pattern):
    return {v for v in map(_variable, pattern) if v is not None}


def _constant(x):
    return x.term() if isinstance(x, Literal) else terms.iri_term(x)


def _value(x):
    return F.lit(None).cast(terms.TERM_TYPE) if x is None else terms.rebuilt(_constant(x))


def _pattern(source, pattern, triples=None):
    """Rows of one triple pattern, a term column per variable; ``triples``: all that can meet it, if they are known."""
    s, p, o = pattern
    p = _predicate(p)
    subject = None if _variable(s) else s
    target = o if isinstance(o, str) and _variable(o) is None else None
    if triples is not None:
        pass
    elif _variable(p) is None:
        triples = source.slice(p, subject, target).withColumn("p", F.lit(p))
    else:
        triples = source.triples(subject)
    if _variable(s) is None:
        triples = triples.where(F.col("s") == s)
    if _variable(o) is None:
        wanted = _constant(o)
        for part in ("kind", "value", "datatype", "lang"):
            triples = triples.where(F.col("o")[part] == wanted[part])
    columns = {}
    for name, term in ((_variable(s), terms.node_term(F.col("s"), bound=True)),
                       (_variable(p), terms.iri_term(F.col("p"), bound=True)),
                       (_variable(o), terms.rebuilt(F.col("o")))):
        if name is None:
            continue
        if name in columns:
            triples = triples.where(columns[name] == term)
        else:
            columns[name] = term
    if not columns:
        raise UnsupportedClause("a pattern needs a variable")
    resources = {_variable(s), _variable(p)}
    return triples.select(*[
        t.alias(n, metadata={RESOURCE: True}) if n in resources else t.alias(n) for n, t in columns.items()
    ])


def _parts(left, right):
    """Shared variables with the term parts that decide whether they are equal."""
    parts = {}
    for c in [c for c in left.columns if c in right.columns]:
        # A resource has neither datatype nor language to tell apart.
        resource = any(side.schema[c].metadata.get(RESOURCE) for side in (left, right))
        parts[c] = ("value", "kind") if resource else ("value", "kind", "datatype", "lang")
    return parts


def _shared(left, right):
    parts = _parts(left, right)
    if not parts:
        raise UnsupportedClause("no shared variable links the patterns")
    return parts
