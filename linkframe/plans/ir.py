"""The structured query: nested stages, as immutable records.

``parse_stage`` accepts the plain list/dict form, for example::

    {"source-table": "Customer",
     "filter": ["=", ["field", "c_mktsegment", None], "BUILDING"],
     "breakout": [["field", "n_name", {"join-alias": "Nation"}]],
     "joins": [{"alias": "Nation", "source-table": "Nation", "fk-field-id": "c_nationkey"}],
     "aggregation": [["count"]],
     "order-by": [["desc", ["aggregation", 0]]],
     "limit": 10}

A clause outside the language raises ``UnsupportedClause``; nothing is dropped.
"""

from dataclasses import dataclass

from linkframe.errors import InvalidQuery, UnsupportedClause

COMPARISONS = ("=", "!=", ">", ">=", "<", "<=", "between")
TEXT_TESTS = ("starts-with", "ends-with", "contains")
NULL_TESTS = ("is-null", "not-null")
AGGREGATES = ("count", "distinct", "sum", "avg", "min", "max")
STAGE_KEYS = {
    "source-table", "source-query", "fields", "filter", "joins", "aggregation",
    "breakout", "order-by", "limit",
}


@dataclass(frozen=True)
class FieldRef:
    ref: int | str
    join_alias: str | None = None


@dataclass(frozen=True)
class AggregationRef:
    index: int


@dataclass(frozen=True)
class Logical:
    op: str                      # and, or, not
    parts: tuple


@dataclass(frozen=True)
class Test:
    op: str
    field: FieldRef
    values: tuple = ()
    case_sensitive: bool = True


@dataclass(frozen=True)
class Join:
    alias: str
    source_table: int | str | None
    key: FieldRef                         # the foreign key that is followed
    target: FieldRef | None = None        # other side of an explicit condition


@dataclass(frozen=True)
class Aggregation:
    op: str
    field: FieldRef | None = None
    name: str | None = None


@dataclass(frozen=True)
class Order:
    descending: bool
    by: FieldRef | AggregationRef


@dataclass(frozen=True)
class Stage:
    source_table: int | str | None = None
    source_query: "Stage | None" = None
    fields: tuple = ()
    filter: Logical | Test | None = None
    joins: tuple = ()
    aggregations: tuple = ()
    breakouts: tuple = ()
    order_by: tuple = ()
    limit: int | None = None


@dataclass(frozen=True)
class ExpectedColumn:
    """One column the caller wants back, in this position."""

    id: int | str | None = None
    name: str | None = None
    join_alias: str | None = None
    fk_field: int | str | None = None
    alias: str | None = None


def _word(x):
    return x.lstrip(":") if isinstance(x, str) else x


def _clause(x):
    return isinstance(x, (list, tuple)) and len(x) > 0 and isinstance(x[0], str)


def _is_field(x):
    return _clause(x) and _word(x[0]) == "field"


def parse_field(token):
    if not _is_field(token) or len(token) < 2 or not isinstance(token[1], (int, str)):
        raise InvalidQuery(f"not a field reference: {token!r}")
    options = token[2] if len(token) > 2 and token[2] else {}
    return FieldRef(token[1], options.get("join-alias"))


def _value(x):
    return x[1] if _clause(x) and _word(x[0]) == "value" else x


def parse_filter(clause):
    if not _clause(clause):
        raise InvalidQuery(f"not a filter clause: {clause!r}")
    op, args = _word(clause[0]), list(clause[1:])
    if op in ("and", "or", "not"):
        if not args or (op == "not" and len(args) != 1):
            raise InvalidQuery(f"{op} has the wrong number of operands")
        return Logical(op, tuple(parse_filter(a) for a in args))
    if op not in COMPARISONS + TEXT_TESTS + NULL_TESTS:
        raise UnsupportedClause(f"filter {op!r} is not supported")
    if not args or not _is_field(args[0]):
        raise UnsupportedClause(f"the left side of {op!r} must be a field")
    field, rest = parse_field(args[0]), args[1:]
    options = rest.pop() if rest and isinstance(rest[-1], dict) else {}
    values = tuple(_value(v) for v in rest)
    _check_arity(op, values)
    return Test(op, field, values, options.get("case-sensitive", True) is not False)


def _check_arity(op, values):
    wanted = {"between": 2, "is-null": 0, "not-null": 0}.get(op, 1)
    several = op in ("=", "!=") and len(values) > 1
    if len(values) != wanted and not several:
        raise InvalidQuery(f"{op!r} takes {wanted} value(s), got {len(values)}")
    if op not in ("=", "!=") and any(v is None for v in values):
        raise InvalidQuery(f"{op!r} cannot compare with nothing")
    if any(isinstance(v, (list, tuple, dict)) for v in values):
        raise UnsupportedClause(f"{op!r} compares with plain values only")


def parse_join(join):
    strategy = _word(join.get("strategy") or "left-join")
    if strategy != "left-join":
        raise UnsupportedClause(f"join strategy {strategy!r} is not supported")
    if not join.get("alias"):
        raise InvalidQuery("a join needs an alias")
    alias, condition, key_id = join["alias"], join.get("condition"), join.get("fk-field-id")
    if condition is not None:
        key, target = _sides(condition, alias)
    elif key_id is not None:
        key, target = FieldRef(key_id), None
    else:
        raise InvalidQuery(f"join {alias} has neither a condition nor a foreign key field")
    if key_id is not None:
        key = FieldRef(key_id, key.join_alias)
    return Join(alias, join.get("source-table"), key, target)


def _sides(condition, alias):
    """Foreign key side and target side of the equality that links ``alias``."""
    equality = condition
    if _clause(condition) and _word(condition[0]) == "and":
        equalities = [c for c in condition[1:] if _clause(c) and _word(c[0]) == "="]
        if len(equalities) != len(condition) - 1 or len(equalities) != 1:
            raise UnsupportedClause("a join condition is one equality of two fields")
        equality = equalities[0]
    if not (_clause(equality) and _word(equality[0]) == "=" and len(equality) == 3):
        raise UnsupportedClause("a join condition is one equality of two fields")
    left, right = parse_field(equality[1]), parse_field(equality[2])
    for fk, target in ((left, right), (right, left)):
        if target.join_alias == alias and fk.join_alias != alias:
            return fk, target
    raise UnsupportedClause(f"the condition of join {alias} does not link it to another table")


def parse_aggregation(clause):
    name = None
    if _clause(clause) and _word(clause[0]) == "aggregation-options":
        name = (clause[2] if len(clause) > 2 else {}).get("name")
        clause = clause[1]
    if not _clause(clause) or _word(clause[0]) not in AGGREGATES:
        raise UnsupportedClause(f"aggregation {clause!r} is not supported")
    op = _word(clause[0])
    field = None
    if len(clause) > 1:
        if not _is_field(clause[1]):
            raise UnsupportedClause(f"{op!r} aggregates a field, not {clause[1]!r}")
        field = parse_field(clause[1])
    elif op != "count":
        raise InvalidQuery(f"{op!r} needs a field")
    return Aggregation(op, field, name)


def parse_order(term):
    direction, by = _word(term[0]), term[1]
    if direction not in ("asc", "desc"):
        raise InvalidQuery(f"unknown sort direction {direction!r}")
    if _clause(by) and _word(by[0]) == "aggregation":
        return Order(direction == "desc", AggregationRef(by[1]))
    return Order(direction == "desc", parse_field(by))


def parse_stage(query):
    if isinstance(query, Stage):
        return query
    query = {_word(k): v for k, v in query.items()}
    unknown = set(query) - STAGE_KEYS
    if unknown:
        raise UnsupportedClause(f"unsupported stage keys: {', '.join(sorted(unknown))}")
    if ("source-table" in query) == ("source-query" in query):
        raise InvalidQuery("a stage has either a source-table or a source-query")
    limit = query.get("limit")
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit < 0):
        raise InvalidQuery(f"limit must be a number of rows, not {limit!r}")
    inner = query.get("source-query")
    return Stage(
        source_table=query.get("source-table"),
        source_query=parse_stage(inner) if inner is not None else None,
        fields=tuple(parse_field(f) for f in query.get("fields") or ()),
        filter=parse_filter(query["filter"]) if query.get("filter") else None,
        joins=tuple(parse_join(j) for j in query.get("joins") or ()),
        aggregations=tuple(parse_aggregation(a) for a in query.get("aggregation") or ()),
        breakouts=tuple(parse_field(b) for b in query.get("breakout") or ()),
        order_by=tuple(parse_order(o) for o in query.get("order-by") or ()),
        limit=limit,
    )


def filter_fields(node):
    if node is None:
        return []
    if isinstance(node, Logical):
        return [f for part in node.parts for f in filter_fields(part)]
    return [node.field]


def conjuncts(node):
    """The parts of a filter that must all hold."""
    if node is None:
        return []
    if isinstance(node, Logical) and node.op == "and":
        return [c for part in node.parts for c in conjuncts(part)]
    return [node]


def aggregation_names(aggregations):
    """Names by which a later stage may refer to the aggregates of this one."""
    default = {"count": "count", "distinct": "count", "sum": "sum", "avg": "avg",
               "min": "min", "max": "max"}
    names, seen = [], {}
    for agg in aggregations:
        base = agg.name or default[agg.op]
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return names
