"""Joins of solutions with unbound variables, against the definition in terms of compatible mappings."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphs import NS, triples
from linkframe import TripleSource
from linkframe.errors import UnsupportedClause
from linkframe.functions import terms
from linkframe.operators.patterns import exists, match, minus, natural_join, not_exists, optional, optional_join, values


def solutions(spark, rows, names):
    """Rows of IRIs or None as terms; a column without None is known to be bound."""
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} string" for n in names))
    bound = [all(r[i] is not None for r in rows) for i in range(len(names))]
    return df.select(*(terms.iri_term(F.col(n), bound=b).alias(n) for n, b in zip(names, bound)))


def found(df, names):
    return Counter(tuple(r) for r in df.select(*(F.col(n)["value"].alias(n) for n in names)).collect())


def compatible(a, b):
    return all(a[k] == b[k] for k in a.keys() & b.keys() if a[k] is not None and b[k] is not None)


def overlap(a, b):
    return any(a[k] is not None and b[k] is not None for k in a.keys() & b.keys())


def merged(a, b):
    return {k: a.get(k) if a.get(k) is not None else b.get(k) for k in {**a, **b}}


CASES = [(seed, shape) for seed in range(3) for shape in ("left", "right", "both", "none")]


@pytest.fixture(params=CASES, ids=str)
def sides(request, spark):
    seed, loose = request.param
    rng = random.Random(seed)
    draw = lambda may: rng.choice(["p", "q", "r"] + ([None] if may else []))
    ours = [(str(i), rng.choice("xy"), draw(loose in ("left", "both")), draw(loose in ("left", "both"))) for i in range(14)]
    theirs = [(rng.choice("xyz"), draw(loose in ("right", "both")), draw(loose in ("right", "both")), str(i)) for i in range(9)]
    a, b = ("id", "x", "y", "z"), ("x", "y", "z", "other")
    return ([dict(zip(a, r)) for r in ours], [dict(zip(b, r)) for r in theirs], solutions(spark, ours, a), solutions(spark, theirs, b))


ALL = ("id", "x", "y", "z", "other")


def as_counter(rows, names):
    return Counter(tuple(r.get(n) for n in names) for r in rows)


def test_join_optional_and_minus_follow_the_definition(sides):
    ours, theirs, left, right = sides
    pairs = [merged(a, b) for a, b in itertools.product(ours, theirs) if compatible(a, b)]
    assert found(natural_join(left, right), ALL) == as_counter(pairs, ALL)
    alone = [a for a in ours if not any(compatible(a, b) for b in theirs)]
    assert found(optional_join(left, right), ALL) == as_counter(pairs + alone, ALL)
    left_over = [a for a in ours if not any(compatible(a, b) and overlap(a, b) for b in theirs)]
    assert found(minus(left, right), ALL[:4]) == as_counter(left_over, ALL[:4])


GRAPH = """
:a :p :b . :a :q :c . :b :p :c . :c :q :a . :b :q :b .
"""


def test_exists_with_an_unbound_variable(spark):
    source = TripleSource(triples(spark, GRAPH), deduplicated=True)
    df = values(spark, s=[NS + "a", NS + "a", None, NS + "zzz"], o=[NS + "b", None, NS + "c", None])
    pattern = ("?s", NS + "p", "?o")
    assert found(exists(df, source, pattern), ("s", "o")) == Counter({(NS + "a", NS + "b"): 1, (NS + "a", None): 1, (None, NS + "c"): 1})
    assert found(not_exists(df, source, pattern), ("s", "o")) == Counter({(NS + "zzz", None): 1})


def test_optional_fills_in_an_unbound_subject(spark):
    source = TripleSource(triples(spark, GRAPH), deduplicated=True)
    df = values(spark, s=[NS + "a", None], k=["http://k/1", "http://k/2"], o=[None, NS + "c"])
    got = found(optional(df, source, ("?s", NS + "p", "?o")), ("s", "k", "o"))
    assert got == Counter({(NS + "a", "http://k/1", NS + "b"): 1, (NS + "b", "http://k/2", NS + "c"): 1})


def test_a_product_is_refused_while_it_runs_and_not_lost(spark):
    left = values(spark, x=[None, "http://x/1"], k=["http://k/1", "http://k/2"])
    right = values(spark, x=["http://x/1"], v=["http://v/1"])
    with pytest.raises(PySparkException, match="bind none of x"):
        natural_join(left, right).collect()
    # With nothing on the other side there is no product to refuse.
    assert optional_join(left, right.where("false")).count() == 2
    with pytest.raises(UnsupportedClause):
        natural_join(left.select("k"), right)
    assert minus(left.select("k"), right).count() == 2


def test_plain_patterns_are_joined_once(spark):
    source = TripleSource(triples(spark, GRAPH), deduplicated=True)
    df = match(source, ("?s", NS + "p", "?o"), ("?o", NS + "q", "?x"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert not any(df.schema[c].nullable for c in df.columns)
