"""Aggregates over several multi-valued properties equal those over all combinations of values."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from graphs import NS, field
from linkframe import ClassMapping, Engine, EngineConfig, MappedSource, Property, TripleSource
from linkframe import vocab as V
from linkframe.functions import terms

TEAMS = ["red", "blue", "red", None, "blue"]


def members(seed):
    rng = random.Random(seed)
    pick = lambda: rng.sample(range(-5, 20), rng.choice([0, 1, 2, 5]))
    return [(f"s{i}", team, pick(), pick(), pick()) for i, team in enumerate(TEAMS * 3)]


def mapped_engine(spark, rows):
    df = spark.createDataFrame(rows, "k string, team string, a array<int>, b array<int>, c array<int>")
    source = MappedSource(NS, {"Team": ClassMapping(df, "k", {p: Property(p) for p in ("team", "a", "b", "c")})})
    return Engine(source, EngineConfig(default_graph=NS))


def triple_engine(spark, rows):
    found = []
    for k, team, *values in rows:
        found.append((NS + k, V.RDF_TYPE, (V.IRI, NS + "Team", "", "")))
        if team:
            found.append((NS + k, NS + "team", (V.LITERAL, team, V.XSD + "string", "")))
        for p, vs in zip("abc", values):
            found += [(NS + k, NS + p, (V.LITERAL, str(v), V.XSD + "integer", "")) for v in vs]
    return Engine(TripleSource(spark.createDataFrame(found, f"s string, p string, o {terms.TERM_TYPE}"), deduplicated=True),
                  EngineConfig(default_graph=NS, metadata_sync_strategy="none"))


AGGREGATIONS = [["count"], ["count", field("a")], ["sum", field("a")], ["avg", field("b")], ["min", field("b")],
                ["max", field("c")], ["distinct", field("a")], ["distinct", field("c")], ["sum", field("c")]]


def multiplied_out(rows, grouped, least=None):
    groups = {}
    for k, team, *values in rows:
        for a, b, c in itertools.product(*(vs or [None] for vs in values)):
            if least is None or (a is not None and a > least):
                groups.setdefault(team if grouped else None, []).append((k, a, b, c))
    if not grouped:
        groups.setdefault(None, [])

    def one(found):
        a, b, c = ([r[i] for r in found if r[i] is not None] for i in (1, 2, 3))
        return (len({r[0] for r in found}), len(a), sum(a) if a else None, sum(b) / len(b) if b else None, min(b, default=None),
                max(c, default=None), len(set(a)), len(set(c)), sum(c) if c else None)

    return sorted(((team,) if grouped else ()) + one(found) for team, found in groups.items()) if not grouped else sorted(
        ((team, *one(found)) for team, found in groups.items()), key=repr)


@pytest.mark.parametrize("make", [mapped_engine, triple_engine])
@pytest.mark.parametrize("least", [None, 4])
@pytest.mark.parametrize("grouped", [False, True])
def test_equals_all_combinations(spark, make, grouped, least):
    rows = members(11)
    query = {"source-table": "Team", "aggregation": AGGREGATIONS}
    if grouped:
        query["breakout"] = [field("team")]
    if least is not None:
        query["filter"] = [">", field("a"), least]
    df = make(spark, rows).query(query).to_df("text")
    numbers = [c for c in df.columns if c.startswith("ag_")]
    df = df.select(*([df.columns[0]] if grouped else []), *(F.col(c).cast("double") for c in numbers))
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(
        (tuple(float(x) if isinstance(x, int) else x for x in r) for r in multiplied_out(rows, grouped, least)), key=repr)


def test_ten_thousand_times_ten_thousand_values(spark):
    n = 10_000
    ids = spark.range(n)
    literal = lambda p: ids.select(F.lit(NS + "s").alias("s"), F.lit(NS + p).alias("p"), terms.literal_term(
        F.col("id").cast("string"), V.XSD + "integer", bound=True).alias("o"))
    kind = spark.range(1).select(F.lit(NS + "s").alias("s"), F.lit(V.RDF_TYPE).alias("p"), terms.iri_term(F.lit(NS + "T"), bound=True).alias("o"))
    engine = Engine(TripleSource(kind.unionByName(literal("a")).unionByName(literal("b")), deduplicated=True),
                    EngineConfig(default_graph=NS, metadata_sync_strategy="none"))
    query = {"source-table": "T", "aggregation": [["count", field("a")], ["sum", field("b")], ["max", field("a")]]}
    got = engine.query(query).to_df("text").first()
    assert (int(got[0]), int(got[1]), int(got[2])) == (n * n, n * (n * (n - 1) // 2), n - 1)


def test_the_plan_joins_one_row_per_subject(spark):
    df = triple_engine(spark, members(3)).query({"source-table": "Team", "aggregation": [["sum", field("a")], ["sum", field("b")]]}).to_df("text")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter") == 2 and text.count("Aggregate [s") >= 2
