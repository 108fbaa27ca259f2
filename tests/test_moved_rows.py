"""A class's rows are moved before they are unfolded into triples, or not unfolded at all."""

import pytest
from pyspark.sql import functions as F

from graphs import NS
from linkframe import ClassMapping, MappedSource, Property
from linkframe import vocab as V
from linkframe.catalog import discovery
from linkframe.operators.patterns import Literal, match
from linkframe.sources.triples import VirtualTriples


@pytest.fixture(scope="module")
def mapped(spark):
    """Keys that repeat, null keys, null values, lists with repeats and nulls, and a class without rows."""
    people = spark.createDataFrame(
        [(1, "x", 7, [1, 1, None, 2], "de"), (1, "y", None, None, None), (2, None, 7, [], "fr"), (None, "z", 8, [3], None), (3, "x", 9, [None], None)],
        "s int, times string, town int, n array<int>, lang string")
    plain = {c: Property(c) for c in ("s", "n")}
    return MappedSource(NS, {
        "Person": ClassMapping(people, "s", {**plain, "name": Property("times", lang="lang"), "town": Property("town", references="Town")}),
        "Row": ClassMapping(people, "*", plain),
        "Town": ClassMapping(spark.createDataFrame([(7,), (8,)], "k int"), "k", {"k": Property("k")}),
        "None": ClassMapping(spark.createDataFrame([], "k int"), "k", {"k": Property("k")})})


CLASSES = [NS + c for c in ("Person", "Row", "Town", "None")]


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("virtual", [False, True])
def test_properties_equal_those_counted_over_joined_triples(mapped, virtual):
    source = VirtualTriples(mapped) if virtual else mapped
    found = discovery.properties(source, CLASSES)
    members = [mapped.members(c).select("s", F.lit(c).alias("class")) for c in CLASSES]
    everything = members[0].union(members[1]).union(members[2]).union(members[3])
    joined = mapped.triples().join(everything, "s").groupBy("class", F.col("p").alias("property")).agg(
        F.count(F.lit(1)).alias("count"), F.min(F.when(F.col("o.kind") == V.IRI, 1).otherwise(0)).alias("is_iri"))
    assert rows(found) == rows(joined)
    assert found.where((F.col("class") == CLASSES[0]) & (F.col("property") == V.RDF_TYPE)).first()["count"] == 2 * 2 + 1 + 1


def test_properties_are_counted_without_unfolding_or_broadcast(mapped):
    text = plan(discovery.properties(mapped, CLASSES))
    assert "explode" not in text and "BroadcastHashJoin" not in text


def test_classes_inside_each_other_are_counted_over_their_triples(spark):
    outer = spark.createDataFrame([("in/1", 5), ("b", 6)], "k string, v int")
    inner = spark.createDataFrame([(1, 7)], "k int, w int")
    source = MappedSource(NS, {"A": ClassMapping(outer, "k", {"v": Property("v")}), "A/in": ClassMapping(inner, "k", {"w": Property("w")})})
    found = {(r["class"], r["property"]): r["count"] for r in discovery.properties(source, [NS + "A", NS + "A/in"]).collect()}
    assert found[NS + "A", NS + "v"] == 2 and found[NS + "A", NS + "w"] == 1 and found[NS + "A/in", NS + "v"] == 1


@pytest.mark.parametrize("cls", ["Person", "Row", "None"])
@pytest.mark.parametrize("first", [0, 1])
def test_all_triples_of_a_class_equal_those_joined_to_its_members(mapped, cls, first):
    patterns = [("?s", "a", NS + cls), ("?s", "?p", "?o")]
    found = match(VirtualTriples(mapped), *(patterns if first == 0 else patterns[::-1])).select(F.col("s.value").alias("s"), F.col("p.value").alias("p"), "o")
    joined = mapped.triples().join(mapped.members(NS + cls), "s").select("s", "p", "o")
    assert rows(found) == rows(joined)


def test_rows_are_unfolded_after_they_are_moved(mapped):
    df = match(VirtualTriples(mapped), ("?s", "a", NS + "Person"), ("?s", "?p", "?o")).groupBy("p.value").count()
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.index("Generate explode(") < text.index("Window [")


def test_other_patterns_are_joined_to_them(mapped):
    patterns = [("?s", "a", NS + "Person"), ("?s", "?p", Literal(7)), ("?s", NS + "town", "?town")]
    graph = VirtualTriples(mapped)
    found = match(graph, *patterns).select("s.value", "p.value", "town.value")
    assert rows(found) == rows(match(graph, patterns[1], patterns[2], patterns[0]).select("s.value", "p.value", "town.value"))
