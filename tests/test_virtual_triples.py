"""Triples of mapped tables: constants become native keys, properties of one table come from one scan."""

import pytest

import workload
from graphs import SMALL, field
from linkframe import ClassMapping, Engine, EngineConfig, MappedSource, Property, TripleSource
from linkframe.operators.patterns import Literal, match
from linkframe.sources import endpoint
from linkframe.sources.triples import VirtualTriples

BASE = "https://m.test/"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, pushed", [
    ("native_subject_constant", "EqualTo(c_custkey,5)"), ("native_object_constant", "EqualTo(c_nationkey,7)"),
    ("native_all_of_subject", "EqualTo(c_custkey,5)"), ("triples_filter_iri_subject", "EqualTo(c_custkey,42)"),
    ("triples_filter_iri_fk", "EqualTo(c_nationkey,7)"), ("native_star_join", "EqualTo(c_mktsegment,BUILDING)")])
def test_constants_reach_the_scan(spark, name, pushed):
    assert pushed in plan(workload.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name, scans, joins", [
    ("triples_order_topk", 1, 0), ("triples_join_chain_3", 4, 3), ("native_object_constant", 1, 0), ("native_star_join", 3, 2)])
def test_one_scan_per_class(spark, name, scans, joins):
    text = plan(workload.QUERIES[name](spark, SMALL))
    assert (text.count("FileScan"), len([x for x in text.splitlines() if "Join" in x.split("[")[0]])) == (scans, joins)


@pytest.fixture(scope="module")
def sources(spark):
    """A mapped source and, as a table, the same triples; class Thing/Part lies inside the IRIs of class Thing."""
    thing = spark.createDataFrame(
        [("a", "one", [1, None, 1], "b"), ("b", None, [], None), ("Part/1", "two", None, "a"), ("c", "one", [3, 4], "Part/1")],
        "id string, title string, nums array<int>, next string")
    part = spark.createDataFrame([(1, "inner"), (2, None)], "id int, title string")
    plain = spark.createDataFrame([(1, "x", [2, 3], 7), (2, "x", None, None), (3, None, [None], 7)], "id int, name string, nums array<int>, size int")
    mapped = MappedSource(BASE, {
        "Thing": ClassMapping(thing, "id", {"title": Property("title"), "nums": Property("nums"), "next": Property("next", references="Thing")}),
        "Thing/Part": ClassMapping(part, "id", {"title": Property("title")}),
        "Plain": ClassMapping(plain, "id", {"name": Property("name"), "pnums": Property("nums"), "size": Property("size")})})
    return mapped, VirtualTriples(mapped), TripleSource(mapped.triples())


PATTERNS = [
    [("?s", "a", BASE + "Plain"), ("?s", BASE + "name", "?n"), ("?s", BASE + "pnums", "?v")],
    [("?s", BASE + "name", "?n"), ("?s", BASE + "name", "?m"), ("?s", BASE + "size", "?n2")],
    [("?s", BASE + "name", Literal("x")), ("?s", BASE + "size", Literal(7))],
    [("?s", BASE + "name", "?v"), ("?s", BASE + "size", "?v")],
    [("?s", BASE + "name", BASE + "Plain/1"), ("?s", BASE + "size", "?v")],
    [("?s", "a", "?c"), ("?s", BASE + "title", "?t")],
    [("?s", "a", BASE + "Thing"), ("?s", BASE + "title", "?t"), ("?s", BASE + "nums", "?v")],
    [("?s", "a", BASE + "Thing/Part"), ("?s", BASE + "next", "?t")],
    [("?s", BASE + "next", BASE + "Thing/a"), ("?s", BASE + "title", "?t")],
    [("?s", BASE + "next", "?t"), ("?t", BASE + "title", "?u"), ("?t", BASE + "next", "?w")],
    [(BASE + "Thing/Part/1", "?p", "?o")], [(BASE + "Plain/1", "?p", "?o")], [(BASE + "Plain/01", BASE + "name", "?o")],
    [("https://elsewhere.test/1", "?p", "?o")], [("?s", "?p", BASE + "Thing/Part/1")],
    [(BASE + "Thing/a", BASE + "nums", "?v")], [("?s", "a", BASE + "Nothing")],
]


@pytest.mark.parametrize("patterns", PATTERNS)
def test_patterns_equal_those_over_the_written_triples(sources, patterns):
    _, virtual, table = sources
    found = [match(s, *patterns) for s in (virtual, table)]
    columns = sorted(found[1].columns)
    got, expected = (sorted((tuple(r) for r in df.select(columns).collect()), key=repr) for df in found)
    assert got == expected


@pytest.mark.parametrize("cls, names", [("Plain", ["name", "pnums", "size"]), ("Thing", ["title", "nums", "next"]), ("Thing/Part", ["title"])])
def test_scans_equal_those_over_the_written_triples(sources, cls, names):
    mapped, virtual, table = sources
    query = {"source-table": BASE + cls, "fields": [field(BASE + n) for n in names]}
    engines = [Engine(s, EngineConfig(default_graph=BASE), mapped.catalog()) for s in (virtual, table)]
    for test in (None, ["=", field(BASE + names[0]), "x"], ["=", field("subject"), BASE + cls + "/1"], ["is-null", field(BASE + names[-1])]):
        asked = query if test is None else {**query, "filter": test}
        got, expected = (sorted((tuple(r) for r in e.query(asked).to_df("declared").collect()), key=repr) for e in engines)
        assert got == expected


def test_constants_go_to_the_endpoint_but_blank_nodes_do_not():
    assert endpoint.asked("<http://p>") == "?s <http://p> ?o"
    assert endpoint.asked("<http://p>", "http://s", "http://o") == "VALUES ?s { <http://s> } VALUES ?o { <http://o> } ?s <http://p> ?o"
    assert endpoint.asked("?p", "_:b1") == "?s ?p ?o"
