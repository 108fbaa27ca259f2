"""Structured queries over small graphs: the semantics no table can show."""

import pytest

from graphs import NS, PEOPLE, engine, field, rows
from linkframe import InvalidQuery, UnsupportedClause, ask
from linkframe.catalog import declared
from linkframe.catalog.model import Catalog, FieldMeta, TableMeta
from linkframe.naming import Naming
from linkframe.operators.patterns import match
from pyspark.sql import functions as F

LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
LABEL_VAR = "http___www_w3_org_2000_01_rdf_schema_label"


def catalog(**tables):
    naming = Naming.of(NS)
    made = Catalog(naming)
    for name, fields in tables.items():
        made.add(TableMeta(name, NS + name, name, ""), fields)
    return made


def meta(name, **more):
    return FieldMeta(name, name if ":" in name else NS + name, **more)


@pytest.fixture(scope="module")
def people(spark):
    return engine(spark, PEOPLE, catalog(
        Person=[meta(LABEL), meta("age", base_type="Integer"), meta("likes", database_type="uri")],
        Company=[meta(LABEL)]))


def test_fields(people):
    result = people.query({"source-table": "Person", "fields": [field(LABEL), field("age")]})
    assert result.names == ["subject", LABEL_VAR, "age"]
    assert rows(result) == [(NS + "ann", "Ann", 41), (NS + "bea", "Bea", 29)]


def test_default_projection_of_all_columns(people):
    expected = [dict(name="subject"), dict(name=LABEL), dict(name="age"), dict(name="likes")]
    result = people.query({"source-table": "Person"}, expected)
    assert rows(result) == [(NS + "ann", "Ann", 41, NS + "bea"), (NS + "bea", "Bea", 29, None)]


@pytest.mark.parametrize("clause, found", [
    (["=", field(LABEL), "Ann"], ["ann"]),
    (["!=", field(LABEL), "Ann"], ["bea"]),
    (["=", field("subject"), NS + "ann"], ["ann"]),
    (["=", field("likes"), NS + "bea"], ["ann"]),
    (["!=", field("likes"), NS + "zed"], ["ann"]),
    (["=", field("likes"), "bea"], []),
    (["between", field("age"), 30, 50], ["ann"]),
    (["<", field("age"), 29.5], ["bea"]),
    (["=", field("age"), 41.0], ["ann"]),
    (["=", field("age"), "41"], []),
    (["!=", field("age"), "41"], []),
    (["is-null", field("likes")], ["bea"]),
    (["not", ["is-null", field("likes")]], ["ann"]),
    (["and", [">", field("age"), 1], ["<", field("age"), 100], ["=", field(LABEL), "Bea"]], ["bea"]),
    (["or", ["=", field("age"), 1], ["=", field("age"), 2], ["=", field("age"), 29]], ["bea"]),
    (["contains", field(LABEL), "EA", {"case-sensitive": False}], ["bea"]),
    (["contains", field("subject"), "/ann"], ["ann"]),
    (["starts-with", field("age"), "4"], ["ann"]),
])
def test_filters(people, clause, found):
    result = people.query({"source-table": "Person", "filter": clause})
    assert rows(result) == [(NS + n,) for n in found]


def test_sort_and_limit(people):
    result = people.query({"source-table": "Person", "fields": [field("age")],
                           "order-by": [["desc", field("age")]], "limit": 1})
    assert rows(result) == [(NS + "ann", 41)]


def test_counts_and_second_stage(people):
    assert rows(people.query({"source-table": "Person", "aggregation": [["count"]]})) == [(2,)]
    by_label = {"source-table": "Person", "aggregation": [["count"]], "breakout": [field(LABEL)]}
    assert rows(people.query(by_label)) == [("Ann", 1), ("Bea", 1)]
    for floor, left in ((0, 2), (5, 0)):
        outer = people.query({"source-query": by_label, "filter": [">", field("count"), floor]})
        assert len(outer.names) == 2 and len(rows(outer)) == left


def test_ask(people):
    df = match(people.source, ("?s", "a", NS + "Person"))
    assert [tuple(r) for r in ask(df).collect()] == [(True,)]
    assert ask(df.where(F.col("s.value") == "no")).first()["boolean"] is False


MULTI = """
:s1 a :T ; :p 1 , 2 ; :q "x" , "y" .
:s2 a :T ; :q "z" .
:s3 a :T .
:s9 a :Other ; :p 7 .
"""


@pytest.mark.parametrize("deduplicated", [True, False])
def test_values_fan_out_but_subjects_count_once(spark, deduplicated):
    graph = engine(spark, MULTI, deduplicated=deduplicated)
    result = graph.query({"source-table": "T", "fields": [field("p"), field("q")]})
    assert len(rows(result)) == 4 + 1 + 1
    counts = graph.query({"source-table": "T", "aggregation": [
        ["count"], ["count", field("p")], ["distinct", field("p")], ["sum", field("p")]],
        "filter": ["or", ["is-null", field("q")], ["not-null", field("q")]]})
    # COUNT(p) and SUM(p) see each value once per value of q.
    assert rows(counts) == [(3, 4, 2, 6)]


def test_duplicate_triples_are_one(spark):
    from linkframe import Engine, EngineConfig, TripleSource
    from graphs import triples

    one = triples(spark, MULTI)
    doubled = Engine(TripleSource(one.union(one)), EngineConfig(default_graph=NS, metadata_sync_strategy="none"))
    assert len(rows(doubled.query({"source-table": "T", "fields": [field("p"), field("q")]}))) == 6


FRIENDS = """
:a a :P ; :name "A" ; :knows :b .
:b a :P ; :name "B" .
:c a :P ; :name "C" ; :knows :b , :a .
:d a :Q ; :name "D" .
"""
KNOWS = {"alias": "Friend", "source-table": "P", "fk-field-id": "knows"}


def test_self_join_and_unbound_key(spark):
    graph = engine(spark, FRIENDS)
    result = graph.query({"source-table": "P", "joins": [KNOWS], "fields": [field("name"), field("name", "Friend")]})
    assert rows(result) == [(NS + "a", "A", "B"), (NS + "b", "B", None), (NS + "c", "C", "A"), (NS + "c", "C", "B")]


def test_a_join_target_needs_no_class(spark):
    graph = engine(spark, ":a a :P ; :knows :d . :d a :Q ; :name \"D\" . :e a :P ; :knows \"literal\" .")
    result = graph.query({"source-table": "P", "joins": [KNOWS],
                          "fields": [field("name", "Friend"), field("subject", "Friend")]})
    assert rows(result, "text") == [(NS + "a", "D", NS + "d"), (NS + "e", None, "literal")]


def test_chained_joins_in_any_order(spark):
    graph = engine(spark, """
        :i1 a :Item ; :provider :p1 . :i2 a :Item ; :provider :p1 . :i3 a :Item ; :provider :p2 . :i4 a :Item .
        :p1 a :Provider ; :owner :o1 . :p2 a :Provider . :o1 a :Owner ; :owner_name "Olga" .
    """, catalog(Item=[meta("provider", semantic_type="FK")], Provider=[meta("owner", semantic_type="FK")],
                 Owner=[meta("owner_name")]))
    by_id = {f.name: f.id for t in ("Item", "Provider", "Owner") for f in graph.catalog.fields(t)}
    explicit = [
        {"alias": "Owner", "source-table": "Owner",
         "condition": ["=", field("owner", "Provider"), field("subject", "Owner")]},
        {"alias": "Provider", "source-table": "Provider",
         "condition": ["=", field("provider"), field("subject", "Provider")]}]
    implicit = [
        {"alias": "Provider", "source-table": "Provider", "fk-field-id": by_id["provider"]},
        {"alias": "Owner", "source-table": "Owner", "fk-field-id": by_id["owner"]}]
    for joins in (explicit, implicit):
        result = graph.query({"source-table": "Item", "joins": joins, "aggregation": [["distinct", field("subject")]],
                              "breakout": [["field", by_id["owner_name"], {"join-alias": "Owner"}]]})
        assert result.names == ["Owner__owner_name", "ag_0"]
        assert rows(result) == [("Olga", 2), (None, 2)]


LANGUAGES = """
:en a :L ; :text "hello"@en . :nl a :L ; :text "hallo"@nl . :both a :L ; :text "hi"@en , "hoi"@nl .
:plain a :L ; :text "42" . :none a :L .
"""


def test_other_languages_leave_unbound_stays(spark):
    tagged = catalog(L=[meta("text", database_type="langString")])
    graph = engine(spark, LANGUAGES, tagged, default_language="nl")
    result = graph.query({"source-table": "L", "fields": [field("text")]})
    assert rows(result) == [(NS + "both", "hoi"), (NS + "nl", "hallo"), (NS + "none", None), (NS + "plain", "42")]
    shouted = engine(spark, LANGUAGES, tagged, default_language="NL")
    assert rows(shouted.query({"source-table": "L", "fields": [field("text")]})) == rows(result)
    unread = graph.query({"source-table": "L"})
    assert len(rows(unread)) == 5
    expected = graph.query({"source-table": "L"}, [dict(name="text")])
    assert rows(expected, "text") == [("42",), ("hallo",), ("hoi",), (None,)]


MIXED = """
:i a :M ; :v 10 . :d a :M ; :v 2.5e0 . :s a :M ; :v "ten" . :u a :M ; :v :ten . :t a :M ; :v "ten"@en .
:b a :M ; :v true . :w a :M ; :v "2020-05-01"^^xsd:date .
"""


@pytest.mark.parametrize("clause, found", [
    ([">", field("v"), 3], ["i"]),
    (["<=", field("v"), 10], ["d", "i"]),
    (["=", field("v"), "ten"], ["s"]),
    (["!=", field("v"), "ten"], ["u"]),
    (["=", field("v"), True], ["b"]),
    ([">", field("v"), "2020-01-01"], ["s", "w"]),
    (["contains", field("v"), "ten"], ["s", "t", "u"]),
])
def test_mixed_values_compare_within_their_family(spark, clause, found):
    assert rows(engine(spark, MIXED).query({"source-table": "M", "filter": clause})) == [(NS + n,) for n in found]


def test_order_of_mixed_values(spark):
    result = engine(spark, MIXED + ":z a :M .").query(
        {"source-table": "M", "fields": [field("v")], "order-by": [["asc", field("v")]]})
    assert [r["v"] for r in result.to_df("text").collect()] == [
        None, NS + "ten", "2.5e0", "10", "2020-05-01", "ten", "ten", "true"]


def test_aggregates_of_terms(spark):
    graph = engine(spark, """
        :a a :N ; :k "x" ; :v 2 . :b a :N ; :k "x" ; :v 40 . :c a :N ; :k "y" ; :v 1 . :d a :N ; :k "y" ; :v 0.5 .
        :e a :N ; :k "z" . :f a :N ; :k "w" ; :v 1 . :g a :N ; :k "w" ; :v "one" .
    """)
    result = graph.query({"source-table": "N", "breakout": [field("k")], "aggregation": [
        ["sum", field("v")], ["avg", field("v")], ["min", field("v")], ["max", field("v")], ["count", field("v")]]})
    assert rows(result, "text") == [
        ("w", None, None, "1", "one", 2), ("x", "42", 21.0, "2", "40", 2),
        ("y", "1.5", 0.75, "0.5", "1", 2), ("z", None, None, None, None, 0)]


def test_names_that_look_alike_stay_apart(spark):
    graph = engine(spark, ':x a :C ; <https://graph.test/a-b> 1 ; <https://graph.test/a.b> 2 ; :id 3 .')
    result = graph.query({"source-table": "C", "fields": [field("a-b"), field("a.b"), field("id")]})
    assert result.names == ["subject", "a_b", "a_b_2", "id"]
    assert rows(result) == [(NS + "x", 1, 2, 3)]


@pytest.mark.parametrize("hostile", ['a"b', "back\\slash", "new\nline", "$1 {{other}}", "x> } UNION {", "'; --"])
def test_hostile_strings_are_only_values(spark, hostile):
    graph = engine(spark, ":x a :C ; :v 1 .")
    for clause in (["=", field("v"), hostile], ["contains", field("v"), hostile], ["=", field("subject"), "http://" + hostile]):
        assert rows(graph.query({"source-table": "C", "filter": clause})) == []


@pytest.mark.parametrize("query", [
    {"source-table": "P", "filter": ["matches", field("name"), "x"]},
    {"source-table": "P", "filter": ["=", ["+", field("name"), 1], 2]},
    {"source-table": "P", "aggregation": [["stddev", field("name")]]},
    {"source-table": "P", "aggregation": [["cum-sum", field("name")]]},
    {"source-table": "P", "joins": [dict(KNOWS, strategy="inner-join")]},
    {"source-table": "P", "joins": [{"alias": "X", "source-table": "P",
                                     "condition": ["<", field("knows"), field("subject", "X")]}]},
    {"source-table": "P", "joins": [{"alias": "X", "source-table": "P",
                                     "condition": ["=", field("knows"), field("name", "X")]}]},
    {"source-table": "P", "expressions": {}},
    {"source-table": "P", "page": {"page": 1}},
])
def test_what_is_not_supported_says_so(spark, query):
    with pytest.raises(UnsupportedClause):
        engine(spark, FRIENDS).query(query)


@pytest.mark.parametrize("query", [
    {},
    {"source-table": "P", "source-query": {"source-table": "P"}},
    {"source-table": "P", "limit": "5"},
    {"source-table": "P", "fields": [field("name", "Nowhere")]},
    {"source-table": "P", "filter": ["between", field("name"), 1]},
    {"source-table": "P", "aggregation": [["sum"]]},
    {"source-table": "P", "aggregation": [["count"]], "order-by": [["asc", ["aggregation", 3]]]},
    {"source-query": {"source-table": "P"}, "fields": [field("missing")]},
])
def test_mistakes_are_reported(spark, query):
    with pytest.raises(InvalidQuery):
        engine(spark, FRIENDS).query(query)


def test_unknown_fields_of_a_known_table(spark):
    known = declared.explicit_catalog({"tables": [{"name": NS + "P", "fields": [NS + "name"]}]}, Naming.of(NS))
    with pytest.raises(InvalidQuery, match="belongs to no table"):
        engine(spark, FRIENDS, known).query({"source-table": "P", "fields": [field("nmae")]})
