"""The stored triple table: layout, hot subjects, and graph patterns over it."""

import pytest
from pyspark.sql import functions as F

from graphs import NS, field, rows, triples
from linkframe import Engine, EngineConfig, InvalidQuery, TripleSource, UnsupportedClause, write_triples
from linkframe.functions import terms
from linkframe.operators.patterns import Literal, exists, match, not_exists, optional, values
from linkframe.sources import triples as T

BODY = """
:a a :C ; :p 1 , 2 , 3 , 4 , 5 , 6 , 7 , 8 , 9 , 10 ; :q :b . :b a :C ; :p 1 ; :q :a , :b . :c a :C .
:d a :D ; :p 5 ; :q :a .
"""


def bound(source):
    return Engine(source, EngineConfig(default_graph=NS, metadata_sync_strategy="none"))


QUERIES = [
    {"source-table": "C", "fields": [field("p")]},
    {"source-table": "C", "fields": [field("p"), field("q")]},
    {"source-table": "C", "joins": [{"alias": "Q", "source-table": "C", "fk-field-id": "q"}],
     "fields": [field("p"), field("p", "Q")]},
    {"source-table": "C", "aggregation": [["count"], ["count", field("p")], ["sum", field("p")]],
     "breakout": [field("q")]},
    {"source-table": "C", "fields": [field("p")], "filter": ["is-null", field("p")]},
]


@pytest.mark.parametrize("query", QUERIES)
def test_salting_hot_subjects_changes_nothing(spark, query):
    plain = TripleSource(triples(spark, BODY), deduplicated=True)
    salted = TripleSource(triples(spark, BODY), deduplicated=True, hot={NS + "p": [NS + "a"], NS + "q": [NS + "b"]})
    assert rows(bound(salted).query(query)) == rows(bound(plain).query(query))


@pytest.mark.parametrize("query", QUERIES)
def test_listed_subjects_without_values_are_ordinary_rows(spark, query):
    every = [NS + n for n in "abcdxyz"]
    plain = TripleSource(triples(spark, BODY), deduplicated=True)
    listed = TripleSource(triples(spark, BODY), deduplicated=True, hot={NS + "p": every, NS + "q": every, NS + "n": every})
    assert rows(bound(listed).query(query)) == rows(bound(plain).query(query))


def test_hot_subjects_are_found_and_bounded(spark):
    found = T.hot_subjects(triples(spark, BODY), least=5).collect()
    assert [tuple(r) for r in found] == [(NS + "p", NS + "a")]
    assert T.hot_subjects(triples(spark, BODY)).collect() == []
    assert TripleSource(triples(spark, BODY)).hot == {}


def test_written_table_answers_like_the_plain_one(spark, tmp_path):
    doubled = triples(spark, BODY).union(triples(spark, BODY))
    stored = write_triples(doubled, str(tmp_path / "kg"), least_hot=5)
    assert stored.hot == {NS + "p": [NS + "a"]}
    again = TripleSource.open(spark, str(tmp_path / "kg"))
    for query in QUERIES:
        assert rows(bound(again).query(query)) == rows(bound(TripleSource(triples(spark, BODY))).query(query))
    plan = again.slice(NS + "q")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_filters_reach_the_stored_table(spark, tmp_path):
    graph = bound(write_triples(triples(spark, BODY + ':a :n "x" . :b :n "y" .'), str(tmp_path / "kg")))
    scans = lambda df: [l for l in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l]
    by_subject = graph.query({"source-table": "C", "fields": [field("p")], "filter": ["=", field("subject"), NS + "a"]})
    assert rows(by_subject)[0] == (NS + "a", 1) and len(rows(by_subject)) == 10
    assert all(f"EqualTo(s,{NS}a)" in l or "IsNotNull(o.kind)" in l for l in scans(by_subject.to_df("text")))
    # The filtered property is joined before the one that is only shown.
    by_value = graph.query({"source-table": "C", "fields": [field("p")], "filter": ["=", field("n"), "y"]})
    assert rows(by_value) == [(NS + "b", 1)]
    found = scans(by_value.to_df("text"))
    assert [("EqualTo(o.value,y)" in l) for l in found] == [False, True, False]


def test_bucketed_table_joins_without_a_shuffle(spark, tmp_path):
    doubled = triples(spark, BODY).union(triples(spark, BODY))
    saved = T.save_triples(doubled, "kg_test", str(tmp_path / "kg"), buckets=4, least_hot=1000)
    try:
        for query in QUERIES:
            assert rows(bound(saved).query(query)) == rows(bound(TripleSource(triples(spark, BODY))).query(query))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        star = bound(saved).query(QUERIES[1]).to_df("text")
        assert "Exchange" not in star._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE kg_test")
        spark.sql("DROP TABLE kg_test_hot")


def test_default_graph(spark):
    quads = triples(spark, BODY).withColumn("g", F.lit("http://g1")).unionByName(
        triples(spark, ":z a :C .").withColumn("g", F.lit("http://g2")))
    query = {"source-table": "C", "aggregation": [["count"]]}
    assert rows(bound(TripleSource(quads, default_graph="http://g2")).query(query)) == [(1,)]
    assert rows(bound(TripleSource(quads)).query(query)) == [(4,)]
    with pytest.raises(InvalidQuery):
        TripleSource(triples(spark, BODY), default_graph="http://g2")


def test_graphs_are_kept_in_stored_tables(spark, tmp_path):
    one, two = (triples(spark, BODY).withColumn("g", F.lit(g)) for g in ("http://g1", "http://g2"))
    query = {"source-table": "C", "aggregation": [["count"], ["count", field("p")]]}
    alone = rows(bound(TripleSource(triples(spark, BODY))).query(query))
    quads = one.unionByName(two).unionByName(triples(spark, ":z a :C .").withColumn("g", F.lit("http://g2")))
    write_triples(quads, str(tmp_path / "kg"))
    assert rows(bound(TripleSource.open(spark, str(tmp_path / "kg"), "http://g1")).query(query)) == alone
    assert rows(bound(TripleSource.open(spark, str(tmp_path / "kg"), "http://g2")).query(query)) == [(alone[0][0] + 1, alone[0][1])]
    assert rows(bound(TripleSource.open(spark, str(tmp_path / "kg"))).query(query)) == [(alone[0][0] + 1, alone[0][1])]


PEOPLE = """
:ann :name "Ann" ; :age 41 ; :knows :bea , :cid . :bea :name "Bea"@en ; :knows :ann . :cid :name "Cid" ; :self :cid .
:dee :alias "Ann" .
"""


def texts(df):
    return sorted(tuple(None if v is None else v["value"].removeprefix(NS) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def graph(spark):
    return TripleSource(triples(spark, PEOPLE), deduplicated=True)


def test_match_joins_on_shared_variables(graph):
    df = match(graph, ("?y", NS + "name", "?n"), ("?x", NS + "knows", "?y"), ("?x", NS + "age", "?a"))
    assert texts(df.select("x", "y", "n")) == [("ann", "bea", "Bea"), ("ann", "cid", "Cid")]


def test_match_constants_and_repeats(graph):
    assert texts(match(graph, ("?x", NS + "name", Literal("Ann")))) == [("ann",)]
    assert texts(match(graph, ("?x", NS + "name", Literal("Bea")))) == []
    assert texts(match(graph, ("?x", NS + "name", Literal("Bea", lang="en")))) == [("bea",)]
    assert texts(match(graph, ("?x", NS + "age", Literal(41)))) == [("ann",)]
    assert texts(match(graph, (NS + "bea", "?p", NS + "ann"))) == [("knows",)]
    assert texts(match(graph, ("?x", NS + "self", "?x"))) == [("cid",)]
    assert texts(match(graph, ("?x", NS + "name", "?v"), ("?y", NS + "alias", "?v"))) == [("ann", "Ann", "dee")]


def test_optional_and_exists(graph):
    people = match(graph, ("?x", NS + "name", "?n")).select("x")
    assert texts(optional(people, graph, ("?x", NS + "age", "?a"))) == [("ann", "41"), ("bea", None), ("cid", None)]
    known = optional(people, graph, ("?y", NS + "knows", "?x"))
    assert texts(known) == [("ann", "bea"), ("bea", "ann"), ("cid", "ann")]
    two = optional(people, graph, ("?x", NS + "knows", "?y"), ("?y", NS + "age", "?a"))
    assert texts(two) == [("ann", None, None), ("bea", "ann", "41"), ("cid", None, None)]
    assert texts(exists(people, graph, ("?x", NS + "knows", "?y"))) == [("ann",), ("bea",)]
    assert texts(not_exists(people, graph, ("?x", NS + "knows", "?y"))) == [("cid",)]


def test_values(spark, graph):
    wanted = values(spark, x=[NS + "bea", NS + "nobody"], n=[Literal(1), Literal("two")])
    assert texts(wanted) == [("bea", "1"), ("nobody", "two")]
    assert texts(exists(wanted, graph, ("?x", NS + "knows", "?y"))) == [("bea", "1")]
    with pytest.raises(InvalidQuery):
        values(spark, x=[NS], y=[])


def test_patterns_must_be_linked(graph):
    with pytest.raises(UnsupportedClause):
        match(graph, ("?x", NS + "name", "?n"), ("?y", NS + "age", "?a"))
    with pytest.raises(UnsupportedClause):
        match(graph, (NS + "ann", NS + "name", Literal("Ann")))


def test_term_functions(spark):
    df = triples(spark, ':x :v 5 . :y :v "a"@en . :z :v :x . :w :v _:b . :u :v "t" . :t :v true .').select("s", "o")
    o = F.col("o")
    got = {r[0].removeprefix(NS): tuple(r)[1:] for r in df.select(
        "s", terms.text(o), terms.lang(o), terms.datatype(o), terms.number(o), terms.is_iri(o), terms.boolean(o)).collect()}
    xsd = "http://www.w3.org/2001/XMLSchema#"
    assert got["x"] == ("5", "", xsd + "integer", 5.0, False, None)
    assert got["y"][:2] == ("a", "en") and got["y"][2].endswith("langString")
    assert got["z"] == (NS + "x", None, None, None, True, None)
    assert got["w"] == (None, None, None, None, False, None)
    assert got["u"][2] == xsd + "string" and got["t"][5] is True


def test_optional_class_pattern(spark):
    source = TripleSource(triples(spark, PEOPLE + ":ann a :Person ."))
    df = optional(match(source, ("?x", NS + "age", "?a")), source, ("?x", "a", "?t"))
    assert [r["t"]["value"] for r in df.collect()] == [NS + "Person"]


def test_nested_optionals_scan_each_pattern_once(spark, tmp_path):
    triples(spark, PEOPLE).write.parquet(str(tmp_path / "t"))
    source = TripleSource(spark.read.parquet(str(tmp_path / "t")), deduplicated=True)
    df = match(source, ("?x", NS + "name", "?n"))
    for k in range(3):
        df = optional(df, source, ("?x", NS + "knows", f"?k{k}"), (f"?k{k}", NS + "name", f"?n{k}"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 7
    assert df.count() > 0


def test_integers_beyond_a_double(spark):
    big = 9007199254740993
    graph = bound(TripleSource(triples(spark, f":a a :C ; :p {big} . :b a :C ; :p {big - 1} . :c a :C ; :p {big - 1} . :d a :C ; :p {10**30} . :e a :C ; :p {10**30 + 1} .")))
    ask = lambda *test: [r[0][-1] for r in rows(graph.query({"source-table": "C", "filter": list(test)}))]
    assert ask("=", field("p"), big) == ["a"] and ask("=", field("p"), big - 1) == ["b", "c"]
    assert ask(">", field("p"), big - 1) == ["a", "d", "e"] and ask("<", field("p"), big) == ["b", "c"]
    assert ask("=", field("p"), 10**30 + 1) == ["e"] and ask("between", field("p"), 10**30 + 1, 10**31) == ["e"]
    order = graph.query({"source-table": "C", "fields": [field("p")], "order-by": [["desc", field("p")]], "filter": [">", field("p"), big]})
    assert [r["subject"][-1] for r in order.to_df("text").collect()] == ["e", "d"]
    least = graph.query({"source-table": "C", "aggregation": [["max", field("p")]]}).to_df("text").first()[0]
    assert least == str(10**30 + 1)
