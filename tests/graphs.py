"""Small graphs for tests, written in Turtle, and the folder of the smallest tables."""

from linkframe import Engine, EngineConfig, TripleSource
from linkframe.sources import turtle
from linkframe.sources.triples import triples_from_terms

SMALL = "/root/testdata/sf0.001"
NS = "https://graph.test/"
PREFIXES = f"""
@prefix : <{NS}> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
"""
PEOPLE = """
:ann a :Person ; rdfs:label "Ann" ; :age 41 ; :likes :bea .
:bea a :Person ; rdfs:label "Bea" ; :age 29 .
:shop a :Company ; rdfs:label "The Shop" .
"""


def triples(spark, body):
    return triples_from_terms(spark, turtle.parse(PREFIXES + body))


def engine(spark, body, catalog=None, deduplicated=True, **settings):
    source = TripleSource(triples(spark, body), deduplicated=deduplicated, hot={})
    if catalog is None:
        settings.setdefault("metadata_sync_strategy", "none")
    return Engine(source, EngineConfig(default_graph=NS, **settings), catalog=catalog)


def field(name, alias=None):
    return ["field", name, {"join-alias": alias} if alias else None]


def rows(result, typing="observed"):
    df = result.to_df(typing)
    return sorted((tuple(r) for r in df.collect()), key=repr)
