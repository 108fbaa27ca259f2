"""RDF classes as Spark tables: structured and native queries over graphs."""

from linkframe.config import EngineConfig
from linkframe.engine import Engine
from linkframe.errors import InvalidQuery, LinkframeError, SourceError, UnsupportedClause
from linkframe.results import QueryResult, ask
from linkframe.sources.mapped import ClassMapping, MappedSource, Property
from linkframe.sources.ntriples import read_ntriples
from linkframe.sources.triples import TripleSource, write_triples

__all__ = [
    "ClassMapping", "Engine", "EngineConfig", "InvalidQuery", "LinkframeError", "MappedSource",
    "Property", "QueryResult", "SourceError", "TripleSource", "UnsupportedClause", "ask",
    "read_ntriples", "write_triples",
]
