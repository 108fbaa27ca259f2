"""Schema strategies: declared JSON, SHACL shapes, discovery from data."""

import json

import pytest

from graphs import NS, PEOPLE, engine, field, rows
from linkframe import vocab as V
from linkframe.catalog import discovery, shacl
from linkframe.catalog.shacl import DEFAULT_ANNOTATIONS as NOTES, ShapeCache, a_text, a_type_name
from linkframe.errors import SourceError
from linkframe.naming import Naming
from linkframe.sources import turtle
from linkframe.sources.turtle import Term

SHAPES = f"""
@prefix sh: <{V.SHACL}> . @prefix xsd: <{V.XSD}> . @prefix rdf: <{V.RDF}> .
@prefix note: <{NOTES}> . @prefix : <{NS}> . @prefix far: <http://far.test/> .

:ThingShape a sh:NodeShape ; sh:targetClass :Thing ;
  sh:property [ sh:path :source ; sh:datatype xsd:string ; sh:description "where from" ] .

:AuthorShape sh:targetClass :Author ; sh:node :ThingShape , :Author ;
  sh:description "Schrijver"@nl , "Writer"@en ;
  sh:property :p_name , :p_born , :p_city , :p_page , :p_secret , :p_far .
:p_name sh:path :name ; sh:datatype rdf:langString ; sh:name "Naam"@nl , "Name"@en ; sh:order 1 .
:p_born sh:path :born ; sh:datatype xsd:integer ; sh:minCount 1 ; sh:order 2 .
:p_city sh:path :city ; sh:class :City ; sh:order 3 ; note:displayValueProperty :label .
:p_page sh:path :page ; sh:nodeKind sh:IRI ; sh:order 4 ; note:semanticType "type/URL" .
:p_secret sh:path :secret ; sh:datatype xsd:string ; note:hide true .
:p_far sh:path far:x ; sh:datatype xsd:anyURI .

:CityShape a sh:NodeShape ; sh:targetClass :City ;
  sh:property [ sh:path :label ; sh:datatype rdf:langString ] , [ sh:path :size ; sh:datatype xsd:decimal ; sh:minCount "few" ] .
"""


def shapes(text=SHAPES, language=""):
    return {s.class_iri: s for s in shacl.shapes(turtle.parse(text), language)}


def test_shapes():
    found = shapes(language="nl")
    author = found[NS + "Author"]
    assert set(found) == {NS + "Thing", NS + "Author", NS + "City"}
    assert author.description == "Schrijver"
    assert set(author.properties) == {NS + n for n in ("source", "name", "born", "city", "page")} | {"http://far.test/x"}
    name, born, city, page = (author.properties[NS + n] for n in ("name", "born", "city", "page"))
    assert name.lang_string and name.description == "Naam" and name.base_type == V.TEXT
    assert born.base_type == V.INTEGER and born.required and born.order == 2
    assert city.holds_iris and city.semantic_type == "FK" and city.target_class == NS + "City"
    assert page.holds_iris and page.semantic_type == "URL" and not page.required
    assert author.properties["http://far.test/x"].semantic_type == "URL"
    size = found[NS + "City"].properties[NS + "size"]
    assert size.base_type == V.FLOAT and not size.required


def test_inheritance_override_cycle_and_hidden_parent():
    found = shapes(f"""
        @prefix sh: <{V.SHACL}> . @prefix note: <{NOTES}> . @prefix : <{NS}> .
        :A sh:targetClass :a ; sh:node :B ; sh:property [ sh:path :p ; sh:order 1 ] .
        :B sh:targetClass :b ; sh:node :A , :H ; sh:property [ sh:path :p ; sh:order 2 ] , [ sh:path :q ] .
        :H sh:targetClass :h ; note:hide true ; sh:property [ sh:path :r ] .
        [ a sh:NodeShape ; sh:targetClass :anon ; sh:property [ sh:path :s ] ] .
        :N a sh:NodeShape ; sh:property [ sh:path :t ] .
        :A2 sh:targetClass :a ; sh:description "second" ; sh:property [ sh:path :p ; sh:order 9 ] .
    """)
    assert set(found) == {NS + "a", NS + "b", NS + "anon"}
    assert found[NS + "a"].properties[NS + "p"].order == 9 and found[NS + "a"].description == "second"
    assert set(found[NS + "a"].properties) == {NS + "p", NS + "q"}
    assert found[NS + "b"].properties[NS + "p"].order == 2
    assert set(found[NS + "anon"].properties) == {NS + "s"}


def test_localized_texts():
    texts = [Term("lit", "x", lang="en"), Term("lit", "y", lang="nl"), Term("lit", "z")]
    assert a_text(texts, "nl") == "y"
    assert a_text(texts, "de") == "z"
    assert a_text(texts[:2], "") == "x"
    assert a_text([Term("iri", "http://x")], "nl") is None


def test_semantic_types():
    given = ["type/URL", ":type/URL", "URL", " ", ""]
    assert [a_type_name([Term("lit", g)], "") for g in given] == ["URL", "URL", "URL", None, None]


def test_shacl_catalog():
    found = shacl.shapes(turtle.parse(SHAPES), "en")
    catalog = shacl.shacl_catalog(found, Naming.of(NS))
    assert [t.name for t in catalog.tables()] == ["Thing", "Author", "City"]
    assert catalog.table("Author").description == "Writer"
    assert catalog.table("City").description == f"RDF Class: {NS}City (SHACL)"
    fields = catalog.fields("Author")
    assert [f.name for f in fields] == ["subject", "name", "born", "city", "page", "http://far.test/x", "source"]
    assert [f.database_type for f in fields] == ["uri", "langString", "string", "uri", "uri", "string", "string"]
    assert [f.position for f in fields] == list(range(7)) and fields[0].pk
    key = catalog.foreign_keys()[0]
    assert (key.fk_table, key.fk_column, key.pk_table, key.pk_column) == ("Author", "city", "City", "subject")
    remap = catalog.display_remaps()[0]
    assert catalog.field_by_id(remap.fk_field).name == "city"
    assert catalog.field_by_id(remap.target_field).name == "label"
    hidden = shacl.shacl_catalog(found, Naming.of(NS), hide_foreign=True)
    assert "http://far.test/x" not in [f.name for f in hidden.fields("Author")]


def test_setting_a_remap_again_replaces_it():
    catalog = shacl.shacl_catalog(shacl.shapes(turtle.parse(SHAPES)), Naming.of(NS))
    assert catalog.set_display_remap("Author", "city", "City", "size") is not None
    assert catalog.set_display_remap("Author", "missing", "City", "size") is None
    assert [catalog.field_by_id(r.target_field).name for r in catalog.display_remaps()] == ["size"]


def test_shape_cache():
    now, reads = [0.0], []
    cache = ShapeCache(clock=lambda: now[0], read=lambda location, **kw: reads.append(location) or SHAPES)
    cache.load("u", "nl")
    cache.load("u", "nl")
    cache.load("u", "en")
    assert len(reads) == 2
    now[0] = 29.0
    cache.load("u", "nl")
    assert len(reads) == 2
    now[0] = 31.0
    cache.load("u", "nl")
    assert len(reads) == 3
    cache.invalidate("u")
    cache.load("u", "en")
    assert len(reads) == 4


def test_document_size_cap(tmp_path):
    path = tmp_path / "shapes.ttl"
    path.write_text(SHAPES)
    assert shacl.read_document(str(path)) == SHAPES
    with pytest.raises(SourceError, match="larger than 10 bytes"):
        shacl.read_document(str(path), max_bytes=10)


LIBRARY = """
:w1 a :Author ; :name "Jan"@nl , "John"@en ; :born 1900 ; :city :c1 .
:w2 a :Author ; :name "Only English"@en ; :city :c1 .
:w3 a :Author ; :city :c2 .
:c1 a :City ; :label "Gent"@nl , "Ghent"@en . :c2 a :City ; :label "Brugge"@nl .
"""


def test_shacl_engine_end_to_end(spark, tmp_path):
    path = tmp_path / "shapes.ttl"
    path.write_text(SHAPES)
    graph = engine(spark, LIBRARY, metadata_sync_strategy="shacl", shacl_url=str(path), default_language="nl")
    result = graph.query({"source-table": "Author", "fields": [field("born"), field("city")]}, remaps=True)
    assert result.names == ["subject", "born", "city", "City__via__city__label"]
    assert rows(result, "declared") == [
        (NS + "w1", 1900, NS + "c1", "Gent"), (NS + "w2", None, NS + "c1", "Gent"), (NS + "w3", None, NS + "c2", "Brugge")]
    named = graph.query({"source-table": "Author", "fields": [field("name")]})
    assert rows(named) == [(NS + "w1", "Jan"), (NS + "w3", None)]
    picked = graph.query({"source-table": "Author", "filter": ["=", field("city"), NS + "c2"]})
    assert rows(picked) == [(NS + "w3",)]


def test_shacl_without_a_document(spark, tmp_path):
    assert engine(spark, LIBRARY, metadata_sync_strategy="shacl").catalog.tables() == []
    with pytest.raises(SourceError):
        engine(spark, LIBRARY, metadata_sync_strategy="shacl", shacl_url=str(tmp_path / "missing.ttl")).sync()
    (tmp_path / "large.ttl").write_text(SHAPES + "#" * (1 << 20))
    with pytest.raises(SourceError, match="larger"):
        engine(spark, LIBRARY, metadata_sync_strategy="shacl", shacl_url=str(tmp_path / "large.ttl"), shacl_max_size_mb=1).sync()


EXPLICIT = json.dumps({"tables": [
    {"name": NS + "Person", "description": "People", "fields": [NS + "age", "http://far.test/x"]},
    {"name": "http://far.test/Place", "fields": [NS + "age"]}]})


def test_explicit(spark):
    graph = engine(spark, PEOPLE, metadata_sync_strategy="explicit", schema_config=EXPLICIT)
    assert [(t.name, t.display_name, t.description) for t in graph.catalog.tables()] == [
        ("Person", "Person", "People"),
        ("http://far.test/Place", "Place", "RDF Class: http://far.test/Place (Explicit)")]
    assert [f.name for f in graph.catalog.fields("Person")] == ["subject", "age", "http://far.test/x"]
    hiding = engine(spark, PEOPLE, metadata_sync_strategy="explicit", schema_config=EXPLICIT, hide_foreign_uris=True)
    assert [t.name for t in hiding.catalog.tables()] == ["Person"]
    assert [f.name for f in hiding.catalog.fields("Person")] == ["subject", "age"]


def test_describing_a_table_no_schema_lists(spark):
    names = lambda **settings: [f.name for f in engine(spark, PEOPLE, **settings).describe_table("Company")]
    assert names(metadata_sync_strategy="explicit", schema_config=EXPLICIT) == ["subject", V.RDF_TYPE, V.RDFS + "label"]
    assert names(metadata_sync_strategy="shacl") == ["subject"]
    assert names(metadata_sync_strategy="none") == []


def test_none_and_fallback_to_auto(spark):
    assert engine(spark, PEOPLE).catalog.tables() == []
    for settings in ({"metadata_sync_strategy": "explicit", "schema_config": "{broken"},
                     {"metadata_sync_strategy": "explicit"}, {"metadata_sync_strategy": "what"}):
        assert [t.name for t in engine(spark, PEOPLE, **settings).catalog.tables()] == ["Person", "Company"]


def test_auto_discovery(spark):
    graph = engine(spark, PEOPLE, metadata_sync_strategy="auto")
    person = graph.catalog.table("Person")
    assert person.description == f"RDF Class: {NS}Person (Instances: 2)"
    fields = {f.name: f.database_type for f in graph.catalog.fields("Person")}
    assert fields == {"subject": "uri", V.RDF_TYPE: "uri", V.RDFS + "label": "string", "age": "string", "likes": "uri"}
    hiding = engine(spark, PEOPLE, metadata_sync_strategy="auto", hide_foreign_uris=True)
    assert [f.name for f in hiding.catalog.fields("Person")] == ["subject", "age", "likes"]
    assert rows(hiding.query({"source-table": "Person", "filter": ["=", field("likes"), NS + "bea"]})) == [(NS + "ann",)]


def test_discovery_limits_and_mixed_properties(spark):
    graph = engine(spark, ":a a :C ; :p :b , 1 ; :q 2 . :b a :C ; :p 3 . :x a :D .")
    source = graph.source
    assert [r["class"] for r in discovery.classes(source, 1).collect()] == [NS + "C"]
    found = {r["property"]: (r["count"], r["is_iri"]) for r in discovery.properties(source, NS + "C", 2).collect()}
    assert found == {NS + "p": (3, 0), V.RDF_TYPE: (2, 1)}
    assert {r["property"] for r in discovery.properties(source, NS + "C").collect()} == {NS + "p", NS + "q", V.RDF_TYPE}
    sampled = discovery.properties(source, [NS + "C", NS + "D"], sample=1).collect()
    assert {r["class"] for r in sampled} == {NS + "C", NS + "D"}


def test_nothing_rare_is_lost(spark):
    """A 101st class, a 21st property, a property of one instance, and a very long subject."""
    body = "".join(f":i{k} a :K{k} . " for k in range(101)) + ":i0 " + " ; ".join(f":p{k} {k}" for k in range(30)) + " . "
    body += "".join(f":m{k} a :Many . " for k in range(300)) + ":m299 :rare 1 . " + f"<{NS}{'x' * 2100}> a :Long ; :q 1 ."
    catalog = engine(spark, body, metadata_sync_strategy="auto").catalog
    assert len(catalog.tables()) == 103
    assert len(catalog.fields("K0")) == 32
    assert [f.name for f in catalog.fields("Many")] == ["subject", V.RDF_TYPE, "rare"]
    assert "q" in [f.name for f in catalog.fields("Long")]
