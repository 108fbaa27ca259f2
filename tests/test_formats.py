"""Turtle documents and N-Triples files."""

import pytest

from linkframe import vocab as V
from linkframe.errors import SourceError
from linkframe.sources import turtle
from linkframe.sources.ntriples import parse_ntriples, read_ntriples, render_ntriples
from linkframe.sources.turtle import Term


def objects(text):
    return [o for _, _, o in turtle.parse("@prefix : <http://t/> . :s :p " + text + " .")]


@pytest.mark.parametrize("text, term", [
    ("<rel>", Term(V.IRI, "http://b/rel")),
    (":a.b", Term(V.IRI, "http://t/a.b")),
    ("7", Term(V.LITERAL, "7", V.XSD + "integer")),
    ("-1.50", Term(V.LITERAL, "-1.50", V.XSD + "decimal")),
    ("1e3", Term(V.LITERAL, "1e3", V.XSD + "double")),
    ("true", Term(V.LITERAL, "true", V.XSD + "boolean")),
    ('"a\\"b\\u00e9"', Term(V.LITERAL, 'a"bé', V.XSD + "string")),
    ("'single'", Term(V.LITERAL, "single", V.XSD + "string")),
    ('"""long "text"\nline"""', Term(V.LITERAL, 'long "text"\nline', V.XSD + "string")),
    ('"hei"@NB-no', Term(V.LITERAL, "hei", V.RDF_LANG_STRING, "nb-no")),
    ('"5"^^<http://dt>', Term(V.LITERAL, "5", "http://dt")),
    ("_:x1", Term(V.BNODE, "_:x1")),
])
def test_turtle_objects(text, term):
    parsed = turtle.parse("@prefix : <http://t/> . :s :p " + text + " .", "http://b/")
    assert [o for _, _, o in parsed] == [term]


def test_turtle_structure():
    parsed = turtle.parse("""
        PREFIX : <http://t/>
        @base <http://base/> .
        # a comment
        :s a :C ; :p 1 , 2 ; ; :q [ :r "x" ; :t [] ] ; :l ( 1 :two ) .
        [ :p :o ] .
        <a> :p <#f> .
    """)
    assert len(parsed) == 13
    assert (Term(V.IRI, "http://base/a"), Term(V.IRI, "http://t/p"), Term(V.IRI, "http://base/#f")) in parsed
    assert sum(p.value == V.RDF + "rest" for _, p, _ in parsed) == 2


@pytest.mark.parametrize("text", ["x:a x:b x:c .", "<a> <b> .", "<a> <b> <c>", '<a> <b> "open .'])
def test_turtle_mistakes_are_reported(text):
    with pytest.raises(SourceError):
        turtle.parse(text)


LINES = r"""
# comment
<http://s> <http://p> <http://o> .
_:b1 <http://p> _:b2 .
<http://s> <http://p> "plain" . # trailing
<http://s> <http://p> "with \"quotes\" and \\U0041 \\ back\\" .
<http://s> <http://p> "tab\there é \U0001F600! \'q\'" .
<http://s> <http://p> "5"^^<http://www.w3.org/2001/XMLSchema#integer> .
<http://s> <http://p> "chat"@fr <http://g> .
<http://s> <http://p> "" .
<http://s/é> <http://p> "<http://not> <an> <iri>" _:g .
"""


def test_ntriples(spark, tmp_path):
    (tmp_path / "a.nt").write_text(LINES, encoding="utf-8")
    found = {(r.g, r.s, r.o.kind, r.o.value, r.o.datatype, r.o.lang)
             for r in read_ntriples(spark, str(tmp_path)).collect()}
    string = V.XSD + "string"
    assert found == {
        (None, "http://s", "iri", "http://o", "", ""),
        (None, "_:b1", "bnode", "_:b2", "", ""),
        (None, "http://s", "lit", "plain", string, ""),
        (None, "http://s", "lit", 'with "quotes" and \\U0041 \\ back\\', string, ""),
        (None, "http://s", "lit", "tab\there é 😀! 'q'", string, ""),
        (None, "http://s", "lit", "5", V.XSD + "integer", ""),
        ("http://g", "http://s", "lit", "chat", V.RDF_LANG_STRING, "fr"),
        (None, "http://s", "lit", "", string, ""),
        ("_:g", "http://s/é", "lit", "<http://not> <an> <iri>", string, ""),
    }


def test_a_broken_line_fails_the_job(spark, tmp_path):
    (tmp_path / "a.nt").write_text("<http://s> <http://p> oops .\n")
    with pytest.raises(Exception, match="not an N-Triples statement"):
        read_ntriples(spark, str(tmp_path)).collect()


def test_blank_nodes_of_several_files(spark, tmp_path):
    for name in ("a.nt", "b.nt"):
        (tmp_path / name).write_text("_:x <http://p> _:x .\n")
    together = read_ntriples(spark, str(tmp_path))
    apart = read_ntriples(spark, str(tmp_path), blanks_per_file=True)
    assert together.select("s").distinct().count() == 1
    assert apart.select("s").distinct().count() == 2
    assert apart.where("s = o.value").count() == 2


def test_literals_of_any_length_and_escapes_in_all_iris(spark, tmp_path):
    long = 'a\\"b' * 250_000
    (tmp_path / "a.nt").write_text(
        f'<http://s> <http://p> "{long}" .\n'
        '<http://s> <http://p> "5"^^<http://www.w3.org/2001/XMLSchema#\\u0069nteger> <http://g\\u00e9> .\n', encoding="utf-8")
    first, second = sorted(read_ntriples(spark, str(tmp_path)).collect(), key=lambda r: -len(r.o.value))
    assert first.o.value == 'a"b' * 250_000
    assert second.o.datatype == V.XSD + "integer" and second.g == "http://gé"


def test_a_line_that_looks_matched_fails(spark):
    lines = spark.createDataFrame([("\u0001<http://s> <http://p> <http://o> .",)], "value string")
    with pytest.raises(Exception, match="not an N-Triples statement"):
        parse_ntriples(lines).collect()


def test_rendered_triples_read_back(spark):
    term = "struct<kind:string,value:string,datatype:string,lang:string>"
    rows = [
        (None, "http://s", "http://p", (V.LITERAL, 'x"\\\r\n\t\u0001 é\U0001f600', V.XSD + "string", "")),
        ("http://g", "_:b", "http://p", (V.LITERAL, "hoi", V.RDF_LANG_STRING, "nl")),
        (None, "http://s/a b<>", "http://p", (V.IRI, "http://o{}", "", "")),
        ("_:g", "http://s", "http://p", (V.BNODE, "_:x", "", "")), (None, "http://s", "http://p", (V.LITERAL, "", V.XSD + "date", "")),
    ]
    triples = spark.createDataFrame(rows, f"g string, s string, p string, o {term}")
    back = parse_ntriples(render_ntriples(triples))
    key = lambda r: str((r.g, r.s, r.p, tuple(r.o)))
    assert sorted(map(key, back.collect())) == sorted(map(key, triples.collect()))
