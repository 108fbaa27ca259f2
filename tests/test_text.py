"""Pure text functions: literals, templates, errors, configuration."""

import socket
from urllib.error import URLError

from linkframe.config import EngineConfig
from linkframe.errors import SourceError, humanize
from linkframe.functions.literals import escape_string, has_scheme, iri_ref, iri_shaped, string_literal
from linkframe.templates import (
    Date, DateRange, TemporalUnit, Unsupported, as_value, bind_parameters, parameter_values, render_terms,
)


def test_strings_are_escaped_once():
    assert escape_string('a"b\\c\n\t\r') == 'a\\"b\\\\c\\n\\t\\r'
    assert string_literal(5) == '"5"'


def test_iri_references_cannot_be_closed_early():
    assert iri_ref("http://x/> } UNION {") == "<http://x/%3E%20%7D%20UNION%20%7B>"
    assert iri_ref("http://x/%20é") == "<http://x/%20é>"
    assert iri_ref("a\\b^c`|\"\n") == "<a%5Cb%5Ec%60%7C%22%0A>"


def test_two_questions_about_schemes():
    assert has_scheme("DID:x") and has_scheme("https://x") and not has_scheme("1:x") and not has_scheme(None)
    assert iri_shaped("urn:a") and iri_shaped("http://x")
    assert not iri_shaped("HTTP://x") and not iri_shaped("did:x")


def test_terms():
    sparql_term = lambda v: as_value(v).sparql()
    assert sparql_term("it's") == '"it\'s"'
    assert sparql_term("http://x/y") == "<http://x/y>"
    assert sparql_term(True) == "true" and sparql_term(2.5) == "2.5"
    assert sparql_term([1, "a", None]) == '1, "a"'
    assert sparql_term([]) is None and sparql_term(None) is None
    assert sparql_term(Date("2020-01-02")) == '"2020-01-02"'
    assert sparql_term(DateRange("2020", "2021")) == '"2020/2021"'
    assert sparql_term(TemporalUnit("day")) == '"day"'
    assert sparql_term({"type": "x", "value": 3}) == "3"
    assert sparql_term(Unsupported("card")) is None


def test_rendering_is_one_pass():
    text = render_terms("{{ a }} {{b}} {{a}} {{gone}}", {"a": "{{b}} $1 \\", "b": 2})
    assert text == '"{{b}} $1 \\\\" 2 "{{b}} $1 \\\\" {{gone}}'


def test_sql_parameters_travel_apart():
    text, args = bind_parameters("x = {{v}} AND y IN ({{list}}) AND z = {{none}}", {
        "v": "'; DROP", "list": [1, 2], "none": None})
    assert text == "x = :p_v_0 AND y IN (:p_list_0, :p_list_1) AND z = {{none}}"
    assert args == {"p_v_0": "'; DROP", "p_list_0": 1, "p_list_1": 2}


def test_parameter_values():
    tags = {"a": {"name": "a"}, "b": {"name": "b", "default": 7}}
    given = [{"type": "text", "target": ["variable", ["template-tag", "a"]], "value": "x"}]
    assert parameter_values(tags, given) == {"a": "x", "b": 7}


def test_connection_errors_in_plain_words():
    assert "401 Unauthorized" in humanize(SourceError("x", "db", 401))
    assert "503 Service Unavailable" in humanize(SourceError("x", status=503))
    outer = SourceError("outer", "transport")
    outer.__cause__ = URLError(ConnectionRefusedError("no"))
    assert "host and port" in humanize(outer)
    outer.__cause__ = URLError(socket.gaierror("no"))
    assert "host name" in humanize(outer)
    outer.__cause__ = TimeoutError()
    assert "in time" in humanize(outer)
    assert humanize(SourceError("odd failure 404")) == "odd failure 404"


def test_settings_from_a_dialog():
    config = EngineConfig.from_details({"default-graph": "http://g/", "class-limit": " 50 ", "sample-limit": "",
                                        "hide-foreign-uris": True, "property-limit": "many"})
    assert (config.class_limit, config.sample_limit, config.property_limit) == (50, None, None)
    assert config.hide_foreign_uris and config.naming.default_graph == "http://g/"
