import pytest
from hypothesis import given
from hypothesis import strategies as st

from linkframe.naming import Naming, has_scheme, local_name, parse_prefixes, variable_name

HOME = "https://home.test/"


@pytest.mark.parametrize("text, expected", [
    ("  p = http://a/b/  ", [("p", "http://a/b/")]),
    ("x=http://n/\ny=http://n/deep/", [("y", "http://n/deep/"), ("x", "http://n/")]),
    ("\nno equals\n=http://x/\nok=http://o/\n", [("ok", "http://o/")]),
    ("p=http://a/ # comment", []),
    ("p=relative/", []),
    ("a__b=http://a/", []),
    ("p=http://one/\np=http://two/", [("p", "http://one/")]),
    ("a=http://A/\na_=http://B/", [("a", "http://A/")]),
    ("a_=http://B/\na=http://A/", [("a_", "http://B/")]),
    (None, []),
    ("", []),
])
def test_prefix_lines(text, expected):
    assert parse_prefixes(text) == expected


NAMING = Naming.of(HOME, "pre=http://names.test/v1/")


@pytest.mark.parametrize("uri, name", [
    (HOME + "Person", "Person"),
    ("http://names.test/v1/name", "pre__name"),
    ("http://elsewhere.test/x", "http://elsewhere.test/x"),
    ("http://names.test/v1/a__b", "http://names.test/v1/a__b"),
    (HOME + "pre__x", HOME + "pre__x"),
    (HOME + "has:label", HOME + "has:label"),
    (HOME, HOME),
    ("http://names.test/v1/", "http://names.test/v1/"),
])
def test_short_names_round_trip(uri, name):
    assert NAMING.shorten(uri) == name
    assert NAMING.absolute(name) == uri


def test_unknown_prefix_belongs_to_the_default_graph():
    assert NAMING.absolute("other__x") == HOME + "other__x"
    assert NAMING.absolute("") == ""
    assert Naming.of(None).absolute("name") == "name"


def test_most_specific_namespace_wins():
    naming = Naming.of(None, "b=http://n/\ns=http://n/sub/")
    assert naming.shorten("http://n/sub/x") == "s__x"
    assert naming.shorten("http://n/sub") == "b__sub"


def test_foreign():
    assert NAMING.is_foreign("http://elsewhere.test/x")
    assert not NAMING.is_foreign("http://names.test/v1/x")
    assert not NAMING.is_foreign(HOME + "x")
    assert not Naming.of(None).is_foreign("http://x/")


_WORDS = st.text(alphabet="ab_:/#.-1é", max_size=8)


@given(_WORDS, st.sampled_from([HOME, "http://names.test/v1/", "http://other.test/", ""]))
def test_shortening_is_always_reversible(tail, namespace):
    uri = namespace + tail
    if has_scheme(uri):
        assert NAMING.absolute(NAMING.shorten(uri)) == uri


def test_variable_names():
    assert variable_name("a-b.c") == "a_b_c"
    assert variable_name("1st") == "_1st"
    assert variable_name("") == "v"
    assert variable_name("http://x/y") == "http___x_y"


def test_local_names():
    assert local_name("http://x/y#z") == "z"
    assert local_name("http://x/y") == "y"
    assert local_name("http://x/y/") == "http://x/y/"
