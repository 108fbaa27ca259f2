"""Catalogs declared by a SHACL document (Turtle).

Node shapes with a target class become tables and their property shapes become
fields. ``sh:node`` is inheritance. A small annotation vocabulary (namespace is
configurable) hides shapes, sets semantic types and picks display values.
"""

import re
import time
from dataclasses import dataclass, field
from urllib.error import HTTPError
from urllib.request import Request, urlopen

from linkframe import vocab as V
from linkframe.catalog.model import Catalog, FieldMeta, ForeignKey, TableMeta
from linkframe.errors import SourceError
from linkframe.naming import has_scheme, local_name
from linkframe.sources import turtle

CACHE_SECONDS = 30
CONNECT_SECONDS = 10
READ_SECONDS = 30
MAX_BYTES = 10 * 1024 * 1024
DEFAULT_ANNOTATIONS = "https://linkframe.example/annotations#"


@dataclass(frozen=True)
class PropertyShape:
    iri: str
    base_type: str = V.TEXT
    semantic_type: str | None = None
    description: str | None = None
    order: int | None = None
    holds_iris: bool = False
    target_class: str | None = None
    display_property: str | None = None
    required: bool = False
    lang_string: bool = False
    hidden: bool = False


@dataclass(frozen=True)
class ClassShape:
    class_iri: str
    description: str | None = None
    properties: dict = field(default_factory=dict)      # property IRI -> PropertyShape


# ---- reading one value from the objects of a statement -------------------------------
# Each reader takes the list of objects (maybe empty) and the wanted language.


def an_iri(objects, language):
    return objects[0].value if objects and objects[0].kind == V.IRI else None


def a_number(objects, language):
    written = objects[0].value.strip() if objects and objects[0].kind == V.LITERAL else ""
    return int(written) if re.fullmatch(r"[+-]?[0-9]+", written) else None


def a_flag(objects, language):
    return bool(objects) and objects[0].kind == V.LITERAL and objects[0].value.lower() in ("true", "1")


def a_text(objects, language):
    """The text in ``language``, else an untagged one, else the first in the document."""
    wanted = [language.lower()] if language else []
    rank = {tag: i for i, tag in enumerate([*wanted, ""])}
    texts = [t for t in objects if t.kind == V.LITERAL]
    return min(texts, key=lambda t: rank.get(t.lang, len(rank))).value if texts else None


def a_type_name(objects, language):
    """``type/URL``, ``:type/URL`` or ``URL`` -> ``URL``; None for anything blank."""
    if not objects or objects[0].kind == V.BNODE:
        return None
    return re.sub(r"^:?(type/)?", "", objects[0].value.strip()) or None


#: What is read of a property shape: name, namespace (SHACL or annotations), local name, reader.
PROPERTY_COLUMNS = [
    ("path", "sh", "path", an_iri), ("datatype", "sh", "datatype", an_iri), ("target", "sh", "class", an_iri),
    ("node_kind", "sh", "nodeKind", an_iri), ("order", "sh", "order", a_number), ("least", "sh", "minCount", a_number),
    ("name", "sh", "name", a_text), ("comment", "sh", "description", a_text),
    ("hidden", "note", "hide", a_flag), ("annotated", "note", "semanticType", a_type_name),
    ("display", "note", "displayValueProperty", an_iri),
]
#: And of a node shape.
NODE_COLUMNS = [("target", "sh", "targetClass", an_iri), ("comment", "sh", "description", a_text), ("hidden", "note", "hide", a_flag)]


class Statements:
    """The objects of every (subject, predicate), in document order."""

    def __init__(self, triples):
        self.objects, self.subjects = {}, {}
        for s, p, o in triples:
            self.objects.setdefault((s, p.value), []).append(o)
            self.subjects[s] = True

    def of(self, node, predicate):
        return self.objects.get((node, predicate), [])

    def row(self, node, columns, namespaces, language):
        return {name: read(self.of(node, namespaces[space] + local), language) for name, space, local, read in columns}


def shapes(triples, language="", annotations=DEFAULT_ANNOTATIONS):
    """``[ClassShape]``, inheritance resolved, one per class, hidden ones left out."""
    found, spaces = Statements(triples), {"sh": V.SHACL, "note": annotations}
    nodes = {}
    for subject in found.subjects:
        row = found.row(subject, NODE_COLUMNS, spaces, language)
        # A hidden shape is gone before anything could be inherited from it.
        if row["target"] is not None and not row["hidden"]:
            nodes[subject] = row
    declared = {n: _declared(found, n, spaces, language) for n in nodes}
    edges = {n: [p for p in found.of(n, V.SHACL + "node") if p in nodes and p != n] for n in nodes}
    by_class = {}
    for node, row in nodes.items():
        by_class.setdefault(row["target"], []).append(node)
    return [_class_shape(iri, same, nodes, edges, declared) for iri, same in by_class.items()]


def _class_shape(iri, same, nodes, edges, declared):
    """One class from all shapes that target it: what a later shape says of a property holds."""
    properties = {}
    for node in same:
        # From the farthest ancestors to the shape itself, so that the nearest declaration is the last.
        for level in reversed(_levels(node, edges)):
            for ancestor in level:
                properties |= declared[ancestor]
    comments = [nodes[n]["comment"] for n in same if nodes[n]["comment"]]
    return ClassShape(iri, next(iter(comments), None), {i: p for i, p in properties.items() if not p.hidden})


def _levels(node, edges):
    """The closure of the inheritance edges by distance; each shape stands at its nearest."""
    levels, seen = [[node]], {node}
    while levels[-1]:
        following = dict.fromkeys(p for n in levels[-1] for p in edges[n] if p not in seen)
        seen |= following.keys()
        levels.append(list(following))
    return levels[:-1]


def _declared(found, node, spaces, language):
    rows = (found.row(p, PROPERTY_COLUMNS, spaces, language) for p in found.of(node, V.SHACL + "property"))
    return {r["path"]: _property_shape(r) for r in rows if r["path"] is not None}


def _property_shape(row):
    default_type = "FK" if row["target"] else "URL" if row["datatype"] == V.XSD + "anyURI" else None
    texts = [row[c] for c in ("name", "comment") if (row[c] or "").strip()]
    return PropertyShape(
        row["path"], V.DECLARED_BASE_TYPE.get(row["datatype"], V.TEXT), row["annotated"] or default_type, " — ".join(texts) or None,
        row["order"], bool(row["target"]) or row["node_kind"] == V.SHACL + "IRI", row["target"], row["display"],
        (row["least"] or 0) > 0, row["datatype"] == V.RDF_LANG_STRING, row["hidden"],
    )


def shacl_catalog(found, naming, hide_foreign=False):
    """Tables, typed fields, foreign keys and display remaps of the shapes."""
    catalog = Catalog(naming)
    foreign = naming.is_foreign if hide_foreign else (lambda iri: False)
    for shape in found:
        if foreign(shape.class_iri):
            continue
        listed = sorted(
            (p for p in shape.properties.values() if not foreign(p.iri)),
            key=lambda p: (p.order if p.order is not None else float("inf"), p.iri),
        )
        name = naming.shorten(shape.class_iri)
        keys = [
            ForeignKey(name, naming.shorten(p.iri), naming.shorten(p.target_class))
            for p in listed if p.target_class and not foreign(p.target_class)
        ]
        description = shape.description or f"RDF Class: {shape.class_iri} (SHACL)"
        catalog.add(
            TableMeta(name, shape.class_iri, local_name(shape.class_iri), description),
            [_field(naming, p) for p in listed], keys,
        )
    for shape in found:
        for prop in shape.properties.values():
            if prop.display_property and prop.target_class:
                catalog.set_display_remap(
                    naming.shorten(shape.class_iri), naming.shorten(prop.iri),
                    naming.shorten(prop.target_class), naming.shorten(prop.display_property),
                )
    return catalog


def _field(naming, prop):
    kind = "langString" if prop.lang_string else "uri" if prop.holds_iris else "string"
    return FieldMeta(
        naming.shorten(prop.iri), prop.iri, kind, prop.base_type, prop.semantic_type,
        comment=prop.description, required=prop.required,
    )


def read_document(location, connect_seconds=None, read_seconds=None, max_bytes=None):
    """Text of a schema document at a URL or path; larger than the cap is refused."""
    cap = max_bytes or MAX_BYTES
    if has_scheme(location) and location.lower().startswith(("http:", "https:")):
        # urllib has one socket timeout, applied to connecting and to each read.
        seconds = max(connect_seconds or CONNECT_SECONDS, read_seconds or READ_SECONDS)
        request = Request(location, headers={"Accept": "text/turtle"})
        try:
            with urlopen(request, timeout=seconds) as response:
                body = response.read(cap + 1)
        except HTTPError as problem:
            raise SourceError(f"fetching {location} failed with status {problem.code}", "transport") from problem
        except OSError as problem:
            raise SourceError(f"fetching {location} failed: {problem}", "transport") from problem
    else:
        with open(location.removeprefix("file://"), "rb") as handle:
            body = handle.read(cap + 1)
    if len(body) > cap:
        raise SourceError(f"the document at {location} is larger than {cap} bytes")
    return body.decode("utf-8")


class ShapeCache:
    """Parsed shapes per (location, language), kept for half a minute."""

    def __init__(self, clock=time.monotonic, read=read_document):
        self._clock, self._read, self._kept = clock, read, {}

    def load(self, location, language="", annotations=DEFAULT_ANNOTATIONS, **limits):
        key, now = (location, language, annotations), self._clock()
        if key in self._kept and now - self._kept[key][0] < CACHE_SECONDS:
            return self._kept[key][1]
        parsed = shapes(turtle.parse(self._read(location, **limits), location), language, annotations)
        self._kept[key] = (now, parsed)
        return parsed

    def invalidate(self, location):
        """Forget the document in every language."""
        self._kept = {k: v for k, v in self._kept.items() if k[0] != location}
