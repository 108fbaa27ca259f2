"""Namespace IRIs, datatype families and base-type names.

Everything in this module is a constant that results must agree with (W3C
namespaces, XSD datatype names and the logical type each one maps to).
"""

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SHACL = "http://www.w3.org/ns/shacl#"

RDF_TYPE = RDF + "type"
RDF_LANG_STRING = RDF + "langString"

# Term kinds as stored in a term struct.
IRI = "iri"
BNODE = "bnode"
LITERAL = "lit"

# Logical column types of a result.
TEXT = "Text"
URL = "URL"
INTEGER = "Integer"
FLOAT = "Float"
BOOLEAN = "Boolean"
DATE = "Date"
DATETIME = "DateTime"
DATETIME_TZ = "DateTimeWithTZ"
TIME = "Time"

# XSD datatypes behind each logical type of a *result cell*.
RESULT_DATATYPES = {
    INTEGER: [
        "integer", "int", "long", "short", "byte", "nonNegativeInteger", "positiveInteger",
        "nonPositiveInteger", "negativeInteger", "unsignedLong", "unsignedInt",
        "unsignedShort", "unsignedByte",
    ],
    FLOAT: ["decimal", "float", "double"],
    BOOLEAN: ["boolean"],
    DATETIME: ["dateTime", "gYear", "gYearMonth"],
    DATE: ["date", "gMonthDay", "gDay", "gMonth"],
    TIME: ["time"],
}

# XSD datatypes behind each logical type of a *declared* SHACL
# property. This differs on purpose from RESULT_DATATYPES.
DECLARED_DATATYPES = {
    TEXT: ["string", "normalizedString", "token", "language", "anyURI"],
    BOOLEAN: ["boolean"],
    INTEGER: [
        "integer", "int", "long", "short", "byte", "unsignedInt", "unsignedLong",
        "unsignedShort", "unsignedByte", "nonNegativeInteger", "positiveInteger",
    ],
    FLOAT: ["decimal", "float", "double"],
    DATE: ["date"],
    DATETIME_TZ: ["dateTime", "dateTimeStamp"],
    TIME: ["time"],
}


def _iris(local_names):
    return [XSD + name for name in local_names]


INTEGER_DATATYPES = _iris(RESULT_DATATYPES[INTEGER])
FLOAT_DATATYPES = _iris(RESULT_DATATYPES[FLOAT])
NUMERIC_DATATYPES = INTEGER_DATATYPES + FLOAT_DATATYPES
# Datatypes whose values compare on the time line.
INSTANT_DATATYPES = _iris(["dateTime", "dateTimeStamp", "date"])

DECLARED_BASE_TYPE = {
    XSD + name: base for base, names in DECLARED_DATATYPES.items() for name in names
}
