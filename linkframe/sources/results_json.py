"""Saved SPARQL results (JSON) as DataFrames of terms, one row per solution.

A results document is one JSON value, so a file is the unit of parallelism:
save large results as many files.
"""

from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.errors import SourceError

_SCHEMA = (
    "head struct<vars:array<string>>, boolean boolean, "
    "results struct<bindings:array<map<string,"
    "struct<type:string,value:string,datatype:string,`xml:lang`:string>>>>"
)


def read_results(spark, path, variables=None):
    """SELECT results as term columns; an ASK result as one column ``boolean``.

    ``variables`` names the columns; left out, they are read from the heads of all documents.
    """
    texts = spark.read.text(path, wholetext=True)
    return parse_results(texts, "value", variables)


def parse_results(texts, column="value", variables=None):
    """The same for a DataFrame with one results document per row."""
    parsed = F.from_json(column, _SCHEMA, {"mode": "FAILFAST"})
    documents = texts.select(parsed.alias("d")).select("d.*")
    if variables is None:
        # One row: the kinds of answers, and the distinct variables, which are few.
        names = F.array_sort(F.collect_set(F.transform("head.vars", lambda v: v)))
        heads = documents.agg(
            F.count(F.lit(1)).alias("n"), F.count("boolean").alias("asked"), names.alias("heads")).first()
        if not heads["n"]:
            raise SourceError("there are no results documents")
        if heads["asked"] == heads["n"]:
            return documents.select("boolean")
        if heads["asked"]:
            raise SourceError("the documents mix answers of SELECT and ASK")
        variables = list(dict.fromkeys(v for head in heads["heads"] for v in head))
    rows = documents.select(F.explode("results.bindings").alias("row"))
    return rows.select(*[_term(F.col("row")[v]).alias(v) for v in variables])


def _term(cell):
    lang = F.lower(F.coalesce(cell["xml:lang"], F.lit("")))
    kind = F.when(cell["type"] == "uri", V.IRI).when(cell["type"] == "bnode", V.BNODE).otherwise(V.LITERAL)
    blank = (cell["type"] == "bnode") & ~cell["value"].startswith("_:")
    value = F.when(blank, F.concat(F.lit("_:"), cell["value"])).otherwise(cell["value"])
    datatype = F.when(kind != V.LITERAL, "").when(lang != "", V.RDF_LANG_STRING).otherwise(
        F.coalesce(cell["datatype"], F.lit(""))
    )
    built = F.struct(kind.alias("kind"), value.alias("value"), datatype.alias("datatype"), lang.alias("lang"))
    return F.when(cell.isNotNull(), built)
