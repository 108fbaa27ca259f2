"""N-Triples and N-Quads text files as a triple table, one line per row.

Lines are independent, so files split freely and the whole reader is column
expressions. A line that is no statement, comment or blank fails the job: rows
are never silently left out.
"""

from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.functions import terms

# Possessive groups: a literal of any length is matched without backtracking or recursion.
_IRI = r"<([^\x00-\x20<>\"{}|^`]++)>"
_BLANK = r"(_:[^\s<>\"]+)"
_LITERAL = r"\"((?:[^\"\\\r\n]++|\\.)*+)\"(?:\^\^" + _IRI + r"|@([A-Za-z0-9\-]+))?"
_STATEMENT = (
    r"^\s*(?:" + _IRI + "|" + _BLANK + r")\s*" + _IRI + r"\s*"
    r"(?:" + _IRI + "|" + _BLANK + "|" + _LITERAL + r")\s*"
    r"(?:" + _IRI + "|" + _BLANK + r")?\s*\.\s*(?:#.*)?$"
)
# Capture groups: 1 2 subject, 3 predicate, 4 5 6 object, 7 datatype, 8 language,
# 9 10 graph. The free text of a literal goes last and may hold the separator.
# A statement begins with <, _ or a space, so one leading separator tells a match.
_SEPARATOR = "\u0001"
_REORDERED = _SEPARATOR + _SEPARATOR.join(["$1", "$2", "$3", "$4", "$5", "$7", "$8", "$9", "$10", "$6"])


def read_ntriples(spark, path, blanks_per_file=False):
    """``g, s, p, o`` rows of all files at ``path``.

    Blank node labels hold for one document. The files at ``path`` count as parts
    of one document, as a dump has them; ``blanks_per_file`` keeps files apart.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path")
    return parse_ntriples(lines, "value", "file_path" if blanks_per_file else None)


def parse_ntriples(lines, column="value", document=None):
    """``g, s, p, o`` rows of a DataFrame of lines; ``document`` names the column that tells documents apart."""
    line = F.col(column)
    scope = F.lit("") if document is None else F.concat(F.lit("."), F.hex(F.xxhash64(document)))
    lines = lines.where(~line.rlike(r"^\s*(#.*)?$"))
    matched = F.when(~line.startswith(_SEPARATOR), F.regexp_replace(line, _STATEMENT, _REORDERED))
    parts = lines.select(F.split(matched, _SEPARATOR, 11).alias("f"), line.alias("line"), scope.alias("scope"))
    # An unmatched line comes back as it was, without the leading separator.
    wrong = F.raise_error(F.concat(F.lit("not an N-Triples statement: "), F.col("line")))
    parts = parts.select(F.when(F.col("f")[0] == "", F.slice("f", 2, 10)).otherwise(wrong).alias("f"), "scope")
    f = F.col("f")

    def blank(i):
        return F.when(f[i] != "", F.concat(f[i], F.col("scope")))

    def iri(i):
        return F.when(f[i] != "", _unescape(f[i]))

    subject = F.coalesce(iri(0), blank(1))
    resource = F.when(f[3] != "", terms.iri_term(_unescape(f[3]))).otherwise(terms.node_term(blank(4)))
    datatype = F.when(f[6] != "", V.RDF_LANG_STRING).otherwise(F.coalesce(iri(5), F.lit(terms.XSD_STRING)))
    literal = terms.literal_term(_unescape(f[9]), datatype, F.lower(f[6]))
    is_literal = (f[3] == "") & (f[4] == "")
    return parts.select(
        F.coalesce(iri(7), blank(8)).alias("g"), subject.alias("s"), _unescape(f[2]).alias("p"),
        F.when(is_literal, literal).otherwise(resource).alias("o"),
    )


def _unescape(text):
    """Undo backslash escapes without leaving the JVM.

    Doubled backslashes become \\u005c first, so every backslash left starts one
    escape. The text is then cut at the eight-digit escapes, whose characters are
    decoded from UTF-32, and the pieces between are read as JSON strings.
    """
    single = F.regexp_replace(text, r"\\\\", r"\\u005c")
    single = F.regexp_replace(single, r"\\'", "'")
    pieces = F.split(single, r"\\U")
    whole = F.array_join(
        F.transform(
            pieces,
            lambda piece, i: F.when(i == 0, _json_text(piece)).otherwise(
                F.concat(F.decode(F.unhex(F.substring(piece, 1, 8)), "UTF-32"),
                         _json_text(F.substr(piece, F.lit(9))))
            ),
        ),
        "",
    )
    return F.when(text.contains("\\"), whole).otherwise(text)


def _json_text(piece):
    wrapped = F.concat(F.lit('["'), piece, F.lit('"]'))
    return F.from_json(wrapped, "array<string>", {"allowUnquotedControlChars": "true"})[0]


def render_ntriples(triples):
    """A DataFrame with one column ``value``: each triple as a line (a quad if it has a graph)."""
    o = F.col("o")
    quoted = F.concat(F.lit('"'), _escape(o["value"]), F.lit('"'))
    typed = F.when(o["lang"] != "", F.concat(quoted, F.lit("@"), o["lang"])).when(
        o["datatype"].isin("", terms.XSD_STRING), quoted).otherwise(F.concat(quoted, F.lit("^^"), _iri(o["datatype"])))
    parts = [_node("s"), _iri(F.col("p")), F.when(o["kind"] == V.LITERAL, typed).otherwise(_node("o.value"))]
    if "g" in triples.columns:
        parts.append(F.when(F.col("g").isNotNull(), _node("g")))
    return triples.select(F.concat(F.concat_ws(" ", *parts), F.lit(" .")).alias("value"))


def _node(column):
    return F.when(F.col(column).startswith("_:"), F.col(column)).otherwise(_iri(F.col(column)))


def _iri(text):
    """What an IRI reference can't hold is written as an escape of its code point."""
    for sign in '\\<>"{}|^` ':
        text = F.replace(text, F.lit(sign), F.lit(f"\\u{ord(sign):04X}"))
    return F.concat(F.lit("<"), text, F.lit(">"))


def _escape(text):
    for sign, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(sign), F.lit(escaped))
    return text
