"""A SPARQL endpoint as a Spark data source.

    spark.dataSource.register(SparqlDataSource)
    spark.read.format("sparql").options(
        endpoint="https://...", variables="s,label", queries=json.dumps([...])).load()

Every text in ``queries`` is one partition: as with JDBC predicates, the caller
splits a large read (by class, by graph, by a range filter) and Spark runs the
parts in parallel. Columns are terms (see functions.terms), so the result joins
and compares like any triple data.
"""

import base64
import itertools
import json
import re
import ssl
import time
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from linkframe import vocab as V
from linkframe.errors import InvalidQuery, SourceError, UnsupportedClause
from linkframe.functions.literals import iri_ref
from linkframe.functions.terms import TERM_TYPE
from linkframe.plans.bindings import TermBinding, ValueBinding
from linkframe.plans.frame import Frame, Output
from linkframe.results import QueryResult
from linkframe.sources.triples import TripleSource
from linkframe.templates import render_terms

ERROR_CHARS = 1000
TIMEOUT_SECONDS = 300
RETRIES = 2
# Rows of one answer that endpoints commonly give; how far a part is split.
PART_ROWS, MOST_DIGITS = 10_000, 8


def auth_headers(kind=None, username=None, password=None, token=None):
    """Request headers of an authentication setting; blank credentials mean none."""
    kind = (kind or "").strip().lower()
    given = [x for x in (username, password, token) if x and x.strip()]
    if kind == "basic" and username in given and password in given:
        encoded = base64.b64encode(f"{username}:{password}".encode()).decode()
        return {"Authorization": f"Basic {encoded}"}
    if kind == "bearer" and token in given:
        return {"Authorization": f"Bearer {token}"}
    return {}


def failure(status, body):
    """The error of a response that is no success: whose fault is it?"""
    text = body if len(body) <= ERROR_CHARS else body[:ERROR_CHARS] + "… (truncated)"
    endpoint_side = status in (401, 403, 407) or status >= 500
    return SourceError(f"endpoint returned status: {status}\nBody: {text}", "db" if endpoint_side else "query", status)


def decode(body):
    """The JSON document of a successful response."""
    try:
        return json.loads(body)
    except ValueError as problem:
        raise SourceError("the endpoint did not answer with JSON", "db") from problem


def term(binding):
    """One cell of SPARQL results JSON as (kind, value, datatype, lang); None if unbound."""
    if binding is None:
        return None
    kind = {"uri": V.IRI, "bnode": V.BNODE}.get(binding["type"], V.LITERAL)
    value, lang = binding["value"], binding.get("xml:lang", "").lower()
    if kind == V.BNODE and not value.startswith("_:"):
        value = "_:" + value
    datatype = V.RDF_LANG_STRING if lang else binding.get("datatype", "")
    return (kind, value, datatype if kind == V.LITERAL else "", lang)


def post(endpoint, query, default_graph=None, insecure=False, headers=None, opener=urlopen, timeout=TIMEOUT_SECONDS, retries=RETRIES):
    """POST a query, return the decoded answer. Without a cookie jar, no cookies are kept.

    A query only reads, so one that fails on the way or that the endpoint is too busy for is sent again.
    """
    for attempt in range(retries + 1):
        try:
            return _post(endpoint, query, default_graph, insecure, headers, opener, timeout)
        except SourceError as problem:
            if attempt == retries or not (problem.kind == "transport" or problem.status in (429, 502, 503, 504)):
                raise
            time.sleep(2**attempt)


def _post(endpoint, query, default_graph, insecure, headers, opener, timeout):
    url = endpoint
    if default_graph:
        url += ("&" if "?" in url else "?") + urlencode({"default-graph-uri": default_graph})
    request = Request(url, data=urlencode({"query": query}).encode(), method="POST", headers={
        "Accept": "application/sparql-results+json, application/json",
        "Content-Type": "application/x-www-form-urlencoded", **(headers or {})})
    context = ssl._create_unverified_context() if insecure else None
    try:
        with opener(request, timeout=timeout, context=context) as response:
            body = response.read().decode("utf-8")
            status = response.status
    except HTTPError as problem:
        raise failure(problem.code, problem.read().decode("utf-8", "replace")) from problem
    except OSError as problem:
        raise SourceError(str(problem), "transport") from problem
    if status != 200:
        raise failure(status, body)
    return decode(body)


def ask(endpoint, query="ASK { }", **options):
    """True or false of an ASK query; the default one tests the connection."""
    answer = post(endpoint, query, **options).get("boolean")
    if not isinstance(answer, bool):
        raise SourceError("the endpoint answered no boolean to an ASK query")
    return answer


def solutions(answer):
    """(variables, rows of bindings) of a SELECT answer; an answer of another form is a failure, not an empty table."""
    head, results = answer.get("head"), answer.get("results")
    if not isinstance(results, dict) or not isinstance(results.get("bindings"), list):
        raise SourceError(f"the endpoint's answer holds no results: {json.dumps(answer)[:ERROR_CHARS]}")
    return list((head or {}).get("vars") or []), results["bindings"]


class QueryPartition(InputPartition):
    """A query text; ``expected`` is how many rows it must answer, where that was counted."""

    def __init__(self, query, expected=None):
        self.query = query
        self.expected = expected


class SparqlReader(DataSourceReader):
    def __init__(self, options, opener=urlopen):
        self.options = dict(options)
        self.opener = opener
        self.variables = _listed(self.options["variables"])

    def partitions(self):
        if "pattern" in self.options:
            return list(self._counted())
        given = self.options.get("queries")
        queries = json.loads(given) if given else [self.options["query"]]
        return [QueryPartition(q) for q in queries]

    def read(self, partition):
        rows = self._rows(partition.query)
        if partition.expected is not None and len(rows) < partition.expected:
            raise SourceError(f"the endpoint answered {len(rows)} of {partition.expected} rows: it caps its answers below partrows")
        cap = int(self.options.get("rowcap", 0))
        if cap and len(rows) >= cap:
            raise SourceError(f"a part of the read reached the endpoint's cap of {cap} rows; split it into more parts")
        for row in rows:
            yield tuple(term(row.get(v)) for v in self.variables)


    def _rows(self, query):
        return solutions(post(self.options["endpoint"], query, opener=self.opener, **connection(self.options)))[1]

    def _counted(self):
        """Parts of at most ``partrows`` rows. Each is counted first; a larger one is split by one more digit."""
        most, pattern = int(self.options["partrows"]), self.options["pattern"]
        digits = "0123456789abcdef"
        waiting = ["".join(p) for p in itertools.product(digits, repeat=int(self.options["digits"]))] + [None]
        while waiting:
            start = waiting.pop(0)
            count = f"SELECT (COUNT(*) AS ?n) WHERE {{ {pattern} . FILTER({part_test(start)}) }}"
            rows = self._rows(count)
            if len(rows) != 1 or "n" not in rows[0]:
                raise SourceError("the endpoint answered a count with something else")
            n = int(rows[0]["n"]["value"])
            if n > most and start is not None and len(start) < MOST_DIGITS:
                waiting += [start + d for d in digits]
            elif n:
                yield QueryPartition(part_query(self.variables, pattern, start), n)


def connection(options):
    """Arguments of ``post`` from the options of the source (names in lower case)."""
    get = options.get
    return {
        "default_graph": get("defaultgraph"), "insecure": str(get("insecure", "false")).lower() == "true",
        "headers": auth_headers(get("authtype"), get("username"), get("password"), get("token")),
        "timeout": float(get("timeout", TIMEOUT_SECONDS)), "retries": int(get("retries", RETRIES)),
    }


def _listed(variables):
    return [v.strip() for v in variables.split(",") if v.strip()]


# What may hold a brace or a keyword without meaning it: comments, IRIs, texts.
_QUOTED = re.compile(r"""#[^\n]*|<[^<>"{}|^`\\\s]*>|\"{3}.*?\"{3}|'{3}.*?'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'""", re.S)


def query_form(text):
    """SELECT, ASK, CONSTRUCT or DESCRIBE: the first such word after the prologue."""
    found = re.search(r"(?<![\w:?$])(SELECT|ASK|CONSTRUCT|DESCRIBE)\b(?!\s*:)", _plain(text), re.I)
    if found is None:
        raise InvalidQuery("the query is no SELECT and no ASK")
    return found[1].upper()


def without_rows(text):
    """The SELECT query with a limit of no rows: the answer names its variables."""
    plain = _plain(text)
    end = plain.rfind("}") + 1
    limit = re.search(r"\bLIMIT\s+[0-9]+", plain[end:], re.I)
    if limit is None:
        return text + "\nLIMIT 0"
    return text[: end + limit.start()] + "LIMIT 0" + text[end + limit.end() :]


def _plain(text):
    """The text with blanks for what is quoted, place by place."""
    return _QUOTED.sub(lambda m: " " * len(m[0]), text)


def read_query(spark, endpoint, text, values=None, **options):
    """One native SELECT query as a DataFrame of terms: ``{{tag}}`` values are written in, columns are those the answer names.

    The text goes to the endpoint as it is, prefixes and all. Its variables are asked for with no rows; the rows are then
    read by one task, as a query with an order or a limit has one answer only.
    """
    query = render_terms(text, values or {})
    if query_form(query) != "SELECT":
        raise InvalidQuery("only a SELECT query has rows; see native()")
    lower = {k.lower(): v for k, v in options.items()}
    variables, _ = solutions(post(endpoint, without_rows(query), **connection(lower)))
    if not variables:
        raise SourceError("the endpoint names no variables for the query", "query")
    spark.dataSource.register(SparqlDataSource)
    return spark.read.format("sparql").options(endpoint=endpoint, query=query, variables=",".join(variables), **options).load()


def native(spark, endpoint, text, values=None, **options):
    """A native query with its typed result: SELECT gives its variables as columns, ASK one ``boolean`` column."""
    query = render_terms(text, values or {})
    form = query_form(query)
    if form == "ASK":
        lower = {k.lower(): v for k, v in options.items()}
        answer = spark.range(1).select(F.lit(ask(endpoint, query, **connection(lower))).alias("boolean"))
        return QueryResult(Frame(answer, [Output("boolean", ValueBinding("boolean", T.BooleanType()))]))
    if form != "SELECT":
        raise UnsupportedClause(f"{form} gives a graph, not a table")
    df = read_query(spark, endpoint, text, values, **options)
    return QueryResult(Frame(df, [Output(c, TermBinding(c)) for c in df.columns]))


class SparqlDataSource(DataSource):
    """Options: endpoint, variables, query or queries (JSON list), defaultGraph, insecure,
    authType (none, basic, bearer), username, password, token, timeout (seconds), retries."""

    @classmethod
    def name(cls):
        return "sparql"

    def schema(self):
        variables = self.options.get("variables", "")
        if not variables.strip():
            raise SourceError("the sparql source needs the option variables", "query")
        return ", ".join(f"`{v}` {TERM_TYPE}" for v in _listed(variables))

    def reader(self, schema):
        return SparqlReader({k.lower(): v for k, v in self.options.items()})


class EndpointTriples(TripleSource):
    """The triples behind an endpoint, read one predicate at a time.

    Each read is split into ``16 ** digits`` disjoint parts by the first digits of the
    subject's MD5, plus one for blank nodes, so no single answer carries a whole
    predicate and a hot predicate is spread over many tasks. Parts are counted when the
    read is planned, and those of more than ``part_rows`` rows are split on. A part whose
    answer holds fewer rows than were counted fails the read: a cap that nobody stated
    never makes the result smaller. ``row_cap`` names a cap that is known.
    """

    def __init__(self, spark, endpoint, digits=1, row_cap=None, part_rows=PART_ROWS, **options):
        if row_cap is not None:
            options["rowcap"] = str(row_cap)
            part_rows = min(part_rows, row_cap - 1)
        self._spark, self._digits, self._part_rows = spark, digits, part_rows
        self._options = {"endpoint": endpoint, **options}
        self.hot = {}
        self._deduplicated = True          # an endpoint answers from a set of triples
        spark.dataSource.register(SparqlDataSource)

    def triples(self, subject=None):
        return self._read("spo", asked("?p", subject)).select(
            F.col("s.value").alias("s"), F.col("p.value").alias("p"), "o")

    def slice(self, prop, subject=None, target=None):
        return self._read("so", asked(iri_ref(prop), subject, target)).select(F.col("s.value").alias("s"), "o")

    def members(self, class_iri):
        return self._read("s", f"?s {iri_ref(V.RDF_TYPE)} {iri_ref(class_iri)}").select(
            F.col("s.value").alias("s"))

    def _read(self, variables, pattern):
        return self._spark.read.format("sparql").options(
            variables=",".join(variables), pattern=pattern, digits=str(self._digits), partrows=str(self._part_rows),
            **self._options).load()

    def ping(self):
        """Does the endpoint answer at all? An ASK query, not a read."""
        lower = {k.lower(): v for k, v in self._options.items()}
        ask(lower["endpoint"], **connection(lower))
        return True


def asked(predicate, subject=None, target=None):
    """The pattern of a read. Constant IRIs are part of it, so the endpoint sends no other rows; blank nodes have no
    name it would know, their rows are found by Spark."""
    given = [(v, x) for v, x in (("?s", subject), ("?o", target)) if x is not None and not x.startswith("_:")]
    return " ".join([*(f"VALUES {v} {{ {iri_ref(x)} }}" for v, x in given), f"?s {predicate} ?o"])


def part_test(start):
    """The subjects of one part; None is that of the blank nodes."""
    # STR of a blank node is an error, which keeps blank nodes out of the digits.
    return "isBlank(?s)" if start is None else f'STRSTARTS(MD5(STR(?s)), "{start}")'


def part_query(variables, pattern, start):
    return f"SELECT {' '.join(f'?{v}' for v in variables)} WHERE {{ {pattern} . FILTER({part_test(start)}) }}"


def split_queries(variables, pattern, digits=1):
    """SELECT texts whose answers together are the answer of the pattern, once each."""
    starts = list(map("".join, itertools.product("0123456789abcdef", repeat=digits)))
    return [part_query(variables, pattern, start) for start in [*starts, None]]
