"""The registered queries: each a structured or native query over the test
tables, with the SQL that must give the same rows."""

import json
import tempfile
import uuid

from pyspark.sql import functions as F

import model
from linkframe import ClassMapping, Engine, EngineConfig, MappedSource, Property, TripleSource, ask
from linkframe.catalog import discovery, shacl
from linkframe.catalog.shacl import DEFAULT_ANNOTATIONS
from linkframe.functions import terms
from linkframe.operators.patterns import (
    Literal, exists, match, minus, natural_join, not_exists, optional, optional_join, values,
)
from linkframe import vocab as V
from linkframe.sources import turtle
from linkframe.sources.ntriples import parse_ntriples, render_ntriples
from linkframe.sources.results_json import parse_results
from linkframe.sources.triples import VirtualTriples, append_triples, write_triples
from linkframe.templates import DateRange

B = model.BASE
QUERIES = {}
ORACLES = {}


def field(name, alias=None):
    return ["field", name, {"join-alias": alias} if alias else None]


def fields(*names):
    return [field(n) for n in names]


def iri(cls, column):
    """SQL for the IRI of a resource."""
    return f"concat('{B}{cls}/', {column})"


def register(name, sql=None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def tidy(df, rounded=(), averages=(), digits=2):
    """Round away what depends on the order of addition.

    An average of few decimals can lie exactly between two rounded values; the
    nudge (also in the SQL) settles those the same way on both sides.
    """
    for column in rounded:
        df = df.withColumn(column, F.round(column, digits))
    for column in averages:
        df = df.withColumn(column, F.round(F.col(column) + 1e-7, digits))
    return df


def structured(name, classes, query, sql, expected=None, triples=False, cast=(), rounding=None, **settings):
    """Register a structured query; with ``triples`` also over the same data as triples."""

    def run(engine):
        df = tidy(engine.query(query, expected).to_df("declared"), **(rounding or {}))
        for column, dtype in dict(cast).items():
            df = df.withColumn(column, F.col(column).cast(dtype))
        return df

    register(name, sql)(lambda spark, d: run(model.engine(spark, d, classes, **settings)))
    if triples:
        register("triples_" + name, sql)(lambda spark, d: run(triple_engine(spark, d, classes, **settings)))


def triple_source(spark, directory, classes):
    return VirtualTriples(model.source(spark, directory, classes))


def triple_engine(spark, directory, classes, **settings):
    mapped = model.source(spark, directory, classes)
    return Engine(VirtualTriples(mapped), EngineConfig(default_graph=B, **settings), catalog=mapped.catalog())


# ---- scans and projection -------------------------------------------------------------

structured(
    "scan_project", ["Customer", "Nation"],
    {"source-table": "Customer", "fields": fields("c_name", "c_acctbal", "c_nationkey")},
    f"""select {iri('Customer', 'c_custkey')} as subject, c_name, c_acctbal,
        {iri('Nation', 'c_nationkey')} as c_nationkey from customer""",
    triples=True,
)
structured(
    "scan_subjects_only", ["Order"], {"source-table": "Order"},
    f"select {iri('Order', 'o_orderkey')} as subject from orders", triples=True,
)
structured(
    "scan_composite_key", ["Conversation"],
    {"source-table": "Conversation", "fields": fields("role", "text")},
    f"select concat('{B}Conversation/', conv_id, '/', turn) as subject, role, text from conversations",
)
structured(
    "multi_valued_rows", ["Embedding"], {"source-table": "Embedding", "fields": fields("embedding")},
    f"""select {iri('Embedding', 'vec_id')} as subject, v::double as embedding
        from (select vec_id, unnest(list_distinct(embedding)) as v from embeddings)""",
    cast={"embedding": "double"},
)
structured(
    "multi_valued_counts", ["Embedding"],
    {"source-table": "Embedding", "breakout": fields("label"),
     "aggregation": [["count"], ["count", field("embedding")]]},
    """select label, count(distinct vec_id) as ag_0, sum(len(list_distinct(embedding)))::bigint as ag_1
       from embeddings group by label""",
)

# ---- filters ----------------------------------------------------------------------------


def filtered(name, cls, column, clause, where, triples=False):
    table, key, _ = model.CLASSES[cls]
    structured(
        name, [cls], {"source-table": cls, "fields": fields(column), "filter": clause},
        f"select {iri(cls, key)} as subject, {column} from {table} where {where}", triples=triples,
    )


SEG = field("c_mktsegment")
filtered("filter_eq_str", "Customer", "c_mktsegment", ["=", SEG, "BUILDING"], "c_mktsegment = 'BUILDING'", True)
filtered("filter_ne_str", "Customer", "c_mktsegment", ["!=", SEG, ["value", "BUILDING", {}]],
         "c_mktsegment <> 'BUILDING'", True)
filtered("filter_eq_any", "Customer", "c_mktsegment", ["=", SEG, "BUILDING", "MACHINERY", "FURNITURE"],
         "c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')")
filtered("filter_gt", "Customer", "c_acctbal", [">", field("c_acctbal"), 5000], "c_acctbal > 5000", True)
filtered("filter_gte", "Part", "p_size", [">=", field("p_size"), 25], "p_size >= 25")
filtered("filter_lt", "Part", "p_retailprice", ["<", field("p_retailprice"), 950.5], "p_retailprice < 950.5", True)
filtered("filter_lte", "Supplier", "s_acctbal", ["<=", field("s_acctbal"), 100], "s_acctbal <= 100")
filtered("filter_between", "Part", "p_size", ["between", field("p_size"), 10, ["value", 20, {}]],
         "p_size between 10 and 20", True)
filtered("filter_and3", "Order", "o_orderstatus",
         ["and", ["=", field("o_orderstatus"), "F"], [">", field("o_totalprice"), 100000],
          ["=", field("o_orderpriority"), "1-URGENT"]],
         "o_orderstatus = 'F' and o_totalprice > 100000 and o_orderpriority = '1-URGENT'", True)
filtered("filter_or3", "Order", "o_orderpriority",
         ["or", ["=", field("o_orderpriority"), "1-URGENT"], ["<", field("o_totalprice"), 2000],
          ["=", field("o_orderstatus"), "P"]],
         "o_orderpriority = '1-URGENT' or o_totalprice < 2000 or o_orderstatus = 'P'")
filtered("filter_not", "Order", "o_orderstatus", ["not", ["or", ["=", field("o_orderstatus"), "F"],
                                                         ["=", field("o_orderstatus"), "O"]]],
         "not (o_orderstatus = 'F' or o_orderstatus = 'O')")
filtered("filter_date_range", "Order", "o_orderdate",
         ["and", [">=", field("o_orderdate"), "1996-01-01"], ["<", field("o_orderdate"), "1997-01-01"]],
         "o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01'")
# A date that no calendar has is a type error, in every comparison; so are comparisons with NaN false.
filtered("filter_date_malformed", "Order", "o_totalprice",
         ["or", ["=", field("o_orderdate"), "2020-13-45"], [">", field("o_orderdate"), "1996-02-30"],
          ["<", field("o_orderdate"), "1996-06-01"]],
         "o_orderdate < timestamp '1996-06-01'", True)
filtered("filter_nan", "Order", "o_totalprice",
         ["or", ["<", field("o_totalprice"), float("nan")], [">=", field("o_totalprice"), float("nan")],
          ["=", field("o_totalprice"), float("nan")], [">", field("o_totalprice"), 400000]],
         "o_totalprice > 400000", True)
filtered("filter_starts_with", "Part", "p_name", ["starts-with", field("p_name"), "red"],
         "starts_with(p_name, 'red')", True)
filtered("filter_starts_with_ci", "Part", "p_name",
         ["starts-with", field("p_name"), "RED", {"case-sensitive": False}], "starts_with(lower(p_name), 'red')")
filtered("filter_ends_with", "Part", "p_name", ["ends-with", field("p_name"), "bolt"], "ends_with(p_name, 'bolt')")
filtered("filter_ends_with_ci", "Part", "p_name",
         ["ends-with", field("p_name"), "BoLT", {"case-sensitive": False}], "ends_with(lower(p_name), 'bolt')", True)
filtered("filter_contains", "Page", "html", ["contains", field("html"), "<p>"], "contains(html, '<p>')")
filtered("filter_contains_ci", "Document", "text", ["contains", field("text"), "LICENSE", {"case-sensitive": False}],
         "contains(lower(text), 'license')")
filtered("filter_contains_iri", "Order", "o_orderstatus", ["contains", field("subject"), "Order/77"],
         "contains(concat('https://data.example/Order/', o_orderkey), 'Order/77')", True)
filtered("filter_type_error", "Customer", "c_mktsegment",
         ["or", ["=", SEG, 5], ["=", SEG, "BUILDING"]], "c_mktsegment = 'BUILDING'", True)
structured(
    "filter_iri_subject", ["Customer"],
    {"source-table": "Customer", "fields": fields("c_name"), "filter": ["=", field("subject"), B + "Customer/42"]},
    f"select {iri('Customer', 'c_custkey')} as subject, c_name from customer where c_custkey = 42", triples=True,
)
structured(
    "filter_iri_fk", ["Customer", "Nation"],
    {"source-table": "Customer", "fields": fields("c_name"), "filter": ["=", field("c_nationkey"), B + "Nation/7"]},
    f"select {iri('Customer', 'c_custkey')} as subject, c_name from customer where c_nationkey = 7", triples=True,
)
structured(
    "filter_iri_fk_ne", ["Customer", "Nation"],
    {"source-table": "Customer", "fields": fields("c_name"), "filter": ["!=", field("c_nationkey"), B + "Nation/7"]},
    f"select {iri('Customer', 'c_custkey')} as subject, c_name from customer where c_nationkey <> 7",
)
structured(
    "filter_iri_not_canonical", ["Customer", "Nation"],
    {"source-table": "Customer", "aggregation": [["count"]], "filter": ["=", field("c_nationkey"), B + "Nation/07"]},
    f"select count(*) as ag_0 from customer where {iri('Nation', 'c_nationkey')} = '{B}Nation/07'", triples=True,
)

LABEL = {"alias": "Label", "source-table": "Label", "fk-field-id": "label"}
QUALITY = field("quality", "Label")
DOC_LABELS = "documents d left join labels l on d.doc_id = l.doc_id"


def labelled(name, clause, where):
    structured(
        name, ["Document", "Label"],
        {"source-table": "Document", "joins": [LABEL], "filter": clause},
        f"select {iri('Document', 'd.doc_id')} as subject from {DOC_LABELS} where {where}", triples=True,
    )


labelled("filter_is_null", ["is-null", QUALITY], "l.quality is null")
labelled("filter_not_null", ["not-null", QUALITY], "l.quality is not null")
labelled("filter_eq_nil", ["=", QUALITY, None], "l.quality is null")
labelled("filter_ne_nil", ["!=", QUALITY, None], "l.quality is not null")
labelled("filter_ne_unbound_drops", ["!=", QUALITY, 1], "l.quality <> 1")
labelled("filter_not_unbound_drops", ["not", ["=", QUALITY, 1]], "not (l.quality = 1)")
labelled("filter_or_unbound_keeps", ["or", ["=", QUALITY, 1], [">", field("n_chars"), 3000]],
         "l.quality = 1 or d.n_chars > 3000")

# ---- sort and limit -----------------------------------------------------------------------

structured(
    "order_topk", ["Order"],
    {"source-table": "Order", "fields": fields("o_totalprice"),
     "order-by": [["desc", field("o_totalprice")], ["asc", field("subject")]], "limit": 10},
    f"""select {iri('Order', 'o_orderkey')} as subject, o_totalprice from orders
        order by o_totalprice desc nulls last, subject asc nulls first limit 10""", triples=True,
)
structured(
    "order_unbound_first", ["Document", "Label"],
    {"source-table": "Document", "joins": [LABEL], "fields": [QUALITY],
     "order-by": [["asc", QUALITY], ["desc", field("subject")]], "limit": 25},
    f"""select {iri('Document', 'd.doc_id')} as subject, l.quality as Label__quality from {DOC_LABELS}
        order by l.quality asc nulls first, subject desc nulls last limit 25""",
)
structured(
    "order_not_projected", ["Customer"],
    {"source-table": "Customer", "fields": fields("c_name"),
     "order-by": [["desc", field("c_acctbal")], ["asc", field("c_name")]], "limit": 20},
    f"""select {iri('Customer', 'c_custkey')} as subject, c_name from customer
        order by c_acctbal desc nulls last, c_name asc nulls first limit 20""", triples=True,
)

# ---- aggregation ----------------------------------------------------------------------------

structured(
    "count_subject", ["Order"], {"source-table": "Order", "aggregation": [["count"]]},
    "select count(distinct o_orderkey) as ag_0 from orders", triples=True,
)
structured(
    "count_rows_of_hashed_class", ["Lineitem"], {"source-table": "Lineitem", "aggregation": [["count"]]},
    "select count(*) as ag_0 from (select distinct * from lineitem)",
)
structured(
    "count_by_breakout", ["Customer"],
    {"source-table": "Customer", "aggregation": [["count"]], "breakout": fields("c_mktsegment")},
    "select c_mktsegment, count(distinct c_custkey) as ag_0 from customer group by 1", triples=True,
)
structured(
    "count_and_distinct_field", ["Order", "Customer"],
    {"source-table": "Order", "aggregation": [["count", field("o_custkey")], ["distinct", field("o_custkey")],
                                              ["distinct", field("o_orderpriority")]]},
    """select count(o_custkey) as ag_0, count(distinct o_custkey) as ag_1,
       count(distinct o_orderpriority) as ag_2 from orders""", triples=True,
)
structured(
    "sum_avg_min_max_by", ["Lineitem"],
    {"source-table": "Lineitem", "breakout": fields("l_returnflag", "l_linestatus"),
     "aggregation": [["sum", field("l_quantity")], ["avg", field("l_extendedprice")],
                     ["min", field("l_shipdate")], ["max", field("l_discount")], ["sum", field("l_linenumber")],
                     ["count"]]},
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as ag_0, round(avg(l_extendedprice) + 1e-7, 2) as ag_1,
       min(l_shipdate) as ag_2, max(l_discount) as ag_3, sum(l_linenumber)::bigint as ag_4, count(*) as ag_5
       from lineitem group by 1, 2""",
    rounding=dict(rounded=["ag_0"], averages=["ag_1"]),
)
structured(
    "global_agg", ["Lineitem"],
    {"source-table": "Lineitem", "aggregation": [
        ["sum", field("l_extendedprice")], ["avg", field("l_discount")], ["max", field("l_quantity")]]},
    """select round(sum(l_extendedprice), 2) as ag_0, round(avg(l_discount) + 1e-7, 2) as ag_1,
       max(l_quantity) as ag_2 from lineitem""",
    rounding=dict(rounded=["ag_0"], averages=["ag_1"]),
)
structured(
    "numeric_aggregates_of_part", ["Part"],
    {"source-table": "Part", "breakout": fields("p_brand"), "aggregation": [
        ["sum", field("p_size")], ["avg", field("p_retailprice")], ["min", field("p_size")],
        ["max", field("p_retailprice")]]},
    """select p_brand, sum(p_size)::bigint as ag_0, round(avg(p_retailprice) + 1e-7, 3) as ag_1,
       min(p_size)::bigint as ag_2, max(p_retailprice) as ag_3 from part group by 1""",
    rounding=dict(averages=["ag_1"], digits=3), cast={"ag_2": "bigint"}, triples=True,
)
structured(
    "agg_order_by_index_limit", ["Order"],
    {"source-table": "Order", "breakout": fields("o_orderpriority"), "aggregation": [["count"]],
     "order-by": [["desc", ["aggregation", 0]], ["asc", field("o_orderpriority")]], "limit": 3},
    """select o_orderpriority, count(distinct o_orderkey) as ag_0 from orders group by 1
       order by ag_0 desc nulls last, o_orderpriority asc nulls first limit 3""", triples=True,
)
structured(
    "agg_filter_pre", ["Order"],
    {"source-table": "Order", "filter": ["=", field("o_orderstatus"), "F"], "breakout": fields("o_orderpriority"),
     "aggregation": [["count"], ["max", field("o_totalprice")]]},
    """select o_orderpriority, count(distinct o_orderkey) as ag_0, max(o_totalprice) as ag_1 from orders
       where o_orderstatus = 'F' group by 1""", triples=True,
)
structured(
    "min_max_iri", ["Customer", "Nation"],
    {"source-table": "Customer", "breakout": fields("c_mktsegment"),
     "aggregation": [["min", field("c_nationkey")], ["max", field("subject")]]},
    f"""select c_mktsegment, min({iri('Nation', 'c_nationkey')}) as ag_0,
        max({iri('Customer', 'c_custkey')}) as ag_1 from customer group by 1""", triples=True,
)
structured(
    "breakout_without_aggregation", ["Order"],
    {"source-table": "Order", "breakout": fields("o_orderstatus", "o_orderpriority")},
    "select distinct o_orderstatus, o_orderpriority from orders", triples=True,
)
structured(
    "group_unbound_is_a_group", ["Document", "Label"],
    {"source-table": "Document", "joins": [LABEL], "breakout": [QUALITY], "aggregation": [["count"]]},
    f"select l.quality as Label__quality, count(distinct d.doc_id) as ag_0 from {DOC_LABELS} group by 1",
)
structured(
    "agg_skips_unbound", ["Document", "Label"],
    {"source-table": "Document", "joins": [LABEL], "breakout": fields("lang"), "aggregation": [
        ["count", QUALITY], ["sum", QUALITY], ["avg", field("toxic", "Label")], ["count"]]},
    f"""select d.lang, count(l.quality) as ag_0, sum(l.quality)::bigint as ag_1, round(avg(l.toxic), 4) as ag_2,
        count(distinct d.doc_id) as ag_3 from {DOC_LABELS} group by 1""",
    rounding=dict(rounded=["ag_2"], digits=4), triples=True,
)
structured(
    "duplicate_agg_names", ["Order", "Customer"],
    {"source-query": {"source-table": "Order", "breakout": fields("o_orderpriority"),
                      "aggregation": [["count"], ["distinct", field("o_custkey")]]},
     "filter": [">", field("count_2"), 100], "fields": fields("o_orderpriority", "count", "count_2")},
    """select * from (select o_orderpriority, count(distinct o_orderkey) as ag_0, count(distinct o_custkey) as ag_1
       from orders group by 1) where ag_1 > 100""",
)

# ---- joins ------------------------------------------------------------------------------------

CUSTOMER = {"alias": "Customer", "source-table": "Customer", "fk-field-id": "o_custkey"}
NATION = {"alias": "Nation", "source-table": "Nation", "fk-field-id": "c_nationkey"}
REGION = {"alias": "Region", "source-table": "Region", "fk-field-id": "n_regionkey"}
ORDER_SIDE = ["Order", "Customer", "Nation", "Region"]
O_C_N_R = """orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey"""

structured(
    "join_implicit_remap", ["Customer", "Nation"],
    {"source-table": "Customer", "joins": [NATION], "fields": [field("c_name"), field("n_name", "Nation")]},
    f"""select {iri('Customer', 'c_custkey')} as subject, c_name, n_name as Nation__n_name
        from customer left join nation on c_nationkey = n_nationkey""", triples=True,
)
structured(
    "join_explicit", ["Order", "Customer"],
    {"source-table": "Order",
     "joins": [{"alias": "Buyer", "source-table": "Customer", "strategy": "left-join",
                "condition": ["and", ["=", field("o_custkey"), field("subject", "Buyer")]]}],
     "fields": [field("o_totalprice"), field("c_name", "Buyer"), field("subject", "Buyer")]},
    f"""select {iri('Order', 'o_orderkey')} as subject, o_totalprice, c_name as Buyer__c_name,
        {iri('Customer', 'o_custkey')} as Buyer_subject
        from orders left join customer on o_custkey = c_custkey""",
)
structured(
    "join_chain_2", ["Customer", "Nation", "Region"],
    {"source-table": "Customer", "joins": [REGION, NATION],
     "fields": [field("c_name"), field("n_name", "Nation"), field("r_name", "Region")]},
    f"""select {iri('Customer', 'c_custkey')} as subject, c_name, n_name as Nation__n_name, r_name as Region__r_name
        from customer left join nation on c_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""", triples=True,
)
CHAIN_3 = {
    "source-table": "Order", "joins": [CUSTOMER, NATION, REGION],
    "breakout": [field("r_name", "Region")], "aggregation": [["count"], ["sum", field("o_totalprice")]],
    "order-by": [["desc", ["aggregation", 0]]], "limit": 10,
}
CHAIN_3_SQL = f"""select r_name as Region__r_name, count(distinct o_orderkey) as ag_0,
    round(sum(o_totalprice), 2) as ag_1 from {O_C_N_R} group by 1 order by ag_0 desc nulls last limit 10"""
structured("join_chain_3", ORDER_SIDE, CHAIN_3, CHAIN_3_SQL, rounding=dict(rounded=["ag_1"]), triples=True)
structured("join_chain_3_grouped_early", ORDER_SIDE, CHAIN_3, CHAIN_3_SQL, rounding=dict(rounded=["ag_1"]), pre_aggregate="always")
structured(
    "join_explicit_chain", ORDER_SIDE,
    {"source-table": "Order", "joins": [
        {"alias": "C", "source-table": "Customer", "condition": ["=", field("o_custkey"), field("subject", "C")]},
        {"alias": "N", "source-table": "Nation",
         "condition": ["=", field("c_nationkey", "C"), field("subject", "N")]}],
     "breakout": [field("n_name", "N")], "aggregation": [["distinct", field("subject")]]},
    """select n_name as N__n_name, count(distinct o_orderkey) as ag_0 from orders
       left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey group by 1""",
)
structured(
    "join_breakout_joined", ["Order", "Customer"],
    {"source-table": "Order", "joins": [CUSTOMER], "aggregation": [["count"], ["avg", field("o_totalprice")]],
     "breakout": [field("c_mktsegment", "Customer"), field("o_orderstatus")]},
    """select c_mktsegment as Customer__c_mktsegment, o_orderstatus, count(distinct o_orderkey) as ag_0,
       round(avg(o_totalprice) + 1e-7, 2) as ag_1
       from orders left join customer on o_custkey = c_custkey group by 1, 2""",
    rounding=dict(averages=["ag_1"]), triples=True,
)
structured(
    "join_filter_joined", ORDER_SIDE,
    {"source-table": "Order", "joins": [CUSTOMER, NATION, REGION], "fields": fields("o_totalprice"),
     "filter": ["=", field("r_name", "Region"), "ASIA"]},
    f"select {iri('Order', 'o_orderkey')} as subject, o_totalprice from {O_C_N_R} where r_name = 'ASIA'",
)
structured(
    "join_aggregates_of_joined", ["Order", "Customer"],
    {"source-table": "Order", "joins": [CUSTOMER], "breakout": fields("o_orderpriority"),
     "aggregation": [["sum", field("c_acctbal", "Customer")], ["distinct", field("c_mktsegment", "Customer")]]},
    """select o_orderpriority, round(sum(c_acctbal), 2) as ag_0, count(distinct c_mktsegment) as ag_1
       from orders left join customer on o_custkey = c_custkey group by 1""", rounding=dict(rounded=["ag_0"]),
)
structured(
    "join_two_parents", ["Lineitem", "Part", "Supplier", "Nation"],
    {"source-table": "Lineitem", "joins": [
        {"alias": "Part", "source-table": "Part", "fk-field-id": "l_partkey"},
        {"alias": "Supplier", "source-table": "Supplier", "fk-field-id": "l_suppkey"},
        {"alias": "Nation", "source-table": "Nation", "fk-field-id": "s_nationkey"}],
     "filter": ["and", [">", field("l_quantity"), 10], ["!=", field("p_type", "Part"), "SMALL"]],
     "breakout": [field("p_brand", "Part"), field("n_name", "Nation")],
     "aggregation": [["sum", field("l_extendedprice")], ["count", field("l_quantity")]]},
    """select p_brand as Part__p_brand, n_name as Nation__n_name, round(sum(l_extendedprice), 2) as ag_0,
       count(l_quantity) as ag_1 from lineitem left join part on l_partkey = p_partkey
       left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey
       where l_quantity > 10 and p_type <> 'SMALL' group by 1, 2""", rounding=dict(rounded=["ag_0"]),
)
structured(
    "join_two_parents_grouped_early", ["Lineitem", "Part", "Supplier"],
    {"source-table": "Lineitem", "joins": [
        {"alias": "Part", "source-table": "Part", "fk-field-id": "l_partkey"},
        {"alias": "Supplier", "source-table": "Supplier", "fk-field-id": "l_suppkey"}],
     "filter": ["or", ["=", field("p_type", "Part"), "SMALL"], ["=", field("l_returnflag"), "R"]],
     "breakout": [field("p_brand", "Part"), field("l_linestatus")],
     "aggregation": [["sum", field("l_linenumber")], ["avg", field("l_quantity")],
                     ["min", field("l_shipdate")], ["max", field("l_tax")], ["count"]]},
    """select p_brand as Part__p_brand, l_linestatus, sum(l_linenumber)::bigint as ag_0,
       round(avg(l_quantity), 3) as ag_1, min(l_shipdate) as ag_2, max(l_tax) as ag_3, count(*) as ag_4
       from lineitem left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey
       where p_type = 'SMALL' or l_returnflag = 'R' group by 1, 2""",
    rounding=dict(rounded=["ag_1"], digits=3), pre_aggregate="always",
)
structured(
    "join_events_to_customers", ["Event", "Customer", "Nation"],
    {"source-table": "Event", "joins": [
        {"alias": "User", "source-table": "Customer", "fk-field-id": "user_id"},
        {"alias": "Nation", "source-table": "Nation", "fk-field-id": "c_nationkey"}],
     "breakout": [field("event_type"), field("n_name", "Nation")],
     "aggregation": [["count"], ["max", field("value")]]},
    """select event_type, n_name as Nation__n_name, count(distinct event_id) as ag_0, max(value) as ag_1
       from events left join customer on user_id = c_custkey left join nation on c_nationkey = n_nationkey
       group by 1, 2""",
)
structured(
    "join_unmatched_kept", ["Document", "Label"],
    {"source-table": "Document", "joins": [LABEL], "fields": [QUALITY]},
    f"select {iri('Document', 'd.doc_id')} as subject, l.quality as Label__quality from {DOC_LABELS}",
)


def display_remap(spark, directory):
    engine = model.engine(spark, directory, ["Customer", "Nation", "Region"])
    engine.catalog.set_display_remap("Customer", "c_nationkey", "Nation", "n_name")
    query = {"source-table": "Customer", "fields": fields("c_name", "c_nationkey")}
    return engine.query(query, remaps=True).to_df()


register("display_value_remap", f"""
    select {iri('Customer', 'c_custkey')} as subject, c_name, {iri('Nation', 'c_nationkey')} as c_nationkey,
    n_name as Nation__via__c_nationkey__n_name
    from customer left join nation on c_nationkey = n_nationkey""")(display_remap)



def remapped(name, query, sql):
    def run(spark, directory):
        engine = model.engine(spark, directory, ["Customer", "Nation", "Region"])
        engine.catalog.set_display_remap("Customer", "c_nationkey", "Nation", "n_name")
        return engine.query(query(), remaps=True).to_df()

    register(name, sql)(run)


# ---- stages over stages ---------------------------------------------------------------------

PER_NATION = {"source-table": "Customer", "aggregation": [["count"]], "breakout": fields("c_nationkey")}
PER_NATION_SQL = f"""(select {iri('Nation', 'c_nationkey')} as c_nationkey, c_nationkey as k,
    count(distinct c_custkey) as ag_0 from customer group by 1, 2)"""
CUST = ["Customer", "Nation"]

structured("derived_passthrough", CUST, {"source-query": PER_NATION},
           f"select c_nationkey, ag_0 from {PER_NATION_SQL}", triples=True)
structured("derived_filter_on_agg", CUST, {"source-query": PER_NATION, "filter": [">", field("count"), 60]},
           f"select c_nationkey, ag_0 from {PER_NATION_SQL} where ag_0 > 60", triples=True)
structured("derived_agg_over_agg", ["Order", "Customer"],
           {"source-query": {"source-table": "Order", "aggregation": [["count"]], "breakout": fields("o_custkey")},
            "aggregation": [["min", field("ag_0")], ["max", field("count")], ["avg", field("count")]]},
           """select min(n) as ag_0, max(n) as ag_1, round(avg(n), 3) as ag_2
              from (select count(distinct o_orderkey) as n from orders group by o_custkey)""",
           rounding=dict(rounded=["ag_2"], digits=3))
structured("derived_count_star", ["Order", "Customer"],
           {"source-query": {"source-table": "Order", "aggregation": [["count"]], "breakout": fields("o_custkey")},
            "breakout": fields("count"), "aggregation": [["count"]]},
           """select n as ag_0, count(*) as ag_0_2
              from (select count(distinct o_orderkey) as n from orders group by o_custkey) group by 1""")
structured("derived_remap", CUST,
           {"source-query": PER_NATION,
            "joins": [{"alias": "Nation", "source-table": "Nation",
                       "condition": ["=", field("c_nationkey"), field("subject", "Nation")]}],
            "fields": [field("c_nationkey"), field("count"), field("n_name", "Nation")]},
           f"""select c_nationkey, ag_0, n_name as Nation__n_name
               from {PER_NATION_SQL} left join nation on k = n_nationkey""", triples=True)
remapped("display_remap_of_aggregate", lambda: PER_NATION | {"order-by": [["desc", ["aggregation", 0]]]},
         f"""select c_nationkey, ag_0, n_name as Nation__via__c_nationkey__n_name
             from {PER_NATION_SQL} left join nation on k = n_nationkey""")
remapped("display_remap_of_derived", lambda: {"source-query": PER_NATION, "filter": [">", field("count"), 60]},
         f"""select c_nationkey, ag_0, n_name as Nation__via__c_nationkey__n_name
             from {PER_NATION_SQL} left join nation on k = n_nationkey where ag_0 > 60""")
structured("derived_order_limit", CUST,
           {"source-query": PER_NATION, "order-by": [["desc", field("count")], ["asc", field("c_nationkey")]],
            "limit": 5},
           f"""select c_nationkey, ag_0 from {PER_NATION_SQL}
               order by ag_0 desc nulls last, c_nationkey asc nulls first limit 5""", triples=True)
structured("derived_filter_on_joined_breakout", CUST,
           {"source-query": {"source-table": "Customer", "joins": [NATION], "aggregation": [["count"]],
                             "breakout": [field("n_name", "Nation")]},
            "filter": ["starts-with", field("n_name", "Nation"), "NATION_1"]},
           """select n_name as Nation__n_name, count(distinct c_custkey) as ag_0 from customer
              left join nation on c_nationkey = n_nationkey where starts_with(n_name, 'NATION_1') group by 1""")
structured("derived_named_aggregate", ["Order"],
           {"source-query": {"source-table": "Order", "breakout": fields("o_orderpriority"),
                             "aggregation": [["aggregation-options", ["sum", field("o_totalprice")],
                                              {"name": "total"}]]},
            "filter": [">", field("total"), 0], "order-by": [["desc", field("total")]], "limit": 2},
           """select o_orderpriority, round(sum(o_totalprice), 2) as ag_0 from orders group by 1
              order by ag_0 desc nulls last limit 2""", rounding=dict(rounded=["ag_0"]))
structured("derived_three_stages", ["Order", "Customer"],
           {"source-query": {"source-query": {"source-table": "Order", "aggregation": [["count"]],
                                              "breakout": fields("o_custkey")},
                             "breakout": fields("count"), "aggregation": [["count"]]},
            "aggregation": [["max", field("count")], ["count"]]},
           """select max(c) as ag_0, count(*) as ag_1 from (select n, count(*) as c
              from (select count(distinct o_orderkey) as n from orders group by o_custkey) group by n)""")

# ---- projection reconciled with expected columns ----------------------------------------------

structured("reconcile_projection", ["Nation", "Region"],
           {"source-table": "Nation", "joins": [REGION], "fields": fields("n_name")},
           f"""select n_name, cast(null as varchar) as undefined_1, {iri('Nation', 'n_nationkey')} as subject,
               r_name as Region__r_name, n_nationkey, cast(null as varchar) as undefined_2
               from nation left join region on n_regionkey = r_regionkey""",
           expected=[dict(name="n_name"), dict(name="an_expression"), dict(name="subject"),
                     dict(name="r_name", fk_field="n_regionkey"), dict(name="n_nationkey"),
                     dict(name="r_name", join_alias="no such join")])
structured("reconcile_derived", CUST,
           {"source-query": PER_NATION,
            "joins": [{"alias": "N", "source-table": "Nation",
                       "condition": ["=", field("c_nationkey"), field("subject", "N")]}],
            "filter": [">", field("How many"), 50]},
           f"""select c_nationkey, ag_0, n_name as N__n_name, cast(null as varchar) as undefined_1
               from {PER_NATION_SQL} left join nation on k = n_nationkey where ag_0 > 50""",
           expected=[dict(name="c_nationkey"), dict(name="How many"), dict(name="n_name", join_alias="N"),
                     dict(name="more")])

# ---- languages ----------------------------------------------------------------------------------

structured("lang_filter", ["Document", "Label"],
           {"source-table": "Document", "fields": fields("text")},
           f"""select {iri('Document', 'doc_id')} as subject, text from documents
               where lang is null or lang = 'fr' or lang = ''""", triples=True, default_language="fr")
structured("lang_filter_only_when_read", ["Document", "Label"],
           {"source-table": "Document", "fields": fields("n_chars")},
           f"select {iri('Document', 'doc_id')} as subject, n_chars from documents", default_language="fr")
structured("lang_tagged_text_is_no_plain_string", ["Document", "Label"],
           {"source-table": "Document", "aggregation": [["count"]],
            "filter": ["or", ["=", field("text"), "x"], ["!=", field("text"), "x"]]},
           "select count(*) as ag_0 from documents where lang = ''", triples=True)

# ---- native queries: patterns over the triples, and SQL with parameters -------------------------


def prop(name):
    return B + name


@register("native_select", f"""select {iri('Customer', 'c_custkey')} as s, c_name as name from customer
                               where c_mktsegment = 'BUILDING'""")
def native_select(spark, directory):
    graph = triple_source(spark, directory, ["Customer"])
    df = match(graph, ("?s", "a", B + "Customer"), ("?s", prop("c_mktsegment"), Literal("BUILDING")),
               ("?s", prop("c_name"), "?name"))
    return df.select(F.col("s.value").alias("s"), F.col("name.value").alias("name"))


@register("native_subject_constant", """select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
                                         where c_custkey = 5""")
def native_subject_constant(spark, directory):
    graph = triple_source(spark, directory, ["Customer", "Nation"])
    one = B + "Customer/5"
    known = values(spark, c=[one])
    for variable, name in (("?name", "c_name"), ("?balance", "c_acctbal"), ("?segment", "c_mktsegment")):
        row = match(graph, (one, prop(name), variable)).withColumn("c", terms.iri_term(one, bound=True))
        known = natural_join(known, row)
    return known.select(F.col("name.value").alias("name"), terms.number(F.col("balance")).alias("balance"),
                        F.col("segment.value").alias("segment"))


@register("native_object_constant", f"""select {iri('Customer', 'c_custkey')} as c, c_name as name, c_mktsegment as segment
                                        from customer where c_nationkey = 7""")
def native_object_constant(spark, directory):
    graph = triple_source(spark, directory, ["Customer", "Nation"])
    df = match(graph, ("?c", prop("c_nationkey"), B + "Nation/7"), ("?c", prop("c_name"), "?name"),
               ("?c", prop("c_mktsegment"), "?segment"))
    return df.select(F.col("c.value").alias("c"), F.col("name.value").alias("name"), F.col("segment.value").alias("segment"))


@register("native_all_of_subject", f"""select '{B}c_name' as p, c_name as o from customer where c_custkey = 5
    union all select '{B}c_mktsegment', c_mktsegment from customer where c_custkey = 5
    union all select '{B}c_nationkey', {iri('Nation', 'c_nationkey')} from customer where c_custkey = 5""")
def native_all_of_subject(spark, directory):
    graph = triple_source(spark, directory, ["Customer", "Nation"])
    df = match(graph, (B + "Customer/5", "?p", "?o"))
    shown = df.select(F.col("p.value").alias("p"), F.col("o.value").alias("o"))
    return shown.where(F.col("p").isin([prop(name) for name in ("c_name", "c_mktsegment", "c_nationkey")]))


@register("native_star_join", f"""select {iri('Order', 'o_orderkey')} as o, c_name as name, n_name as nation from orders
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderstatus = 'P' and c_mktsegment = 'BUILDING'""")
def native_star_join(spark, directory):
    graph = triple_source(spark, directory, ["Order", "Customer", "Nation"])
    df = match(graph, ("?o", prop("o_orderstatus"), Literal("P")), ("?o", prop("o_custkey"), "?c"),
               ("?c", "a", B + "Customer"), ("?c", prop("c_mktsegment"), Literal("BUILDING")), ("?c", prop("c_name"), "?name"),
               ("?c", prop("c_nationkey"), "?n"), ("?n", prop("n_name"), "?nation"))
    return df.select(F.col("o.value").alias("o"), F.col("name.value").alias("name"), F.col("nation.value").alias("nation"))


@register("native_join_path", """select n_name as nation, r_name as region from nation
                                 join region on n_regionkey = r_regionkey""")
def native_join_path(spark, directory):
    graph = triple_source(spark, directory, ["Nation", "Region"])
    df = match(graph, ("?n", prop("n_regionkey"), "?r"), ("?n", prop("n_name"), "?nation"),
               ("?r", prop("r_name"), "?region"))
    return df.select(terms.text(F.col("nation")).alias("nation"), terms.text(F.col("region")).alias("region"))


@register("native_optional", f"""select {iri('Document', 'd.doc_id')} as doc, quality from {DOC_LABELS}""")
def native_optional(spark, directory):
    graph = triple_source(spark, directory, ["Document", "Label"])
    df = match(graph, ("?doc", prop("label"), "?label"))
    df = optional(df, graph, ("?label", prop("quality"), "?quality"))
    return df.select(F.col("doc.value").alias("doc"), terms.number(F.col("quality")).cast("int").alias("quality"))


@register("native_group", """select o_orderstatus as status, count(*) as n, round(sum(o_totalprice), 2) as total
                             from orders group by 1""")
def native_group(spark, directory):
    graph = triple_source(spark, directory, ["Order", "Customer"])
    df = match(graph, ("?o", prop("o_orderstatus"), "?status"), ("?o", prop("o_totalprice"), "?price"))
    return df.groupBy(terms.text(F.col("status")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(terms.number(F.col("price"))), 2).alias("total"))


@register("native_subselect", f"""select c_name as name, n from customer join
    (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey where n > 14""")
def native_subselect(spark, directory):
    graph = triple_source(spark, directory, ["Order", "Customer"])
    counts = match(graph, ("?o", prop("o_custkey"), "?c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    named = match(graph, ("?c", prop("c_name"), "?name"))
    joined = counts.where("n > 14").join(named, "c")
    return joined.select(F.col("name.value").alias("name"), "n")


@register("native_ask", "select count(*) > 0 as boolean from customer where c_acctbal > 9990")
def native_ask(spark, directory):
    graph = triple_source(spark, directory, ["Customer"])
    df = match(graph, ("?c", prop("c_acctbal"), "?b"))
    return ask(df.where(terms.compare(F.col("b"), ">", 9990)))


@register("native_values_bind", f"""select {iri('Nation', 'n_nationkey')} as n, upper(n_name) as shout
                                    from nation where n_nationkey in (3, 5)""")
def native_values_bind(spark, directory):
    graph = triple_source(spark, directory, ["Nation", "Region"])
    wanted = values(spark, n=[B + "Nation/3", B + "Nation/5"])
    df = optional(wanted, graph, ("?n", prop("n_name"), "?name"))
    return df.select(F.col("n.value").alias("n"), F.upper(terms.text(F.col("name"))).alias("shout"))


@register("native_distinct_order_limit", """select distinct p_brand as brand from part
                                            order by brand desc nulls last limit 5""")
def native_distinct_order_limit(spark, directory):
    graph = triple_source(spark, directory, ["Part"])
    brands = match(graph, ("?p", prop("p_brand"), "?brand")).select("brand").distinct()
    top = brands.orderBy(terms.sort_key(F.col("brand")).desc_nulls_last()).limit(5)
    return top.select(F.col("brand.value").alias("brand"))


@register("native_union", """select c_name as name, c_acctbal as balance from customer
                             union all select s_name, s_acctbal from supplier""")
def native_union(spark, directory):
    graph = triple_source(spark, directory, ["Customer", "Supplier", "Nation"])
    parts = [match(graph, ("?x", prop(f"{c}_name"), "?name"), ("?x", prop(f"{c}_acctbal"), "?balance"))
             for c in ("c", "s")]
    df = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return df.select(F.col("name.value").alias("name"), terms.number(F.col("balance")).alias("balance"))


@register("native_exists", f"""select {iri('Order', 'o_orderkey')} as o from orders
    where exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def native_exists(spark, directory):
    graph = triple_source(spark, directory, ["Order", "Customer", "Lineitem", "Part", "Supplier"])
    df = exists(match(graph, ("?o", "a", B + "Order")), graph, ("?l", prop("l_orderkey"), "?o"))
    return df.select(F.col("o.value").alias("o"))


@register("native_not_exists", f"""select {iri('Order', 'o_orderkey')} as o from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def native_not_exists(spark, directory):
    graph = triple_source(spark, directory, ["Order", "Customer", "Lineitem", "Part", "Supplier"])
    df = not_exists(match(graph, ("?o", "a", B + "Order")), graph, ("?l", prop("l_orderkey"), "?o"))
    return df.select(F.col("o.value").alias("o"))


# Suppliers with an even number are known by their nation, the others by its region alone, some by neither.
PLACED = f"""(select s_suppkey, case when s_suppkey % 2 = 0 then s_nationkey end as nation,
    case when s_suppkey % 2 = 1 then n_regionkey end as region from supplier join nation on s_nationkey = n_nationkey)"""


def placed_suppliers(graph):
    """Solutions of a UNION: each of them leaves ?n or ?r unbound."""
    rows = match(graph, ("?s", prop("s_suppkey"), "?k"), ("?s", prop("s_nationkey"), "?n"), ("?n", prop("n_regionkey"), "?r"))
    even = terms.number(F.col("k")) % 2 == 0
    return rows.where(even).select("s", "n").unionByName(rows.where(~even).select("s", "r"), allowMissingColumns=True)


def nations_called(graph, letter):
    rows = match(graph, ("?n", prop("n_regionkey"), "?r"), ("?n", prop("n_name"), "?name"))
    return rows.where(F.col("name.value").endswith(letter)) if letter else rows


def shown_solutions(df, *names):
    return df.select(*(F.col(n)["value"].alias(n) for n in names))


@register("native_union_join", f"""select {iri('Supplier', 's_suppkey')} as s, {iri('Nation', 'n_nationkey')} as n, {iri('Region', 'n_regionkey')} as r,
    n_name as name from {PLACED} p join nation on n_nationkey = p.nation or n_regionkey = p.region""")
def native_union_join(spark, directory):
    graph = triple_source(spark, directory, ["Supplier", "Nation", "Region"])
    return shown_solutions(natural_join(placed_suppliers(graph), nations_called(graph, "")), "s", "n", "r", "name")


@register("native_optional_unbound", f"""select {iri('Supplier', 's_suppkey')} as s, {iri('Nation', 'coalesce(n_nationkey, p.nation)')} as n,
    {iri('Region', 'coalesce(n_regionkey, p.region)')} as r, n_name as name
    from {PLACED} p left join nation on (n_nationkey = p.nation or n_regionkey = p.region) and n_name like '%3'""".replace(
        iri('Nation', 'coalesce(n_nationkey, p.nation)'), f"'{B}Nation/' || coalesce(n_nationkey, p.nation)").replace(
        iri('Region', 'coalesce(n_regionkey, p.region)'), f"'{B}Region/' || coalesce(n_regionkey, p.region)"))
def native_optional_unbound(spark, directory):
    graph = triple_source(spark, directory, ["Supplier", "Nation", "Region"])
    return shown_solutions(optional_join(placed_suppliers(graph), nations_called(graph, "3")), "s", "n", "r", "name")


@register("native_minus", f"""select {iri('Supplier', 's_suppkey')} as s from {PLACED} p where not exists (
    select 1 from nation where n_name like '%3' and (n_nationkey = p.nation or n_regionkey = p.region))""")
def native_minus(spark, directory):
    graph = triple_source(spark, directory, ["Supplier", "Nation", "Region"])
    return shown_solutions(minus(placed_suppliers(graph), nations_called(graph, "3")), "s")


@register("native_minus_optional", f"""select {iri('Document', 'd.doc_id')} as d from {DOC_LABELS} where quality is distinct from 1""")
def native_minus_optional(spark, directory):
    """The side that is taken away binds ?q in some of its solutions only."""
    graph = triple_source(spark, directory, ["Document", "Label"])
    docs = match(graph, ("?d", prop("lang"), "?lang"), ("?d", prop("label"), "?x"))
    rated = optional(match(graph, ("?d", prop("label"), "?x")), graph, ("?x", prop("quality"), "?q"))
    rated = rated.where(terms.number(F.col("q")) == 1)
    return shown_solutions(minus(docs, rated), "d")


@register("native_exists_unbound", f"""select {iri('Supplier', 's_suppkey')} as s from {PLACED} p where exists (
    select 1 from customer join nation on c_nationkey = n_nationkey where n_nationkey = p.nation or n_regionkey = p.region)""")
def native_exists_unbound(spark, directory):
    graph = triple_source(spark, directory, ["Supplier", "Nation", "Region", "Customer"])
    met = exists(placed_suppliers(graph), graph, ("?c", prop("c_nationkey"), "?n"), ("?n", prop("n_regionkey"), "?r"))
    return shown_solutions(met, "s")


@register("native_lang_datatype", """select lang, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' as datatype,
                                     count(*) as n from documents group by 1""")
def native_lang_datatype(spark, directory):
    graph = triple_source(spark, directory, ["Document", "Label"])
    text = F.col("text")
    df = match(graph, ("?d", prop("text"), "?text"))
    return df.groupBy(terms.lang(text).alias("lang"), terms.datatype(text).alias("datatype")).agg(
        F.count(F.lit(1)).alias("n"))


@register("native_if_coalesce_in", f"""select {iri('Document', 'd.doc_id')} as doc,
    coalesce(quality::varchar, if(lang in ('en', 'fr'), 'unrated', 'unread')) as rating from {DOC_LABELS}""")
def native_if_coalesce_in(spark, directory):
    graph = triple_source(spark, directory, ["Document", "Label"])
    df = match(graph, ("?doc", prop("label"), "?label"), ("?doc", prop("lang"), "?lang"))
    df = optional(df, graph, ("?label", prop("quality"), "?quality"))
    fallback = F.when(terms.plain_string(F.col("lang")).isin("en", "fr"), "unrated").otherwise("unread")
    return df.select(F.col("doc.value").alias("doc"),
                     F.coalesce(terms.text(F.col("quality")), fallback).alias("rating"))


@register("native_bind_strdt", f"""select {iri('Part', 'p_partkey')} as part, length(p_name)::bigint * p_size as area
                                   from part where length(p_name) * p_size > 200""")
def native_bind_strdt(spark, directory):
    """BIND of a computed, retyped value, and a filter on it."""
    graph = triple_source(spark, directory, ["Part"])
    df = match(graph, ("?part", prop("p_name"), "?name"), ("?part", prop("p_size"), "?size"))
    product = F.length(terms.text(F.col("name"))) * terms.number(F.col("size"))
    df = df.withColumn("area", terms.literal_term(product.cast("bigint"), V.XSD + "integer"))
    df = df.where(terms.compare(F.col("area"), ">", 200))
    return df.select(F.col("part.value").alias("part"), terms.number(F.col("area")).cast("bigint").alias("area"))


@register("native_predicate_variable", f"""select '{B}' || p as p, count(*) as n from (
    select unnest(['c_custkey', 'c_name', 'c_acctbal', 'c_mktsegment', 'c_nationkey']) as p from customer)
    group by 1 union all select '{V.RDF_TYPE}', count(*) from customer""")
def native_predicate_variable(spark, directory):
    graph = triple_source(spark, directory, ["Customer"])
    df = match(graph, ("?s", "a", B + "Customer"), ("?s", "?p", "?o"))
    return df.groupBy(F.col("p.value").alias("p")).agg(F.count(F.lit(1)).alias("n"))


def sql_over_views(classes, text, parameters):
    def run(spark, directory):
        engine = model.engine(spark, directory, classes)
        engine.views(spark, prefix="kg_")
        return engine.native(spark, text, parameters)

    return run


register("param_template_int", f"""select {iri('Order', 'o_orderkey')} as subject, o_totalprice
                                   from orders where o_totalprice > 400000""")(
    sql_over_views(["Order", "Customer"],
                   "SELECT subject, o_totalprice FROM kg_Order WHERE o_totalprice > {{ floor }}", {"floor": 400000}))
register("param_template_iri", f"""select c_name from customer where c_nationkey = 7""")(
    sql_over_views(CUST, "SELECT c_name FROM kg_Customer WHERE c_nationkey = {{nation}}", {"nation": B + "Nation/7"}))
register("param_template_list", """select c_name, c_mktsegment from customer
                                   where c_mktsegment in ('BUILDING', 'MACHINERY')""")(
    sql_over_views(CUST, "SELECT c_name, c_mktsegment FROM kg_Customer WHERE c_mktsegment IN ({{segments}})",
                   {"segments": ["BUILDING", "MACHINERY"]}))
register("native_sql_triples", "select count(*) as n from part where p_brand = 'Brand#4'")(
    sql_over_views(["Part"], """SELECT count(*) AS n FROM kg_triples WHERE p = {{p}} AND o.value = {{brand}}""",
                   {"p": B + "p_brand", "brand": "Brand#4"}))

# ---- discovery and typing ----------------------------------------------------------------------


def _class_counts():
    return " union all ".join(
        f"select '{B}{cls}' as class, count(*) as count from {table}" for cls, (table, _, _) in model.CLASSES.items())


@register("discover_classes", _class_counts())
def discover_classes(spark, directory):
    return discovery.classes(model.source(spark, directory))


@register("discover_properties", f"""
    select '{B}Customer' as class, property, count, is_iri::int as is_iri from (
      select '{V.RDF_TYPE}' as property, count(*) as count, 1 as is_iri from customer
      union all select '{B}c_custkey', count(c_custkey), 0 from customer
      union all select '{B}c_name', count(c_name), 0 from customer
      union all select '{B}c_acctbal', count(c_acctbal), 0 from customer
      union all select '{B}c_mktsegment', count(c_mktsegment), 0 from customer
      union all select '{B}c_nationkey', count(c_nationkey), 1 from customer)""")
def discover_properties(spark, directory):
    source = model.source(spark, directory, ["Customer", "Nation", "Region"])
    return discovery.properties(source, B + "Customer")


@register("typing_observed", """
    select 'subject' as name, 'URL' as base_type union all select 'c_custkey', 'Integer'
    union all select 'c_acctbal', 'Float' union all select 'c_name', 'Text' union all select 'c_nationkey', 'URL'""")
def typing_observed(spark, directory):
    """Types found by looking at every cell, with nothing declared."""
    graph = triple_source(spark, directory, ["Customer", "Nation"])
    engine = Engine(graph, EngineConfig(default_graph=B, metadata_sync_strategy="none"))
    result = engine.query({"source-table": "Customer",
                           "fields": fields("c_custkey", "c_acctbal", "c_name", "c_nationkey")})
    return spark.createDataFrame([(c.name, c.base_type) for c in result.columns()], "name string, base_type string")


@register("typing_mixed_promotes", """select c_acctbal::double as x from customer
                                      union all select c_custkey::double from customer""")
def typing_mixed_promotes(spark, directory):
    """Integers and decimals in one column make a Float column."""
    from linkframe.results import observe_types, typed_cell

    graph = triple_source(spark, directory, ["Customer"])
    df = graph.slice(prop("c_acctbal")).select("o").union(graph.slice(prop("c_custkey")).select("o"))
    base = observe_types(df, {"o": F.col("o")})["o"]
    return df.select(typed_cell(F.col("o"), base).alias("x"))


@register("discover_properties_all_classes", " union all ".join(
    f"select '{B}{cls}' as class, '{p}' as property, {count} as count, {int(iri)} as is_iri from {table}"
    for cls, (table, _, properties) in model.CLASSES.items()
    for p, count, iri in [(V.RDF_TYPE, "count(*)", True)] + [
        (B + name, "sum(len(list_distinct(embedding)))::bigint" if name == "embedding" else f"count({mapped.columns[0]})", bool(mapped.references))
        for name, mapped in properties.items()]))
def discover_properties_all_classes(spark, directory):
    source = model.source(spark, directory)
    return discovery.properties(source, list(source.classes))


def _groups_by_key(table, key):
    if key == "*":
        return f"select *, count(*) as n from {table} group by all"
    return f"select count(*) as n from {table} group by {', '.join([key] if isinstance(key, str) else key)}"


@register("repeated_keys", " union all ".join(
    f"select '{B}{cls}' as class, count(*) as keys, coalesce(sum(n), 0)::bigint as rows from ({_groups_by_key(table, key)}) where n > 1"
    for cls, (table, key, _) in model.CLASSES.items()))
def repeated_keys(spark, directory):
    return model.source(spark, directory).repeated_keys()


# ---- aggregates over several properties of many values ----------------------------------------------

# The balances of a nation's customers and of its suppliers, in cents, and the sizes of nothing.
HELD = {"balance": ("customer", "c_nationkey", "c_acctbal"), "credit": ("supplier", "s_nationkey", "s_acctbal")}
HELD_SQL = """(select distinct c_nationkey as n, round(c_acctbal * 100)::bigint as balance from customer) b on b.n = n_nationkey
    left join (select distinct s_nationkey as n, round(s_acctbal * 100)::bigint as credit from supplier) c on c.n = n_nationkey"""


def held_engine(spark, directory):
    parts = [triple_source(spark, directory, ["Nation", "Region"]).triples()]
    for name, (table, key, value) in HELD.items():
        cents = F.round(F.col(value) * 100).cast("bigint").cast("string")
        parts.append(model.table(spark, directory, table).select(
            F.concat(F.lit(B + "Nation/"), F.col(key).cast("string")).alias("s"), F.lit(prop(name)).alias("p"),
            terms.literal_term(cents, V.XSD + "integer", bound=True).alias("o")))
    triples = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return Engine(TripleSource(triples), EngineConfig(default_graph=B, metadata_sync_strategy="none"))


def agg_multi_valued(name, query, sql):
    def run(spark, directory):
        df = held_engine(spark, directory).query({"source-table": "Nation", **query}).to_df("text")
        numbers = [F.col(c).cast("double").alias(c) if c.startswith("ag_") else F.col(c) for c in df.columns]
        return df.select(*numbers)

    register("agg_multi_valued_" + name, sql)(run)


agg_multi_valued("global", {"aggregation": [["count"], ["count", field("balance")], ["sum", field("balance")], ["sum", field("credit")],
                                            ["avg", field("credit")], ["min", field("balance")], ["max", field("credit")]]},
                 f"""select count(distinct n_nationkey)::double as ag_0, count(balance)::double as ag_1, sum(balance)::double as ag_2,
    sum(credit)::double as ag_3, sum(credit)::double / count(credit) as ag_4, min(balance)::double as ag_5, max(credit)::double as ag_6
    from nation left join {HELD_SQL}""")
agg_multi_valued("grouped", {"aggregation": [["sum", field("balance")], ["count", field("credit")], ["count"]], "breakout": [field("n_regionkey")]},
                 f"""select {iri('Region', 'n_regionkey')} as n_regionkey, sum(balance)::double as ag_0, count(credit)::double as ag_1,
    count(distinct n_nationkey)::double as ag_2 from nation left join {HELD_SQL} group by 1""")
agg_multi_valued("distinct", {"aggregation": [["distinct", field("balance")], ["distinct", field("credit")], ["count", field("credit")]],
                              "breakout": [field("n_regionkey")]},
                 f"""select {iri('Region', 'n_regionkey')} as n_regionkey, count(distinct balance)::double as ag_0,
    count(distinct credit)::double as ag_1, count(credit)::double as ag_2 from nation left join {HELD_SQL} group by 1""")
agg_multi_valued("filtered", {"aggregation": [["sum", field("credit")], ["count", field("n_name")], ["count", field("balance")]],
                              "filter": [">", field("balance"), 500000]},
                 f"""select sum(credit)::double as ag_0, count(n_name)::double as ag_1, count(balance)::double as ag_2
    from nation left join {HELD_SQL} where balance > 500000""")

# ---- a stored triple table: duplicates, several graphs, listed hot subjects ---------------------

GRAPH = "https://data.example/graph/main"


def stored_source(spark, directory, classes):
    """The triples of the tables, twice over in one graph, and those of the regions in another one.

    The hot list names a subject with values, and one that does not exist.
    """
    main = triple_source(spark, directory, classes).triples().withColumn("g", F.lit(GRAPH))
    other = triple_source(spark, directory, ["Region"]).triples().withColumn("g", F.lit(GRAPH + "2"))
    hot = {B + p: [B + "Customer/1", B + "Nation/7", B + "Order/7", B + "Nobody/0"] for p in ("c_name", "n_name", "o_totalprice")}
    return TripleSource(main.union(main).unionByName(other), default_graph=GRAPH, hot=hot)


def stored(name, classes, query, sql, **settings):
    def run(spark, directory):
        catalog = model.source(spark, directory, classes).catalog()
        engine = Engine(stored_source(spark, directory, classes), EngineConfig(default_graph=B, **settings), catalog=catalog)
        return engine.query(query).to_df("declared")

    register("stored_" + name, sql)(run)


stored("scan", CUST, {"source-table": "Customer", "fields": fields("c_name", "c_nationkey")},
       f"select {iri('Customer', 'c_custkey')} as subject, c_name, {iri('Nation', 'c_nationkey')} as c_nationkey from customer")
stored("filter", ["Order", "Customer"], {
    "source-table": "Order", "fields": fields("o_totalprice"), "filter": [">", field("o_totalprice"), 300000]},
    f"select {iri('Order', 'o_orderkey')} as subject, o_totalprice from orders where o_totalprice > 300000")
stored("join_chain", ["Customer", "Nation", "Region"], {
    "source-table": "Customer", "joins": [NATION, REGION], "fields": [field("c_name"), field("r_name", "Region")]},
    f"""select {iri('Customer', 'c_custkey')} as subject, c_name, r_name as Region__r_name from customer
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
stored("count", CUST, {"source-table": "Customer", "aggregation": [["count"], ["distinct", field("c_nationkey")]]},
       "select count(*) as ag_0, count(distinct c_nationkey) as ag_1 from customer")
stored("lang_filter", ["Document", "Label"], {"source-table": "Document", "fields": fields("text")},
       f"select {iri('Document', 'doc_id')} as subject, text from documents where lang = 'de'", default_language="de")


@register("named_graph_filter", f"select '{GRAPH}2' as g, count(*) * 3 as n from region")
def named_graph_filter(spark, directory):
    quads = triple_source(spark, directory, ["Region"]).triples().withColumn("g", F.lit(GRAPH + "2")).unionByName(
        triple_source(spark, directory, ["Nation", "Region"]).triples().withColumn("g", F.lit(GRAPH)))
    return TripleSource(quads, default_graph=GRAPH + "2").triples().agg(F.count(F.lit(1)).alias("n")).select(F.lit(GRAPH + "2").alias("g"), "n")


_written = {}
STORED = ["Customer", "Nation", "Region", "Order"]


def written_source(spark, directory):
    """The triples of some classes, written as a stored table once per application, in two steps: orders are appended."""
    key = (spark.sparkContext.applicationId, directory)
    if key not in _written:
        folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="linkframe-stored-")
        path = f"{folder}/linkframe-stored-{uuid.uuid4().hex}"
        write_triples(triple_source(spark, directory, STORED[:3]).triples(), path)
        # Some are there already; they are neither stored nor counted again.
        append_triples(triple_source(spark, directory, STORED).triples(), path)
        _written[key] = path
    return TripleSource.open(spark, _written[key])


@register("discover_from_summary", " union all ".join(
    f"select '{B}{cls}' as class, '{p}' as property, {count} as count, {int(iri)} as is_iri from {table}"
    for cls, (table, _, properties) in model.CLASSES.items() if cls in STORED
    for p, count, iri in [(V.RDF_TYPE, "count(*)", True)] + [
        (B + name, f"count({mapped.columns[0]})", bool(mapped.references)) for name, mapped in properties.items()]))
def discover_from_summary(spark, directory):
    """What discovery finds, read from the counts that are stored with the triples."""
    return discovery.properties(written_source(spark, directory), [B + c for c in STORED])


@register("discover_classes_from_summary", " union all ".join(
    f"select '{B}{cls}' as class, count(*) as count from {model.CLASSES[cls][0]}" for cls in STORED))
def discover_classes_from_summary(spark, directory):
    return discovery.classes(written_source(spark, directory))


def written(name, query, sql):
    def run(spark, directory):
        catalog = model.source(spark, directory, STORED).catalog()
        engine = Engine(written_source(spark, directory), EngineConfig(default_graph=B), catalog=catalog)
        return engine.query(query).to_df("declared")

    register("written_" + name, sql)(run)


written("scan", {"source-table": "Customer", "fields": fields("c_name", "c_nationkey")},
        f"select {iri('Customer', 'c_custkey')} as subject, c_name, {iri('Nation', 'c_nationkey')} as c_nationkey from customer")
written("filter", {"source-table": "Order", "fields": fields("o_totalprice"), "filter": [">", field("o_totalprice"), 300000]},
        f"select {iri('Order', 'o_orderkey')} as subject, o_totalprice from orders where o_totalprice > 300000")
written("join_chain", {"source-table": "Customer", "joins": [NATION, REGION], "fields": [field("c_name"), field("r_name", "Region")]},
        f"""select {iri('Customer', 'c_custkey')} as subject, c_name, r_name as Region__r_name from customer
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")

# ---- integers beyond the 53 bits of a double ------------------------------------------------------

BIG = "o_orderkey * 1000000000000 + o_custkey"


def big_orders(spark, directory):
    orders = model.table(spark, directory, "orders").withColumn("big", F.expr(BIG.replace("o_orderkey", "cast(o_orderkey as bigint)")))
    return MappedSource(B, {"BigOrder": ClassMapping(orders, "o_orderkey", {"big": Property("big")})})


def big_engines(spark, directory):
    mapped = big_orders(spark, directory)
    config = EngineConfig(default_graph=B)
    return {"": Engine(mapped, config), "triples_": Engine(VirtualTriples(mapped), config, catalog=mapped.catalog())}


def big_query(name, make, sql):
    for kind in ("", "triples_"):
        register(kind + name, sql)(lambda spark, d, kind=kind: make(big_engines(spark, d)[kind]))


ABOVE = 7 * 10**12 + 100
big_query("filter_bigint", lambda e: e.query({
    "source-table": "BigOrder", "fields": fields("big"), "filter": [">", field("big"), ABOVE]}).to_df("declared"),
    f"select concat('{B}BigOrder/', o_orderkey) as subject, o_orderkey::bigint * 1000000000000 + o_custkey as big from orders "
    f"where o_orderkey::bigint * 1000000000000 + o_custkey > {ABOVE}")
big_query("min_max_bigint", lambda e: e.query({
    "source-table": "BigOrder", "aggregation": [["min", field("big")], ["max", field("big")]]}).to_df("declared"),
    "select min(o_orderkey::bigint * 1000000000000 + o_custkey) as ag_0, max(o_orderkey::bigint * 1000000000000 + o_custkey) as ag_1 from orders")
big_query("order_bigint", lambda e: e.query({
    "source-table": "BigOrder", "fields": fields("big"), "order-by": [["desc", field("big")]], "limit": 20}).to_df("declared"),
    f"select concat('{B}BigOrder/', o_orderkey) as subject, o_orderkey::bigint * 1000000000000 + o_custkey as big from orders order by big desc limit 20")

# ---- references to keys of several columns ---------------------------------------------------------


@register("join_composite_fk", f"""select concat('{B}Reply/', r.conv_id, '/', r.turn) as subject, r.text, q.text as Q__text
    from conversations r left join conversations q on q.conv_id = r.conv_id and q.turn = r.turn - 1""")
def join_composite_fk(spark, directory):
    said = model.table(spark, directory, "conversations")
    replies = said.withColumn("before", F.col("turn") - 1)
    source = MappedSource(B, {
        "Conversation": ClassMapping(said, ("conv_id", "turn"), {"text": Property("text")}),
        "Reply": ClassMapping(replies, ("conv_id", "turn"), {
            "text": Property("text"), "answers": Property(("conv_id", "before"), references="Conversation")})})
    return Engine(source, EngineConfig(default_graph=B)).query({
        "source-table": "Reply", "joins": [{"alias": "Q", "source-table": "Conversation", "fk-field-id": "answers"}],
        "fields": [field("text"), field("text", "Q")]}).to_df("declared")


# ---- file formats over whole tables -----------------------------------------------------------------


@register("ntriples_documents", f"select {iri('Document', 'doc_id')} as s, text, lang from documents")
def ntriples_documents(spark, directory):
    """All texts written as N-Triples lines and read back."""
    lines = render_ntriples(triple_source(spark, directory, ["Document", "Label"]).slice(prop("text")).withColumn("p", F.lit(prop("text"))))
    back = parse_ntriples(lines)
    return back.select("s", F.col("o.value").alias("text"), F.col("o.lang").alias("lang"))


@register("results_json_rows", f"""select {iri('Customer', 'c_custkey')} as c, case when c_custkey % 2 = 0 then c_name end as name,
    case when c_custkey % 2 = 1 then c_mktsegment end as segment from customer""")
def results_json_rows(spark, directory):
    """A results document per customer; half of them name other variables than the rest."""
    other = F.when(F.col("c_custkey") % 2 == 0, "name").otherwise("segment")
    value = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment"))
    cell = lambda kind, v: F.struct(F.lit(kind).alias("type"), v.alias("value"))
    binding = F.map_from_arrays(F.array(F.lit("c"), other), F.array(
        cell("uri", F.concat(F.lit(B + "Customer/"), F.col("c_custkey").cast("string"))), cell("literal", value)))
    document = F.to_json(F.struct(
        F.struct(F.array(F.lit("c"), other).alias("vars")).alias("head"), F.struct(F.array(binding).alias("bindings")).alias("results")))
    df = parse_results(model.table(spark, directory, "customer").select(document.alias("value")))
    return df.select(*(F.col(c)["value"].alias(c) for c in ("c", "name", "segment")))


# ---- declared catalogs ----------------------------------------------------------------------------------

SHAPES = f"""
@prefix sh: <{V.SHACL}> . @prefix xsd: <{V.XSD}> . @prefix note: <{DEFAULT_ANNOTATIONS}> . @prefix : <{B}> . @prefix far: <http://far.example/> .
:NamedShape a sh:NodeShape ; sh:targetClass :Named ; sh:property [ sh:path :c_name ; sh:datatype xsd:string ; sh:order 1 ] .
:CustomerShape a sh:NodeShape ; sh:targetClass :Customer ; sh:node :NamedShape ;
  sh:property [ sh:path :c_acctbal ; sh:datatype xsd:double ; sh:order 2 ] , [ sh:path :c_mktsegment ; note:hide true ] ,
    [ sh:path :c_nationkey ; sh:class :Nation ; sh:order 3 ; note:displayValueProperty :n_name ] , [ sh:path far:x ] .
:NationShape a sh:NodeShape ; sh:targetClass :Nation ; sh:property [ sh:path :n_name ; sh:datatype xsd:string ] .
"""
EXPLICIT = json.dumps({"tables": [
    {"name": B + "Customer", "fields": [B + "c_name", B + "c_nationkey"]}, {"name": "http://far.example/T", "fields": []}]})


def declared_engine(spark, directory, **settings):
    graph = triple_source(spark, directory, CUST)
    config = EngineConfig(default_graph=B, **settings)
    catalog = None
    if settings.get("metadata_sync_strategy") == "shacl":
        catalog = shacl.shacl_catalog(shacl.shapes(turtle.parse(SHAPES)), config.naming, config.hide_foreign_uris)
    return Engine(graph, config, catalog=catalog)


def fields_of(engine, spark, table="Customer"):
    return [f.name for f in engine.catalog.fields(table)]


@register("catalog_shacl", f"""select {iri('Customer', 'c_custkey')} as subject, c_name, c_acctbal, {iri('Nation', 'c_nationkey')} as c_nationkey,
    n_name as Nation__via__c_nationkey__n_name from customer join nation on c_nationkey = n_nationkey""")
def catalog_shacl(spark, directory):
    """Fields, order, inheritance, hiding and display remaps as the shapes declare them."""
    engine = declared_engine(spark, directory, metadata_sync_strategy="shacl", hide_foreign_uris=True)
    shown = [field(n) for n in fields_of(engine, spark) if n != "subject"]
    return engine.query({"source-table": "Customer", "fields": shown}, remaps=True).to_df("declared")


@register("catalog_explicit", f"select {iri('Customer', 'c_custkey')} as subject, c_name, {iri('Nation', 'c_nationkey')} as c_nationkey from customer")
def catalog_explicit(spark, directory):
    engine = declared_engine(spark, directory, metadata_sync_strategy="explicit", schema_config=EXPLICIT, hide_foreign_uris=True)
    shown = [field(n) for t in engine.catalog.tables() for n in fields_of(engine, spark, t.name) if n != "subject"]
    return engine.query({"source-table": "Customer", "fields": shown}).to_df("text")


@register("catalog_none", f"select {iri('Customer', 'c_custkey')} as subject, c_name from customer")
def catalog_none(spark, directory):
    """Nothing is listed, and a class is answered all the same."""
    engine = declared_engine(spark, directory, metadata_sync_strategy="none")
    assert not engine.catalog.tables()
    return engine.query({"source-table": "Customer", "fields": fields("c_name")}).to_df("text")


@register("catalog_auto_fields", f"""select {iri('Customer', 'c_custkey')} as subject, c_name, c_mktsegment, c_acctbal,
    {iri('Nation', 'c_nationkey')} as c_nationkey, c_custkey from customer""")
def catalog_auto_fields(spark, directory):
    """All fields that discovery finds in the data."""
    engine = declared_engine(spark, directory)
    shown = [field(n) for n in fields_of(engine, spark) if n != "subject" and n != V.RDF_TYPE]
    df = engine.query({"source-table": "Customer", "fields": shown}).to_df("text")
    return df.withColumns({"c_custkey": F.col("c_custkey").cast("int"), "c_acctbal": F.col("c_acctbal").cast("double")})


# ---- templates ------------------------------------------------------------------------------------------

register("template_date_range", f"""select {iri('Order', 'o_orderkey')} as subject from orders
                                    where strftime(o_orderdate, '%Y-%m-%d') between '1995-01-01' and '1995-03-31'""")(
    sql_over_views(["Order", "Customer"], """SELECT subject FROM kg_Order WHERE date_format(o_orderdate, 'yyyy-MM-dd')
        BETWEEN split_part({{when}}, '/', 1) AND split_part({{when}}, '/', 2)""", {"when": DateRange("1995-01-01", "1995-03-31")}))
