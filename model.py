"""The test tables as classes: which table is which class, and its keys."""

from linkframe import ClassMapping, Engine, EngineConfig, MappedSource, Property

BASE = "https://data.example/"


def _plain(*columns):
    return {c: Property(c) for c in columns}


# class -> (table, key, properties)
CLASSES = {
    "Region": ("region", "r_regionkey", _plain("r_regionkey", "r_name")),
    "Nation": ("nation", "n_nationkey", {
        **_plain("n_nationkey", "n_name"), "n_regionkey": Property("n_regionkey", references="Region")}),
    "Customer": ("customer", "c_custkey", {
        **_plain("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
        "c_nationkey": Property("c_nationkey", references="Nation")}),
    "Supplier": ("supplier", "s_suppkey", {
        **_plain("s_suppkey", "s_name", "s_acctbal"),
        "s_nationkey": Property("s_nationkey", references="Nation")}),
    "Part": ("part", "p_partkey", _plain(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")),
    "Order": ("orders", "o_orderkey", {
        **_plain("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
        "o_custkey": Property("o_custkey", references="Customer")}),
    "Lineitem": ("lineitem", "*", {
        **_plain("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"),
        "l_orderkey": Property("l_orderkey", references="Order"),
        "l_partkey": Property("l_partkey", references="Part"),
        "l_suppkey": Property("l_suppkey", references="Supplier")}),
    "Event": ("events", "event_id", {
        **_plain("event_id", "ts", "event_type", "value", "props"),
        "user_id": Property("user_id", references="Customer")}),
    "Document": ("documents", "doc_id", {
        **_plain("doc_id", "lang", "source", "n_chars"),
        "text": Property("text", lang="lang"),
        "label": Property("doc_id", references="Label")}),
    "Label": ("labels", "doc_id", _plain("quality", "toxic")),
    "Page": ("pages", "page_id", _plain("page_id", "url", "html")),
    "Benchmark": ("benchmark", "item_id", _plain("item_id", "text")),
    "Conversation": ("conversations", ("conv_id", "turn"), _plain("conv_id", "turn", "role", "text")),
    "Embedding": ("embeddings", "vec_id", {
        **_plain("vec_id", "label"), "embedding": Property("embedding")}),
}


_opened = {}


def table(spark, directory, name):
    """Open each table once per application: opening reads file footers."""
    key = (spark.sparkContext.applicationId, directory, name)
    if key not in _opened:
        _opened[key] = spark.read.parquet(f"{directory}/{name}.parquet")
    return _opened[key]


def source(spark, directory, names=None):
    """The mapped source over the parquet files of one directory."""
    classes = {}
    for name in names or CLASSES:
        file, key, properties = CLASSES[name]
        classes[name] = ClassMapping(table(spark, directory, file), key, properties)
    return MappedSource(BASE, classes)


def engine(spark, directory, names=None, **settings):
    return Engine(source(spark, directory, names), EngineConfig(default_graph=BASE, **settings))
