"""Triple tables: ``s STRING, p STRING, o <term>`` and optionally ``g STRING``.

Subjects are plain text (``_:x`` marks a blank node). A property is one slice
of the table, left-joined on the subject. Written by ``write_triples`` the table
is split by predicate, so a slice reads only its own directory, and a slice is
clustered by subject (by class for rdf:type), so point filters skip row groups.
"""

from functools import reduce

from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.errors import InvalidQuery
from linkframe.functions import terms
from linkframe.plans.bindings import TermBinding
from linkframe.plans.frame import SUBJECT

# A subject with this many values of one predicate is listed as hot when a table
# is written; a higher number shortens the list, which the driver holds.
HOT_VALUES = 1_000_000
SALTS = 64
# Rows are clustered by subject, so a search by value needs a Bloom filter.
SCHEMA_COUNTS = "class string, property string, kind string, datatype string, count long"
_BLOOM = {
    "parquet.bloom.filter.enabled#o.value": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


class TripleSource:
    """Classes and properties over a triple table.

    ``deduplicated`` states that no triple occurs twice (true for tables from
    ``write_triples``); otherwise each slice is made distinct, as a graph is a
    set. ``hot`` maps a predicate to the subjects with very many values of it:
    their joins are salted. It only steers the layout; a subject that is listed
    without having values is an ordinary row. ``default_graph`` reads one graph of
    a table with graphs; without it the graphs are read as one.
    """

    fans_out = True

    #: Counts by class, property, kind and datatype, where they are stored with the triples (see schema_counts).
    schema = None

    def __init__(self, triples, default_graph=None, deduplicated=False, hot=None):
        graphs = "g" in triples.columns
        if default_graph is not None:
            if not graphs:
                raise InvalidQuery(f"the triples name no graphs, so not {default_graph} either")
            triples = triples.where(F.col("g") == default_graph)
        self._triples = triples.select("s", "p", "o")
        # A triple may stand in several graphs.
        self._deduplicated = deduplicated and (default_graph is not None or not graphs)
        self.hot = hot or {}

    @classmethod
    def open(cls, spark, path, default_graph=None):
        """Open a table written by ``write_triples`` together with its hot list."""
        source = cls(spark.read.parquet(f"{path}/triples"), default_graph, deduplicated=True,
                     hot=_by_predicate(spark.read.parquet(f"{path}/hot")))
        if "g" not in spark.read.parquet(f"{path}/triples").columns:
            source.schema = spark.read.schema(SCHEMA_COUNTS).parquet(f"{path}/schema")
        return source

    @classmethod
    def open_table(cls, spark, name, default_graph=None):
        """Open a table saved by ``save_triples``."""
        return cls(spark.table(name), default_graph, deduplicated=True, hot=_by_predicate(spark.table(f"{name}_hot")))

    def triples(self, subject=None):
        """All triples. A source may leave out those of other subjects than ``subject``; see also ``slice``."""
        return self._triples

    def triples_of(self, class_iris):
        """Triples among which are all those of the classes' instances."""
        return self.triples()

    def scan(self, class_iri, props, names, only=None):
        """Rows of a class with properties. ``only`` maps the subject (SUBJECT) or a property to texts, one of which
        every row asked for has there; a source may leave other rows out."""
        subject = names.new(SUBJECT)
        df = self.members(class_iri).select(F.col("s").alias(subject))
        binding = TermBinding(subject, node=True)
        df, bound = self.attach(df, binding, props, names, "")
        return df, binding, bound

    def attach(self, df, anchor, props, names, hint):
        """One left join per property; all of them hash on the same resource."""
        bound = {}
        if not props:
            return df, bound
        key = anchor.column
        if not anchor.node:
            key = names.new(f"{hint}_node")
            df = df.withColumn(key, anchor.node_key())
        for prop, prop_hint in props.items():
            name = names.new(prop_hint)
            df = self.left_join(df, key, prop, name, names)
            bound[prop] = TermBinding(name)
        return (df if anchor.node else df.drop(key)), bound

    def values(self, class_iri, prop, hint, names):
        """The values of one property: a row each, with the binding of its subject and its own."""
        subject, name = names.new(SUBJECT), names.new(hint)
        rows = self.slice(prop).select(F.col("s").alias(subject), F.col("o").alias(name))
        return rows, TermBinding(subject, node=True), TermBinding(name)

    def table_of(self, prop, target=None):
        """A class whose table alone answers the property (rdf:type: of ``target``) and is read by ``wide``; None here."""
        return None

    def described(self, class_iri):
        """The triples of a class's instances, where a source can give them without joining; None here."""
        return None

    def multi_valued(self, class_iri, prop):
        return True

    def target_of(self, class_iri, prop):
        return None

    def members(self, class_iri):
        """``s`` rows of one class, each subject once."""
        rows = self._triples.where(
            (F.col("p") == V.RDF_TYPE) & (F.col("o.kind") == V.IRI) & (F.col("o.value") == class_iri)
        ).select("s")
        return rows if self._deduplicated else rows.distinct()

    def slice(self, prop, subject=None, target=None):
        """``s, o`` rows of one predicate; those with another subject or object IRI than the given may be missing."""
        rows = self._triples.where(F.col("p") == prop).select("s", "o")
        return rows if self._deduplicated else rows.distinct()

    def left_join(self, df, key, prop, name, names):
        """Add column ``name``: the values of ``prop`` for the resource in ``key``."""
        right_key = names.new("s")
        right = self.slice(prop).select(F.col("s").alias(right_key), F.col("o").alias(name))
        hot = self.hot.get(prop)
        if not hot:
            return df.join(right, F.col(key) == F.col(right_key), "left").drop(right_key)
        # A subject with a great share of the slice would be one giant partition
        # of the joined side, which a left join cannot split. Spread its values
        # over salts and repeat its row per salt. A listed subject that occurs in
        # this slice has values, so a salt that met none is no answer and is
        # dropped again. Those that occur are no more rows than the list has.
        left_salt, right_salt, is_hot = names.new("salt"), names.new("salt"), names.new("hot")
        spread = F.sequence(F.lit(0), F.lit(SALTS - 1))
        listed = right.where(F.col(right_key).isin(hot)).select(F.col(right_key).alias(is_hot)).distinct()
        df = df.join(F.broadcast(listed), F.col(key) == F.col(is_hot), "left")
        df = df.withColumn(is_hot, F.col(is_hot).isNotNull())
        df = df.withColumn(left_salt, F.explode(F.when(F.col(is_hot), spread).otherwise(F.array(F.lit(0)))))
        right = right.withColumn(
            right_salt,
            F.when(F.col(right_key).isin(hot), F.pmod(F.xxhash64(name), F.lit(SALTS)).cast("int")).otherwise(0),
        )
        joined = df.join(
            right, (F.col(key) == F.col(right_key)) & (F.col(left_salt) == F.col(right_salt)), "left"
        )
        kept = joined.where(~F.col(is_hot) | F.col(name).isNotNull())
        return kept.drop(right_key, left_salt, right_salt, is_hot)


class VirtualTriples(TripleSource):
    """The triples of a mapped source, made from its tables as they are read.

    Properties that one table holds come from one scan of it, as terms side by side; constant subjects and objects are
    cut into native keys. Both give the rows that joining the triples would give: a key identifies a row, and an IRI
    belongs to one class. Where class IRIs lie inside each other that isn't so, and the triples are joined.
    """

    def __init__(self, mapped):
        self._mapped = mapped
        self.hot = {}
        self._slices = {}

    def triples(self, subject=None):
        return self._mapped.triples(subject=subject)

    def triples_of(self, class_iris):
        return self._mapped.triples(class_iris)

    def members(self, class_iri):
        return self._mapped.members(class_iri)

    def table_of(self, prop, target=None):
        if prop == V.RDF_TYPE:
            return target if target is not None and self._mapped.stands_alone(target) else None
        return self._mapped.holder(prop)

    def uses(self, class_iri):
        return self._mapped.uses(class_iri)

    def described(self, class_iri):
        return self._mapped.described(class_iri) if self._mapped.stands_alone(class_iri) else None

    def multi_valued(self, class_iri, prop):
        return not self._mapped.stands_alone(class_iri) or self._mapped.multi_valued(class_iri, prop)

    def wide(self, class_iri, subject, columns, only=None):
        return self._mapped.wide(class_iri, subject, columns, only)

    def scan(self, class_iri, props, names, only=None):
        if not self._mapped.stands_alone(class_iri):
            return super().scan(class_iri, props, names)
        subject = names.new(SUBJECT)
        columns = {prop: names.new(hint) for prop, hint in props.items()}
        df = self._mapped.wide(class_iri, subject, columns, only)
        return df, TermBinding(subject, node=True), {prop: TermBinding(name) for prop, name in columns.items()}

    def attach(self, df, anchor, props, names, hint):
        """One left join per table that alone has some of the properties, one per other property."""
        tables = {}
        for prop in props:
            tables.setdefault(self._mapped.holder(prop), []).append(prop)
        df, bound = super().attach(df, anchor, {p: props[p] for p in tables.pop(None, [])}, names, hint)
        if not tables:
            return df, bound
        key = anchor.column
        if not anchor.node:
            key = names.new(f"{hint}_node")
            df = df.withColumn(key, anchor.node_key())
        for class_iri, held in tables.items():
            right_key, columns = names.new("s"), {prop: names.new(props[prop]) for prop in held}
            right = self._mapped.wide(class_iri, right_key, columns)
            df = df.join(right, F.col(key) == F.col(right_key), "left").drop(right_key)
            bound.update((prop, TermBinding(name)) for prop, name in columns.items())
        return (df if anchor.node else df.drop(key)), bound

    def slice(self, prop, subject=None, target=None):
        if subject is not None or target is not None:
            return self._mapped.slice(prop, subject, target)
        if prop not in self._slices:
            self._slices[prop] = self._mapped.slice(prop)
        return self._slices[prop]


def hot_subjects(triples, least=HOT_VALUES):
    """(p, s) pairs with at least so many values that joining them needs salting.

    All triples are counted, combined before the shuffle, so the result has at
    most one pair per ``least`` triples.
    """
    return triples.groupBy("p", "s").count().where(F.col("count") >= least).select("p", "s")


def _by_predicate(pairs):
    hot = {}
    for row in pairs.collect():
        hot.setdefault(row["p"], []).append(row["s"])
    return hot


def write_triples(triples, path, least_hot=HOT_VALUES):
    """Write a triple table for querying: distinct, by predicate, clustered.

    Range partitioning splits a dominant predicate, class or subject over many
    tasks. The cluster column is the class for rdf:type and the subject for all
    other predicates; the hash at the end separates the values of one subject.
    Graph names are kept.
    """
    spark = triples.sparkSession
    _write(_columns(triples).distinct(), path, "error")
    stored = spark.read.parquet(f"{path}/triples")
    hot_subjects(stored, least_hot).write.parquet(f"{path}/hot")
    if "g" not in stored.columns:
        schema_counts(_typed(stored), stored).write.parquet(f"{path}/schema")
    return TripleSource.open(spark, path)


def append_triples(triples, path, least_hot=HOT_VALUES):
    """Add triples to a table of ``write_triples`` without graphs; those it holds already are left out.

    The schema counts grow by what the new triples add: those of any subject with a
    class, and the older ones of subjects that get a class now. Counts are rows that
    readers sum, so nothing stored is read again but the triples of such subjects.
    """
    spark = triples.sparkSession
    old = spark.read.parquet(f"{path}/triples")
    if "g" in old.columns or "g" in triples.columns:
        raise InvalidQuery("triples are appended to a table without graphs only")
    # What was there when the list of files was read, also after more has been written.
    same = [F.col("n.s") == F.col("o.s"), F.col("n.p") == F.col("o.p"), *(
        F.col("n.o")[part] == F.col("o.o")[part] for part in ("kind", "value", "datatype", "lang"))]
    new = _columns(triples).distinct().alias("n").join(old.alias("o"), reduce(lambda a, b: a & b, same), "left_anti")
    _write(new, path, "append")
    # Counted from the files that were not there before, so that the triples given aren't made and joined again for each count.
    before = F.broadcast(old.select(F.col("_metadata.file_path").alias("file")).distinct())
    stored = spark.read.parquet(f"{path}/triples")
    added = stored.select("s", "p", "o", F.col("_metadata.file_path").alias("file")).join(before, "file", "left_anti").drop("file")
    counts = schema_counts(_typed(added), stored).unionByName(schema_counts(_typed(old), added, instances=False))
    counts.write.mode("append").parquet(f"{path}/schema")
    hot_subjects(spark.read.parquet(f"{path}/triples"), least_hot).write.mode("overwrite").parquet(f"{path}/hot")
    return TripleSource.open(spark, path)


def _write(distinct, path, mode):
    cluster = F.when(F.col("p") == V.RDF_TYPE, F.col("o.value")).otherwise(F.lit(""))
    laid_out = distinct.withColumn("cluster", cluster).repartitionByRange(
        "p", "cluster", "s", F.xxhash64("o"))
    sorted_rows = laid_out.sortWithinPartitions("p", "cluster", "s").drop("cluster")
    sorted_rows.write.mode(mode).partitionBy("p").options(**_BLOOM).parquet(f"{path}/triples")


def _typed(triples):
    """``s, class`` of the subjects that have a class."""
    return triples.where((F.col("p") == V.RDF_TYPE) & (F.col("o.kind") == V.IRI)).select("s", F.col("o.value").alias("class"))


def schema_counts(types, triples, instances=True):
    """How often subjects of each class have values of each property, by the values' kind and datatype.

    Counts of the instances themselves have no property. ``types`` and ``triples`` hold no row twice.
    """
    counts = triples.join(types, "s").groupBy(
        "class", F.col("p").alias("property"), F.col("o.kind").alias("kind"), F.col("o.datatype").alias("datatype")
    ).agg(F.count(F.lit(1)).alias("count"))
    if not instances:
        return counts
    members = types.groupBy("class").agg(F.count(F.lit(1)).alias("count"))
    none = F.lit(None).cast("string")
    return counts.unionByName(members.select(
        "class", none.alias("property"), none.alias("kind"), none.alias("datatype"), "count"))


def save_triples(triples, name, path, buckets, least_hot=HOT_VALUES):
    """Save as a catalog table, by predicate and bucketed by subject.

    All slices then share one partitioning, so queries that read many properties
    of a subject join them without moving a row. Hot subjects are salted, which
    leaves the buckets aside for their predicates.
    """
    spark = triples.sparkSession
    distinct = _columns(triples).distinct()
    # The bucket number Spark will use, so that each task writes few files.
    bucket = F.pmod(F.hash("s"), F.lit(buckets))
    laid_out = distinct.repartitionByRange("p", bucket, "s", F.xxhash64("o"))
    writer = laid_out.write.partitionBy("p").bucketBy(buckets, "s").sortBy("s").options(**_BLOOM)
    writer.option("path", f"{path}/triples").saveAsTable(name)
    hot = hot_subjects(spark.table(name), least_hot)
    hot.write.option("path", f"{path}/hot").saveAsTable(f"{name}_hot")
    return TripleSource.open_table(spark, name)


def _columns(triples):
    return triples.select(*(["g"] if "g" in triples.columns else []), "s", "p", "o")


def triples_from_terms(spark, triples):
    """A triple table from parsed terms of a small document (see turtle.parse)."""
    rows = [(_node_text(s), p.value, tuple(o)) for s, p, o in triples]
    return spark.createDataFrame(rows, f"s string, p string, o {terms.TERM_TYPE}")


def _node_text(term):
    return term.value


def union_all(frames):
    """Union as a balanced tree: each step analyses its own half only."""
    while len(frames) > 1:
        pairs = [frames[i:i + 2] for i in range(0, len(frames), 2)]
        frames = [reduce(lambda a, b: a.union(b), pair) for pair in pairs]
    return frames[0]
