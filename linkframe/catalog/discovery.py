"""Schema discovery from the data itself: classes, then their properties.

Everything is counted over all instances, or was when the triples were written. What comes to the driver is the schema: a row per class, and per class and
property. Limits and samples are there for callers that ask for them.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from linkframe import vocab as V
from linkframe.catalog.model import Catalog, FieldMeta, TableMeta
from linkframe.naming import local_name
from linkframe.sources.triples import union_all


def classes(source, limit=None):
    """Classes with their instance counts, the largest first."""
    if _stored(source) is not None:
        counts = source.schema.where("property is null").groupBy("class").agg(F.sum("count").alias("count"))
    else:
        counts = source.slice(V.RDF_TYPE).groupBy(F.col("o.value").alias("class")).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc("class"))
    return ordered if limit is None else ordered.limit(limit)


def properties(source, class_iris, limit=None, sample=None):
    """The properties used by the instances of each class (or of ``sample`` of them), with their use.

    Classes whose tables tell alone are answered by one pass over each, all others by one pass over the triples. ``is_iri`` is 1 when
    every value seen is an IRI. ``limit`` keeps the most used of each class.
    """
    if isinstance(class_iris, str):
        class_iris = [class_iris]
    if _stored(source) is not None and sample is None:
        wanted = source.schema.where(F.col("class").isin(list(class_iris)) & F.col("property").isNotNull())
        return _most_used(wanted.groupBy("class", "property").agg(
            F.sum("count").alias("count"), F.min(F.when(F.col("kind") == V.IRI, 1).otherwise(0)).alias("is_iri")), limit)
    found, rest = [], []
    for iri in class_iris:
        members = source.members(iri).select("s")
        members = members if sample is None else members.limit(sample)
        uses = _uses(source, iri)
        if uses is None:
            rest.append(members.withColumn("class", F.lit(iri)))
        else:
            found.append(_used(iri, members, *uses))
    if rest:
        seen = source.triples_of(class_iris).join(union_all(rest), "s")
        found.append(seen.groupBy("class", F.col("p").alias("property")).agg(
            F.count(F.lit(1)).alias("count"),
            F.min(F.when(F.col("o.kind") == V.IRI, 1).otherwise(0)).alias("is_iri"),
        ))
    return _most_used(union_all(found), limit)


def _uses(source, class_iri):
    """How many values of each property a row of the class has, where a source can tell without unfolding it, or None."""
    return source.uses(class_iri) if hasattr(source, "uses") else None


def _used(class_iri, members, rows, columns):
    """Counts over the members, of which one row each is moved and not one per triple. IRIs are long, so that a small table
    can have very many in memory: they are joined by shuffles, whatever the size of its files."""
    sums = rows.join(members.hint("merge"), "s").agg(*(F.sum(c).alias(c) for c in columns))
    cells = [F.struct(F.lit(prop).alias("property"), F.col(c).alias("count"), F.lit(is_iri).alias("is_iri"))
             for c, (prop, is_iri) in columns.items()]
    counts = sums.select(F.lit(class_iri).alias("class"), F.inline(F.array(*cells)))
    return counts.where("count > 0")


def _stored(source):
    """The counts a source keeps with its triples, or None."""
    return getattr(source, "schema", None)


def _most_used(counts, limit):
    if limit is None:
        return counts
    rank = Window.partitionBy("class").orderBy(F.desc("count"), F.asc("property"))
    return counts.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= limit).drop("rank")


def class_fields(source, class_iris, naming, limit=None, sample=None, hide_foreign=False):
    """Fields of each class by use."""
    rows = properties(source, class_iris, limit, sample).collect()
    fields = {iri: [] for iri in class_iris}
    for row in sorted(rows, key=lambda r: (-r["count"], r["property"])):
        iri = row["property"]
        if not (hide_foreign and naming.is_foreign(iri)):
            fields[row["class"]].append(FieldMeta(naming.shorten(iri), iri, "uri" if row["is_iri"] else "string"))
    return fields


def discover(source, naming, class_limit=None, property_limit=None, sample_limit=None, hide_foreign=False):
    """A catalog of what the data holds; every column is text or IRI."""
    catalog = Catalog(naming)
    found = {r["class"]: r["count"] for r in classes(source, class_limit).collect()}
    shown = [iri for iri in found if not (hide_foreign and naming.is_foreign(iri))]
    if not shown:
        return catalog
    fields = class_fields(source, shown, naming, property_limit, sample_limit, hide_foreign)
    for iri in shown:
        description = f"RDF Class: {iri} (Instances: {found[iri]})"
        catalog.add(TableMeta(naming.shorten(iri), iri, local_name(iri), description), fields[iri])
    return catalog
