"""Counts stored with a triple table equal those over its triples, also after triples are appended."""

import random

import pytest
from pyspark.sql import functions as F

from graphs import NS
from linkframe import ClassMapping, MappedSource, Property, TripleSource
from linkframe import vocab as V
from linkframe.catalog import discovery
from linkframe.errors import InvalidQuery
from linkframe.functions import terms
from linkframe.sources.triples import VirtualTriples, append_triples, write_triples


def some_triples(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(60):
        s = f"{NS}s{rng.randrange(12)}"
        kind = rng.randrange(4)
        if kind == 0:
            rows.append((s, V.RDF_TYPE, (V.IRI, NS + rng.choice("AB"), "", "")))
        elif kind == 1:
            rows.append((s, NS + "link", (V.IRI, f"{NS}s{rng.randrange(12)}", "", "")))
        else:
            rows.append((s, NS + rng.choice("pq"), (V.LITERAL, str(rng.randrange(5)), V.XSD + rng.choice(["integer", "string"]), "")))
    return spark.createDataFrame(rows, f"s string, p string, o {terms.TERM_TYPE}")


def counted(triples):
    return discovered(TripleSource(triples.distinct(), deduplicated=True))


def discovered(source):
    found = discovery.properties(source, [NS + "A", NS + "B"]).collect()
    return sorted(map(tuple, discovery.classes(source).collect())), sorted(tuple(r[c] for c in ("class", "property", "count", "is_iri")) for r in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_appended_triples_are_counted_once(spark, tmp_path, seed):
    path = str(tmp_path / "graph")
    first, second, third = (some_triples(spark, 10 * seed + i) for i in range(3))
    source = write_triples(first, path)
    assert discovered(source) == counted(first)
    # Some of these are stored already, some subjects get a class only now.
    append_triples(second.union(first), path)
    source = append_triples(third.union(third), path)
    whole = first.union(second).union(third)
    assert discovered(source) == counted(whole)
    assert source.triples().count() == whole.distinct().count()


def test_discovery_of_a_stored_table_reads_no_triple(spark, tmp_path):
    source = write_triples(some_triples(spark, 5), str(tmp_path / "graph"))
    for df in (discovery.classes(source), discovery.properties(source, NS + "A", limit=2)):
        assert all("/schema/" in f for f in df.inputFiles())
    sampled = discovery.properties(source, NS + "A", sample=1)
    assert any("/triples/" in f for f in sampled.inputFiles())


def test_tables_with_graphs_keep_no_counts(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "graph")
    source = write_triples(some_triples(spark, 6).withColumn("g", F.lit("g1")), path)
    assert source.schema is None
    with pytest.raises(InvalidQuery):
        append_triples(some_triples(spark, 7), path)


def test_triples_too_many_to_send_to_all_tasks_are_appended_and_counted(spark, tmp_path):
    """Joined by shuffles, as large tables are."""
    customers = spark.range(40).selectExpr("id as key", "concat('name ', id % 7) as name", "id % 3 as nation")
    source = MappedSource(NS, {"Customer": ClassMapping(customers, "key", {"name": Property("name"), "nation": Property("nation", references="Nation")}),
                               "Nation": ClassMapping(spark.range(3).toDF("nation"), "nation", {"number": Property("nation")})})
    triples, path = VirtualTriples(source).triples(), str(tmp_path / "graph")
    sizes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        write_triples(triples.where(F.col("p") != NS + "nation"), path)
        appended = append_triples(triples, path)
        found = sorted(tuple(r) for r in discovery.classes(appended).collect())
        properties = {(r["class"], r["property"]): (r["count"], r["is_iri"]) for r in discovery.properties(appended, [NS + "Customer", NS + "Nation"]).collect()}
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert found == [(NS + "Customer", 40), (NS + "Nation", 3)]
    assert properties == {
        (NS + "Customer", V.RDF_TYPE): (40, 1), (NS + "Customer", NS + "name"): (40, 0), (NS + "Customer", NS + "nation"): (40, 1),
        (NS + "Nation", V.RDF_TYPE): (3, 1), (NS + "Nation", NS + "number"): (3, 0)}
