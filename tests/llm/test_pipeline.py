import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from linkframe.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents labels benchmark pages conversations".split()


def test_run_equals_its_stages_by_hand(spark):
    """Each stage is held against brute force in its own tests; here: the same rows, one after the other, in fewer stages' hands."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "benchmark_decontamination", "best_fit_packing"]
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > counts[0] / 2
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_last_stage_holds_the_packed_ids(spark, documents):
    text = "token ids are what training reads " * 1500
    rows = corpus_pipeline.best_fit_packing(spark, documents([(1, text, "en", "a"), (2, "short", "en", "a"), (3, None, "en", "a")]), "").collect()
    assert len(rows) > 3 and {r["doc_id"] for r in rows} == {1, 2, 3}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_empty_tables(spark, tmp_path):
    for name in TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == (1 if name == "op7_chat_formatting" else 0)


def test_awkward_rows_pass_all_stages(spark, awkward, tmp_path):
    for name in TABLES[1:3]:
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, duck, name):
    import check

    df = contract.queries()[name](spark, SF)
    relation = duck.sql(contract.oracle_sql()[name])
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check.rows_of(relation.columns, relation.fetchall())


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and "pipeline" in contract.queries()


def test_documents_come_back_once(spark):
    for name in ("op1_toxicity", "op4_quality_classifier", "op5_sharding", "op6_ngram_jaccard_join", "op10_quality_rules"):
        out = contract.queries()[name](spark, SF)
        ids = out.groupBy("doc_id").count().where(F.col("count") > 1).count()
        assert ids == 0 and out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
