"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
import check
import model
import workload
from graphs import SMALL


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    assert check.compare(spark, duck, SMALL, name).startswith("ok")


def test_entry(spark):
    assert contract.entry(spark).columns == ["Region__r_name", "ag_0", "ag_1"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(workload.QUERIES["filter_iri_fk"](spark, SMALL))
    assert "EqualTo(c_nationkey,7)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in text
    text = plan(workload.QUERIES["filter_iri_not_canonical"](spark, SMALL))
    assert "Nation/07" not in text and "EqualTo" not in text


def test_counting_subjects_reads_no_column(spark):
    assert "ReadSchema: struct<>" in plan(workload.QUERIES["count_subject"](spark, SMALL))


def test_unused_joins_cost_nothing(spark):
    engine = model.engine(spark, SMALL, ["Order", "Customer", "Nation", "Region"])
    query = {"source-table": "Order", "joins": [workload.CUSTOMER, workload.NATION], "aggregation": [["count"]]}
    assert "Join" not in plan(engine.query(query).to_df())


def test_one_predicate_reads_one_table(spark):
    graph = workload.triple_source(spark, SMALL, None)
    assert plan(graph.slice(model.BASE + "c_name")).count("FileScan") == 1


def test_rows_are_grouped_before_the_join_only_on_request(spark):
    for setting, aggregates in (("never", 2), ("always", 4)):
        engine = model.engine(spark, SMALL, ["Order", "Customer", "Nation", "Region"], pre_aggregate=setting)
        assert plan(engine.query(workload.CHAIN_3).to_df()).count("HashAggregate") == aggregates


def test_discovery_of_a_mapped_class_reads_its_table_twice(spark):
    df = workload.QUERIES["discover_properties"](spark, SMALL)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_a_full_sort_tells_equal_keys_apart(spark):
    engine = model.engine(spark, SMALL, ["Order", "Customer"])
    query = {"source-table": "Order", "order-by": [["asc", workload.field("o_orderstatus")]]}
    assert "xxhash64(" in plan(engine.query(query).to_df())
