"""Types of result columns and cells, found by looking at the values."""

import pytest
from pyspark.sql import functions as F

from graphs import NS, engine, field, rows
from linkframe import vocab as V
from linkframe.results import observe_types, resolve_types, typed_cell


@pytest.mark.parametrize("kinds, expected", [
    (set(), V.TEXT),
    ({V.INTEGER}, V.INTEGER),
    ({V.INTEGER, V.FLOAT}, V.FLOAT),
    ({V.DATE, V.DATETIME}, V.DATETIME),
    ({V.INTEGER, V.URL}, V.TEXT),
    ({V.INTEGER, V.FLOAT, V.TEXT}, V.TEXT),
    ({V.DATE, V.TIME}, V.TEXT),
])
def test_promotion(kinds, expected):
    assert resolve_types(kinds) == expected


def observed(spark, *literals):
    body = "".join(f":x{i} a :C ; :v {text} ." for i, text in enumerate(literals))
    result = engine(spark, body).query({"source-table": "C", "fields": [field("v")]})
    return result.columns()[1].base_type, [r[1] for r in sorted(rows(result))]


@pytest.mark.parametrize("literals, base_type, cells", [
    (["1", "2"], V.INTEGER, [1, 2]),
    (["1", "2.5"], V.FLOAT, [1.0, 2.5]),
    (["1", ":x"], V.TEXT, ["1", NS + "x"]),
    ([":x"], V.URL, [NS + "x"]),
    (["_:b"], V.TEXT, ["_:b"]),
    (["true", '"1"^^xsd:boolean', '"false"^^xsd:boolean'], V.BOOLEAN, [True, False, False]),
    (['"2020-01-01"^^xsd:date', '"2020-01-01T00:00:00"^^xsd:dateTime'], V.DATETIME,
     ["2020-01-01", "2020-01-01T00:00:00"]),
    (['"2020"^^xsd:gYear'], V.DATETIME, ["2020"]),
    (['"10:00:00"^^xsd:time'], V.TIME, ["10:00:00"]),
    (['"x"@en', '"y"'], V.TEXT, ["x", "y"]),
    (['"http://a"^^xsd:anyURI'], V.TEXT, ["http://a"]),
    (['"-3"^^xsd:negativeInteger'], V.INTEGER, [-3]),
    (['"2020-01-01T00:00:00Z"^^xsd:dateTimeStamp'], V.TEXT, ["2020-01-01T00:00:00Z"]),
    (["99999999999999999999"], V.TEXT, ["99999999999999999999"]),
])
def test_columns_and_cells(spark, literals, base_type, cells):
    assert observed(spark, *literals) == (base_type, cells)


def test_all_unbound_is_text(spark):
    result = engine(spark, ":x a :C .").query({"source-table": "C", "fields": [field("v")]})
    assert result.columns()[1].base_type == V.TEXT
    assert rows(result) == [(NS + "x", None)]


def test_late_values_change_the_type(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") < 49_999, F.lit(None)).otherwise(F.lit("x")).alias("t"))
    term = F.when(F.col("t").isNotNull(), F.struct(
        F.lit("lit").alias("kind"), F.col("t").alias("value"),
        F.lit(V.XSD + "date").alias("datatype"), F.lit("").alias("lang")))
    assert observe_types(df, {"c": term}) == {"c": V.DATE}
    assert df.select(typed_cell(term, V.DATE).alias("c")).where("c is not null").count() == 1
