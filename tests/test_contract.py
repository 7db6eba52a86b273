import pytest
from pyspark.sql import types as T

from siftwell import validate
from siftwell.operators.contract import type_matches


@pytest.mark.parametrize(
    "expected, actual, fits",
    [
        ("LongType", T.LongType(), True),
        ("longtype()", T.LongType(), True),
        ("bigint", T.LongType(), True),
        ("long", T.LongType(), True),
        ("LongType", T.ArrayType(T.LongType()), False),
        ("ArrayType", T.ArrayType(T.LongType()), True),
        ("array<bigint>", T.ArrayType(T.LongType()), True),
        ("ArrayType(LongType(), True)", T.ArrayType(T.LongType()), True),
        ("DecimalType", T.DecimalType(12, 3), True),
        ("decimal(12,3)", T.DecimalType(12, 3), True),
        ("decimal(12,2)", T.DecimalType(12, 3), False),
        ("StringType", T.DoubleType(), False),
        ("no such type", T.StringType(), False),
    ],
)
def test_type_texts(spark, expected, actual, fits):
    assert type_matches(expected, actual) is fits


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, None, 1.0), (2, "x", None)], "a bigint, b string, c double")


def test_issue_order_and_messages(frame):
    contract = {
        "columns": {"a": "StringType", "z": "LongType", "b": "string"},
        "nullable": {"c": False, "a": False, "b": False, "gone": False},
    }
    rows = validate(frame, contract).collect()
    assert [(r["seq"], r["kind"], r["column_name"]) for r in rows] == [
        (1, "type_mismatch", "a"),
        (2, "missing", "z"),
        (3, "null_violation", "c"),
        (4, "null_violation", "b"),
        (5, "unexpected", "c"),
    ]
    assert [r["message"] for r in rows] == [
        "TYPE MISMATCH 'a': expected=StringType, got=LongType()",
        "MISSING column: 'z' (expected type=LongType)",
        "NON-NULLABLE VIOLATION 'c': 1 null values found",
        "NON-NULLABLE VIOLATION 'b': 1 null values found",
        "UNEXPECTED column: 'c' (not in expected schema)",
    ]


def test_counts_in_messages_have_separators(spark):
    nulls = spark.range(1234).selectExpr("cast(null as int) as v")
    row = validate(nulls, {"nullable": {"v": False}}).first()
    assert row["message"] == "NON-NULLABLE VIOLATION 'v': 1,234 null values found"
    assert row["null_count"] == 1234


def test_unexpected_columns_need_a_column_list(frame):
    assert validate(frame, {"nullable": {"a": False}}).count() == 0
    assert validate(frame, None).count() == 0


def test_struct_type_contract(frame):
    assert validate(frame, frame.schema).count() == 0
    strict = T.StructType([T.StructField(f.name, f.dataType, False) for f in frame.schema.fields])
    assert [r["column_name"] for r in validate(frame, strict).collect()] == ["b", "c"]


def test_markers_count_as_present(spark):
    frame = spark.createDataFrame([("N/A",)], "v string")
    assert validate(frame, {"nullable": {"v": False}}).count() == 0


def test_metadata_checks_need_no_scan(frame):
    plan = validate(frame, {"columns": {"a": "bigint"}})._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan
