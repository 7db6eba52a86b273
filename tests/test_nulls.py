import datetime
import math

from pyspark.sql import functions as F

from siftwell import (
    drop_sparse_columns,
    drop_sparse_rows,
    normalize_nulls,
    null_audit,
    sparse_columns,
)
from siftwell.operators.nulls import markers_for


def test_markers_match_exactly(column, values):
    frame = column(["N/A", "n/a", " N/A", "x", None, "", "unknown"], "string")
    assert values(normalize_nulls(frame)) == [None, None, " N/A", "x", None, None, "unknown"]


def test_typed_markers_keep_the_type(column, values):
    frame = normalize_nulls(column([True, False, None], "boolean"), ["false"])
    assert values(frame) == [True, None, None]
    assert frame.schema["v"].dataType.typeName() == "boolean"
    day = datetime.date(2021, 1, 1)
    assert values(normalize_nulls(column([day, None], "date"), ["2021-01-01"])) == [None, None]


def test_empty_binary_and_arrays(column, values):
    assert values(normalize_nulls(column([bytearray(b""), bytearray(b"x")], "binary")))[0] is None
    frame = column([[], [1]], "array<int>")
    assert values(normalize_nulls(frame)) == [[], [1]]
    assert values(normalize_nulls(frame, ["[]"])) == [None, [1]]


def test_only_reachable_markers_are_compared(spark):
    markers = ["N/A", "false", "2020-01-01", "[]"]
    types = {f.name: f.dataType for f in spark.createDataFrame(
        [], "s string, b boolean, d date, a array<int>, n bigint").schema.fields}
    assert markers_for(types["s"], markers) == markers
    assert markers_for(types["b"], markers) == ["false"]
    assert markers_for(types["d"], markers) == ["2020-01-01"]
    assert markers_for(types["a"], markers) == ["[]"]
    assert markers_for(types["n"], markers) == []


def test_none_means_default_and_empty_means_off(column, values):
    frame = column(["N/A", "x"], "string")
    assert values(normalize_nulls(frame, None)) == [None, "x"]
    assert values(normalize_nulls(frame, [])) == ["N/A", "x"]


def test_numeric_columns_pass_through(column, values):
    found = values(normalize_nulls(column([float("nan"), 1.0, None], "double"), ["1.0", "NaN"]))
    assert math.isnan(found[0]) and found[1:] == [1.0, None]
    assert values(normalize_nulls(column([float("nan"), 1.0], "double"), nan_is_null=True)) == [None, 1.0]


def test_odd_column_names(spark):
    frame = spark.createDataFrame([("N/A", 1), ("x", None)], "`a.b` string, `c``d` int")
    clean = normalize_nulls(frame)
    assert clean.columns == ["a.b", "c`d"]
    audit = {r["column_name"]: r["null_count"] for r in null_audit(clean).collect()}
    assert audit == {"a.b": 1, "c`d": 1}


def test_audit_counts_and_empty_table(spark, column):
    row = null_audit(column([1, None, None], "int")).first()
    assert (row["null_count"], row["null_pct"], row["row_count"]) == (2, 66.67, 3)
    row = null_audit(column([], "int")).first()
    assert (row["null_count"], row["null_pct"], row["row_count"]) == (0, 0.0, 0)


def test_audit_is_one_scan_for_many_columns(spark, count_jobs):
    narrow = spark.range(10)
    wide = narrow.select(*[(F.col("id") + i).alias(f"c{i}") for i in range(150)])
    few, _ = count_jobs(lambda: null_audit(narrow).collect())
    many, rows = count_jobs(lambda: null_audit(wide).collect())
    assert many == few and len(rows) == 150


def test_more_columns_than_one_pass(spark):
    wide = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(450)])
    rows = null_audit(wide).collect()
    assert [r["column_name"] for r in rows] == wide.columns
    assert {r["row_count"] for r in rows} == {10}


def test_sparse_threshold_is_strict(spark):
    frame = spark.createDataFrame([(1, None, 1)] + [(None, None, 1)] * 4, "a int, b int, c int")
    assert drop_sparse_columns(frame, 0.80).columns == ["a", "c"]
    assert drop_sparse_columns(frame, 0.80, keep=["B"]).columns == ["a", "b", "c"]
    assert [r["column_name"] for r in sparse_columns(frame).collect()] == ["b"]


def test_empty_table_drops_nothing(spark):
    frame = spark.createDataFrame([], "a int, b string")
    assert drop_sparse_columns(frame).columns == ["a", "b"]


def test_sparse_rows(spark):
    nan = float("nan")
    frame = spark.createDataFrame(
        [(1, "x", nan), (1, None, None), (None, None, None), (None, "y", 1.0)],
        "a int, b string, c double",
    )
    assert drop_sparse_rows(frame, 1).count() == 2
    assert drop_sparse_rows(frame, 2).count() == 3
    assert drop_sparse_rows(frame, 0).count() == 1  # NaN is not a null
    assert drop_sparse_rows(frame, 0, ["a"]).count() == 2
