import math

import pytest
from pyspark.sql import functions as F

from siftwell import OutlierDetector


def detect(frame, **settings):
    return OutlierDetector(**{"relative_error": 0.0, **settings}).fit(frame)


@pytest.fixture
def hundred(column):
    return column([1, 2, 3, 4, 100, None], "bigint")


def test_quartile_fences_and_flags(spark, hundred, values):
    model = detect(hundred)
    bounds = model.bounds(spark).first()
    assert (bounds["lower_bound"], bounds["upper_bound"]) == (-1.0, 7.0)
    flags = model.transform(hundred)
    assert values(flags, "v_is_outlier") == [False, False, False, False, True, None]
    assert model.summary(hundred).first()["outlier_count"] == 1


def test_cap_keeps_nulls_and_widens_to_double(hundred, values):
    capped = detect(hundred, action="cap").transform(hundred)
    assert values(capped) == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert capped.schema["v"].dataType.simpleString() == "double"


def test_remove_drops_nulls_unless_kept(hundred):
    model = detect(hundred, action="remove")
    out = model.transform(hundred)
    assert out.count() == 4 and out.columns == ["v"]
    assert model.removal_counts(hundred).first()["rows_removed"] == 2
    assert detect(hundred, action="remove", keep_nulls=True).transform(hundred).count() == 5


def test_zscore(spark, column):
    frame = column([0] * 10 + [11], "bigint")
    model = detect(frame, method="zscore")
    bounds = model.bounds(spark).first()
    assert round(bounds["lower_bound"], 4) == -8.9499
    assert round(bounds["upper_bound"], 4) == 10.9499
    assert model.summary(frame).first()["outlier_count"] == 1


def test_zero_iqr_is_reported_as_degenerate(spark, column):
    frame = column([7, 7, 7, 7, 9], "int")
    row = detect(frame).summary(frame).first()
    assert (row["lower_bound"], row["upper_bound"]) == (7.0, 7.0)
    assert row["outlier_count"] == 1 and row["degenerate"]


def test_nan_is_an_outlier(column, values):
    frame = column([1.0, 2.0, 3.0, 4.0, float("nan")], "double")
    assert values(detect(frame).transform(frame), "v_is_outlier")[-1] is True


def test_skipped_columns(spark):
    frame = spark.createDataFrame([("a", None, 1), ("b", None, 1)], "s string, e int, c int")
    model = detect(frame, columns=["s", "e", "absent"], action="remove")
    status = {r["column_name"]: r["status"] for r in model.summary(frame).collect()}
    assert status == {"s": "skipped: not numeric", "e": "skipped: no values"}
    assert model.transform(frame).count() == 2
    model = detect(frame, columns=["C"], method="zscore")
    assert model.fences[0].column == "c" and model.fences[0].status == "skipped: no spread"
    empty = detect(frame.select("s"))
    assert empty.transform(frame).columns == frame.columns
    assert empty.summary(frame).count() == 0


def test_empty_column_list_means_all_numeric(spark):
    frame = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, s string")
    assert [f.column for f in detect(frame, columns=[]).fences] == ["a", "b"]


def test_bad_settings():
    with pytest.raises(ValueError, match="method"):
        OutlierDetector(method="mad")
    with pytest.raises(ValueError, match="action"):
        OutlierDetector(action="delete")


def test_remove_uses_every_checked_column(spark):
    rows = [(i, i) for i in range(1, 11)] + [(500, 5), (5, 500)]
    frame = spark.createDataFrame(rows, "a int, b int")
    out = detect(frame, action="remove").transform(frame)
    assert out.count() == 10


def test_capped_values_stay_inside_and_flags_match_the_summary(spark):
    frame = spark.range(500).select(F.pow(F.col("id") % 97, F.lit(3)).alias("v"))
    model = detect(frame)
    flagged = model.transform(frame).where("v_is_outlier").count()
    assert flagged == model.summary(frame).first()["outlier_count"] > 0
    fence = model.fences[0]
    capped = detect(frame, action="cap").transform(frame)
    low, high = capped.agg(F.min("v"), F.max("v")).first()
    assert fence.lower <= low and high <= fence.upper
    assert math.isclose(high, fence.upper)


def test_jobs_do_not_grow_with_columns(spark, count_jobs):
    table = lambda n: spark.range(50).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(n)])
    for method in ("iqr", "zscore"):
        detector = OutlierDetector(method=method)
        few, _ = count_jobs(lambda: detector.fit(table(1)))
        many, model = count_jobs(lambda: detector.fit(table(30)))
        assert many == few and len(model.checked) == 30
