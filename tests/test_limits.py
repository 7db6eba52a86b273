"""Accuracy limits, infinities, maps, job counts and the lifetime of work tables."""

import os

import pytest
from pyspark.sql import functions as F

from siftwell import Imputer, OutlierDetector, QualityRun, drop_duplicate_rows, duplicate_count, profile
from siftwell.functions.frequency import LEAST_SKETCH_ERROR, LONG_BYTES
from siftwell.functions.quantiles import LARGEST_SKETCH, quantiles, sketch_size
from siftwell.plans import quality_run


def test_errors_beyond_sketches_are_answered_exactly(spark):
    assert sketch_size(0.01) <= LARGEST_SKETCH and sketch_size(1e-5) is None
    numbers = spark.range(1, 20_002).select(F.col("id").alias("v"))
    assert quantiles(numbers, ["v"], [0.25, 0.5], 1e-6) == {"v": [5001, 10001]}


def test_distinct_error_beyond_sketches_raises(column):
    with pytest.raises(ValueError):
        profile(column([1, 2], "bigint"), distinct="approx", approx_rsd=LEAST_SKETCH_ERROR / 2)


@pytest.mark.parametrize("ddl", ["bigint", "decimal(38,2)"])
def test_exact_quantiles_keep_all_digits(spark, monkeypatch, ddl):
    from siftwell.functions import quantiles as q

    monkeypatch.setattr(q, "RANKABLE_ROWS", 3)
    base = 1 << 60
    rows = spark.range(200).select((F.lit(base) + F.col("id") * 2 + 1).cast(ddl).alias("v"))
    assert [int(x) for x in quantiles(rows, ["v"], [0.25, 0.5, 1.0], 0)["v"]] == [
        base + 99, base + 199, base + 399,
    ]


def test_infinite_quartiles_are_skipped(column):
    inf = float("inf")
    rows = column([inf] * 8 + [1.0, 2.0], "double")
    model = OutlierDetector(action="remove", relative_error=0.0).fit(rows)
    assert [f.status for f in model.fences] == ["skipped: infinite quartiles"]
    assert model.transform(rows).count() == 10


def test_rows_with_maps(spark):
    rows = spark.createDataFrame(
        [(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (2, None), (2, None)], "k int, m map<string,int>"
    )
    kept = drop_duplicate_rows(rows)
    assert kept.dtypes == rows.dtypes
    assert sorted((r.k, r.m) for r in kept.collect()) == [(1, {"a": 1, "b": 2}), (2, None)]
    assert duplicate_count(rows).first()["duplicate_rows"] == 2
    with QualityRun().fit(rows) as model:
        assert model.result.count() == 2


def test_constants_take_one_job(spark, count_jobs):
    names = [f"c{i}" for i in range(30)]
    rows = spark.range(4).select(*[F.when(F.col("id") > 0, F.col("id")).alias(n) for n in names])
    values = dict.fromkeys(names, 7) | {"c3": "no number"}
    imputer = Imputer(dict.fromkeys(names, "constant"), values)
    jobs, model = count_jobs(lambda: imputer.fit(rows))
    assert jobs <= 3
    assert {f.column for f in model.fills if f.literal is None} == {"c3"}
    assert model.transform(rows).where("c0 = 7").count() == 1


def test_long_values_are_whole_in_reports(spark):
    long, other = "x" * (LONG_BYTES * 3), "x" * (LONG_BYTES * 3 - 1) + "y"
    rows = spark.createDataFrame([(long,), (long,), (other,), ("short",), (None,)], "v string")
    found = profile(rows)
    assert found.columns.first()["distinct_count"] == 3
    assert {(r["value"], r["count"]) for r in found.top_values.collect()} == {(long, 2), (other, 1), ("short", 1)}
    filled = Imputer({"v": "mode"}).fit_transform(rows)
    assert filled.where(F.col("v") == long).count() == 3


def test_nested_values_compare_as_spark_does(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (array(0D), named_struct('a', 0D, 't', timestamp'2024-01-01 00:00:00.000001')), "
        "(array(-0D), named_struct('a', -0D, 't', timestamp'2024-01-01 00:00:00.000002')) AS t(x, y)"
    )
    counts = {r["column_name"]: r["distinct_count"] for r in profile(rows).columns.collect()}
    assert counts == {"x": 1, "y": 2}
    estimates = {r["column_name"]: r["distinct_count"] for r in profile(rows, distinct="approx").columns.collect()}
    assert estimates == counts


def _leftovers(folder):
    return [name for name in os.listdir(folder) if name.startswith("siftwell-cleaned")]


def test_work_tables_go_after_success_and_failure(spark, tmp_path, monkeypatch, column):
    rows = column([1, 2, 2, None], "bigint")
    monkeypatch.setattr("siftwell.sources.workspace.shared_folder", lambda _: str(tmp_path))
    with QualityRun().fit(rows) as model:
        assert model.result.count() == 2 and len(_leftovers(tmp_path)) == 1
    assert not _leftovers(tmp_path)

    def broken(*_):
        raise RuntimeError("late")

    monkeypatch.setattr(quality_run.QualityRun, "_profile_after", broken)
    with pytest.raises(RuntimeError):
        QualityRun().fit(rows)
    assert not _leftovers(tmp_path)
