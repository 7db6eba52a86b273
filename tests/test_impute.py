import datetime
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftwell import Imputer


def fill(frame, strategy, value=None, **kw):
    values = {} if value is None else {"v": value}
    return Imputer({"v": strategy}, values, **kw).fit_transform(frame)


def test_mean_of_integers_is_truncated(column, values):
    assert values(fill(column([1, 2, 4, None], "bigint"), "mean")) == [1, 2, 4, 2]
    assert values(fill(column([-1, -2, -5, None], "bigint"), "mean"))[-1] == -2


def test_mean_of_decimals(column, values):
    frame = fill(column([Decimal("1.00"), Decimal("2.00"), None], "decimal(10,2)"), "mean")
    assert values(frame)[-1] == Decimal("1.50")
    assert frame.schema["v"].dataType.simpleString() == "decimal(10,2)"


@pytest.mark.parametrize("error", [0.0, 0.01])
def test_median_is_an_element(column, values, error):
    frame = column([1.0, 2.0, 3.0, 4.0, None], "double")
    assert values(fill(frame, "median", relative_error=error))[-1] == 2.0


def test_mode_ties_take_the_lowest(column, values):
    assert values(fill(column(["b", "a", None], "string"), "mode"))[-1] == "a"
    assert values(fill(column([10, 9, None], "int"), "mode"))[-1] == 9
    decimals = [Decimal("10.0"), Decimal("9.0"), None]
    assert values(fill(column(decimals, "decimal(5,1)"), "mode"))[-1] == Decimal("9.0")


@pytest.mark.parametrize(
    "ddl, value",
    [
        ("boolean", True),
        ("date", datetime.date(2021, 1, 1)),
        ("date", datetime.date(1960, 2, 29)),
        ("timestamp", datetime.datetime(2021, 1, 1, 2, 3, 4, 567)),
        ("timestamp_ntz", datetime.datetime(2021, 1, 1, 2, 3, 4, 567)),
        ("decimal(20,4)", Decimal("12345678901234.5678")),
        ("float", 1.5),
        ("double", 0.1),
        ("tinyint", -3),
        ("bigint", 2**62),
        ("binary", bytearray(b"\xff\x00")),
        ("string", "Ünï"),
    ],
)
def test_mode_of_each_type(column, values, ddl, value):
    frame = fill(column([value, value, None], ddl), "mode")
    assert values(frame) == [value] * 3
    assert frame.schema["v"].dataType.simpleString() == ddl


def test_constants_are_typed_or_reported(spark, column, values):
    day = datetime.date(2021, 1, 1)
    assert values(fill(column([None], "date"), "constant", day)) == [day]
    assert values(fill(column([None], "int"), "constant", 7)) == [7]
    frame = column([None, 1], "int")
    model = Imputer({"v": "constant"}, {"v": "abc"}).fit(frame)
    assert values(model.transform(frame)) == [None, 1]
    assert model.plan(spark).first()["status"] == "skipped: constant does not fit int"
    model = Imputer({"v": "constant"}).fit(frame)
    assert model.plan(spark).first()["status"] == "skipped: no constant given"


def test_default_strategy_and_untouched_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a", "k"), (2, "a", "k"), (None, None, "k")], "n int, s string, full string"
    )
    model = Imputer(relative_error=0.0).fit(frame)
    plan = {r["column_name"]: r["strategy"] for r in model.plan(spark).collect()}
    assert plan == {"n": "median", "s": "mode"}
    out = model.transform(frame)
    assert out.columns == frame.columns
    nullable = {f.name: f.nullable for f in out.schema.fields}
    assert nullable == {"n": False, "s": False, "full": True}


def test_all_null_and_nested_and_misfit_columns(spark):
    frame = spark.createDataFrame(
        [(None, None, None), (None, [1], "x")], "e string, a array<int>, s string"
    )
    model = Imputer({"s": "mean"}).fit(frame)
    status = {r["column_name"]: r["status"] for r in model.plan(spark).collect()}
    assert status == {
        "e": "skipped: no values",
        "a": "skipped: nested type",
        "s": "skipped: needs a numeric column",
    }
    assert model.transform(frame).where("s is null").count() == 1


def test_unknown_strategy_is_an_error():
    with pytest.raises(ValueError, match="unknown imputation"):
        Imputer({"v": "average"})


def test_nan_is_filled_only_with_nulls(column, values):
    nan = float("nan")
    found = values(fill(column([nan, None, 1.0, 1.0], "double"), "mode"))
    assert found[1:] == [1.0, 1.0, 1.0] and found[0] == 1.0
    found = values(fill(column([nan, 1.0], "double"), "median"))
    assert math.isnan(found[0])


def test_jobs_do_not_grow_with_columns(spark, count_jobs):
    def table(n):
        cells = [F.when(F.col("id") % 3 > 0, F.col("id")).alias(f"n{i}") for i in range(n)]
        texts = [F.when(F.col("id") % 3 > 0, F.lit("x")).alias(f"s{i}") for i in range(n)]
        return spark.range(50).select(*cells, *texts)

    few, _ = count_jobs(lambda: Imputer().fit(table(1)))
    many, model = count_jobs(lambda: Imputer().fit(table(20)))
    assert many == few and len(model.fills) == 40


def test_fill_is_idempotent(column):
    frame = column([1.0, None, 3.0], "double")
    model = Imputer().fit(frame)
    once = model.transform(frame)
    assert model.transform(once).collect() == once.collect()


def test_transform_works_on_a_stream(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (None, None)], "n int, s string")
    frame.write.parquet(str(tmp_path / "in"))
    model = Imputer().fit(frame)
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    assert model.transform(stream).isStreaming
