import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siftwell import profile, quality_score


def by_name(frame):
    return {r["column_name"]: r.asDict(recursive=True) for r in frame.collect()}


@pytest.fixture
def mixed(spark):
    rows = [
        (1, 1.5, "a", True, datetime.date(2020, 1, 1), Decimal("1.10"), [1], {"k": 1, "j": 2}),
        (2, -0.0, "b", False, None, Decimal("1.1"), [1], {"j": 2, "k": 1}),
        (2, 0.0, "a", True, datetime.date(2020, 1, 1), None, None, None),
        (None, None, None, None, None, None, [2], {}),
    ]
    return spark.createDataFrame(
        rows,
        "i int, d double, s string, b boolean, day date, m decimal(5,2), arr array<int>, "
        "map map<string,int>",
    )


def test_every_type(mixed):
    p = by_name(profile(mixed).columns)
    assert {c: r["distinct_count"] for c, r in p.items()} == {
        "i": 2, "d": 2, "s": 2, "b": 2, "day": 1, "m": 1, "arr": 2, "map": 2,
    }
    assert {c: r["null_count"] for c, r in p.items()} == {
        "i": 1, "d": 1, "s": 1, "b": 1, "day": 2, "m": 2, "arr": 1, "map": 1,
    }
    assert p["i"]["min"] == 1.0 and p["i"]["max"] == 2.0 and p["i"]["mean"] == 1.6667
    assert p["i"]["top_values"] is None and p["s"]["min"] is None
    assert p["b"]["top_values"] == [{"value": "true", "count": 2}, {"value": "false", "count": 1}]
    assert p["day"]["top_values"] == [{"value": "2020-01-01", "count": 2}]
    assert p["s"]["data_type"] == "StringType()" and p["s"]["nullable"]
    assert p["day"]["completeness_pct"] == 50.0


def test_approximate_counts(mixed, spark):
    exact, rough = by_name(profile(mixed).columns), by_name(profile(mixed, distinct="approx").columns)
    assert rough == exact
    big = spark.range(20_000).selectExpr("id", "cast(id % 50 as string) as s")
    row = by_name(profile(big, distinct="approx", approx_rsd=0.02).columns)
    assert abs(row["id"]["distinct_count"] / 20_000 - 1) < 0.1
    assert row["s"]["distinct_count"] == 50
    with pytest.raises(ValueError):
        profile(big, distinct="some")


def test_zero_mean_and_spread_are_numbers(column):
    row = profile(column([0, 0], "int")).columns.first()
    assert (row["mean"], row["stddev"]) == (0.0, 0.0)


def test_top_values_are_three_with_stable_ties(column):
    rows = profile(column(["d", "c", "b", "a", "d", None], "string")).top_values.collect()
    assert [(r["rank"], r["value"], r["count"]) for r in rows] == [(1, "d", 2), (2, "a", 1), (3, "b", 1)]


def test_empty_table(spark):
    p = profile(spark.createDataFrame([], "a int, s string"))
    assert p.shape.first().asDict() == {"total_rows": 0, "total_columns": 2}
    row = by_name(p.columns)["a"]
    assert (row["null_pct"], row["completeness_pct"], row["distinct_count"]) == (0.0, 0.0, 0)
    assert p.score.first()["quality_score"] == 30.0


def test_wide_table(spark):
    wide = spark.range(20).select(
        *[(F.col("id") % (i + 1)).alias(f"n{i}") for i in range(130)],
        *[F.concat(F.lit("v"), F.col("id") % (i + 1)).alias(f"s{i}") for i in range(130)],
    )
    p = by_name(profile(wide).columns)
    assert len(p) == 260
    assert all(p[f"n{i}"]["distinct_count"] == min(20, i + 1) for i in range(130))
    assert all(p[f"s{i}"]["distinct_count"] == min(20, i + 1) for i in range(130))


def test_values_shuffle_once_for_counts_and_top_values(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(id % 9 as string) as s").write.parquet(path)
    columns = profile(spark.read.parquet(path)).columns
    columns.collect()
    plan = columns._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"WindowGroupLimit", final)) == 2


def test_jobs_do_not_grow_with_columns(spark, count_jobs):
    table = lambda n: spark.range(30).select(
        *[(F.col("id") + i).cast("string").alias(f"c{i}") for i in range(n)]
    )
    few, _ = count_jobs(lambda: profile(table(2)).columns.collect())
    many, rows = count_jobs(lambda: profile(table(40)).columns.collect())
    assert many <= few and len(rows) == 40


# Completeness percent and distinct count per column of the published example, in
# table order, before and after cleaning.
BEFORE = [
    (100.0, 365), (100.0, 96), (93.71, 5), (82.06, 1560), (79.49, 3961), (79.49, 3959),
    (79.49, 3975), (92.31, 12), (65.14, 12), (5.45, 1), (100.0, 5), (100.0, 3), (100.0, 3),
    (100.0, 2), (100.0, 2), (100.0, 2), (100.0, 2), (100.0, 2), (93.59, 11), (77.12, 11),
    (13.63, 11), (0.0, 0), (0.0, 0), (100.0, 5000), (95.78, 11), (82.57, 11), (18.2, 11),
    (0.0, 0), (0.0, 0),
]
AFTER = [
    (100.0, n)
    for n in [365, 96, 5, 1560, 3961, 3959, 3975, 12, 12, 5, 3, 3, 2, 2, 2, 2, 2, 9, 9, 5000, 10,
              10, 2, 2, 2, 2, 2, 1, 1]
]


@pytest.mark.parametrize(
    "columns, rows, issues, rule, expected",
    [
        (BEFORE, 5100, 18, "nonempty", 52.72),
        (AFTER, 5000, 0, "nonempty", 100.0),
        (BEFORE, 5100, 18, "ratio", 36.17),
        (AFTER, 5000, 0, "ratio", 80.69),
    ],
)
def test_published_scores(spark, columns, rows, issues, rule, expected):
    frame = spark.createDataFrame(
        [(rows, pct, n) for pct, n in columns],
        "row_count bigint, completeness_pct double, distinct_count bigint",
    )
    found = spark.range(issues).withColumnRenamed("id", "seq")
    assert quality_score(frame, found, rule).first()["quality_score"] == expected


@pytest.mark.parametrize("issues, expected", [(0, 30.0), (3, 24.0), (18, 0.0)])
def test_validity_points(spark, issues, expected):
    frame = spark.createDataFrame(
        [(1, 100.0, 1)], "row_count bigint, completeness_pct double, distinct_count bigint"
    )
    assert quality_score(frame, spark.range(issues)).first()["validity_score"] == expected


def test_no_columns_score_nothing(spark):
    frame = spark.createDataFrame(
        [], "row_count bigint, completeness_pct double, distinct_count bigint"
    )
    assert quality_score(frame).first()["quality_score"] == 0.0
    with pytest.raises(ValueError):
        quality_score(frame, None, "other")
