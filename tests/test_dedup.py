import pytest
from pyspark.sql import functions as F

from siftwell import TableCleaner, drop_duplicate_rows, drop_duplicate_rows_late, duplicate_count


def test_whole_rows(column):
    assert drop_duplicate_rows(column([None, None, 1], "int")).count() == 2
    nan = float("nan")
    assert drop_duplicate_rows(column([nan, nan, 0.0, -0.0], "double")).count() == 2


def test_survivor_follows_the_order(spark):
    frame = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, n int, s string")
    first = drop_duplicate_rows(frame, ["k"], ["n"]).orderBy("k").collect()
    assert [r["s"] for r in first] == ["y", "z"]
    last = drop_duplicate_rows(frame, ["K"], [F.col("n").desc()]).orderBy("k").collect()
    assert [r["s"] for r in last] == ["x", "z"]


def test_survivor_without_order_does_not_depend_on_partitions(spark):
    frame = spark.range(2000).select((F.col("id") % 7).alias("k"), F.hash("id").alias("v"))
    results = {
        tuple(sorted(map(tuple, drop_duplicate_rows(frame.repartition(n), ["k"]).collect())))
        for n in (1, 3, 8)
    }
    assert len(results) == 1 and len(results.pop()) == 7


def test_null_keys_are_one_group(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert drop_duplicate_rows(frame, ["k"]).count() == 2
    row = duplicate_count(frame, ["k"]).first()
    assert (row["row_count"], row["distinct_count"], row["duplicate_rows"]) == (3, 2, 1)
    assert duplicate_count(spark.createDataFrame([], "k int")).first()["duplicate_rows"] == 0


def test_missing_key_is_an_error(column):
    with pytest.raises(ValueError, match="not in the table"):
        drop_duplicate_rows(column([1], "int"), ["absent"])


def test_hot_keys_shrink_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = drop_duplicate_rows(frame, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_cleaning_counts_sparse_rows_apart(spark):
    rows = [(1, "a", "b"), (1, "a", "b"), (2, None, None), (3, "a", None)]
    frame = spark.createDataFrame(rows, "k int, s string, t string")
    model = TableCleaner(drop_row_threshold=1, keys=["k"]).fit(frame)
    assert model.summary(frame).first().asDict() == {
        "row_count_before": 4,
        "row_count_after": 2,
        "duplicate_rows_removed": 1,
        "sparse_rows_removed": 1,
        "dropped_columns": [],
    }
    assert sorted(r["k"] for r in model.transform(frame).collect()) == [1, 3]


def test_statistics_follow_the_row_filter_and_precede_dedup(spark):
    rows = [(1, "a", 5), (1, "a", 5), (2, "b", 6), (3, None, 7), (None, None, None)]
    frame = spark.createDataFrame(rows, "k int, s string, n int")
    model = TableCleaner(drop_row_threshold=1, relative_error=0.0).fit(frame)
    out = sorted(map(tuple, model.transform(frame).collect()))
    assert out == [(1, "a", 5), (2, "b", 6), (3, "a", 7)]


def test_keys_are_never_dropped_as_sparse(spark):
    frame = spark.createDataFrame([(None, 1)] * 9 + [(5, 1)], "k int, v int")
    model = TableCleaner(keys=["k"]).fit(frame)
    assert model.dropped_columns == ()
    plan = model.imputation_plan(frame).first()
    assert plan["status"] == "filled: deduplication key"
    assert model.transform(frame).count() == 1


def test_cleaned_table_has_no_nulls_and_cleaning_again_changes_nothing(spark):
    frame = spark.range(60).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("n"),
        F.when(F.col("id") % 7 == 0, "N/A").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("s"),
    )
    cleaner = TableCleaner(relative_error=0.0)
    once = cleaner.fit_transform(frame)
    assert once.where("n is null or s is null").count() == 0
    again = cleaner.fit_transform(once)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def _rows(frame):
    return sorted(map(str, frame.collect()))


def _wide(spark, rows=2000):
    key = F.col("id")
    return spark.range(rows, numPartitions=4).select(
        F.when(key % 3 == 0, 0).when(key % 100 == 1, key - 1).otherwise(key).alias("k"),
        F.when(key % 50 == 2, None).otherwise(F.concat(F.lit("s"), key % 7)).alias("k.2"),
        F.hash("id").alias("v"),
        F.sha2(key.cast("string"), 512).alias("payload"),
    )


@pytest.mark.parametrize("keys", [["k"], ["k", "k.2"], ["K.2"], None])
@pytest.mark.parametrize("most", [1 << 20, 3])
def test_late_form_keeps_the_same_rows(spark, keys, most):
    frame = _wide(spark)
    frame = frame.unionByName(frame.where("v % 40 = 0"))
    order = ["v"] if keys else None
    late = drop_duplicate_rows_late(frame, keys, order, most)
    assert _rows(late) == _rows(drop_duplicate_rows(frame, keys, order))
    assert late.columns == frame.columns


def test_late_form_shuffles_repeated_keys_only(spark, tmp_path):
    _wide(spark).where("k <> 0 OR v % 2 = 0").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    late = drop_duplicate_rows_late(frame, ["k"], ["v"])
    plan = late._jdf.queryExecution().executedPlan().toString()
    # One side passes through, the other is limited to a row a key and task, then exchanged.
    assert (plan.count("LeftAnti"), plan.count("LeftSemi")) == (1, 1)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2


def test_late_form_without_repeats_returns_the_table(spark):
    frame = spark.range(100).withColumn("v", F.hash("id"))
    plan = drop_duplicate_rows_late(frame, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert drop_duplicate_rows_late(spark.createDataFrame([], "a int, b string")).count() == 0


def test_late_form_compares_like_the_plain_one(spark):
    """NaN equals NaN, zeros of either sign are equal, so are maps of the same entries and nulls."""
    nan = float("nan")
    numbers = spark.createDataFrame([(nan, 1), (nan, 2), (0.0, 3), (-0.0, 4), (None, 5), (None, 6)], "k double, v int")
    assert sorted(r["v"] for r in drop_duplicate_rows_late(numbers, ["k"], ["v"]).collect()) == [1, 3, 5]
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT NULL")
    assert drop_duplicate_rows_late(maps).count() == 2
