import pytest
from pyspark.sql import functions as F

from siftwell.functions.frequency import top_values, value_frequencies
from siftwell.functions.heavy import certified, nominated, settle, settled_top_values
from siftwell.operators.impute import find_modes
from siftwell.operators.profile import profile

COLUMNS = ["col_id", "num", "real", "txt", "freq", "rank"]


def mixed(spark, rows=40_000):
    """A skewed column of many values, a narrow one, a unique one, and one of equal counts."""
    key = F.col("id")
    return spark.range(rows, numPartitions=5).select(
        F.when(key % 4 == 0, "hot").when(key % 10 == 1, "warm").when(key % 50 == 3, "mild")
        .otherwise(F.concat(F.lit("v"), key)).alias("skewed"),
        (key % 3 == 0).alias("narrow"),
        F.concat(F.lit("unique "), F.lpad(key.cast("string"), 9, "0")).alias("unique"),
        F.concat(F.lit("pair "), (key / 2).cast("int")).alias("paired"),
        F.lit(None).cast("string").alias("empty"),
        F.when(key % 2 == 0, F.lit(-0.0)).when(key % 5 == 0, F.lit(0.0)).when(key % 5 == 1, F.lit(float("nan")))
        .otherwise(key.cast("double")).alias("real"),
        (F.when(key % 3 == 0, 1).otherwise(key) / 4).cast("decimal(20,2)").alias("amount"),
        F.when(key % 3 == 0, "x" * 300).otherwise(F.concat(F.lit("y" * 200), key)).alias("long"),
    )


def ranked(frame):
    return sorted(map(str, frame.select(*COLUMNS).collect()))


@pytest.mark.parametrize("k", [1, 3, 20])
def test_equal_to_counting_everything(spark, k):
    frame = mixed(spark)
    fields = frame.schema.fields
    every = range(len(fields))
    assert ranked(settled_top_values(frame, fields, every, k)) == ranked(
        top_values(value_frequencies(frame, fields), k)
    )


def test_what_is_settled(spark):
    frame = mixed(spark)
    names = frame.columns
    found = settle(frame, frame.schema.fields, range(len(names)), 2)
    # The second place of two columns is a tie of values that occur once beside a hot one.
    assert {names[i] for i in found.left} == {"paired", "amount", "long"}
    assert {names[i] for i in settle(frame, frame.schema.fields, range(len(names)), 1).left} == {"paired"}
    known = {names[i]: n for i, n in found.distinct.items()}
    assert known == {"narrow": 2, "unique": 40_000, "empty": 0}


def test_close_counts_are_not_certified(spark):
    """Two buckets' worth of values that nearly tie leave the column to the exact count."""
    frame = spark.range(30_000).select((F.col("id") % 3000).cast("string").alias("v"))
    assert settle(frame, frame.schema.fields, [0], 3).left == [0]


def test_bound_covers_every_other_value(spark):
    frame = mixed(spark)
    fields = frame.schema.fields
    row = certified(frame, fields, [0], [(0, "warm")]).first()
    assert [c["freq"] for c in row["counts"]] == [frame.where("skewed = 'warm'").count()]
    assert row["bound"] >= frame.where("skewed = 'hot'").count()


def test_wrong_nominations_do_no_harm(spark, monkeypatch):
    from siftwell.functions import heavy

    frame = mixed(spark)
    fields = frame.schema.fields
    monkeypatch.setattr(heavy, "nominated", lambda *_: [(0, "v2"), (0, "absent"), (1, "true")])
    assert ranked(settled_top_values(frame, fields, range(len(fields)), 2)) == ranked(
        top_values(value_frequencies(frame, fields), 2)
    )


def test_empty_and_null_columns(spark):
    frame = spark.createDataFrame([], "a string, b double")
    found = settle(frame, frame.schema.fields, [0, 1], 3)
    assert found.left == [] and found.distinct == {0: 0, 1: 0} and found.freq.count() == 0
    assert profile(frame, top="nominated").top_values.count() == 0
    assert find_modes(frame, frame.schema.fields, True) == {"a": None, "b": None}


def test_nominations_are_few(spark):
    frame = mixed(spark)
    names = nominated(frame, frame.schema.fields, [0, 1, 2])
    assert (0, "hot") in names and len(names) <= 48 and not any(i == 2 for i, _ in names)


def test_unique_values_are_not_exchanged(spark):
    """What is left to run ranks a few rows of each task; no exchange carries a value of every row."""
    frame = mixed(spark).select("unique")
    found = settle(frame, frame.schema.fields, [0], 3)
    plan = top_values(found.freq, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "HashAggregate" not in plan
    assert [r["txt"][-3:] for r in top_values(found.freq, 3).orderBy("rank").collect()] == ["000", "001", "002"]


def test_profiles_are_equal(spark):
    frame = mixed(spark, 3000)
    plain, quick = profile(frame), profile(frame, top="nominated")
    order = lambda f: sorted(map(str, f.collect()))
    assert order(quick.columns) == order(plain.columns)
    assert order(quick.top_values) == order(plain.top_values)
    with pytest.raises(ValueError, match="top must be"):
        profile(frame, top="guessed")
