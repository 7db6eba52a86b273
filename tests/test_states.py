"""Mergeable states, scans of the full run, words of bits, failed casts and balanced files."""

import math
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from siftwell import QualityRun, RunConfig, cast_columns, profile, read_text_csv, write_parquet
from siftwell.functions.frequency import word_counts
from siftwell.operators.profile import column_stats
from siftwell.operators.states import as_stats, column_states, merged, profile_states
from siftwell.plans import quality_run
from siftwell.sources import cast_failures


@pytest.fixture
def mixed(spark):
    key = F.col("id")
    return spark.range(0, 3000, 1, 7).select(
        key,
        F.when(key % 9 > 0, key % 40 - 20).cast("int").alias("small"),
        (F.lit(str(10**30)).cast("decimal(38,2)") + key).alias("wide"),
        F.when(key % 5 > 0, key / 7).alias("real"),
        F.when(key % 4 > 0, F.concat(F.lit("t"), key % 11)).alias("text"),
        F.lit(None).cast("double").alias("none"),
    )


def test_merged_states_are_those_of_the_whole(mixed):
    fields = mixed.schema.fields
    parts = [column_states(mixed.where(F.col("id") % 3 == k)) for k in range(3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = {r.column_name: r for r in profile_states(together, fields).collect()}
    stats = {r.column_name: r for r in column_stats(mixed).collect()}
    exact = {r.column_name: r.distinct_count for r in profile(mixed).columns.collect()}
    assert set(found) == set(stats)
    for name, row in found.items():
        whole = stats[name]
        for fact in ("row_count", "null_count", "min", "max", "min_text", "max_text"):
            assert row[fact] == whole[fact], (name, fact)
        for fact in ("mean", "stddev"):
            if name != "wide":  # doubles hold neither of its moments
                assert row[fact] == (None if whole[fact] is None else round(whole[fact], 4))
        assert abs(row.distinct_count - exact[name]) <= 0.2 * exact[name]
    assert abs(found["id"].quantiles[1] - 1500) < 60 and found["none"].quantiles is None


def test_states_of_nothing(mixed, spark):
    fields = mixed.schema.fields
    empty = profile_states(column_states(mixed.limit(0)), fields)
    assert empty.count() in (0, len(fields))
    nan = spark.sql("SELECT * FROM VALUES (1D), (double('nan')), (NULL) AS t(v)")
    row = as_stats(merged(column_states(nan), nan.schema.fields)).first()
    assert row.null_count == 1 and math.isnan(row["mean"]) and math.isnan(row["max"]) and row["min"] == 1.0


def _scans(spark, df):
    """The table through a function that counts the rows it hands out."""
    counted = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), counted


@pytest.mark.parametrize("action", ["flag", "cap", "remove"])
def test_a_run_reads_each_table_three_times(spark, tmp_path, monkeypatch, action):
    key = F.col("id")
    spark.range(0, 500, 1, 3).select(
        key,
        F.when(key % 4 > 0, key % 90 / 3).alias("size"),
        F.when(key % 7 > 0, key % 6).cast("string").alias("kind"),
    ).write.parquet(str(tmp_path / "raw"))
    raw, read = _scans(spark, spark.read.parquet(str(tmp_path / "raw")))
    stored = []
    store = quality_run.materialize

    def watched(df, label):
        frame, path = store(df, label)
        stored.append(_scans(spark, frame))
        return stored[-1][0], path

    monkeypatch.setattr(quality_run, "materialize", watched)
    # Of an integer key no distinct count is asked, so no words are counted apart.
    config = RunConfig(outlier_action=action, distinct="approx", outlier_cols=["size"])
    with QualityRun(config).fit(raw):
        rows = 500
        assert read.value == 3 * rows
        # One more for the estimates of distinct counts.
        assert stored[0][1].value <= 4 * rows


def test_rows_before_deduplication_are_observed(spark):
    rows = spark.range(60).select((F.col("id") % 50).alias("k"), F.when(F.col("id") % 3 > 0, 1).alias("v"))
    config = RunConfig(dedup_subset_cols=["k"], drop_row_threshold=0)
    with QualityRun(config).fit(rows) as model:
        s = model.reports["run_summary"].first()
    assert (s.row_count_before, s.sparse_rows_removed) == (60, 20)
    assert s.row_count_after + s.duplicate_rows_removed == 40


def test_words_count_every_integer(spark):
    edge = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, 63, 64, -64, -65, None, 0, 63]
    rows = spark.createDataFrame([(v, v % 5 if v else None) for v in edge], "a bigint, b bigint")
    found = {r.col_id: r.distinct_count for r in word_counts(rows, rows.schema.fields, [0, 1]).collect()}
    assert found == {0: 9, 1: len({v % 5 for v in edge if v})}
    counts = {r.column_name: r.distinct_count for r in profile(rows).columns.collect()}
    assert counts == {"a": found[0], "b": found[1]}
    plan = profile(rows).columns._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and word_counts(rows, rows.schema.fields, []).count() == 0


def test_broken_lines_and_casts_are_counted(spark, tmp_path):
    lines = ["a,b,c", "1,2,3", "4,x,6", "7", "8,9,10,11", ",,"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    rows = read_text_csv(spark, str(tmp_path / "t.csv"), "line")
    assert rows.columns == ["a", "b", "c", "line"]
    assert sorted(r.line for r in rows.collect() if r.line) == ["7", "8,9,10,11"]
    types = {"a": "int", "b": "int", "gone": "int"}
    found = {r.column_name: r for r in cast_failures(rows, types).collect()}
    assert set(found) == {"a", "b"} and found["a"].failed_count == 0
    assert (found["b"].value_count, found["b"].failed_count, found["b"].least_failed) == (3, 1, "x")
    seen = Observation()
    assert cast_columns(rows, types, seen).count() == 5
    assert seen.get == {"a": 0, "b": 1}
    assert cast_failures(rows, {}).count() == 0


def test_hot_values_do_not_make_large_files(spark, tmp_path):
    key = F.col("id")
    hot = spark.range(200_000).select(
        F.when(key % 3 > 0, 0).otherwise(key).alias("k"), F.sha2(key.cast("string"), 256).alias("v")
    )
    skewed = hot.repartition(4, "k")

    def sizes(name):
        return sorted(
            f.stat().st_size for f in (tmp_path / name).iterdir() if f.name.endswith(".parquet")
        )

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    write_parquet(skewed, str(tmp_path / "skewed"))
    write_parquet(skewed, str(tmp_path / "even"), file_bytes=1 << 20)
    assert max(sizes("skewed")) > 0.6 * sum(sizes("skewed"))
    assert max(sizes("even")) < 0.25 * sum(sizes("even"))
    assert spark.read.parquet(str(tmp_path / "even")).count() == 200_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before
    assert os.path.isdir(tmp_path / "even")
