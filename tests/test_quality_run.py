import json

import pytest
from pyspark.sql import functions as F

from siftwell import QualityRun, RunConfig, TableCleaner, OutlierDetector, profile


@pytest.fixture(scope="module")
def table(spark):
    key = F.col("id")
    return spark.range(400).select(
        (key % 380).alias("id"),
        F.when(key % 9 == 0, "N/A").when(key % 3 == 0, "x").otherwise("y").alias("kind"),
        F.when(key % 380 % 7 > 0, key % 380 % 50).when(key % 380 % 14 == 0, 900).alias("size"),
        F.lit(None).cast("string").alias("empty"),
        F.when(key % 380 % 5 > 0, F.lit(True)).alias("ok"),
    )


CONFIG = {
    "expected_schema": {
        "columns": {"id": "LongType", "kind": "StringType", "gone": "StringType"},
        "nullable": {"size": False},
    },
    "imputation_strategies": {"size": "median", "ok": "mode"},
    "dedup_subset_cols": ["id"],
    "outlier_cols": ["size"],
    "relative_error": 0.0,
}


def test_run_equals_its_steps(spark, table):
    model = QualityRun.from_dict(CONFIG).fit(table)
    cleaner = TableCleaner(strategies=CONFIG["imputation_strategies"], keys=["id"], relative_error=0.0)
    cleaned = cleaner.fit_transform(table)
    detector = OutlierDetector(["size"], relative_error=0.0)
    expected = sorted(map(str, detector.fit_transform(cleaned).collect()))
    assert sorted(map(str, model.result.collect())) == expected
    assert sorted(map(str, model.transform(table).collect())) == expected

    alone = profile(table, CONFIG["expected_schema"])
    assert sorted(map(str, model.reports["pre_column_profile"].collect())) == sorted(
        map(str, alone.columns.collect())
    )
    assert model.reports["pre_schema_issues"].collect() == alone.issues.collect()
    assert model.reports["pre_quality_score"].collect() == alone.score.collect()
    assert sorted(map(str, model.before.top_values.collect())) == sorted(
        map(str, alone.top_values.collect())
    )
    before = {r["column_name"]: r["null_count"] for r in model.reports["null_audit_before"].collect()}
    assert before == {
        r["column_name"]: r["null_count"]
        for r in model.cleaning.null_audit_before(table).collect()
    }
    model.release()


@pytest.mark.parametrize("action", ["flag", "cap", "remove"])
def test_summary_adds_up(table, action):
    model = QualityRun.from_dict({**CONFIG, "outlier_action": action}).fit(table)
    s = model.reports["run_summary"].first()
    assert s["row_count_before"] == 400 and s["row_count_after"] == 380
    assert s["duplicate_rows_removed"] == 20 and s["dropped_columns"] == ["empty"]
    assert model.result.count() == 380 - s["outlier_rows_removed"]
    assert (s["outlier_rows_removed"] > 0) == (action == "remove")
    assert s["quality_score_after"] == 100.0 > s["quality_score_before"]
    assert {r["null_count"] for r in model.reports["null_audit_after"].collect()} == {0}
    model.release()


def test_full_report_is_json(table):
    model = QualityRun.from_dict(CONFIG).fit(table)
    report = json.loads(json.dumps(model.full_report()))
    assert list(report) == [
        "pre_clean_profile", "missing_duplicates", "outlier_detection", "post_clean_profile",
        "pipeline_duration_seconds",
    ]
    assert report["missing_duplicates"]["dropped_columns"] == ["empty"]
    assert list(report["pre_clean_profile"]["column_profiles"]) == table.columns
    assert report["outlier_detection"]["columns_checked"] == ["size"]
    assert report["pre_clean_profile"]["total_rows"] == 400
    model.release()


def test_sparse_rows_and_unstored_runs(table):
    settings = {**CONFIG, "drop_row_threshold": 1, "materialize": False}
    model = QualityRun.from_dict(settings).fit(table)
    assert model.work_table is None
    s = model.reports["run_summary"].first()
    assert s["sparse_rows_removed"] > 0
    assert s["row_count_before"] == (
        s["row_count_after"] + s["duplicate_rows_removed"] + s["sparse_rows_removed"]
    )


def test_validate_after(table):
    model = QualityRun.from_dict({**CONFIG, "validate_after": True}).fit(table)
    kinds = [r["kind"] for r in model.reports["post_schema_issues"].collect()]
    assert "missing" in kinds and "null_violation" not in kinds
    model.release()


def test_outputs_and_unknown_settings(spark, table, tmp_path):
    with pytest.warns(UserWarning, match="other"):
        config = RunConfig.from_dict({**CONFIG, "other": 1, "pre_profile_output": str(tmp_path)})
    model = QualityRun(config).fit(table)
    written = spark.read.json(str(tmp_path / "pre_column_profile"))
    assert written.count() == len(table.columns)
    model.write_reports(str(tmp_path / "all"))
    assert len(list((tmp_path / "all").iterdir())) == len(model.reports)
    model.release()


def test_jobs_do_not_grow_with_columns(spark, count_jobs):
    def frame(n):
        numbers = [F.when(F.col("id") % 4 > 0, F.col("id") + i).alias(f"n{i}") for i in range(n)]
        texts = [F.when(F.col("id") % 4 > 0, F.lit("t")).alias(f"s{i}") for i in range(n)]
        return spark.range(60).select("id", *numbers, *texts)

    run = QualityRun(RunConfig(dedup_subset_cols=["id"]))
    few, _ = count_jobs(lambda: run.fit(frame(1)).release())
    many, _ = count_jobs(lambda: run.fit(frame(12)).release())
    assert many <= few + 2
