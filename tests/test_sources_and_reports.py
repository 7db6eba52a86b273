import json

import pytest

from siftwell import (
    cast_columns,
    domain_reports,
    group_counts,
    hour_histogram,
    null_audit,
    read_text_csv,
    top_k,
    totals,
    write_csv,
    write_report,
    write_reports,
)
from siftwell.sources import discard, materialize, shared_folder, work_path


def test_csv_scan_is_text_and_casts_are_safe(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text('a,b,c\n1,1.5,x\n,"",\nbad,worse,"q"\n')
    scan = read_text_csv(spark, str(file))
    assert {f.dataType.simpleString() for f in scan.schema.fields} == {"string"}
    out = cast_columns(scan, {"a": "bigint", "B": "double", "absent": "int"})
    assert [tuple(r) for r in out.collect()] == [(1, 1.5, "x"), (None, None, None), (None, None, "q")]
    assert out.columns == ["a", "b", "c"]


def test_csv_writer_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a"b,c'), (2, None)], "n int, s string")
    write_csv(frame, str(tmp_path / "out"))
    back = cast_columns(read_text_csv(spark, str(tmp_path / "out")), {"n": "int"})
    assert sorted(map(tuple, back.collect())) == [(1, 'a"b,c'), (2, None)]


def test_reports_keep_null_fields(spark, tmp_path):
    report = spark.createDataFrame([("x", None)], "column_name string, fill_value string")
    write_report(report, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).columns == ["column_name", "fill_value"]
    write_reports({"one": report, "two": null_audit(report)}, str(tmp_path / "all"))
    lines = [
        json.loads(line)
        for part in (tmp_path / "all" / "two").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    assert {r["column_name"]: r["null_count"] for r in lines} == {"column_name": 0, "fill_value": 1}


class FakeSession:
    """Stands for sessions of other clusters: the setting cannot change while Spark runs."""

    def __init__(self, setting=None, master="yarn", context_folder=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.applicationId = master, "app"
        self.getCheckpointDir = lambda: context_folder


def test_shared_folder_prefers_the_session_setting(spark):
    assert shared_folder(FakeSession("hdfs:///shared/", context_folder="/other")) == "hdfs:///shared"
    assert shared_folder(FakeSession(context_folder="/other")) == "/other"
    assert shared_folder(spark) == shared_folder(spark)
    assert work_path(spark, "x") != work_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession())


def test_work_tables(spark):
    import os

    stored, path = materialize(spark.range(5).toDF("n"), "five")
    assert path.startswith(shared_folder(spark)) and stored.count() == 5
    discard(spark, path)
    assert not os.path.exists(path)


def test_hours(column):
    frame = column(["9:05", "23:59", "", "x:1", None], "string")
    rows = [(r["hour"], r["count"]) for r in hour_histogram(frame, "v").collect()]
    assert rows == [(None, 3), (9, 1), (23, 1)]


def test_group_counts_and_top(column):
    frame = column(["a", None, "b", "b", None, None, "c"], "string")
    assert [tuple(r) for r in group_counts(frame, "v").collect()] == [
        (None, 3), ("b", 2), ("a", 1), ("c", 1),
    ]
    assert [tuple(r) for r in top_k(frame, "v", 2).collect()] == [("b", 2), ("a", 1)]
    plan = top_k(frame, "v", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_totals_of_nothing_are_zero(spark):
    frame = spark.createDataFrame([(None, None)], "n bigint, x double")
    assert tuple(totals(frame, ["n"], ["x"]).first()) == (0, 0.0)
    frame = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 4.0)], "n bigint, x double")
    assert tuple(totals(frame, ["n"], ["x"]).first()) == (3, 2.3333)


def test_domain_reports(spark):
    frame = spark.createDataFrame(
        [("n", "f", "car", 1, "0:10"), ("n", None, "bus", None, "13:00")],
        "area string, factor string, vehicle string, hurt int, at string",
    )
    reports = domain_reports(frame, "area", ["factor", "vehicle"], ["hurt"], ["hurt"], "at")
    assert list(reports) == ["counts_by_area", "top_factor", "top_vehicle", "totals", "hours_of_at"]
    assert reports["top_factor"].count() == 1
    assert reports["totals"].first().asDict() == {"total_hurt": 1, "avg_hurt": 1.0}
