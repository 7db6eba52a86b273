import importlib.util
import os

EXAMPLE = os.path.join(os.path.dirname(os.path.dirname(__file__)), "examples", "road_collisions.py")


def test_collision_records_end_to_end(spark, tmp_path):
    spec = importlib.util.spec_from_file_location("road_collisions", EXAMPLE)
    example = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(example)

    header = [
        "crash_date", "crash_time", "borough", "zip_code", "latitude", "longitude", *example.COUNTS,
        "contributing_factor_vehicle_1", "contributing_factor_vehicle_5", "vehicle_type_code1",
        "collision_id",
    ]
    lines = [",".join(header)]
    for i in list(range(40)) + [0, 1]:
        borough = ["A", "B", "Unspecified", ""][i % 4]
        counts = [str(i % 3), "" if i == 5 else "0"] + ["0"] * 6
        factor = "UNKNOWN" if i % 5 == 0 else f"f{i % 2}"
        lines.append(
            ",".join(["2024-01-01", f"{i % 24}:05", borough, "1", f"4{i % 2}.5", "-73.9", *counts,
                      factor, "", "Sedan", str(i)])
        )
    source = tmp_path / "in.csv"
    source.write_text("\n".join(lines) + "\n")

    target = str(tmp_path / "out")
    model = example.process(spark, str(source), target)
    summary = model.reports["run_summary"].first()
    assert (summary["row_count_before"], summary["row_count_after"]) == (42, 40)
    assert summary["dropped_columns"] == ["contributing_factor_vehicle_5"]
    clean = spark.read.option("header", True).csv(f"{target}/clean")
    assert clean.count() == 40 and "latitude_is_outlier" in clean.columns
    assert clean.where("borough IS NULL OR borough = 'Unspecified'").count() == 0
    hours = spark.read.json(f"{target}/analytics/hours_of_crash_time")
    assert hours.agg({"count": "sum"}).first()[0] == 40
    assert spark.read.json(f"{target}/quality/pre_schema_issues").count() > 0
