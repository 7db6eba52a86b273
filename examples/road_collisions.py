"""Clean a CSV file of road-collision records and write table and reports.

    spark-submit examples/road_collisions.py <input csv> <output folder>
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siftwell import (  # noqa: E402
    QualityRun,
    QualityRunModel,
    cast_columns,
    domain_reports,
    read_text_csv,
    write_csv,
    write_reports,
)

# Column names, types and settings of the collision data set.
COUNTS = [
    "number_of_persons_injured",
    "number_of_persons_killed",
    "number_of_pedestrians_injured",
    "number_of_pedestrians_killed",
    "number_of_cyclist_injured",
    "number_of_cyclist_killed",
    "number_of_motorist_injured",
    "number_of_motorist_killed",
]
TYPES = {
    "number_of_persons_injured": "bigint",
    "number_of_persons_killed": "bigint",
    "number_of_pedestrians_injured": "bigint",
    "number_of_pedestrians_killed": "bigint",
    "number_of_cyclist_injured": "bigint",
    "number_of_cyclist_killed": "bigint",
    "number_of_motorist_injured": "bigint",
    "number_of_motorist_killed": "bigint",
    "latitude": "double",
    "longitude": "double",
    "collision_id": "bigint",
}
SETTINGS = {
    "null_representations": [
        "N/A", "null", "None", "", "Unknown", "n/a", "NA", "NaN", "UNKNOWN", "Unspecified",
    ],
    "drop_col_threshold": 0.80,
    "imputation_strategies": {
        "borough": "mode",
        "zip_code": "mode",
        "latitude": "median",
        "longitude": "median",
        "on_street_name": "mode",
        "contributing_factor_vehicle_1": "mode",
        "vehicle_type_code1": "mode",
        "number_of_persons_injured": "median",
        "number_of_persons_killed": "constant",
    },
    "fill_values": {"number_of_persons_killed": 0},
    "dedup_subset_cols": ["collision_id"],
    "outlier_cols": [
        "number_of_persons_injured",
        "number_of_persons_killed",
        "number_of_pedestrians_injured",
        "number_of_cyclist_injured",
        "number_of_motorist_injured",
        "latitude",
        "longitude",
    ],
    "outlier_method": "iqr",
    "outlier_action": "flag",
    "iqr_multiplier": 1.5,
    "expected_schema": {
        "columns": {
            "crash_date": "StringType",
            "crash_time": "StringType",
            "borough": "StringType",
            "zip_code": "StringType",
            "latitude": "DoubleType",
            "longitude": "DoubleType",
            "collision_id": "LongType",
            "number_of_persons_injured": "LongType",
            "number_of_persons_killed": "LongType",
            "contributing_factor_vehicle_1": "StringType",
            "vehicle_type_code1": "StringType",
        },
        "nullable": {"collision_id": False, "crash_date": False},
    },
}


def collision_reports(clean: DataFrame) -> dict[str, DataFrame]:
    return domain_reports(
        clean,
        group_column="borough",
        top_columns=["contributing_factor_vehicle_1", "vehicle_type_code1"],
        sum_columns=["number_of_persons_injured", "number_of_persons_killed"],
        average_columns=["number_of_persons_injured"],
        time_column="crash_time",
    )


def process(spark: SparkSession, source: str, target: str) -> QualityRunModel:
    records = cast_columns(read_text_csv(spark, source), TYPES)
    with QualityRun.from_dict(SETTINGS).fit(records) as model:
        write_csv(model.result, f"{target}/clean")
        model.write_reports(f"{target}/quality")
        write_reports(collision_reports(model.result), f"{target}/analytics")
    return model


if __name__ == "__main__":
    process(SparkSession.builder.appName("road-collisions").getOrCreate(), *sys.argv[1:3])
