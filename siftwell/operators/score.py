"""Quality score of a profiled table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Points per part, the distinct share that counts as unique, points per issue.
COMPLETENESS_POINTS = 50
UNIQUENESS_POINTS = 20
VALIDITY_POINTS = 30
UNIQUE_SHARE = 0.90
ISSUE_POINTS = 2

UNIQUENESS_RULES = ("nonempty", "ratio")


def quality_score(
    columns: DataFrame, issues: DataFrame | None = None, uniqueness: str = "nonempty"
) -> DataFrame:
    """One row: ``completeness_score, uniqueness_score, validity_score, quality_score``.

    ``columns`` needs ``row_count``, ``completeness_pct`` and ``distinct_count`` per column,
    ``issues`` one row per contract violation. A column counts as unique when it has any value
    (``nonempty``) or when more than 90 % of its rows are distinct (``ratio``). A table without
    columns scores 0.
    """
    if uniqueness not in UNIQUENESS_RULES:
        raise ValueError(f"uniqueness must be one of {UNIQUENESS_RULES}, not {uniqueness!r}")
    base = F.col("row_count") if uniqueness == "ratio" else F.lit(1)
    parts = columns.select(
        F.col("completeness_pct"),
        (F.col("distinct_count") / F.greatest(base, F.lit(1)) > UNIQUE_SHARE)
        .cast("int")
        .alias("is_unique"),
        F.lit(0).alias("issue"),
    )
    if issues is not None:
        parts = parts.unionByName(
            issues.select(
                F.lit(None).cast("double").alias("completeness_pct"),
                F.lit(None).cast("int").alias("is_unique"),
                F.lit(1).alias("issue"),
            )
        )
    penalty = F.least(F.sum("issue") * ISSUE_POINTS, F.lit(VALIDITY_POINTS))
    has_columns = F.count("completeness_pct") > 0
    scored = parts.agg(
        *[
            F.when(has_columns, points.cast("double")).otherwise(F.lit(0.0)).alias(name)
            for name, points in {
                "completeness_score": F.avg("completeness_pct") * (COMPLETENESS_POINTS / 100),
                "uniqueness_score": F.avg("is_unique") * UNIQUENESS_POINTS,
                "validity_score": VALIDITY_POINTS - penalty,
            }.items()
        ]
    )
    total = F.col("completeness_score") + F.col("uniqueness_score") + F.col("validity_score")
    return scored.withColumn("quality_score", F.round(total, 2))
