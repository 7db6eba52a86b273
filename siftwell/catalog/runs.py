"""Queries over the full run: profile, clean, treat outliers, profile again."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.catalog.inputs import DIRTY_EVENTS, FILLED_ORDERS, dirty_events, dirty_orders
from siftwell.catalog.profiles import (
    CONTRACT,
    ISSUES,
    NUMERIC,
    OTHER,
    PROFILE,
    TYPES,
    profile_sql,
    top_sql,
)
from siftwell.catalog.registry import query
from siftwell.functions.columns import pin
from siftwell.operators.analytics import domain_reports
from siftwell.plans.config import RunConfig
from siftwell.plans.quality_run import QualityRun
from siftwell.sources import work_path, write_reports
from siftwell.sources.workspace import discard

FENCE = """fence AS (
      SELECT q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
      FROM (SELECT quantile_disc(o_totalprice, 0.25) AS q1,
              quantile_disc(o_totalprice, 0.75) AS q3 FROM clean))"""
IS_OUTLIER = (
    "(o_totalprice < (SELECT lower_bound FROM fence) "
    "OR o_totalprice > (SELECT upper_bound FROM fence))"
)


def _fit(spark, folder, action="flag", **more):
    config = RunConfig(
        expected_schema=CONTRACT,
        dedup_subset_cols=["o_orderkey"],
        outlier_cols=["o_totalprice"],
        outlier_action=action,
        relative_error=0.0,
        **more,
    )
    return QualityRun(config).fit(dirty_orders(spark, folder))


@query(
    "full_run_clean",
    f"WITH {FILLED_ORDERS}, {FENCE} SELECT *, {IS_OUTLIER} AS o_totalprice_is_outlier FROM clean",
)
def full_run_clean(spark, folder):
    return _fit(spark, folder).result


@query(
    "full_run_approx",
    f"WITH {FILLED_ORDERS}, {FENCE} SELECT *, {IS_OUTLIER} AS o_totalprice_is_outlier FROM clean",
)
def full_run_approx(spark, folder):
    """The same table with estimated distinct counts in the profiles."""
    return _fit(spark, folder, distinct="approx").result


@query(
    "full_run_summary",
    f"""WITH {FILLED_ORDERS}, {FENCE}, profile AS ({PROFILE}), issues AS ({ISSUES})
    SELECT (SELECT count(*) FROM dirty) AS row_count_before, count(*) AS row_count_after,
      (SELECT count(*) FROM dirty) - count(*) AS duplicate_rows_removed,
      0 AS sparse_rows_removed, 'o_note' AS dropped_columns,
      count(*) FILTER ({IS_OUTLIER}) AS outlier_rows_removed,
      (SELECT round(avg(completeness_pct) * 0.5
         + avg(CASE WHEN distinct_count >= 1 THEN 1 ELSE 0 END) * 20
         + 30 - least(2 * (SELECT count(*) FROM issues), 30), 2) FROM profile)
        AS quality_score_before,
      100.0::DOUBLE AS quality_score_after, 'iqr' AS outlier_method, 'remove' AS outlier_action
    FROM clean""",
)
def full_run_summary(spark, folder):
    with _fit(spark, folder, "remove") as model:
        summary = pin(model.reports["run_summary"])
    return summary.withColumn("dropped_columns", F.array_join("dropped_columns", ","))


def _sides(column):
    after = (
        "NULL AS null_count_after, NULL AS distinct_count_after, NULL AS completeness_pct_after"
        if column == "o_note"
        else f"(SELECT count(*) - count({column}) FROM clean) AS null_count_after, "
        f"(SELECT count(DISTINCT {column}) FROM clean) AS distinct_count_after, "
        f"(SELECT round(100.0 * count({column}) / count(*), 2) FROM clean) "
        "AS completeness_pct_after"
    )
    return (
        f"SELECT '{column}' AS column_name, count(*) - count({column}) AS null_count_before, "
        f"count(DISTINCT {column}) AS distinct_count_before, "
        f"round(100.0 * count({column}) / count(*), 2) AS completeness_pct_before, {after} "
        "FROM dirty"
    )


@query(
    "full_run_report",
    f"WITH {FILLED_ORDERS} " + " UNION ALL ".join(_sides(c) for c in TYPES),
)
def full_run_report(spark, folder):
    """Profiles before and after, side by side."""
    with _fit(spark, folder) as model:
        reports = {name: pin(report) for name, report in model.reports.items()}
    facts = ["null_count", "distinct_count", "completeness_pct"]
    side = lambda frame, when: frame.select(
        "column_name", *[F.col(f).alias(f"{f}_{when}") for f in facts]
    )
    return side(reports["pre_column_profile"], "before").join(
        F.broadcast(side(reports["post_column_profile"], "after")), "column_name", "left"
    )


FLAGGED = f"flagged AS (SELECT *, {IS_OUTLIER} AS o_totalprice_is_outlier FROM clean)"
AFTER_TYPES = {
    **{c: t for c, t in TYPES.items() if c != "o_note"},
    "o_totalprice_is_outlier": "BooleanType()",
}


@query(
    "full_run_report_facts",
    f"WITH {FILLED_ORDERS}, {FENCE}, {FLAGGED} "
    + " UNION ALL ".join(
        f"SELECT '{phase}' AS phase, * FROM ({profile_sql(source, types)}) LEFT JOIN ("
        + " UNION ALL ".join(top_sql(c, source) for c in types if c not in NUMERIC)
        + ") USING (column_name)"
        for phase, source, types in (("pre", "dirty", TYPES), ("post", "flagged", AFTER_TYPES))
    ),
)
def full_run_report_facts(spark, folder):
    """Every fact of the profiles before and after, top values as rows."""
    with _fit(spark, folder) as model:
        both = [
            pin(model.reports[f"{phase}_column_profile"]).withColumn("phase", F.lit(phase))
            for phase in ("pre", "post")
        ]
    rows = both[0].unionByName(both[1]).select("*", F.posexplode_outer("top_values").alias("pos", "top"))
    named = rows.select("*", (F.col("pos") + 1).alias("rank"), "top.value", "top.count")
    return named.drop("top_values", "pos", "top")


def _facts_sql(source, columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count FROM {source}"
        for c in columns
    )


CAPPED = """capped AS (
      SELECT * REPLACE (least(greatest(o_totalprice, (SELECT lower_bound FROM fence)),
        (SELECT upper_bound FROM fence)) AS o_totalprice) FROM clean)"""


@query(
    "full_report_roundtrip",
    f"WITH {FILLED_ORDERS}, {FENCE}, {CAPPED} "
    + " UNION ALL ".join(
        "SELECT '" + phase + "' AS phase, column_name, null_count, distinct_count, rank, value, count "
        f"FROM ({_facts_sql(source, columns)}) LEFT JOIN ("
        + " UNION ALL ".join(top_sql(c, source) for c in columns if c in OTHER)
        + ") USING (column_name)"
        for phase, source, columns in (
            ("pre", "dirty", list(TYPES)),
            ("post", "capped", [c for c in TYPES if c != "o_note"]),
        )
    ),
)
def full_report_roundtrip(spark, folder):
    """All reports of a run written as JSON; both profiles read back, nested top values as rows."""
    path = work_path(spark, "run-reports")
    with _fit(spark, folder, "cap") as model:
        model.write_reports(path)
        schemas = {n: r.schema for n, r in model.reports.items()}
    both = [
        spark.read.schema(schemas[f"{phase}_column_profile"])
        .json(f"{path}/{phase}_column_profile")
        .withColumn("phase", F.lit(phase))
        for phase in ("pre", "post")
    ]
    found = pin(
        both[0].unionByName(both[1]).select(
            "phase",
            "column_name",
            "null_count",
            "distinct_count",
            F.posexplode_outer("top_values").alias("pos", "top"),
        )
    )
    discard(spark, path)
    return found.select(
        "phase",
        "column_name",
        "null_count",
        "distinct_count",
        (F.col("pos") + 1).alias("rank"),
        "top.value",
        "top.count",
    )


@query(
    "domain_reports_roundtrip",
    f"""WITH {DIRTY_EVENTS}
    SELECT 'counts_by_event_type' AS report, event_type AS key, count(*) AS count,
      CAST(NULL AS DOUBLE) AS average FROM dirty GROUP BY event_type
    UNION ALL (SELECT 'top_event_type', event_type, count(*), NULL FROM dirty
      WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 10)
    UNION ALL SELECT 'totals', NULL, CAST(sum(user_id) AS BIGINT), round(avg(value), 4) FROM dirty
    UNION ALL SELECT 'hours_of_clock',
      CAST(TRY_CAST(split_part(clock, ':', 1) AS INTEGER) AS VARCHAR), count(*), NULL
      FROM dirty GROUP BY 2""",
)
def domain_reports_roundtrip(spark, folder):
    """The set of summary reports written as JSON and read back."""
    reports = domain_reports(
        dirty_events(spark, folder), "event_type", ["event_type"], ["user_id"], ["value"], "clock"
    )
    path = work_path(spark, "domain-reports")
    write_reports(reports, path)
    columns = {
        "counts_by_event_type": ("event_type", "count", None),
        "top_event_type": ("event_type", "count", None),
        "totals": (None, "total_user_id", "avg_value"),
        "hours_of_clock": ("hour", "count", None),
    }
    parts = []
    for name, (key, count, average) in columns.items():
        frame = spark.read.schema(reports[name].schema).json(f"{path}/{name}")
        parts.append(
            frame.select(
                F.lit(name).alias("report"),
                (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
                F.col(count).cast("long").alias("count"),
                (F.col(average) if average else F.lit(None)).cast("double").alias("average"),
            )
        )
    found = pin(reduce(DataFrame.unionByName, parts))
    discard(spark, path)
    return found
