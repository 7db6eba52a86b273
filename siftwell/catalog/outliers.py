"""Queries over outlier fences and actions."""

from pyspark.sql import functions as F

from siftwell.catalog.inputs import DIRTY_EVENTS, DIRTY_ORDERS, dirty_events, dirty_orders, table
from siftwell.catalog.registry import query
from siftwell.functions.columns import one_row_per_column
from siftwell.operators.outliers import OutlierDetector

LINE_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _iqr_sql(column, source):
    """Fence CTE ``fence(lower_bound, upper_bound)``."""
    return f"""fence AS (
      SELECT q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
      FROM (SELECT CAST(quantile_disc({column}, 0.25) AS DOUBLE) AS q1,
              CAST(quantile_disc({column}, 0.75) AS DOUBLE) AS q3 FROM {source}))"""


ZSCORE_FENCE = """fence AS (
      SELECT avg(o_totalprice) - 3.0 * stddev_samp(o_totalprice) AS lower_bound,
        avg(o_totalprice) + 3.0 * stddev_samp(o_totalprice) AS upper_bound FROM dirty)"""

IQR_EVENTS = f"WITH {DIRTY_EVENTS}, {_iqr_sql('value', 'dirty')}"
ZSCORE_ORDERS = f"WITH {DIRTY_ORDERS}, {ZSCORE_FENCE}"


def _iqr(action, columns=("value",), **settings):
    return OutlierDetector(columns, "iqr", action, relative_error=0.0, **settings)


def _zscore(action, **settings):
    return OutlierDetector(["o_totalprice"], "zscore", action, **settings)


@query(
    "outlier_iqr_bounds",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'iqr' AS method, lower_bound, upper_bound, "
        f"lower_bound = upper_bound AS degenerate, 'checked' AS status "
        f"FROM (WITH {_iqr_sql(c, 'lineitem')} SELECT * FROM fence)"
        for c in LINE_NUMBERS
    ),
)
def outlier_iqr_bounds(spark, folder):
    lines = table(spark, folder, "lineitem")
    return _iqr("flag", LINE_NUMBERS).fit(lines).bounds(spark)


@query(
    "outlier_iqr_summary",
    f"""WITH {DIRTY_ORDERS}, {_iqr_sql("o_totalprice", "dirty")}
    SELECT 'o_totalprice' AS column_name, 'iqr' AS method, 'flag' AS action,
      (SELECT round(lower_bound, 4) FROM fence) AS lower_bound,
      (SELECT round(upper_bound, 4) FROM fence) AS upper_bound,
      count(*) FILTER (o_totalprice < (SELECT lower_bound FROM fence)
        OR o_totalprice > (SELECT upper_bound FROM fence)) AS outlier_count,
      false AS degenerate, 'checked' AS status FROM dirty
    UNION ALL SELECT 'o_orderstatus', 'iqr', 'flag', NULL, NULL, NULL, false,
      'skipped: not numeric'""",
)
def outlier_iqr_summary(spark, folder):
    dirty = dirty_orders(spark, folder)
    columns = ["o_totalprice", "o_orderstatus", "absent"]
    return _iqr("flag", columns).fit(dirty).summary(dirty)


@query(
    "outlier_iqr_flag",
    f"""{IQR_EVENTS} SELECT dirty.*,
      value < (SELECT lower_bound FROM fence) OR value > (SELECT upper_bound FROM fence)
        AS value_is_outlier
    FROM dirty""",
)
def outlier_iqr_flag(spark, folder):
    return _iqr("flag").fit_transform(dirty_events(spark, folder))


@query(
    "outlier_iqr_cap",
    f"""{IQR_EVENTS} SELECT dirty.* REPLACE (
      CASE WHEN value < (SELECT lower_bound FROM fence) THEN (SELECT lower_bound FROM fence)
           WHEN value > (SELECT upper_bound FROM fence) THEN (SELECT upper_bound FROM fence)
           ELSE value END AS value)
    FROM dirty""",
)
def outlier_iqr_cap(spark, folder):
    return _iqr("cap").fit_transform(dirty_events(spark, folder))


@query(
    "outlier_iqr_remove",
    f"""{IQR_EVENTS} SELECT * FROM dirty
    WHERE value >= (SELECT lower_bound FROM fence) AND value <= (SELECT upper_bound FROM fence)""",
)
def outlier_iqr_remove(spark, folder):
    return _iqr("remove").fit_transform(dirty_events(spark, folder))


@query(
    "outlier_iqr_remove_keep_nulls",
    f"""{IQR_EVENTS} SELECT * FROM dirty WHERE value IS NULL OR
      (value >= (SELECT lower_bound FROM fence) AND value <= (SELECT upper_bound FROM fence))""",
)
def outlier_iqr_remove_keep_nulls(spark, folder):
    return _iqr("remove", keep_nulls=True).fit_transform(dirty_events(spark, folder))


@query(
    "outlier_iqr_sketched",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS value_count, true AS q1_within, "
        "true AS q3_within FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def outlier_iqr_sketched(spark, folder):
    """Default error 0.01: the ranks of the sketched quartiles must be within it."""
    lines = table(spark, folder, "lineitem")
    model = OutlierDetector(LINE_NUMBERS).fit(lines)
    records = []
    for fence in model.fences:
        # Undo lower = q1 - 1.5 r, upper = q3 + 1.5 r with r = q3 - q1.
        reach = (fence.upper - fence.lower) / 4
        q1, q3 = fence.lower + 1.5 * reach, fence.upper - 1.5 * reach
        c, slack = fence.column, 1e-6
        share = lambda test: f"count_if({c} {test}D) / count({c})"
        within = lambda q, p: (
            f"{share(f'< {q - slack!r}')} <= {p + 0.01} "
            f"AND {share(f'<= {q + slack!r}')} >= {p - 0.01}"
        )
        records.append(
            f"struct('{c}' AS column_name, count({c}) AS value_count, "
            f"{within(q1, 0.25)} AS q1_within, {within(q3, 0.75)} AS q3_within)"
        )
    return one_row_per_column(lines, records)


@query(
    "outlier_zscore_bounds",
    f"""{ZSCORE_ORDERS} SELECT 'o_totalprice' AS column_name, 'zscore' AS method,
      round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound,
      false AS degenerate, 'checked' AS status FROM fence""",
)
def outlier_zscore_bounds(spark, folder):
    bounds = _zscore("flag").fit(dirty_orders(spark, folder)).bounds(spark)
    return bounds.withColumns({c: F.round(c, 4) for c in ("lower_bound", "upper_bound")})


@query(
    "outlier_zscore_summary",
    f"""{ZSCORE_ORDERS} SELECT 'o_totalprice' AS column_name, 'zscore' AS method,
      'remove' AS action,
      (SELECT round(lower_bound, 4) FROM fence) AS lower_bound,
      (SELECT round(upper_bound, 4) FROM fence) AS upper_bound,
      count(*) FILTER (o_totalprice < (SELECT lower_bound FROM fence)
        OR o_totalprice > (SELECT upper_bound FROM fence)) AS outlier_count,
      false AS degenerate, 'checked' AS status FROM dirty""",
)
def outlier_zscore_summary(spark, folder):
    dirty = dirty_orders(spark, folder)
    return _zscore("remove").fit(dirty).summary(dirty)


@query(
    "outlier_zscore_flag",
    f"""{ZSCORE_ORDERS} SELECT dirty.*,
      o_totalprice < (SELECT lower_bound FROM fence)
        OR o_totalprice > (SELECT upper_bound FROM fence) AS o_totalprice_is_outlier
    FROM dirty""",
)
def outlier_zscore_flag(spark, folder):
    return _zscore("flag").fit_transform(dirty_orders(spark, folder))


@query(
    "outlier_zscore_cap",
    f"""{ZSCORE_ORDERS} SELECT dirty.* REPLACE (round(
      CASE WHEN o_totalprice < (SELECT lower_bound FROM fence)
             THEN (SELECT lower_bound FROM fence)
           WHEN o_totalprice > (SELECT upper_bound FROM fence)
             THEN (SELECT upper_bound FROM fence)
           ELSE o_totalprice END, 4) AS o_totalprice)
    FROM dirty""",
)
def outlier_zscore_cap(spark, folder):
    capped = _zscore("cap").fit_transform(dirty_orders(spark, folder))
    return capped.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "outlier_zscore_remove",
    f"""{ZSCORE_ORDERS} SELECT * FROM dirty
    WHERE o_totalprice >= (SELECT lower_bound FROM fence)
      AND o_totalprice <= (SELECT upper_bound FROM fence)""",
)
def outlier_zscore_remove(spark, folder):
    return _zscore("remove").fit_transform(dirty_orders(spark, folder))


@query(
    "outlier_rows_removed",
    f"""{ZSCORE_ORDERS},
    kept AS (SELECT count(*) AS n FROM dirty
      WHERE o_totalprice >= (SELECT lower_bound FROM fence)
        AND o_totalprice <= (SELECT upper_bound FROM fence))
    SELECT count(*) AS rows_before, (SELECT n FROM kept) AS rows_after,
      count(*) - (SELECT n FROM kept) AS rows_removed FROM dirty""",
)
def outlier_rows_removed(spark, folder):
    dirty = dirty_orders(spark, folder)
    return _zscore("remove").fit(dirty).removal_counts(dirty)


@query(
    "outlier_small_error",
    """SELECT 'l_extendedprice' AS column_name,
      q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
    FROM (SELECT quantile_disc(l_extendedprice, 0.25) AS q1,
      quantile_disc(l_extendedprice, 0.75) AS q3 FROM lineitem)""",
)
def outlier_small_error(spark, folder):
    """An error that no sketch reaches is answered exactly."""
    lines = table(spark, folder, "lineitem")
    model = OutlierDetector(["l_extendedprice"], relative_error=1e-6).fit(lines)
    return model.bounds(spark).select("column_name", "lower_bound", "upper_bound")
