"""Queries over schema checks, profiles, scores and summary reports."""

from pyspark.sql import functions as F

from siftwell.catalog.inputs import (
    DIRTY_EVENTS,
    DIRTY_ORDERS,
    dirty_events,
    dirty_orders,
    per_column_sql,
    table,
    wide_numbers,
)
from siftwell.catalog.registry import query
from siftwell.functions.columns import pin
from siftwell.functions.frequency import distinct_counts, value_frequencies
from siftwell.operators.analytics import group_counts, hour_histogram, top_k, totals
from siftwell.operators.contract import validate
from siftwell.operators.profile import profile
from siftwell.operators.states import column_states, profile_states
from siftwell.sources import discard, work_path, write_parquet

TYPES = {
    "o_orderkey": "LongType()",
    "o_custkey": "LongType()",
    "o_orderstatus": "StringType()",
    "o_totalprice": "DoubleType()",
    "o_orderpriority": "StringType()",
    "o_note": "StringType()",
    "o_orderdate": "TimestampNTZType()",
}
NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
OTHER = [c for c in TYPES if c not in NUMERIC]

# One fault of each kind: a missing column, two wrong types (one by class name, one by DDL),
# nulls where none are allowed, and columns the contract does not name.
CONTRACT = {
    "columns": {
        "o_orderkey": "LongType",
        "o_shipmode": "StringType",
        "o_custkey": "int",
        "o_totalprice": "StringType",
        "o_orderstatus": "string",
    },
    "nullable": {"o_orderkey": False, "o_orderstatus": False, "o_totalprice": False, "o_note": True},
}


def _issue_sql(seq, kind, column, expected, actual, message):
    text = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return (
        f"SELECT {seq} AS seq, '{kind}' AS kind, '{column}' AS column_name, "
        f"{text(expected)} AS expected, {text(actual)} AS actual, "
        f"CAST(NULL AS BIGINT) AS null_count, {text(message)} AS message"
    )


def _violation_sql(seq, column):
    return (
        f"SELECT {seq}, 'null_violation', '{column}', NULL, NULL, count(*) - count({column}), "
        f"'NON-NULLABLE VIOLATION ''{column}'': ' || format('{{:,}}', count(*) - count({column})) "
        "|| ' null values found' FROM dirty"
    )


ISSUES = " UNION ALL ".join(
    [
        _issue_sql(1, "missing", "o_shipmode", "StringType", None,
                   "MISSING column: 'o_shipmode' (expected type=StringType)"),
        _issue_sql(2, "type_mismatch", "o_custkey", "int", "LongType()",
                   "TYPE MISMATCH 'o_custkey': expected=int, got=LongType()"),
        _issue_sql(3, "type_mismatch", "o_totalprice", "StringType", "DoubleType()",
                   "TYPE MISMATCH 'o_totalprice': expected=StringType, got=DoubleType()"),
        _violation_sql(4, "o_orderstatus"),
        _violation_sql(5, "o_totalprice"),
    ]
    + [
        _issue_sql(6 + i, "unexpected", c, None, None,
                   f"UNEXPECTED column: '{c}' (not in expected schema)")
        for i, c in enumerate(["o_orderpriority", "o_note", "o_orderdate"])
    ]
)


@query("schema_issues", f"WITH {DIRTY_ORDERS} {ISSUES}")
def schema_issues(spark, folder):
    return validate(dirty_orders(spark, folder), CONTRACT)


@query(
    "schema_nonnull_violations",
    f"WITH {DIRTY_ORDERS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM dirty"
        for c in ["o_orderstatus", "o_totalprice"]
    ),
)
def schema_nonnull_violations(spark, folder):
    issues = validate(dirty_orders(spark, folder), {"nullable": CONTRACT["nullable"]})
    return issues.where(F.col("kind") == "null_violation").select("column_name", "null_count")


@query(
    "profile_table_shape",
    f"WITH {DIRTY_ORDERS} SELECT count(*) AS total_rows, {len(TYPES)} AS total_columns FROM dirty",
)
def profile_table_shape(spark, folder):
    return profile(dirty_orders(spark, folder)).shape


@query(
    "profile_completeness",
    f"WITH {DIRTY_ORDERS} "
    + per_column_sql(
        list(TYPES),
        "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        "round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        "round(100.0 * count({c}) / count(*), 2) AS completeness_pct FROM dirty",
    ),
)
def profile_completeness(spark, folder):
    columns = profile(dirty_orders(spark, folder)).columns
    return columns.select("column_name", "null_count", "null_pct", "completeness_pct")


@query(
    "profile_distinct",
    f"WITH {DIRTY_ORDERS} "
    + per_column_sql(
        list(TYPES),
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM dirty",
    ),
)
def profile_distinct(spark, folder):
    columns = profile(dirty_orders(spark, folder)).columns
    return columns.select("column_name", "distinct_count")


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "profile_distinct_approx",
    per_column_sql(
        LINE_COLUMNS,
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, "
        "true AS estimate_within_20_pct FROM lineitem",
    ),
)
def profile_distinct_approx(spark, folder):
    """HyperLogLog++ estimates beside exact counts; the estimates come from one aggregate."""
    lines = table(spark, folder, "lineitem")
    exact = pin(distinct_counts(value_frequencies(lines, lines.schema.fields)))
    estimates = profile(lines, distinct="approx", approx_rsd=0.02).columns
    error = F.abs(estimates["distinct_count"] / exact["distinct_count"] - 1)
    return estimates.join(F.broadcast(exact), "col_id").select(
        "column_name", exact["distinct_count"], (error <= 0.2).alias("estimate_within_20_pct")
    )


@query(
    "profile_numeric",
    f"WITH {DIRTY_ORDERS} "
    + per_column_sql(
        NUMERIC,
        "SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, "
        "CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS mean, "
        "round(stddev_samp({c}), 4) AS stddev FROM dirty",
    ),
)
def profile_numeric(spark, folder):
    columns = profile(dirty_orders(spark, folder)).columns
    numeric = columns.where(F.col("min").isNotNull())
    return numeric.select("column_name", "min", "max", "mean", "stddev")


def top_sql(column, source):
    return (
        f"SELECT * FROM (SELECT '{column}' AS column_name, "
        f"row_number() OVER (ORDER BY count(*) DESC, {column} ASC) AS rank, "
        f"CAST({column} AS VARCHAR) AS value, count(*) AS count FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}) WHERE rank <= 3"
    )


@query(
    "profile_top_values",
    f"WITH {DIRTY_ORDERS} " + " UNION ALL ".join(top_sql(c, "dirty") for c in OTHER),
)
def profile_top_values(spark, folder):
    return profile(dirty_orders(spark, folder)).top_values


@query(
    "profile_top_values_typed",
    f"WITH {DIRTY_EVENTS} "
    + " UNION ALL ".join(
        top_sql(c, "dirty") for c in ["event_type", "is_high", "event_date", "clock"]
    ),
)
def profile_top_values_typed(spark, folder):
    return profile(dirty_events(spark, folder)).top_values


@query(
    "profile_documents",
    per_column_sql(
        ["doc_id", "text", "lang", "source", "n_chars"],
        "SELECT '{c}' AS column_name, count(*) AS row_count, "
        "count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM documents",
    ),
)
def profile_documents(spark, folder):
    """Whole texts take part, of any length."""
    columns = profile(table(spark, folder, "documents")).columns
    return columns.select("column_name", "row_count", "null_count", "distinct_count")


def _numbers(column):
    if column not in NUMERIC:
        nothing = "CAST(NULL AS DOUBLE)"
        text = "CAST(NULL AS VARCHAR)"
        return (
            f"{nothing} AS min, {nothing} AS max, {text} AS min_text, {text} AS max_text, "
            f"{nothing} AS mean, {nothing} AS stddev"
        )
    text = lambda f: f"CAST({f}({column}) AS VARCHAR)"
    if TYPES[column] == "DoubleType()":
        text = lambda f: "CAST(NULL AS VARCHAR)"
    return (
        f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
        f"{text('min')} AS min_text, {text('max')} AS max_text, "
        f"round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS stddev"
    )


def profile_sql(source, types):
    return " UNION ALL ".join(
        f"SELECT {i} AS col_id, '{c}' AS column_name, '{t}' AS data_type, true AS nullable, "
        f"count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        f"count(DISTINCT {c}) AS distinct_count, "
        f"round(100.0 * count({c}) / count(*), 2) AS completeness_pct, {_numbers(c)} FROM {source}"
        for i, (c, t) in enumerate(types.items())
    )


PROFILE = profile_sql("dirty", TYPES)


@query("column_profile", f"WITH {DIRTY_ORDERS} {PROFILE}")
def column_profile(spark, folder):
    return profile(dirty_orders(spark, folder)).columns.drop("top_values")


@query(
    "column_profile_top_values",
    f"WITH {DIRTY_ORDERS} " + " UNION ALL ".join(top_sql(c, "dirty") for c in OTHER),
)
def column_profile_top_values(spark, folder):
    """The nested top values of the column profile, as rows."""
    columns = profile(dirty_orders(spark, folder)).columns
    rows = columns.select("column_name", F.posexplode("top_values").alias("pos", "top"))
    return rows.select("column_name", (F.col("pos") + 1).alias("rank"), "top.value", "top.count")


@query(
    "profile_states_merged",
    f"WITH {DIRTY_ORDERS} SELECT col_id, column_name, data_type, row_count, null_count, completeness_pct, "
    f"min, max, min_text, max_text, mean, stddev FROM ({PROFILE})",
)
def profile_states_merged(spark, folder):
    """States of two parts of a table, stored apart; together they are the profile of the whole."""
    orders = dirty_orders(spark, folder)
    paths = []
    for part in (0, 1):
        states = column_states(orders.where(F.col("o_orderkey") % 2 == part))
        paths.append(work_path(spark, "states"))
        write_parquet(states, paths[-1])
    rows = pin(profile_states(spark.read.parquet(*paths), orders.schema.fields))
    for path in paths:
        discard(spark, path)
    return rows.drop("distinct_count", "quantiles")


@query(
    "profile_integers_by_words",
    per_column_sql(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM lineitem",
    ),
)
def profile_integers_by_words(spark, folder):
    """Exact distinct counts of integers from words of bits."""
    lines = table(spark, folder, "lineitem")
    found = profile(lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")).columns
    return found.select("column_name", "distinct_count")


LINE_TOPS = ["l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "top_values_nominated",
    f"WITH {DIRTY_EVENTS} "
    + " UNION ALL ".join(top_sql(c, "dirty") for c in ["event_type", "is_high", "event_date", "clock"]),
)
def top_values_nominated(spark, folder):
    """Top values from nominated values that are counted exactly and certified."""
    return profile(dirty_events(spark, folder), distinct="approx", top="nominated").top_values


@query(
    "top_values_nominated_lines",
    " UNION ALL ".join(top_sql(c, "lineitem") for c in LINE_TOPS),
)
def top_values_nominated_lines(spark, folder):
    """Narrow columns are known whole; dates of similar counts are counted as ever."""
    return profile(table(spark, folder, "lineitem"), distinct="approx", top="nominated").top_values


@query(
    "top_values_nominated_unique",
    " UNION ALL ".join(top_sql(c, "customer") for c in ["c_name", "c_mktsegment"]),
)
def top_values_nominated_unique(spark, folder):
    """Names occur once each: no shuffle carries them, and the least are the top values."""
    return profile(table(spark, folder, "customer"), distinct="approx", top="nominated").top_values


LOCATED = """WITH located AS (
  SELECT source || '/' || doc_id AS locator, lang, source, left(text, 24) AS opening, n_chars FROM documents)
"""


@query(
    "top_values_nominated_documents",
    LOCATED + " UNION ALL ".join(top_sql(c, "located") for c in ["locator", "lang", "source", "opening"]),
)
def top_values_nominated_documents(spark, folder):
    """A unique column, two narrow ones, and the openings of texts, of which many repeat."""
    located = table(spark, folder, "documents").select(
        F.concat("source", F.lit("/"), "doc_id").alias("locator"),
        "lang",
        "source",
        F.substring("text", 1, 24).alias("opening"),
        "n_chars",
    )
    return profile(located, distinct="approx", top="nominated").top_values


@query(
    "profile_distinct_nominated",
    per_column_sql(
        ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM customer",
    ),
)
def profile_distinct_nominated(spark, folder):
    """Exact distinct counts, of which certified and unique columns are known from the top values."""
    columns = profile(table(spark, folder, "customer"), top="nominated").columns
    return columns.select("column_name", "distinct_count")


TEXT_KEY = "CASE WHEN strlen({c}) > 120 THEN left({c}, 64) || sha256({c}) ELSE {c} END"


@query(
    "profile_documents_top_values",
    per_column_sql(
        ["text", "lang", "source"],
        "SELECT * FROM (SELECT '{c}' AS column_name, row_number() OVER (ORDER BY count(*) DESC, "
        f"{TEXT_KEY}) AS rank, {{c}} AS value, count(*) AS count FROM documents "
        "WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= 3",
    ),
)
def profile_documents_top_values(spark, folder):
    """Whole texts among the top values; ties of long ones go by their start, then digest."""
    return profile(table(spark, folder, "documents")).top_values


LONG = """WITH long AS (
  SELECT repeat('A common header. ', CAST(5 + doc_id % 3 * 40 AS INT)) || text AS noted, source FROM documents)
"""


@query(
    "top_values_of_long_ties",
    LONG + " UNION ALL ".join(top_sql(c, "long") for c in ["noted", "source"]),
)
def top_values_of_long_ties(spark, folder):
    """Texts that differ after hundreds of characters, ordered by value all the same."""
    header = F.expr("repeat('A common header. ', CAST(5 + doc_id % 3 * 40 AS INT))")
    noted = table(spark, folder, "documents").select(F.concat(header, "text").alias("noted"), "source")
    return profile(noted, long_ties="value").top_values


@query(
    "profile_documents_top_values_by_value",
    " UNION ALL ".join(top_sql(c, "documents") for c in ["text", "lang", "source"]),
)
def profile_documents_top_values_by_value(spark, folder):
    return profile(table(spark, folder, "documents"), long_ties="value").top_values


@query(
    "profile_nested",
    """WITH nested AS (
      SELECT [ts, ts + to_microseconds(event_id % 3)] AS times,
        {'at': ts + to_microseconds(event_id % 2), 'kind': event_type} AS what,
        [CASE WHEN event_id % 2 = 0 THEN 0.0::DOUBLE ELSE value END] AS numbers
      FROM events)
    SELECT 'embedding' AS column_name, count(DISTINCT embedding) AS distinct_count FROM embeddings
    UNION ALL SELECT 'times', count(DISTINCT times) FROM nested
    UNION ALL SELECT 'what', count(DISTINCT what) FROM nested
    UNION ALL SELECT 'numbers', count(DISTINCT numbers) FROM nested""",
)
def profile_nested(spark, folder):
    """Arrays and structs, with times a microsecond apart and zeros of either sign."""
    zero = F.when(F.col("event_id") % 4 == 0, F.lit(-0.0)).otherwise(F.lit(0.0))
    nested = table(spark, folder, "events").select(
        F.expr("array(ts, timestampadd(MICROSECOND, event_id % 3, ts))").alias("times"),
        F.struct(
            F.expr("timestampadd(MICROSECOND, event_id % 2, ts)").alias("at"),
            F.col("event_type").alias("kind"),
        ).alias("what"),
        F.array(F.when(F.col("event_id") % 2 == 0, zero).otherwise(F.col("value"))).alias("numbers"),
    )
    vectors = table(spark, folder, "embeddings").select("embedding")
    found = [profile(frame).columns for frame in (vectors, nested)]
    return found[0].unionByName(found[1]).select("column_name", "distinct_count")


@query(
    "profile_wide_numbers",
    """WITH wide AS (
      SELECT o_orderkey + 1152921504606846976 AS big, CAST(o_orderkey AS DECIMAL(38, 2))
        + CAST('12345678901234567890.12' AS DECIMAL(38, 2)) AS amount FROM orders)
    SELECT 'big' AS column_name, CAST(min(big) AS VARCHAR) AS min_text,
      CAST(max(big) AS VARCHAR) AS max_text FROM wide
    UNION ALL SELECT 'amount', CAST(min(amount) AS VARCHAR), CAST(max(amount) AS VARCHAR) FROM wide""",
)
def profile_wide_numbers(spark, folder):
    """Range of integers and decimals beyond the precision of doubles."""
    columns = profile(wide_numbers(spark, folder).drop("o_orderkey")).columns
    return columns.select("column_name", "min_text", "max_text")


def _score_sql(unique):
    return f"""WITH {DIRTY_ORDERS}, profile AS ({PROFILE}), issues AS ({ISSUES}),
    parts AS (
      SELECT avg(completeness_pct) * 0.5 AS completeness_score,
        avg(CASE WHEN {unique} THEN 1 ELSE 0 END) * 20 AS uniqueness_score,
        CAST(30 - least(2 * (SELECT count(*) FROM issues), 30) AS DOUBLE) AS validity_score
      FROM profile)
    SELECT round(completeness_score, 4) AS completeness_score,
      round(uniqueness_score, 4) AS uniqueness_score, validity_score,
      round(completeness_score + uniqueness_score + validity_score, 2) AS quality_score
    FROM parts"""


def _score(spark, folder, uniqueness):
    score = profile(dirty_orders(spark, folder), CONTRACT, uniqueness=uniqueness).score
    return score.withColumns(
        {c: F.round(c, 4) for c in ("completeness_score", "uniqueness_score")}
    )


@query("quality_score", _score_sql("distinct_count >= 1"))
def quality_score_query(spark, folder):
    return _score(spark, folder, "nonempty")


@query("quality_score_ratio", _score_sql("distinct_count / row_count > 0.90"))
def quality_score_ratio(spark, folder):
    return _score(spark, folder, "ratio")


@query(
    "group_count_desc",
    "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority",
)
def group_count_desc(spark, folder):
    return group_counts(table(spark, folder, "orders"), "o_orderpriority")


@query(
    "top_k_categories",
    f"""WITH {DIRTY_ORDERS} SELECT o_orderpriority, count(*) AS count FROM dirty
    WHERE o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority LIMIT 10""",
)
def top_k_categories(spark, folder):
    return top_k(dirty_orders(spark, folder), "o_orderpriority", 10)


@query(
    "top_k_types",
    """SELECT p_type, count(*) AS count FROM part WHERE p_type IS NOT NULL
    GROUP BY p_type ORDER BY count DESC, p_type LIMIT 10""",
)
def top_k_types(spark, folder):
    return top_k(table(spark, folder, "part"), "p_type", 10)


@query(
    "top_k_customers",
    """SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL
    GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 10""",
)
def top_k_customers(spark, folder):
    return top_k(table(spark, folder, "orders"), "o_custkey", 10)


@query(
    "severity_summary",
    """SELECT coalesce(CAST(sum(l_linenumber) AS BIGINT), 0) AS total_l_linenumber,
      coalesce(sum(l_quantity), 0) AS total_l_quantity,
      coalesce(round(avg(l_extendedprice), 4), 0) AS avg_l_extendedprice FROM lineitem""",
)
def severity_summary(spark, folder):
    lines = table(spark, folder, "lineitem")
    return totals(lines, ["l_linenumber", "l_quantity"], ["l_extendedprice"])


@query(
    "hour_histogram",
    f"""WITH {DIRTY_EVENTS}
    SELECT TRY_CAST(split_part(clock, ':', 1) AS INTEGER) AS hour, count(*) AS count
    FROM dirty GROUP BY 1""",
)
def hour_histogram_query(spark, folder):
    return hour_histogram(dirty_events(spark, folder), "clock")
