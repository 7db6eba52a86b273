"""Profile, clean, treat outliers and profile again.

The number of passes over the data does not depend on the number of columns. The raw table is read
three times:

1. one aggregate: profile statistics, null counts that remain after marker normalisation, the
   sketches for the medians that imputation needs and, where they are estimated, for distinct
   counts;
2. one frequency table: distinct counts, top values, and the modes for imputation (ranked apart
   from the null markers); integers that are not ranked are counted by words of bits, which reads
   their columns apart;
3. the cleaned table is written to the shared folder (the deduplication shuffle happens here, and
   the rows that enter it are counted on the way).

So is the cleaned one:

4. one set of sketches, or one aggregate, for the outlier fences;
5. one aggregate: outlier and removal counts, remaining nulls, and the statistics of the result;
6. one frequency table over the result, as in 2.

Exact quantiles (``relative_error=0``) add a check and a ranking to passes 1 and 4; dropped sparse
rows, after which medians and modes must be taken, add a count of nulls, sketches and frequencies;
estimated distinct counts add their sketches to pass 6.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import is_float, is_numeric, one_row_per_column, pin, sql_name
from siftwell.functions.frequency import (
    KEYS,
    counts_by_words,
    decode_row,
    distinct_counts,
    top_values,
    value_frequencies,
    value_text,
    with_full_texts,
    word_counts,
)
from siftwell.functions.quantiles import sketched_ranks
from siftwell.operators.cleaning import CleaningModel
from siftwell.operators.contract import Contract, validate
from siftwell.operators.impute import Imputer
from siftwell.operators.nulls import (
    DEFAULT_NULL_MARKERS,
    markers_for,
    percent,
    without_markers,
)
from siftwell.operators.outliers import OutlierModel
from siftwell.operators.profile import (
    TOP_VALUES,
    ProfileResult,
    build_columns,
    column_stats,
    pinned_profile,
    profile,
    stats_record,
    top_value_rows,
)
from siftwell.operators.states import as_stats, column_states, merged, sketched_quantiles
from siftwell.plans.config import RunConfig
from siftwell.sources.sinks import write_reports
from siftwell.sources.workspace import discard, materialize


@dataclass(frozen=True)
class QualityRunModel:
    """A fitted run. ``transform`` applies the learned steps to any table of the same schema.

    ``cleaned`` is the cleaned input table and ``result`` the same after outlier treatment;
    ``reports`` maps report names to small frames.
    """

    config: RunConfig
    cleaning: CleaningModel
    outliers: OutlierModel
    before: ProfileResult
    after: ProfileResult
    cleaned: DataFrame
    result: DataFrame
    reports: Mapping[str, DataFrame]
    work_table: str | None
    seconds: float

    def transform(self, df: DataFrame) -> DataFrame:
        return self.outliers.transform(self.cleaning.transform(df))

    def full_report(self) -> dict[str, Any]:
        """All reports as one nested, JSON-ready dictionary of four phases and the duration."""
        rows = {name: _plain(report) for name, report in self.reports.items()}
        cleaning = rows["cleaning_summary"][0]
        fences = rows["outlier_summary"]
        # The keys of the report.
        return {
            "pre_clean_profile": _profile_dict(rows, "pre"),
            "missing_duplicates": {
                **cleaning,
                "null_counts_before": _null_dict(rows["null_audit_before"]),
                "null_counts_after": _null_dict(rows["null_audit_after"]),
                "imputation_plan": rows["imputation_plan"],
            },
            "outlier_detection": {
                "method": self.outliers.method,
                "action": self.outliers.action,
                "columns_checked": [f["column_name"] for f in fences],
                "outlier_summary": {
                    f["column_name"]: {
                        k: f[k] for k in ("lower_bound", "upper_bound", "outlier_count")
                    }
                    for f in fences
                    if f["outlier_count"] is not None
                },
                "rows_removed": rows["run_summary"][0]["outlier_rows_removed"],
            },
            "post_clean_profile": _profile_dict(rows, "post"),
            "pipeline_duration_seconds": round(self.seconds, 2),
        }

    def write_reports(self, path: str) -> None:
        write_reports(self.reports, path)

    def release(self) -> None:
        """Delete the work table; ``cleaned`` and ``result`` cannot be read afterwards."""
        if self.work_table:
            discard(self.cleaned.sparkSession, self.work_table)

    def __enter__(self) -> QualityRunModel:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()


@dataclass(frozen=True)
class QualityRun:
    """The full sequence: profile with contract, clean, treat outliers, profile."""

    config: RunConfig = field(default_factory=RunConfig)

    @staticmethod
    def from_dict(settings: Mapping[str, Any]) -> QualityRun:
        return QualityRun(RunConfig.from_dict(settings))

    def fit(self, df: DataFrame) -> QualityRunModel:
        started = time.monotonic()
        config = self.config
        cleaner, detector = config.cleaner(), config.detector()

        stats = self._stats(df)
        before, modes = self._profile_before(df, stats)
        counted = stats.collect()
        cleaning = cleaner.fit(
            df,
            null_counts={r["column_name"]: r["row_count"] - r["usable_count"] for r in counted},
            row_count=counted[0]["row_count"],
            modes=modes,
            sketched=self._sketched(counted),
        )

        seen = Observation() if config.materialize else None
        cleaned, work_table = cleaning.transform(df, seen), None
        if config.materialize:
            cleaned, work_table = materialize(cleaned, "cleaned")
        try:
            outliers = detector.fit(cleaned)
            result = outliers.transform(cleaned)
            counts = self._counts_after(cleaned, result, outliers)
            after = self._profile_after(result, counts)
            rows_in = seen.get["row_count"] if seen else cleaning.prepared(df).count()
            reports = self._reports(df, stats, cleaning, rows_in, outliers, counts, before, after)
            for phase, folder in (
                ("pre", config.pre_profile_output),
                ("post", config.post_profile_output),
            ):
                if folder:
                    own = {n: r for n, r in reports.items() if n.startswith(phase + "_")}
                    write_reports(own, folder)
        except BaseException:
            if work_table:
                discard(df.sparkSession, work_table)
            raise
        return QualityRunModel(
            config, cleaning, outliers, before, after, cleaned, result, reports, work_table,
            time.monotonic() - started,
        )

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).result

    def _markers(self) -> list[str]:
        given = self.config.null_representations
        return list(DEFAULT_NULL_MARKERS if given is None else given)

    def _stats(self, df: DataFrame) -> DataFrame:
        """Pass 1, one row per column; with sketched quantiles and estimated distinct counts."""
        usable = {
            f.name: without_markers(f, self._markers(), self.config.nan_is_null)
            for f in df.schema.fields
        }
        strategy = Imputer(self.config.imputation_strategies).strategy_of(df)
        medians = {
            f.name for f in df.schema.fields if is_numeric(f.dataType) and strategy[f.name] == "median"
        }
        if self.config.drop_row_threshold is not None:
            medians = set()
        rsd = self.config.approx_rsd if self.config.distinct == "approx" else None
        if not medians and rsd is None:
            return pin(column_stats(df, usable))
        ranks, error = sketched_ranks([0.5], self.config.relative_error)
        states = merged(column_states(df, usable, medians, error, rsd), df.schema.fields, error, rsd)
        estimated = F.expr("hll_sketch_estimate(hll)") if rsd else F.lit(None).cast("bigint")
        found = states.select("*", estimated.alias("distinct_count"), *sketched_quantiles(ranks))
        sketched = F.col("column_name").isin(list(medians)).alias("sketched")
        extra = ("distinct_count", "whole_q", "real_q", sketched)
        return pin(as_stats(found, *extra))

    @staticmethod
    def _sketched(stats: list[Row]) -> dict[str, list]:
        """What the sketches of pass 1 gave, by column."""
        if not stats or "sketched" not in stats[0]:
            return {}
        return {r["column_name"]: r["whole_q"] or r["real_q"] or [] for r in stats if r["sketched"]}

    def _is_missing(self, fields: list[T.StructField]) -> Column:
        """Whether a frequency row's value counts as missing once markers are normalised."""
        by_hits: dict[tuple[str, ...], list[int]] = {}
        for i, f in enumerate(fields):
            hits = tuple(markers_for(f.dataType, self._markers()))
            if hits:
                by_hits.setdefault(hits, []).append(i)
        missing = F.lit(False)
        for hits, ids in by_hits.items():
            missing = missing | (F.col("col_id").isin(ids) & value_text(fields).isin(list(hits)))
        if self.config.nan_is_null:
            floats = [i for i, f in enumerate(fields) if is_float(f.dataType)]
            missing = missing | (F.col("col_id").isin(floats) & F.isnan("real"))
        return F.coalesce(missing, F.lit(False))

    def _profile_before(
        self, df: DataFrame, stats: DataFrame
    ) -> tuple[ProfileResult, dict[str, Column | None]]:
        """Pass 2: the raw profile and the modes of the normalised columns."""
        fields = df.schema.fields
        other = [i for i, f in enumerate(fields) if not is_numeric(f.dataType)]
        wanted = sorted(set(other) | self._numeric_modes(df))
        # With estimated distinct counts, only columns whose values are ranked are shuffled.
        approx = self.config.distinct == "approx"
        by_words = [i for i, f in enumerate(fields) if counts_by_words(f) and i not in wanted]
        counted = wanted if approx else [i for i in range(len(fields)) if i not in by_words]
        freq = value_frequencies(df, fields, counted)
        ranked = top_values(
            freq.withColumn("missing", self._is_missing(fields)), TOP_VALUES, wanted, ["missing"]
        )
        ranked = with_full_texts(ranked, df, fields)
        counts = stats if approx else distinct_counts(freq)
        if by_words and not approx:
            counts = counts.unionByName(word_counts(df, fields, by_words))
        found = pin(
            ranked.select(*KEYS, "freq", "missing", "rank", F.lit(None).cast("bigint").alias("distinct_count"))
            .unionByName(counts.select("col_id", "distinct_count"), allowMissingColumns=True)
        )
        distinct = found.where(F.col("distinct_count").isNotNull())
        values = found.where(F.col("distinct_count").isNull())

        modes: dict[str, Column | None] = {fields[i].name: None for i in wanted}
        for row in values.where(~F.col("missing") & (F.col("rank") == 1)).collect():
            f = fields[row["col_id"]]
            modes[f.name] = decode_row(row, f.dataType)

        top = top_value_rows(top_values(values.drop("rank"), TOP_VALUES, other), fields)
        contract = Contract.of(self.config.expected_schema)
        nulls = {r["column_name"]: r["null_count"] for r in stats.collect()}
        issues = validate(df, contract, nulls)
        columns = pin(build_columns(stats.drop("distinct_count"), distinct, top))
        return pinned_profile(columns, issues, self.config.uniqueness), modes

    def _counts_after(self, cleaned: DataFrame, result: DataFrame, outliers: OutlierModel) -> DataFrame:
        """Pass 5: statistics of the result, outlier counts, and nulls and rows before removals."""
        fields = {f.name: f for f in result.schema.fields}
        own = set(cleaned.columns)
        removes = outliers.action == "remove"
        rows = f"count_if({outliers.kept_sql})" if removes else "count(*)"
        records = []
        for i, (name, value, test) in enumerate(outliers.outcome(cleaned)):
            nulls = f"count(*) - count({sql_name(name)})" if name in own else "CAST(NULL AS BIGINT)"
            more = [
                f"{f'count_if({test})' if test else 'CAST(NULL AS BIGINT)'} AS outlier_count",
                f"{nulls} AS nulls_before",
                "count(*) AS rows_before",
            ]
            records.append(stats_record(i, fields[name], value, rows, more))
        return pin(one_row_per_column(cleaned, records))

    def _profile_after(self, result: DataFrame, counts: DataFrame) -> ProfileResult:
        found = profile(
            result,
            distinct=self.config.distinct,
            approx_rsd=self.config.approx_rsd,
            stats=counts.drop("outlier_count", "nulls_before", "rows_before"),
        )
        columns = pin(found.columns)
        contract = Contract.of(self.config.expected_schema if self.config.validate_after else None)
        nulls = {r["column_name"]: r["null_count"] for r in counts.collect()}
        return pinned_profile(columns, validate(result, contract, nulls), self.config.uniqueness)

    def _numeric_modes(self, df: DataFrame) -> set[int]:
        strategies = self.config.imputation_strategies
        named = {c for c, s in strategies.items() if s == "mode"}
        return {i for i, f in enumerate(df.schema.fields) if f.name in named and is_numeric(f.dataType)}

    def _reports(self, df, stats, cleaning, rows_in, outliers, counts, before, after):
        audit_before = stats.selectExpr(
            "column_name",
            "row_count - usable_count AS null_count",
            f"{percent('row_count - usable_count', 'row_count')} AS null_pct",
            "row_count",
        )
        audit_after = counts.where(F.col("nulls_before").isNotNull()).selectExpr(
            "column_name",
            "nulls_before AS null_count",
            f"{percent('nulls_before', 'rows_before')} AS null_pct",
            "rows_before AS row_count",
        )
        counted = counts.collect()
        rows_after = counted[0]["rows_before"] if counted else 0
        removed = rows_after - counted[0]["row_count"] if counted else 0
        found = {r["column_name"]: r["outlier_count"] for r in counted if r["outlier_count"] is not None}

        # One local row to select literals from, without a job.
        one = df.sparkSession.sql("VALUES (0)")
        long = lambda n, name: F.lit(n).cast("bigint").alias(name)
        summary = cleaning.summary(
            df, one.select(long(rows_in, "row_count"), long(rows_after, "distinct_count"))
        )
        pre_score, post_score = pin(before.score), pin(after.score)
        run_summary = summary.select(
            "*",
            long(removed, "outlier_rows_removed"),
            F.lit(pre_score.first()["quality_score"]).alias("quality_score_before"),
            F.lit(post_score.first()["quality_score"]).alias("quality_score_after"),
            F.lit(outliers.method).alias("outlier_method"),
            F.lit(outliers.action).alias("outlier_action"),
        )
        return {
            "pre_column_profile": before.columns,
            "pre_schema_issues": before.issues,
            "pre_quality_score": pre_score,
            "null_audit_before": audit_before,
            "imputation_plan": cleaning.imputation_plan(df),
            "cleaning_summary": summary,
            "null_audit_after": audit_after,
            "outlier_summary": pin(outliers.counted_summary(df.sparkSession, found)),
            "post_column_profile": after.columns,
            "post_schema_issues": after.issues,
            "post_quality_score": post_score,
            "run_summary": run_summary,
        }


def _plain(report: DataFrame) -> list[dict[str, Any]]:
    return [r.asDict(recursive=True) for r in report.collect()]


def _null_dict(rows: list[dict[str, Any]]) -> dict[str, Any]:
    return {r["column_name"]: {"count": r["null_count"], "pct": r["null_pct"]} for r in rows}


def _profile_dict(rows: Mapping[str, list[dict[str, Any]]], phase: str) -> dict[str, Any]:
    columns = sorted(rows[f"{phase}_column_profile"], key=lambda r: r["col_id"])
    skipped = ("col_id", "column_name", "row_count")
    return {
        "schema_issues": [r["message"] for r in rows[f"{phase}_schema_issues"]],
        "column_profiles": {
            r["column_name"]: {k: v for k, v in r.items() if k not in skipped} for r in columns
        },
        "quality_score": rows[f"{phase}_quality_score"][0]["quality_score"],
        "total_rows": columns[0]["row_count"] if columns else 0,
        "total_columns": len(columns),
    }
