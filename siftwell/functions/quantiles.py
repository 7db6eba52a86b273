"""Quantiles of many columns, approximate or exact, without gathering a column anywhere.

Approximate: one KLL sketch per column and task, merged in two levels so that no single task
has to merge the sketches of all tasks.

Exact (``relative_error=0``): sketches only *propose* a bracket around the wanted rank. Exact
counts then decide whether an end of the bracket is the answer or how many rows lie strictly
inside. While too many do, the bracket is sketched again; a frequent value becomes a bracket
end and drops out. What remains is a bounded slice that a window can rank. Values are compared
in their own type, so integers and decimals beyond the precision of doubles keep all digits.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import (
    COLUMNS_PER_PASS,
    col,
    merge_group,
    sql_double,
    sql_name,
    stacked_sketches,
)

Number = int | float | decimal.Decimal

# Rows strictly inside a bracket that one ranking task may hold.
RANKABLE_ROWS = 1_000_000
# Brackets checked per aggregate, with five counts each.
SEARCHES_PER_PASS = 100
# Share of ranks that a bracket spans on each side of the wanted one. Its sketch is four times as
# fine with 99 % confidence, and wrong brackets are found by the exact counts.
BRACKET_MARGIN = 0.004
# Largest parameter that KLL sketches take.
LARGEST_SKETCH = 65535


def sketch_size(relative_error: float) -> int | None:
    """KLL ``k`` whose 99 % rank error is a quarter of ``relative_error`` (about 2.3 / k^0.97).

    None if no sketch is that fine, which is below an error of about 0.0002.
    """
    k = max(200, math.ceil((2.3 / (relative_error / 4)) ** (1 / 0.97)))
    return k if k <= LARGEST_SKETCH else None


def is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def sql_number(value: Number | None, dtype: T.DataType) -> str:
    """SQL literal of a value in the type it is compared in."""
    if is_whole(dtype):
        # The lowest long has no literal of its own.
        return f"CAST('{value}' AS BIGINT)"
    if isinstance(dtype, T.DecimalType):
        return f"CAST('{value}' AS {dtype.simpleString()})"
    return sql_double(value)


def ranked_value(name: str, dtype: T.DataType) -> str:
    """SQL of a column in the type it is compared in, with NaN as null: neither takes a rank."""
    if is_whole(dtype):
        return f"CAST({sql_name(name)} AS BIGINT)"
    if isinstance(dtype, T.DecimalType):
        return sql_name(name)
    value = f"CAST({sql_name(name)} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def _sketch(
    df: DataFrame,
    values: Sequence[str],
    whole: Sequence[bool],
    ranks: Sequence[Sequence[float]],
    error: float,
) -> list[list[Number]]:
    """Approximate quantiles of SQL expressions: one list per expression, empty if all null.

    ``whole`` says which expressions are integers; these have sketches of integers.
    """
    out: list[list[Number]] = []
    k = sketch_size(error)
    for start in range(0, len(values), COLUMNS_PER_PASS):
        chunk = range(start, min(start + COLUMNS_PER_PASS, len(values)))
        found: dict[int, list[Number]] = {}
        kinds = {"bigint": [i for i in chunk if whole[i]], "double": [i for i in chunk if not whole[i]]}
        per_group = df.groupBy(merge_group()).agg(
            *[
                F.expr(f"kll_sketch_agg_{kind}({values[i]}, {k}) AS s{i}")
                for kind, ids in kinds.items()
                for i in ids
            ]
        )
        for kind, ids in kinds.items():
            if not ids:
                continue
            merged = stacked_sketches(per_group, ids).groupBy("col_id").agg(
                F.expr(f"kll_merge_agg_{kind}(sketch, {k})").alias("sketch")
            )
            groups: dict[tuple[float, ...], list[int]] = {}
            for i in ids:
                groups.setdefault(tuple(map(float, ranks[i])), []).append(i)
            cases = " ".join(
                f"WHEN col_id IN ({', '.join(map(str, own))}) THEN kll_sketch_get_quantile_{kind}"
                f"(sketch, array({', '.join(map(sql_double, wanted))}))"
                for wanted, own in groups.items()
            )
            rows = merged.where(f"kll_sketch_get_n_{kind}(sketch) > 0").selectExpr(
                "col_id", f"CASE {cases} END AS q"
            )
            found.update({row["col_id"]: list(row["q"]) for row in rows.collect()})
        out += [found.get(i, []) for i in chunk]
    return out


@dataclass
class _Search:
    """One wanted quantile: ``rank``-th smallest of the values strictly between ``lo`` and ``hi``.

    A bound of ``None`` is open-ended. ``inner`` counts the values inside, once known. Values and
    bounds have the column's own type; integers are compared as long, floats as double.
    """

    column: str
    dtype: T.DataType
    probability: float
    lo: Number | None = None
    hi: Number | None = None
    fraction: float = 0.0
    rank: int = 0
    inner: int | None = None
    answer: Number | None = None
    empty: bool = False
    from_above: bool = False

    @property
    def base(self) -> Number | None:
        """The bound from which the sketch of decimals counts."""
        if self.lo is None or (self.from_above and self.hi is not None):
            return self.hi
        return self.lo

    @property
    def inside(self) -> str:
        """SQL of the value if it lies strictly inside the bracket, else null."""
        value = ranked_value(self.column, self.dtype)
        tests = [f"{value} IS NOT NULL"]
        if self.lo is not None:
            tests.append(f"{value} > {self.literal(self.lo)}")
        if self.hi is not None:
            tests.append(f"{value} < {self.literal(self.hi)}")
        return f"CASE WHEN {' AND '.join(tests)} THEN {value} END"

    @property
    def sketched(self) -> str:
        """SQL of what a sketch gets: decimals as double, counted from a bound.

        The closer a value is to that bound, the finer its double is; a search that does not get
        on is counted from the other bound.
        """
        if not isinstance(self.dtype, T.DecimalType):
            return self.inside
        base = "0" if self.base is None else self.literal(self.base)
        return f"CAST({self.inside} - {base} AS DOUBLE)"

    def bound(self, proposed: float) -> Number:
        """A proposed end of the bracket in the column's own type."""
        if not isinstance(self.dtype, T.DecimalType):
            return proposed
        step = decimal.Decimal(1).scaleb(-self.dtype.scale)
        most = decimal.Decimal(10) ** (self.dtype.precision - self.dtype.scale) - step
        with decimal.localcontext(decimal.Context(prec=80)):
            value = (decimal.Decimal(proposed) + (self.base or 0)).quantize(step)
            return max(-most, min(most, value))

    def literal(self, value: Number) -> str:
        return sql_number(value, self.dtype)

    @property
    def done(self) -> bool:
        return self.empty or self.answer is not None


def sketched_ranks(probabilities: Sequence[float], relative_error: float) -> tuple[list[float], float]:
    """Ranks, and their error, that :func:`quantiles` wants of sketches made elsewhere."""
    if is_exact(relative_error):
        ends = [(max(0.0, p - BRACKET_MARGIN), min(1.0, p + BRACKET_MARGIN)) for p in probabilities]
        return [r for pair in ends for r in pair], BRACKET_MARGIN
    return list(probabilities), relative_error


def is_exact(relative_error: float) -> bool:
    return relative_error == 0 or sketch_size(relative_error) is None


def _propose(
    df: DataFrame, searches: list[_Search], sketched: Mapping[str, list[Number]]
) -> list[tuple[Number, Number] | None]:
    first = searches[0].inner is None
    if first and all(s.column in sketched for s in searches):
        brackets, at = [], {}
        for s in searches:
            i = at[s.column] = at.get(s.column, -1) + 1
            ends = sketched[s.column][2 * i : 2 * i + 2]
            s.empty = not ends
            brackets.append((s.bound(ends[0]), s.bound(ends[1])) if ends else None)
        return brackets
    if first:
        # All probabilities of a column share the column's sketch.
        names = list(dict.fromkeys(s.column for s in searches))
        groups = [[s for s in searches if s.column == n] for n in names]
    else:
        groups = [[s] for s in searches]
    values = [g[0].sketched for g in groups]
    ranks = [
        [
            r
            for s in group
            for r in (
                max(0.0, s.fraction - BRACKET_MARGIN),
                min(1.0, s.fraction + BRACKET_MARGIN),
            )
        ]
        for group in groups
    ]
    found = _sketch(df, values, [is_whole(g[0].dtype) for g in groups], ranks, BRACKET_MARGIN)
    brackets = {}
    for group, quantiles in zip(groups, found):
        for i, s in enumerate(group):
            if quantiles:
                brackets[id(s)] = (s.bound(quantiles[2 * i]), s.bound(quantiles[2 * i + 1]))
            else:
                s.empty = True
    return [brackets.get(id(s)) for s in searches]


def _settle(df: DataFrame, searches: list[_Search], brackets: list[tuple[Number, Number]]) -> None:
    """Check proposed brackets by exact counts, then answer or narrow each search."""
    counts = []
    for i, (s, (lo, hi)) in enumerate(zip(searches, brackets)):
        v = s.inside
        counts += [
            f"count({v}) AS n{i}",
            f"count_if({v} < {s.literal(lo)}) AS below{i}",
            f"count_if({v} <= {s.literal(lo)}) AS to_lo{i}",
            f"count_if({v} < {s.literal(hi)}) AS to_hi{i}",
            f"count_if({v} <= {s.literal(hi)}) AS through{i}",
        ]
    row = df.agg(*[F.expr(c) for c in counts]).first()
    for i, (s, (lo, hi)) in enumerate(zip(searches, brackets)):
        if s.inner is None:
            s.rank = max(1, math.ceil(s.probability * row[f"n{i}"]))
        known = s.inner
        below, to_lo = row[f"below{i}"], row[f"to_lo{i}"]
        to_hi, through = row[f"to_hi{i}"], row[f"through{i}"]
        if s.rank <= below:
            # The sketch erred: the rank lies under the bracket, search there.
            s.hi, s.inner = lo, below
        elif s.rank <= to_lo:
            s.answer = lo
        elif s.rank <= to_hi:
            s.lo, s.hi, s.inner, s.rank = lo, hi, to_hi - to_lo, s.rank - to_lo
        elif s.rank <= through:
            s.answer = hi
        else:
            s.lo, s.inner, s.rank = hi, row[f"n{i}"] - through, s.rank - through
        if not s.done:
            s.fraction = s.rank / s.inner
            if s.inner == known:
                s.from_above = not s.from_above


def _rank_inside(df: DataFrame, searches: list[_Search]) -> None:
    """Finish searches of one type whose brackets hold few enough rows for one task each."""
    cells = ", ".join(f"{i}, {s.inside}" for i, s in enumerate(searches))
    window = Window.partitionBy("search").orderBy("value")
    ranks = ", ".join(f"{s.rank}L" for s in searches)
    rank = F.expr(f"element_at(array({ranks}), search + 1)")
    rows = (
        df.selectExpr(f"stack({len(searches)}, {cells}) AS (search, value)")
        .where(F.col("value").isNotNull())
        .groupBy("search", "value")
        .agg(F.count("*").alias("freq"))
        .withColumn("through", F.sum("freq").over(window))
        .where((F.col("through") >= rank) & (F.col("through") - F.col("freq") < rank))
        .collect()
    )
    for row in rows:
        searches[row["search"]].answer = row["value"]


def exact_quantiles(
    df: DataFrame,
    fields: Sequence[T.StructField],
    probabilities: Sequence[float],
    sketched: Mapping[str, list[Number]],
) -> dict[str, list[Number]]:
    searches = [_Search(f.name, f.dataType, p, fraction=p) for f in fields for p in probabilities]
    needed = df.select(*[col(f.name) for f in fields])
    pending = searches
    while pending:
        brackets = _propose(needed, pending, sketched)
        active = [(s, b) for s, b in zip(pending, brackets) if not s.empty]
        for start in range(0, len(active), SEARCHES_PER_PASS):
            chunk = active[start : start + SEARCHES_PER_PASS]
            _settle(needed, [s for s, _ in chunk], [b for _, b in chunk])
        small: dict[str, list[_Search]] = {}
        for s in pending:
            if not s.done and s.inner <= RANKABLE_ROWS:
                kind = "bigint" if is_whole(s.dtype) else s.dtype.simpleString().replace("float", "double")
                small.setdefault(kind, []).append(s)
        for own in small.values():
            for start in range(0, len(own), COLUMNS_PER_PASS):
                _rank_inside(needed, own[start : start + COLUMNS_PER_PASS])
        pending = [s for s in pending if not s.done]
    out: dict[str, list[Number]] = {}
    for s in searches:
        out.setdefault(s.column, [])
        if s.answer is not None:
            out[s.column].append(s.answer)
    return out


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
    sketched: Mapping[str, list[Number]] | None = None,
) -> dict[str, list[Number]]:
    """Quantiles per numeric column; ``[]`` for all-null columns.

    ``sketched`` may hold, for each column, what sketches of the same table gave for the ranks of
    :func:`sketched_ranks` (``[]`` without values); that saves a scan.

    The ``p`` quantile is the smallest value whose share of rows at or below it is at least
    ``p``. Nulls and NaN take no rank. ``relative_error=0`` is exact, as is any error that is
    too small for a sketch. Results are elements of the data in the column's own type (integers as
    int, decimals as Decimal, floats as float); only sketched quantiles of decimals are the nearest
    double of such an element.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    if relative_error < 0:
        raise ValueError("relative_error must not be negative")
    types = {f.name: f.dataType for f in df.schema.fields}
    known = sketched if sketched and all(c in sketched for c in columns) else {}
    if is_exact(relative_error):
        return exact_quantiles(df, [T.StructField(c, types[c]) for c in columns], probabilities, known)
    if known:
        return {c: known[c] for c in columns}
    values = [
        f"CAST({sql_name(c)} AS DOUBLE)"
        if isinstance(types[c], T.DecimalType)
        else ranked_value(c, types[c])
        for c in columns
    ]
    whole = [is_whole(types[c]) for c in columns]
    found = _sketch(df, values, whole, [probabilities] * len(columns), relative_error)
    return dict(zip(columns, found))
