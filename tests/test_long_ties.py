from collections import Counter

import pytest

from siftwell.functions.frequency import top_values, value_frequencies
from siftwell.functions.long_ties import ranked_by_value
from siftwell.operators.profile import profile


def top(frame, **options):
    rows = profile(frame, long_ties="value", **options).top_values.orderBy("column_name", "rank").collect()
    return [(r["column_name"], r["value"], r["count"]) for r in rows]


def expected(texts, k=3):
    counts = Counter(t for t in texts if t is not None)
    best = sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))[:k]
    return [("v", text, n) for text, n in best]


CASES = {
    "differ late": ["x" * 500 + c for c in "dbca"],
    "one is the start of others": ["x" * n for n in (64, 65, 120, 121, 500, 1000)][::-1],
    "short and long share a start": ["y" * 64 + "b", "y" * 64 + "a" * 200, "y" * 64 + "c" * 90],
    "higher counts first": ["z" * 300 + c for c in "aabbbcdd"] + ["z" * 300 + "e" * 2] * 2,
    "wide characters": ["é" * 200 + c for c in ("😀", "ä", "z", "ￂ")],
    "two branches": [h + t for h in ("p" * 100, "p" * 90 + "o" * 10) for t in ("q" * 300 + "2", "q" * 300 + "1")],
    "lower counts between": ["w" * 80 + c for c in ("b", "b", "c", "c", "d", "d", "a")],
    "nulls and empty texts": [None, "", "", None, "k" * 200, "k" * 199],
    "empty": [],
}


@pytest.mark.parametrize("name", list(CASES))
def test_order_is_by_value(spark, column, name):
    texts = CASES[name]
    frame = column(texts, "string") if texts else spark.createDataFrame([], "v string")
    assert top(frame) == expected(texts)


def test_nominated_values_are_ordered_too(column):
    texts = CASES["differ late"] * 2 + ["q"]
    assert top(column(texts, "string"), top="nominated", distinct="approx") == expected(texts)


def test_no_further_scan_without_competing_texts(column, count_jobs):
    """Long texts alone in their place are not looked at again, nor are other types."""
    frame = column(["a" * 200] * 3 + ["b" * 200] * 2 + ["c"], "string")
    fields = frame.schema.fields
    ranked = lambda: top_values(value_frequencies(frame, fields), 4)
    plain, _ = count_jobs(lambda: ranked().collect())
    jobs, _ = count_jobs(lambda: ranked_by_value(ranked(), 3, frame, fields))
    assert jobs == plain
    with pytest.raises(ValueError, match="long_ties"):
        profile(frame, long_ties="other")
