"""Periodic runs, toxicity and whitening against plain Python and numpy."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import runs, toxicity, whitening
from siftwell.llm.frames import WordHashes
from siftwell.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def plain_runs(words, least=12):
    """Every run by comparing all words at every distance."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        same = [words[k] == words[k - q] for k in range(q, len(words))] + [False]
        begun = None
        for k, hit in enumerate(same):
            if hit and begun is None:
                begun = k
            elif not hit and begun is not None:
                start, n = begun, k - begun + q
                inner = words[start : start + n]
                smallest = all(any(inner[i] != inner[i - p] for i in range(p, n)) for p in range(1, q))
                if n >= max(least, 2 * q) and smallest:
                    found.append((start, n, q))
                begun = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(4)
    for _ in range(400):
        n = rng.randrange(60)
        words = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(n)]
        if n and rng.random() < 0.5:
            p = rng.randrange(1, n + 1)
            words = [words[k % p] for k in range(n)]
            if rng.random() < 0.5:
                words[rng.randrange(n)] = 99
        for least in (2, 5, 12):
            assert runs.runs_of_ids(words, least) == plain_runs(words, least)
        texts = [[b"%d" % w for w in words], [b"a"] * 11, [], [b"%d" % w for w in words * 2]]
        found = runs.runs_of_texts(texts, WordHashes())
        assert found == [plain_runs(t) for t in texts]


def test_runs_of_long_repeats_take_little_time():
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 30_000:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    found = runs.runs_of_ids(fibonacci[1])
    # All smallest periods of a Fibonacci word's runs are Fibonacci numbers.
    assert {q for _, _, q in found} <= {1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987,
                                       1597, 2584, 4181, 6765, 10946, 17711}
    assert runs.runs_of_ids([7] * 100_000) == [(0, 100_000, 1)]


@tables
def test_run_query(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(found) == len(texts)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    some = 0
    for doc_id, text in texts:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 1000:
            continue
        expected = plain_runs(words)
        row = found[doc_id]
        some += len(expected)
        gone = {k for s, length, q in expected for k in range(s + q, s + length)}
        best = min(expected, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(expected), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if expected else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in expected)
        assert row.runs_sha256 == digest(lines.encode())
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert row.collapsed_sha256 == digest(kept)
    assert some > 10


def test_machine_learns_pairs_that_no_sum_can():
    rng = random.Random(2)

    def text(insult, group):
        words = [f"w{rng.randrange(50)}" for _ in range(20)]
        return " ".join(words + ["fool"] * insult + ["martians"] * group)

    cases = [(i, g) for i in (0, 1) for g in (0, 1)] * 200
    memo = toxicity.TermMemo()
    rows = [toxicity.terms(text(i, g), memo) for i, g in cases]
    numbers = {t: k for k, t in enumerate(sorted({t for ids, _ in rows for t in ids}))}
    rows = [([numbers[t] for t in ids], values) for ids, values in rows]
    # Toxic unless the two come alone or not at all; and the reverse, where sums must fail.
    for labels in (np.array([i and g for i, g in cases]), np.array([i == g for i, g in cases])):
        machine = toxicity.fit_machine(rows, labels.astype(float), numbers)
        assert ((machine.predict(rows) >= 0.5) == labels).mean() > 0.97


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = toxicity.Machine({}, 0.3, rng.normal(size=9), rng.normal(size=(9, toxicity.FACTORS)))
    rows = [([0, 3, 8], [0.5, 1.0, 0.2]), ([], []), ([4], [1.0])]
    for margin, (at, value) in zip(machine.margins(rows), rows):
        pairs = [(a, b) for a in range(len(at)) for b in range(a)]
        whole = 0.3 + sum(machine.weights[t] * v for t, v in zip(at, value))
        whole += sum(machine.factors[at[a]] @ machine.factors[at[b]] * value[a] * value[b] for a, b in pairs)
        assert abs(margin - whole) < 1e-12


@pytest.fixture
def rude(documents, spark):
    rng = random.Random(6)
    texts, marks = [], []
    for k in range(1200):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}n{rng.choice('rstl')}" for _ in range(30)]
        if k % 5 == 0:
            words[rng.randrange(30)] = rng.choice(("wretch!", "Wretched", "wretches"))
        texts.append((k, " ".join(words)))
        marks.append((k, None, int(k % 5 == 0)))
    labels = spark.createDataFrame(marks[:900], "doc_id long, quality int, toxic int")
    return documents(texts), labels


def test_toxic_documents_are_caught(rude):
    rows = toxicity.toxicity_scores(*rude).collect()
    assert len(rows) == 1200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in rows]) > 0.99
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_ignores_held_out_labels_and_clashing_columns(rude, spark):
    docs, labels = rude
    before = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1).otherwise(F.col("toxic")))
    again = docs.withColumns({"label": F.lit(1), "score": F.lit(2), "digest": F.lit("x"), "toxic": F.lit(1)})
    after = {r.doc_id: r.score for r in toxicity.toxicity_scores(again, turned).collect()}
    assert before == after
    one = labels.withColumn("toxic", F.lit(0))
    assert {r.predicted for r in toxicity.toxicity_scores(docs, one).collect()} == {0}
    none = {r.score for r in toxicity.toxicity_scores(docs, labels.limit(0)).collect()}
    assert none == {0.5}


def symmetric(rng, n, kind):
    b = rng.normal(size=(n, 3 * n)) * np.linspace(1, 3, n)[:, None]
    if kind == "low rank":
        b[:, 2:] = 0
    if kind == "spread":
        b *= np.logspace(0, -4, n)[:, None]
    m = b @ b.T
    if kind == "ties":
        m = np.diag(np.r_[np.full(n // 2, 2.0), np.full(n - n // 2, 1.0)])
    if kind == "indefinite":
        m = rng.normal(size=(n, n))
        np.fill_diagonal(m, 0)
    return (m + m.T) / 2


@pytest.mark.parametrize("kind", ["full", "low rank", "spread", "ties", "indefinite"])
@pytest.mark.parametrize("n", [1, 2, 3, 8, 33])
def test_counts_and_components(n, kind):
    rng = np.random.default_rng(n)
    m = symmetric(rng, n, kind)
    values = np.linalg.eigvalsh(m)[::-1]
    for shift in rng.uniform(values[-1] - 1, values[0] + 1, 20):
        if np.abs(values - shift).min() > 1e-9:
            assert whitening.count_below(m, shift) == (values < shift).sum()
    if kind == "indefinite":
        return
    found, vectors = whitening.leading_components(m)
    positive = values[values > 1e-9 * values[0]][:16] if values[0] > 0 else values[:0]
    assert len(found) == len(positive)
    assert np.allclose(found, positive, rtol=1e-11)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max(initial=0) < 1e-11
    assert np.abs(m @ vectors.T - vectors.T * found).max(initial=0) < 1e-12 * max(values[0], 1)


def vectors_frame(spark, rows, kind="array<double>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").repartition(3)


@tables
def test_whitened_vectors(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    found = QUERIES["op13_whitening"](spark, FOLDER).toPandas().sort_values(["vec_id", "component"])
    table = sorted((r for r in table if r.embedding is not None), key=lambda r: r.vec_id)
    x = np.floor(64 * np.array([r.embedding for r in table])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    expected = (x - sums / n) @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    got = found["whitened"].to_numpy().reshape(len(table), 16)
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-9
    assert (found["deviation"].to_numpy()[::16] == ((n * x - sums) ** 2).sum(axis=1)).all()
    assert np.allclose(found["explained"][:16], values[::-1][:16] / np.trace(cov), rtol=1e-12)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-10
    assert set(found["n"]) == {n}


def test_whitening_edges(spark):
    rng = np.random.default_rng(8)
    good = [(k, rng.normal(size=3).tolist(), 0) for k in range(40)]
    bad = [
        (100, None, 0), (101, [], 0), (102, [1.0, None, 2.0], 0), (103, [float("nan"), 0.0, 0.0], 0),
        (104, [0.0, float("-inf"), 0.0], 0), (105, [1.0, 2.0], 0), (106, [1.0] * 4, 0),
    ]
    copies = [(k, good[0][1], 1) for k in (0, None, 77)]
    plain = whitening.whitened_vectors(vectors_frame(spark, good)).toPandas()
    frame = vectors_frame(spark, good + bad + copies).withColumns({"x": F.lit(1), "n": F.lit(2), "component": F.lit(3)})
    found = whitening.whitened_vectors(frame).toPandas()
    assert len(plain) == 120 and len(found) == 129
    assert sorted(set(found["vec_id"].dropna())) == [*range(40), 77]
    key = ["vec_id", "component"]
    both = plain.merge(found.drop_duplicates(key), on=key)
    assert len(both) == 120 and (both["deviation_x"] == both["deviation_y"]).all()
    assert np.allclose(both["whitened_x"].abs(), both["whitened_y"].abs(), atol=1e-10)
    for few in (good[:0], good[:1], [(k, [1.0, 2.0, 3.0], 0) for k in range(9)], bad[:2]):
        empty = whitening.whitened_vectors(vectors_frame(spark, few))
        assert empty.columns == list(found.columns) and empty.count() == 0
    # A constant dimension and one that copies another leave two components.
    flat = [(k, [v[0], 5.0, v[1], v[0]], 0) for k, v, _ in good]
    assert set(whitening.whitened_vectors(vectors_frame(spark, flat)).toPandas()["component"]) == {1, 2}
    huge = [(k, [1e300 * v[0], -1e30 * v[1], v[2]], 0) for k, v, _ in good]
    far = whitening.whitened_vectors(vectors_frame(spark, huge)).toPandas()
    assert far["deviation"].isna().all() and np.isfinite(far["whitened"]).all()


def test_runs_edges(awkward):
    rows = runs.periodic_runs(awkward).collect()
    by = Counter((r.doc_id, r.kept_text) for r in rows)
    assert by[11, "tail"] == 2 and by[None, ""] == 1 and by[3, ""] == 1
    assert all(r.runs == [] for r in rows)
    ones = awkward.limit(1).withColumn("text", F.repeat(F.lit("one "), 12))
    (row,) = runs.periodic_runs(ones).collect()
    assert [tuple(r) for r in row.runs] == [(0, 12, 1)] and row.kept_text == "one"
