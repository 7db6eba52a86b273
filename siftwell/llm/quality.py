"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counts and ratios of bytes, words and lines of the whole text; labels, language,
source and identifier are no inputs. Trees are grown level by level on binned statistics with
logistic loss. A fitted model is four arrays, one row per tree with its nodes in heap order, and
is applied to a batch by stepping all rows through a tree at once.

The model is fitted on at most ``SAMPLE`` labelled rows, those of lowest identifier hash; that
bounds what the driver receives and what is broadcast. Scoring covers every row, in one scan
without a shuffle.

Edge cases: a null text is the empty text, whose statistics are zeros, and gets a score like any
other; rows of a null ``doc_id`` are scored, never trained on and never held out; of several
labels of a document the majority counts, ties as 1, null labels not at all; of several texts with
one identifier the one of lowest digest is trained on; without any label
every score is 0.5, with labels of one class the model is that class's smoothed rate; equal texts
get equal scores; an empty table gives an empty result; other columns are ignored or, in
``drop_low_quality``, kept.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import map_rows, plain_texts, text_bytes

SAMPLE = 20_000
THRESHOLD = 0.3
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
FOLDS = 5

LETTERS = np.zeros(256, bool)
LETTERS[np.r_[65:91, 97:123, 128:256]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*+/<=>@\\^_`{|}~[]()")] = True
STOPS = np.zeros(256, bool)
STOPS[list(b".,;:?!'\"-")] = True


def statistics(text: bytes) -> list[float]:
    """What the classifier sees of a text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, len(text))
    share = counts[counts > 0] / n
    words = text.split()
    lines = text.split(b"\n")
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    often = Counter(words)
    letters = max(1, int(counts[LETTERS].sum()))
    ends = Counter(w[-1] for w in words)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        counts[UPPER].sum() / letters,
        counts[LETTERS].sum() / n,
        counts[DIGITS].sum() / n,
        counts[SYMBOLS].sum() / n,
        counts[STOPS].sum() / n,
        counts[33] / n,
        counts[124] / n,
        counts[128:].sum() / n,
        -(share * np.log(share)).sum(),
        len(often) / m,
        max(often.values(), default=0) / m,
        sum(c for w, c in often.items() if c > 1 and len(w) > 4) / m,
        (lengths > 12).sum() / m,
        (lengths < 3).sum() / m,
        sum(k for b, k in ends.items() if not LETTERS[b]) / m,
        ends[46] / m,
        len(lines) / m,
        1 - len(set(lines)) / len(lines),
        max(map(len, lines)) / n,
    ]


STATISTICS = 24


def statistics_matrix(texts: list[bytes]) -> np.ndarray:
    rows = np.array([statistics(t) for t in texts], np.float32)
    return rows.reshape(-1, STATISTICS)


@dataclass
class Trees:
    """Trees flattened to arrays: inner nodes and leaves in heap order, one row per tree."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 of every row."""
        margin = np.full(len(rows), self.start)
        at = np.arange(len(rows))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[at, feature[node]] > limit[node])
            margin += leaf[node - inner]
        return 1 / (1 + np.exp(-margin))


def _best_splits(binned, node, nodes, gradient, hessian):
    """Best feature and bin of every node of a level, and its gain."""
    width = nodes * BINS
    best = np.zeros(nodes)
    feature, cut = np.zeros(nodes, np.int64), np.full(nodes, BINS - 1)
    for f in range(binned.shape[1]):
        key = node * BINS + binned[:, f]
        g = np.bincount(key, gradient, width).reshape(nodes, BINS)
        h = np.bincount(key, hessian, width).reshape(nodes, BINS)
        gl, hl = g.cumsum(1), h.cumsum(1)
        gt, ht = gl[:, -1:], hl[:, -1:]
        gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
        gain[(hl < 1) | (ht - hl < 1)] = 0
        top = gain.argmax(1)
        value = gain[np.arange(nodes), top]
        better = value > best + 1e-9
        best[better], feature[better], cut[better] = value[better], f, top[better]
    return feature, cut


def fit_trees(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boost ``TREES`` trees of ``DEPTH`` levels on binned rows."""
    positive = labels.sum()
    start = float(np.log((positive + 1) / (len(labels) - positive + 1))) if len(labels) else 0.0
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if not 0 < positive < len(labels):
        empty = np.empty((0, inner))
        return Trees(start, empty.astype(np.int64), empty, np.empty((0, leaves)))
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(rows, levels, axis=0, method="inverted_cdf").astype(np.float32)
    binned = np.stack(
        [np.searchsorted(edges[:, f], rows[:, f], side="left") for f in range(rows.shape[1])], 1
    )
    # A row is in bin b if it is above edge b - 1 and not above edge b.
    limits = np.vstack([edges, np.full((1, rows.shape[1]), np.inf, np.float32)])
    features, cuts, values = [], [], []
    margin = np.full(len(rows), start)
    at = np.arange(len(rows))
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        gradient, hessian = labels - chance, chance * (1 - chance)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS - 1)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            nodes, first = 2**level, 2**level - 1
            f, c = _best_splits(binned, node - first, nodes, gradient, hessian)
            feature[first : first + nodes], cut[first : first + nodes] = f, c
            node = 2 * node + 1 + (binned[at, feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, hessian, leaves)
        value = RATE * g / (h + RIDGE)
        margin += value[leaf]
        features.append(feature)
        cuts.append(limits[cut, feature])
        values.append(value)
    return Trees(start, np.array(features), np.array(cuts), np.array(values))


def remainder(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the identifier as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, FOLDS) == 0, F.lit(False))


def _sample_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = text_bytes(batch["text"])
    rows = statistics_matrix(texts)
    return pa.record_batch(
        {
            "doc_id": batch["doc_id"].cast(pa.int64()),
            "digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            "row": pa.array(list(rows), pa.list_(pa.float32())),
            "label": batch["label"],
        }
    )


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` labelled documents that are not held out."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    chosen = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = plain_texts(docs).join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, digest binary, row array<float>, label int"
    found = map_rows(texts.select("doc_id", "text", "label"), _sample_batch, schema)
    # Where rows repeat an identifier, the text of the lowest digest stands for it.
    first = found.groupBy("doc_id").agg(F.min(F.struct("digest", "row", "label")).alias("first"))
    table = first.select("first.row", "first.label").orderBy("row", "label").toArrow()
    rows = np.array(table["row"].to_pylist(), np.float32).reshape(-1, STATISTICS)
    return fit_trees(rows, table["label"].to_numpy().astype(np.float64))


def score_of(trees: Trees):
    """A column function: the score of a text column without nulls."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [
            trees.predict(statistics_matrix(text_bytes(texts.slice(at, 2000))))
            for at in range(0, len(texts), 2000)
        ]
        return pa.array(np.concatenate([np.empty(0), *parts]), pa.float64())

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    score = score_of(fit_quality(docs, labels))
    scored = plain_texts(docs).select("doc_id", score(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least the threshold; all columns kept."""
    score = score_of(fit_quality(docs, labels))
    return docs.where(score(F.coalesce(docs["text"], F.lit(""))) >= THRESHOLD)
