"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words in lower case, bare of punctuation, and the beginnings of these words
(``STEMS`` characters), which stand for inflected forms. A term is known by its hash, cut to
``BUCKET_BITS`` bits. Its value ``x = c / (c + words / 100)``, for ``c`` occurrences, nears 1 where
it is more than one word in a hundred. The score of a text is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

whose second sum is the weight ``<v_i, v_j>`` of every pair of terms that occur together, such as an
insult and the mention of a group, in time linear in the terms.

Training reads at most ``SAMPLE`` labelled rows, those of lowest identifier hash, found by a
broadcast of their identifiers. A first pass counts in how many of them, by label, each bucket
occurs; the ``TERMS`` buckets that differ most between the labels, in standard errors, are the
model's terms. A second one sends only these terms to the driver, where weights are learnt by
mini-batches. Labels, language, source and identifier are never inputs of a score. Scoring is one
scan of all rows without a shuffle.

Edge cases: a null text is the empty text, which has no terms and scores by ``w0`` alone; rows of a
null ``doc_id`` are scored, never trained on and never held out; a ``doc_id`` that labels name
more than once has the label of the majority, ties as 1, null labels not at all, and where
documents repeat it, its lowest text is the one trained on; without any label
every score is 0.5, with labels of one class the model is that class's smoothed rate; equal texts
get equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import map_rows, plain_texts
from siftwell.sources.workspace import discard, materialize

#: Labelled rows that the model is learnt on, at most; also the bound of what reaches the driver.
SAMPLE = 20_000
THRESHOLD = 0.3
FOLDS, FOLD = 4, 2
BUCKET_BITS = 18
TERMS = 4096
#: A term is chosen if it occurs in so many training texts, and its labels differ by so many errors.
LEAST_TEXTS, LEAST_ERRORS = 4, 3.0
STEMS = range(4, 9)
FACTORS = 8
EPOCHS, BATCH, RATE = 30, 256, 0.05
#: Penalties of weights and of factors.
RIDGE, FACTOR_RIDGE = 2e-4, 2e-3


class TermMemo(dict):
    """Buckets of the terms of a word as it stands in lower case, remembered; forgets when full."""

    def __init__(self, numbers: dict[int, int] | None = None, limit: int = 300_000):
        super().__init__()
        self.numbers, self.limit = numbers, limit

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        word = token
        if not token.isalnum():
            inner = [k for k, c in enumerate(token) if c.isalnum()]
            word = token[inner[0] : inner[-1] + 1] if inner else ""
        names = [f"={word}", *(f"^{word[:k]}" for k in STEMS if k <= len(word))] if word else []
        hashes = [xxhash.xxh64_intdigest(n.encode("utf-8", "replace")) >> (64 - BUCKET_BITS) for n in names]
        if self.numbers is not None:
            hashes = [self.numbers[h] for h in hashes if h in self.numbers]
        found = self[token] = tuple(hashes)
        return found


def terms(text: str, memo: TermMemo) -> tuple[list[int], list[float]]:
    """The terms of a text that the memo knows, and their values."""
    words = text.lower().split()
    counts: dict[int, int] = {}
    for token, count in Counter(words).items():
        for term in memo[token]:
            counts[term] = counts.get(term, 0) + count
    share = len(words) / 100
    return list(counts), [c / (c + share) for c in counts.values()]


@dataclass
class Machine:
    """A factorization machine whose terms are numbered."""

    numbers: dict[int, int]
    start: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, rows: list[tuple[list[int], list[float]]]) -> np.ndarray:
        at, value, row = flat(rows)
        return self._margins(at, value, row, len(rows))[0]

    def _margins(self, at, value, row, n):
        carried = self.factors[at] * value[:, None]
        sums = np.stack([np.bincount(row, c, n) for c in carried.T], 1)
        squares = np.bincount(row, (carried**2).sum(1), n)
        linear = np.bincount(row, self.weights[at] * value, n)
        return self.start + linear + ((sums**2).sum(1) - squares) / 2, sums

    def predict(self, rows: list[tuple[list[int], list[float]]]) -> np.ndarray:
        """Probability of class 1 of every row."""
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -30, 30)))


def flat(rows: list[tuple[list[int], list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers, values and row numbers of all terms of some rows."""
    at = np.array([t for ids, _ in rows for t in ids], np.int64)
    value = np.array([v for _, values in rows for v in values], np.float64)
    return at, value, np.repeat(np.arange(len(rows)), [len(ids) for ids, _ in rows])


def fit_machine(
    rows: list[tuple[list[int], list[float]]], labels: np.ndarray, numbers: dict[int, int]
) -> Machine:
    """Learn weights and factors by mini-batches with per-weight step sizes (Adagrad)."""
    positive, n = float(labels.sum()), len(labels)
    machine = Machine(
        numbers,
        float(np.log((positive + 1) / (n - positive + 1))),
        np.zeros(len(numbers)),
        np.random.default_rng(12).normal(0, 0.05, (len(numbers), FACTORS)),
    )
    if not 0 < positive < n:
        return Machine(numbers, machine.start, machine.weights, machine.factors * 0)
    size = len(numbers)
    seen_start, seen_weights, seen_factors = 1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
    at, value, row = flat(rows)
    ends = np.cumsum([0, *(len(ids) for ids, _ in rows)])
    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(n)
        for begin in range(0, n, BATCH):
            chosen = order[begin : begin + BATCH]
            pieces = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in chosen])
            here, x = at[pieces], value[pieces]
            of = np.repeat(np.arange(len(chosen)), ends[chosen + 1] - ends[chosen])
            margin, sums = machine._margins(here, x, of, len(chosen))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
            push = error[of] * x
            used, place = np.unique(here, return_inverse=True)
            m = len(used)
            by_weight = np.bincount(place, push, m) / len(chosen) + RIDGE * machine.weights[used]
            each = push[:, None] * (sums[of] - machine.factors[here] * x[:, None])
            by_factor = np.stack([np.bincount(place, c, m) for c in each.T], 1) / len(chosen)
            by_factor += FACTOR_RIDGE * machine.factors[used]
            seen_weights[used] += by_weight**2
            seen_factors[used] += by_factor**2
            seen_start += error.mean() ** 2
            machine.weights[used] -= RATE * by_weight / np.sqrt(seen_weights[used])
            machine.factors[used] -= RATE * by_factor / np.sqrt(seen_factors[used])
            machine.start -= RATE * error.mean() / np.sqrt(seen_start)
    return machine


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of the identifier as text, modulo ``FOLDS``, is ``FOLD``."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text, label`` of at most ``sample`` labelled documents that are not held out.

    Rows that repeat both identifier and text are still repeated here.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
    )
    chosen = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = plain_texts(docs).withColumn("digest", F.sha2("text", 256))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    first, _ = materialize(found.agg(F.min("digest").alias("digest")), "labelled")
    return texts.join(F.broadcast(first), ["doc_id", "digest"]).select("doc_id", "text", "label")


def choose_terms(training: DataFrame) -> dict[int, int]:
    """Numbers of the buckets that differ most between the labels, over the training rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = TermMemo()
        rows = [terms(t, memo)[0] for t in batch["text"].to_pylist()]
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "label": batch["label"],
                "buckets": pa.array(rows, pa.list_(pa.int32())),
            }
        )

    schema = "doc_id long, label int, buckets array<int>"
    found = map_rows(training, run, schema).dropDuplicates(["doc_id"])
    # Bucket -1 is in every text.
    each = found.select("label", F.explode(F.concat("buckets", F.array(F.lit(-1)))).alias("bucket"))
    counted = each.groupBy("bucket").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    counts, path = materialize(counted, "terms")
    every = counts.where("bucket = -1").first()
    rate = every["toxic"] / every["n"] if every else 0.0
    # The number of toxic texts among n, against what the common rate gives.
    spread = F.sqrt(F.col("n") * rate * (1 - rate) + 0.25)
    errors = F.abs(F.col("toxic") - F.col("n") * rate) / spread
    differ = counts.where((F.col("bucket") >= 0) & (F.col("n") >= LEAST_TEXTS)).where(errors >= LEAST_ERRORS)
    best = differ.orderBy(errors.desc(), "bucket").limit(TERMS).select("bucket").collect()
    discard(training.sparkSession, path)
    return {r["bucket"]: k for k, r in enumerate(best)}


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Choose terms and learn their weights on at most ``sample`` labelled documents."""
    training = training_rows(docs, labels, sample)
    numbers = choose_terms(training)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = TermMemo(numbers)
        rows = [terms(t, memo) for t in batch["text"].to_pylist()]
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "at": pa.array([ids for ids, _ in rows], pa.list_(pa.int32())),
                "value": pa.array([values for _, values in rows], pa.list_(pa.float32())),
                "label": batch["label"],
            }
        )

    schema = "doc_id long, at array<int>, value array<float>, label int"
    found = map_rows(training, run, schema).dropDuplicates(["doc_id"])
    table = found.toArrow().sort_by("doc_id")
    rows = list(zip(table["at"].to_pylist(), table["value"].to_pylist()))
    return fit_machine(rows, table["label"].to_numpy().astype(np.float64), numbers)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    machine = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels))
    memos: list[TermMemo] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not memos:
            memos.append(TermMemo(machine.value.numbers))
        rows = [terms(t, memos[0]) for t in batch["text"].to_pylist()]
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "score": pa.array(machine.value.predict(rows), pa.float64()),
            }
        )

    return map_rows(plain_texts(docs), run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
