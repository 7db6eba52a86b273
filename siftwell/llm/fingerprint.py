"""Document fingerprints by consistent weighted sampling.

The terms of a text are its runs of five words (A-Z in lower case), weighted by how often they
occur. For each of 64 samples every term draws, from a hash of term and sample, two gamma(2, 1)
values ``r`` and ``c`` and a uniform ``b``; with ``t = floor(ln(weight) / r + b)`` its rank is
``c / exp(r * (t - b + 1))``, and the term and ``t`` of the lowest rank are the sample. Two texts
agree in a sample with a probability equal to the generalised Jaccard similarity of their weights,
so the share of equal samples estimates it.

A gamma(2, 1) value cut at a uniform place makes two independent exponential values, so ``r (1 - b)``
and ``r b`` are drawn instead of ``r`` and ``b``: a term of weight 1 then has the rank ``c`` times a
uniform value. Draws are quantiles by 16 bits of the hash each.

``fingerprint_edits`` sorts documents by ``doc_id`` in ranges, streams each range once, and sends
the first document of a range also to the range before it, so each document meets its successor
without a global order in one task. Ranges start at approximate quantiles of ``doc_id``; the
driver holds these (``MOST_RANGES`` at most).

Edge cases: a null or empty text, or one without words, has no terms: its fingerprint is all zeros
and equals only those of other such texts; a text of fewer than five words is one term; null
identifiers come first; rows of equal ``doc_id`` are ordered by text, and a repeated row is its
own successor; in a table of one row the successor is the row itself; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import WordHashes, mix64, plain_texts, rolling

SAMPLES = 64
WORDS = 5
ROWS_PER_RANGE = 500
MOST_RANGES = 65_536
LOWEST = -(1 << 63)
#: Terms that are ranked at once.
CHUNK = 2048


def gamma_quantiles(n: int) -> np.ndarray:
    """Midpoint quantiles of the gamma(2, 1) distribution, by bisection of its distribution."""
    wanted = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(64):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


MULTIPLIERS = mix64(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
UNIFORM = (np.arange(1 << 16) + 0.5) / (1 << 16)
#: ``r (1 - b)`` or ``r b``, and what a term of weight 1 multiplies ``c`` by.
PART, ONCE = -np.log(UNIFORM), UNIFORM.astype(np.float32)
C = gamma_quantiles(1 << 16).astype(np.float32)
STEP_MIX = np.uint32(0x9E3779B1)


def terms(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct terms of a text, and their weights."""
    words = hashes.of(text.encode("utf-8", "surrogatepass").lower().split())
    if not len(words):
        return words, np.empty(0, np.int64)
    return np.unique(rolling(words, min(WORDS, len(words))), return_counts=True)


def signature(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The samples of weighted terms, 32 bits each; zeros if there are none."""
    if not len(found):
        return np.zeros(SAMPLES, np.uint32)
    best = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), CHUNK):
        value = found[start : start + CHUNK, None] * MULTIPLIERS
        halves = value.view(np.uint16).reshape(*value.shape, 4)
        c = C[halves[:, :, 2]]
        rank = c * ONCE[halves[:, :, 3]]
        parts = value.view(np.uint32).reshape(*value.shape, 2)
        many = np.nonzero(weights[start : start + CHUNK] > 1)[0]
        if len(many):
            # These bits also stay part of the sample's name.
            above, below = PART[halves[many, :, 3]], PART[halves[many, :, 1]]
            r = above + below
            step = np.floor((np.log(weights[start + many])[:, None] + below) / r)
            rank[many] = c[many] * np.exp(-above - r * step)
            parts[many, :, 0] ^= step.astype(np.uint32) * STEP_MIX
        parts[:, :, 1] = rank.view(np.uint32)
        best = np.minimum(best, value.min(axis=0))
    return best.astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _text(samples: np.ndarray) -> str:
    return samples.astype(">u4").tobytes().hex()


def _range_starts(docs: DataFrame) -> list[int]:
    """Distinct identifiers at which ranges start, the lowest first."""
    rows = docs.count()
    if not rows:
        return []
    ranges = min(MOST_RANGES, -(-rows // ROWS_PER_RANGE))
    shares = [k / ranges for k in range(ranges)]
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST)).cast("long")
    found = docs.agg(
        F.min(key).alias("least"),
        F.percentile_approx(key, shares, F.lit(20 * ranges)).alias("starts"),
    ).first()
    return sorted({found["least"], *found["starts"]})


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of range, own before borrowed, identifier; each range ends with a borrowed row."""
    hashes = WordHashes()
    kinds = {
        "doc_id": pa.int64(),
        "n_chars": pa.int64(),
        "edited_sha256": pa.string(),
        "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
    }
    before = None
    rows: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(kinds)
        rows.clear()
        return pa.record_batch({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns)})

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("part", "borrowed", "doc_id", "text")]
        for part, borrowed, doc_id, text in zip(*columns):
            mine = None if borrowed and before is None else signature(*terms(text, hashes))
            if before is not None and before[0] == part:
                _, old_id, old_text, old = before
                new_text = edited(old_text, text)
                new = signature(*terms(new_text, hashes))
                digest = hashlib.sha256(new_text.encode()).hexdigest()
                near = likeness(old, new), likeness(old, mine)
                rows.append((old_id, len(old_text), digest, _text(old), _text(new), *near))
            before = None if borrowed else (part, doc_id, text, mine)
            if len(rows) >= 1000:
                yield packed()
    if rows:
        yield packed()


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and two likenesses."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST)).cast("long")
    texts = plain_texts(docs).withColumn("key", key)
    starts = np.array(_range_starts(docs.select("doc_id")), np.int64)

    @F.arrow_udf("int")
    def part_of(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(starts, keys.to_numpy(), side="right") - 1, pa.int32())

    own = texts.select(part_of("key").alias("part"), F.lit(0).alias("borrowed"), "key", "doc_id", "text")
    last = max(0, len(starts) - 1)
    firsts = docs.sparkSession.createDataFrame(
        [(int(s), (k - 1) % (last + 1)) for k, s in enumerate(starts)], "key long, part int"
    )
    borrowed = (
        texts.join(F.broadcast(firsts), "key")
        .groupBy("part", "key")
        .agg(F.min("text").alias("text"))
        .select("part", F.lit(1).alias("borrowed"), "key", F.lit(None).cast("long").alias("doc_id"), "text")
    )
    ordered = own.union(borrowed).repartition("part")
    ordered = ordered.sortWithinPartitions("part", "borrowed", "key", "text")
    return ordered.drop("key").mapInArrow(_fingerprints, schema)
