"""Near duplicates by SimHash: tiled exact comparison of 64-bit fingerprints.

Fingerprints within ``radius`` differing bits agree in at least two of ``radius + 2`` blocks of
bits, so each distinct fingerprint joins one bucket for each pair of blocks (10 for radius 3, of
25 or 26 bits). A bucket is compared exactly: its members, ordered by population count, are cut
into tiles, each pair of tiles is compared by exclusive-or and bit counts, and pairs of tiles
whose population counts differ beyond the radius are skipped. Buckets of more than ``TILE``
members are first dealt into tiles by a hash, and each pair of tiles becomes a task of its own.
A bucket reports a spanning forest of its links, never all pairs; components follow from these.

Edge cases: a null or empty text has fingerprint 0, as has a text without words, and is linked
like any other; texts of one or two words have a single shingle; equal fingerprints always share a
component; a component's identifier is its smallest ``doc_id``, null identifiers only where there
is no other; repeated rows are reported as often as they occur; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.components import components
from siftwell.llm.frames import map_rows, owned_rows, plain_texts, text_bytes
from siftwell.sources.workspace import materialize

SEED = 42
WORDS = 3
RADIUS = 3
#: Members of a bucket that one task compares at once, and rows of an inner tile.
TILE = 32768
INNER = 512
#: Runs up to this length are compared by shifts over a whole batch.
SHORT = 8
BITS = 64


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """XXH64 of every run of ``words`` words, A-Z in lower case, joined by one space."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    pieces = [joined[a:b] for a, b in zip(starts, ends[words - 1 :].tolist())]
    return np.fromiter(
        map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces)
    )


def majority_bits(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit integer."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fp, sha`` of every document; ``sha`` is the SHA-256 of its text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch["text"])
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "fp": pa.array([majority_bits(shingle_hashes(t, words)) for t in texts], pa.int64()),
                "sha": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
        )

    return map_rows(plain_texts(docs), run, "doc_id long, fp long, sha string")


def block_masks(radius: int) -> list[int]:
    """Masks of every pair of blocks, as signed 64-bit integers."""
    edges = [BITS * k // (radius + 2) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


class Forest:
    """Union-find over positions of an array."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        for i, j in zip(left.tolist(), right.tolist()):
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
        while not np.array_equal(self.parent, up := self.parent[self.parent]):
            self.parent = up


def link_tiles(prints: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Parents in a spanning forest of the links between two sets of positions.

    Both sets are ordered by population count; they are the same set or have no common element.
    """
    forest = Forest(len(prints))
    same = left is right
    counts = np.bitwise_count(prints).astype(np.int64)
    for i in range(0, len(left), INNER):
        a = left[i : i + INNER]
        for j in range(i if same else 0, len(right), INNER):
            b = right[j : j + INNER]
            if counts[b[0]] - counts[a[-1]] > radius:
                break
            if counts[a[0]] - counts[b[-1]] > radius:
                continue
            near = np.bitwise_count(prints[a][:, None] ^ prints[b][None, :]) <= radius
            hit = near.any(axis=1)
            forest.link(a[hit], b[near[hit].argmax(axis=1)])
            hit = near.any(axis=0)
            forest.link(a[near[:, hit].argmax(axis=0)], b[hit])
            near &= forest.parent[a][:, None] != forest.parent[b][None, :]
            while near.any():
                x, y = np.nonzero(near)
                roots = forest.parent[a[x]] * len(prints) + forest.parent[b[y]]
                _, first = np.unique(roots, return_index=True)
                forest.link(a[x[first]], b[y[first]])
                near &= forest.parent[a][:, None] != forest.parent[b][None, :]
    return forest.parent


def _bucket_links(prints: np.ndarray, tiles: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = tiles.min(), tiles.max()
    if low == high:
        left = right = np.arange(len(prints))
    else:
        left, right = np.nonzero(tiles == low)[0], np.nonzero(tiles == high)[0]
    parent = link_tiles(prints, left, right, radius)
    child = np.nonzero(parent != np.arange(len(prints)))[0]
    return prints[child], prints[parent[child]]


def _run_links(
    prints: np.ndarray, tiles: np.ndarray, starts: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links within complete runs that begin at ``starts``."""
    lengths = np.diff(starts, append=len(prints))
    run = np.repeat(np.arange(len(starts)), lengths)
    short = (lengths <= SHORT)[run]
    out = []
    for k in range(1, SHORT):
        pair = (run[k:] == run[:-k]) & short[k:]
        pair &= np.bitwise_count(prints[k:] ^ prints[:-k]) <= radius
        out.append((prints[k:][pair], prints[:-k][pair]))
    for at in np.nonzero(lengths > SHORT)[0]:
        here = slice(starts[at], starts[at] + lengths[at])
        out.append(_bucket_links(prints[here], tiles[here], radius))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _links(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Compare rows that arrive ordered by bucket, pair of tiles and population count."""
    names = ("t", "masked", "low", "high", "fp", "tile")
    held = [np.empty(0, np.int64)] * len(names)

    def pack(columns: list[np.ndarray], starts: np.ndarray) -> pa.RecordBatch:
        a, b = _run_links(columns[4].view(np.uint64), columns[5], starts, radius)
        return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    def run_starts(columns: list[np.ndarray]) -> np.ndarray:
        change = np.ones(len(columns[0]), bool)
        change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])
        return np.nonzero(change)[0]

    for batch in batches:
        new = [batch[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in names]
        held = [np.concatenate(pair) for pair in zip(held, new)]
        starts = run_starts(held)
        if len(starts) > 1:
            last = starts[-1]
            yield pack([c[:last] for c in held], starts[:-1])
            held = [c[last:].copy() for c in held]
    if len(held[0]):
        yield pack(held, run_starts(held))


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links that connect all fingerprints within the radius; ``prints`` has distinct ``fp``."""
    masks = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(radius)])
    rows = prints.select("fp", F.posexplode(masks).alias("t", "masked"))
    shared = rows.groupBy("t", "masked").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    dealt = rows.join(shared.select("t", "masked", tiles.alias("tiles")), ["t", "masked"])
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    pairs = dealt.select("t", "masked", "fp", own.alias("tile"), other.alias("other")).select(
        "t",
        "masked",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "fp",
        "tile",
    )
    group = ("t", "masked", "low", "high")
    ordered = pairs.repartition(*group).sortWithinPartitions(*group, F.bit_count("fp"), "fp")
    return ordered.mapInArrow(lambda batches: _links(batches, radius), "a long, b long")


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def _members(docs: DataFrame, radius: int, words: int) -> tuple[DataFrame, DataFrame]:
    """Stored prints, and ``fp, first, label`` of every distinct fingerprint.

    ``first`` is the print of the smallest identifier: ``none, doc_id, fp, sha``.
    """
    prints, _ = materialize(fingerprints(docs, words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "sha")
    owners, _ = materialize(prints.groupBy("fp").agg(F.min(first).alias("first")), "owners")
    labels = components(fingerprint_links(owners.select("fp"), radius))
    return prints, owners.join(labels, owners["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )


def simhash_groups(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints, members = _members(docs, radius, words)
    lowest = members.groupBy("label").agg(F.min("first").alias("lowest"))
    of_print = members.join(lowest, "label").select(
        "fp", F.col("lowest.doc_id").alias("component_id")
    )
    fingerprint = _hex(F.col("fp")).alias("fingerprint")
    return prints.join(of_print, "fp").select("doc_id", fingerprint, "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """One document of each component, the one of smallest ``doc_id``; all columns kept.

    Where rows share that identifier, the smallest fingerprint and then the smallest hash of the
    text decides.
    """
    _, members = _members(docs, radius, words)
    first = F.min("first").alias("first")
    keepers = members.groupBy("label").agg(first).select(
        F.col("first.doc_id").alias("keep_id"), F.col("first.sha").alias("text_sha256")
    )
    return owned_rows(docs, keepers)
