"""Repeated passages: fixed-block anchors, extended to maximal exact repeats.

A window of 13 words holds, wherever it lies, a whole block of 7 words that starts at a multiple of
7. So the blocks at multiples of 7 are the index, and every rolling run of 7 words probes it:
a block that also occurs in another document is an anchor. Each anchor is extended to the windows
of 13 words around it; of every such window the smallest ``doc_id`` is found, and where it is
smaller than a document's own, the window is covered there. Covered windows that touch or overlap
make up the maximal exact repeats, which are cut out.

Documents are dealt into groups of about ``GROUP_ROWS``. A group sends each distinct hash once,
packed in sorted arrays, one for each hash bucket, so a passage on a third of all rows costs one
entry per group, and a bucket's size follows the number of distinct hashes. Buckets answer the
groups with those hashes alone that other documents share. The texts are shuffled once, for three
readings; anchors use about 32 bits of hash beside the bucket, which only ever adds candidates,
and windows use 64.

Edge cases: null and empty texts have no words and an empty kept text; a text of fewer than 13
words is kept; a passage repeated within one document only is kept, as are passages shared by rows
of one ``doc_id``; rows of null ``doc_id`` neither lose words nor make others lose them; repeated
rows get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import WordHashes, plain_texts, rolling, text_bytes

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
GROUP_ROWS = 1000
BUCKET_ROWS = 4000
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)
BLOBS = "grp int, bucket int, hashes binary, marks binary"
WINDOWS = "grp int, bucket int, hashes binary, least binary, marks binary"
KEPT = "doc_id long, n_words long, n_removed long, repeats array<struct<start:long,end:long>>, kept_text string"

_hashes = WordHashes()


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper half, the lower half of the hash below it."""
    return ((hashes >> HALF) % np.uint64(buckets) << HALF) | (hashes & LOW)


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a non-empty ordered array."""
    return np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0]


def found_in(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values an ordered array has, and where."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def _words(table: pa.Table) -> list[tuple[int | None, list[bytes]]]:
    return list(zip(table["doc_id"].to_pylist(), map(bytes.split, text_bytes(table["text"]))))


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *parts])


def _blocks(table: pa.Table, buckets: int) -> pa.Table:
    """The distinct rolling hashes of a group, by bucket; marks: 1 a block, 2 in two documents."""
    hashes, owners, aligned = [], [], []
    for k, (doc_id, words) in enumerate(_words(table)):
        if doc_id is not None and len(words) >= WINDOW:
            rolled = bucketed(rolling(_hashes.of(words), BLOCK), buckets)
            hashes.append(rolled)
            owners.append(np.full(len(rolled), k, np.int32))
            aligned.append(np.arange(len(rolled)) % BLOCK == 0)
    every = _joined(hashes, np.uint64)
    out: dict[str, list] = {"grp": [], "bucket": [], "hashes": [], "marks": []}
    if len(every):
        order = np.argsort(every, kind="stable")
        every, owner = every[order], _joined(owners, np.int32)[order]
        first = runs(every)
        # The order is stable, so the first and last of a run differ if any two do.
        last = np.append(first[1:], len(every)) - 1
        several = owner[first] != owner[last]
        marks = np.maximum.reduceat(_joined(aligned, bool)[order].astype(np.uint8), first)
        marks |= several.astype(np.uint8) << 1
        _by_bucket(out, table["grp"][0].as_py(), every[first], lambda a, b: {"marks": marks[a:b]})
    return pa.table(out, _arrow(BLOBS))


def _by_bucket(out: dict, group: int, keys: np.ndarray, more) -> None:
    """Rows of one group, one for each bucket of ordered keys."""
    bucket = (keys >> HALF).astype(np.int64)
    edges = runs(bucket) if len(bucket) else np.empty(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(keys))):
        out["grp"].append(group)
        out["bucket"].append(int(bucket[a]))
        columns = {"hashes": (keys[a:b] & LOW).astype(np.uint32), **more(a, b)}
        for name, values in columns.items():
            out[name].append(values.tobytes())


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in ddl.split(", "))])


def _arrays(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _shared_blocks(table: pa.Table) -> pa.Table:
    """Of one bucket: which hashes of each group are anchors."""
    hashes, marks = _arrays(table["hashes"], np.uint32), _arrays(table["marks"], np.uint8)
    row = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    every, mark = np.concatenate(hashes), np.concatenate(marks)
    order = np.argsort(every, kind="stable")
    first = runs(every[order])
    size = np.diff(first, append=len(every))
    any_mark = np.bitwise_or.reduceat(mark[order], first)
    anchor = np.repeat(((any_mark & 1) > 0) & ((size > 1) | (any_mark > 1)), size)
    hit = order[anchor]
    hit.sort()
    out: dict[str, list] = {"grp": [], "bucket": [], "hashes": []}
    groups, bucket = table["grp"].to_pylist(), table["bucket"][0].as_py()
    edges = np.searchsorted(row[hit], np.arange(len(hashes) + 1))
    for k, group in enumerate(groups):
        if edges[k] < edges[k + 1]:
            out["grp"].append(group)
            out["bucket"].append(bucket)
            out["hashes"].append(every[hit[edges[k] : edges[k + 1]]].tobytes())
    return pa.table(out, _arrow("grp int, bucket int, hashes binary"))


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Bucketed hashes of all replies to a group, and the order that sorts them."""
    parts = [
        (np.uint64(bucket) << HALF) | hashes.astype(np.uint64)
        for bucket, hashes in zip(table["bucket"].to_pylist(), _arrays(table["hashes"], np.uint32))
    ]
    keys = _joined(parts, np.uint64)
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def _candidates(table: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """The distinct windows around anchors of a group, with the smallest identifier; mark 1: two have it."""
    anchors, _ = _keys(replies)
    hashes, ids = [], []
    for doc_id, words in _words(table) if len(anchors) else []:
        if doc_id is None or len(words) < WINDOW:
            continue
        values = _hashes.of(words)
        hit, _ = found_in(bucketed(rolling(values, BLOCK), buckets), anchors)
        if not hit.any():
            continue
        upto = np.concatenate([[0], np.cumsum(hit)])
        near = upto[BLOCK:] > upto[:-BLOCK]
        windows = rolling(values, WINDOW)[near]
        hashes.append(windows)
        ids.append(np.full(len(windows), doc_id, np.int64))
    every, ids = _joined(hashes, np.uint64), _joined(ids, np.int64)
    out: dict[str, list] = {"grp": [], "bucket": [], "hashes": [], "least": [], "marks": []}
    if len(every):
        order = np.lexsort((ids, every))
        every, ids = every[order], ids[order]
        first = runs(every)
        several = ids[first] != ids[np.append(first[1:], len(every)) - 1]
        every, ids, marks = every[first], ids[first], several.astype(np.uint8)
        bucket = (every % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        group = table["grp"][0].as_py()
        for b in np.unique(bucket):
            here = order[edges[b] : edges[b + 1]]
            out["grp"].append(group)
            out["bucket"].append(int(b))
            out["hashes"].append(every[here].tobytes())
            out["least"].append(ids[here].tobytes())
            out["marks"].append(marks[here].tobytes())
    return pa.table(out, _arrow(WINDOWS))


def _shared_windows(table: pa.Table) -> pa.Table:
    """Of one bucket: for each group, the windows that a smaller identifier has."""
    hashes, least = _arrays(table["hashes"], np.uint64), _arrays(table["least"], np.int64)
    marks = np.concatenate(_arrays(table["marks"], np.uint8))
    row = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    every, own = np.concatenate(hashes), np.concatenate(least)
    order = np.argsort(every, kind="stable")
    first = runs(every[order])
    size = np.diff(first, append=len(every))
    lowest = np.empty(len(every), np.int64)
    lowest[order] = np.repeat(np.minimum.reduceat(own[order], first), size)
    told = (lowest < own) | (marks > 0)
    edges = np.searchsorted(row, np.arange(len(hashes) + 1))
    out: dict[str, list] = {"grp": [], "hashes": [], "least": []}
    for k, group in enumerate(table["grp"].to_pylist()):
        here = slice(edges[k], edges[k + 1])
        if told[here].any():
            out["grp"].append(group)
            out["hashes"].append(every[here][told[here]].tobytes())
            out["least"].append(lowest[here][told[here]].tobytes())
    return pa.table(out, _arrow("grp int, hashes binary, least binary"))


def _cut(table: pa.Table, replies: pa.Table) -> pa.Table:
    """Documents of a group without their repeats."""
    windows = _joined(_arrays(replies["hashes"], np.uint64), np.uint64)
    least = _joined(_arrays(replies["least"], np.int64), np.int64)
    order = np.argsort(windows, kind="stable")
    windows, least = windows[order], least[order]
    rows = []
    for doc_id, words in _words(table):
        spans: list[tuple[int, int]] = []
        if doc_id is not None and len(words) >= WINDOW and len(windows):
            hit, at = found_in(rolling(_hashes.of(words), WINDOW), windows)
            starts = np.nonzero(hit & (least[at] < doc_id))[0]
            if len(starts):
                breaks = np.nonzero(np.diff(starts) > WINDOW)[0]
                begins = starts[np.concatenate([[0], breaks + 1])]
                ends = starts[np.append(breaks, len(starts) - 1)] + WINDOW
                spans = list(zip(begins.tolist(), ends.tolist()))
        kept, before = [], 0
        for start, end in spans:
            kept += words[before:start]
            before = end
        kept += words[before:]
        rows.append((doc_id, len(words), len(words) - len(kept), spans, b" ".join(kept)))
    ids, counts, removed, spans, texts = zip(*rows)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "repeats": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(span)),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        }
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: word counts, the removed spans of words, the kept words as text."""
    rows = max(1, docs.count())
    groups, buckets = -(-rows // GROUP_ROWS), -(-rows // BUCKET_ROWS)
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("grp")
    texts = plain_texts(docs)
    texts = texts.select(texts["doc_id"].cast("long").alias("doc_id"), "text", group)
    blocks = texts.groupBy("grp").applyInArrow(lambda t: _blocks(t, buckets), BLOBS)
    anchors = blocks.groupBy("bucket").applyInArrow(
        _shared_blocks, "grp int, bucket int, hashes binary"
    )

    def candidates(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: [] for n in _arrow(WINDOWS).names}, _arrow(WINDOWS))
        return _candidates(table, replies, buckets)

    windows = texts.groupBy("grp").cogroup(anchors.groupBy("grp")).applyInArrow(candidates, WINDOWS)
    shared = windows.groupBy("bucket").applyInArrow(
        _shared_windows, "grp int, hashes binary, least binary"
    )
    return texts.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_cut, KEPT)
