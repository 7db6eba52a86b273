"""Exact duplicates by compressed radix tries.

Texts are dealt out by length and content hash. Each partition inserts the full byte strings into
a Patricia trie, whose terminal nodes hold the owner (the largest identifier) and the number of
rows. Before the shuffle every task merges its own copies in such a trie, so a text on a third of
all rows is sent once per task. A trie over its memory budget spills its heaviest subtrees, as
rows that the next stage merges; nothing is written to local files.

Edge cases: a null text is the empty text; a null ``doc_id`` is smaller than any other, so it owns
only groups without other identifiers; of rows equal in text and ``doc_id`` one stays; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import owned_rows, plain_texts, text_bytes

PARTIAL = "n_bytes int, content long, body binary, keep_id long, members long"
OWNERS = "text_sha256 string, keep_id long, group_size long"


class Node:
    __slots__ = ("children", "content", "keep", "label", "members")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.keep: int | None = None
        self.members = 0
        self.content = 0


def shared_length(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` agree with ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class Trie:
    """Compressed radix trie over byte strings."""

    #: Bytes counted for a node besides its label.
    OVERHEAD = 300

    def __init__(self):
        self.root = Node(b"")
        self.held = 0

    def insert(self, text: bytes, keep: int | None, members: int, content: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.held += len(text) - at + self.OVERHEAD
            elif not text.startswith(child.label, at):
                cut = shared_length(child.label, text, at)
                fork = Node(child.label[:cut])
                child.label = child.label[cut:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = child = fork
                self.held += self.OVERHEAD
            node, at = child, at + len(child.label)
        node.keep = larger(node.keep, keep) if node.members else keep
        node.members += members
        node.content = content

    def drain(self, key: int | None = None) -> Iterator[tuple[bytes, Node]]:
        """Remove the subtree below a first byte (all, if None); yields texts and terminals."""
        if key is None:
            stack, self.root, self.held = [(self.root, b"")], Node(b""), 0
        else:
            stack = [(self.root.children.pop(key), b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if key is not None:
                self.held -= len(node.label) + self.OVERHEAD
            if node.members:
                yield text, node
            stack += [(child, text) for child in node.children.values()]

    def heaviest(self) -> int | None:
        """First byte of the subtree with most bytes; None if only the root is left."""

        def weight(node: Node) -> int:
            total, stack = 0, [node]
            while stack:
                node = stack.pop()
                total += len(node.label) + self.OVERHEAD
                stack += node.children.values()
            return total

        children = self.root.children
        return max(children, key=lambda k: weight(children[k])) if children else None


def local_owners(batches: Iterable[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Merge the copies within a task; over ``budget`` bytes subtrees are sent on."""
    trie = Trie()

    def packed(found: list[tuple[bytes, Node]]) -> pa.RecordBatch:
        return pa.record_batch(
            {
                "n_bytes": pa.array([len(body) for body, _ in found], pa.int32()),
                "content": pa.array([node.content for _, node in found], pa.int64()),
                "body": pa.array([body for body, _ in found], pa.binary()),
                "keep_id": pa.array([node.keep for _, node in found], pa.int64()),
                "members": pa.array([node.members for _, node in found], pa.int64()),
            }
        )

    for batch in batches:
        bodies, contents = text_bytes(batch["text"]), batch["content"].to_pylist()
        for body, content, doc_id in zip(bodies, contents, batch["doc_id"].to_pylist()):
            trie.insert(body, doc_id, 1, content)
            while trie.held > budget and (key := trie.heaviest()) is not None:
                yield from map(packed, batched(trie.drain(key), 500))
    yield from map(packed, batched(trie.drain(), 500))


def final_owners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners of texts that arrive ordered by length and hash; a trie serves one key at a time."""
    trie, current = Trie(), None

    def packed() -> pa.RecordBatch:
        return pa.record_batch(
            {
                "text_sha256": pa.array([hashlib.sha256(body).hexdigest() for body, _ in found]),
                "keep_id": pa.array([node.keep for _, node in found], pa.int64()),
                "group_size": pa.array([node.members for _, node in found], pa.int64()),
            }
        )

    found: list[tuple[bytes, Node]] = []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("n_bytes", "content", "body", "keep_id", "members")]
        for n_bytes, content, body, keep, members in zip(*columns):
            if (n_bytes, content) != current:
                found += trie.drain()
                current = (n_bytes, content)
            trie.insert(body, keep, members, content)
        if found:
            yield packed()
            found = []
    found += trie.drain()
    if found:
        yield packed()


def text_owners(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """One row per distinct text: its hash, the identifier that stays, its number of rows."""
    texts = plain_texts(docs).withColumn("content", F.xxhash64("text"))
    partial = texts.mapInArrow(lambda batches: local_owners(batches, budget), PARTIAL)
    keys = ("n_bytes", "content")
    return (
        partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final_owners, OWNERS)
    )


def exact_groups(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = (
        plain_texts(docs)
        .select("doc_id", F.sha2("text", 256).alias("text_sha256"))
        .groupBy("doc_id", "text_sha256")
        .count()
    )
    joined = rows.join(text_owners(docs, budget), "text_sha256")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("nth"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """The documents that own their text, all columns kept."""
    return owned_rows(docs, text_owners(docs, budget))
