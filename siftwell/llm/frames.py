"""Shared pieces: plain document columns, Arrow batch mapping, words, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space of every word rule here: space, tab, line feed, vertical tab, form feed, return.
#: ``bytes.split`` without arguments cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def plain_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text becomes the empty text."""
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column without nulls."""
    return column.cast(pa.binary()).to_pylist()


def map_rows(
    frame: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table],
    schema: str,
    rows: int = 2000,
) -> DataFrame:
    """Apply a batch function in pieces of at most ``rows`` rows, so that memory stays small."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                found = function(batch.slice(start, rows))
                if isinstance(found, pa.Table):
                    yield from found.combine_chunks().to_batches()
                else:
                    yield found

    return frame.mapInArrow(run, schema)


def own_columns(docs: DataFrame, struct: str = "d") -> list[Column]:
    """The columns of ``docs`` out of a struct that holds them all."""
    return [F.col(f"{struct}.`{c.replace('`', '``')}`") for c in docs.columns]


def owned_rows(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``keep_id`` and ``text_sha256``, one for each name.

    Of rows that share identifier and text, the first by the remaining columns stays (columns with
    maps, which have no order, by their JSON). Join and ranking use the same three keys, so that
    rows are shuffled once.
    """
    names = ("sha", "key", "none")
    marked = docs.select(
        F.struct("*").alias("d"),
        F.sha2(F.coalesce(docs["text"], F.lit("")), 256).alias("sha"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("key"),
        docs["doc_id"].isNull().alias("none"),
    )
    named = keepers.select(
        F.col("text_sha256").alias("sha"),
        F.coalesce(F.col("keep_id").cast("long"), F.lit(0)).alias("key"),
        F.col("keep_id").isNull().alias("none"),
    )
    order = [
        F.to_json(F.struct(c.alias("m"))) if "map<" in kind else c
        for c, (_, kind) in zip(own_columns(docs), docs.dtypes)
    ]
    first = Window.partitionBy(*names).orderBy(*order)
    found = marked.join(named, list(names)).withColumn("nth", F.row_number().over(first))
    return found.where("nth = 1").select(*own_columns(docs))


class WordHashes(dict):
    """64-bit hash of each word, remembered; forgets all beyond ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 0)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= base
        total += hashes[k : k + n]
    return mix64(total)
