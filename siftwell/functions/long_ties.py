"""Ranks of long texts by their value, where counts tie and their starts are equal.

Frequency tables hold the first ``START_CHARACTERS`` of a long text and its digest, which orders most
texts by value. Where texts of equal count share that start and compete for a place, the next pieces of
just these texts decide, each twice as far into the text as the last: pieces are counted by text, ranked,
and only texts that still agree go on to the next round. No shuffle carries more of a text than two of
them have in common, about; the driver holds at most ``k`` keys and digests a column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.functions.columns import sql_name
from siftwell.functions.frequency import START_CHARACTERS, full_text, key_text, may_be_long

RANKED = "col_id int, num bigint, real double, txt string, freq bigint, rank int"


@dataclass
class Tied:
    """Texts of a column with equal counts whose first characters have a digest."""

    col_id: int
    freq: int
    digest: str
    places: int
    #: In order of value: keys of single texts, and texts that still agree.
    order: list[str | Tied] = field(default_factory=list)

    def keys(self) -> list[str]:
        found = []
        for entry in self.order:
            found += [entry] if isinstance(entry, str) else entry.keys()
        return found[: self.places]


def _next_pieces(df: DataFrame, fields: Sequence[T.StructField], tied: Sequence[Tied], length: int) -> DataFrame:
    """For each group of ``tied`` texts, whose first ``length`` characters agree, their least pieces.

    ``members`` is the number of texts that share a piece, ``key`` one of them, ``digest`` that of all
    characters up to the end of the piece.
    """
    rows = [(no, t.col_id, t.freq, t.digest, t.places) for no, t in enumerate(tied)]
    # At most as many rows as the report has.
    groups = F.broadcast(
        df.sparkSession.createDataFrame(rows, "no int, id int, n bigint, start string, places int")
    )
    ids = sorted({t.col_id for t in tied})
    cells = ", ".join(f"{i}, {full_text(sql_name(fields[i].name), fields[i].dataType)}" for i in ids)
    texts = (
        df.selectExpr(f"stack({len(ids)}, {cells}) AS (col_id, full)")
        .where(F.char_length("full") >= length)
        .withColumn("head", F.sha2(F.substring("full", 1, length), 256))
    )
    members = (
        texts.join(groups, (F.col("col_id") == F.col("id")) & (F.col("head") == F.col("start")))
        .select(
            "no",
            "n",
            "places",
            F.expr(key_text("full")).alias("key"),
            F.substring("full", length + 1, length).alias("piece"),
            F.sha2(F.substring("full", 1, 2 * length), 256).alias("digest"),
        )
        .groupBy("no", "n", "places", "key", "piece", "digest")
        .agg(F.count("*").alias("freq"))
        .where(F.col("freq") == F.col("n"))
    )
    pieces = members.groupBy("no", "places", "piece", "digest").agg(
        F.count("*").alias("members"), F.min("key").alias("key")
    )
    window = Window.partitionBy("no").orderBy("piece")
    most = max(t.places for t in tied)
    ranked = pieces.withColumn("place", F.row_number().over(window)).where(F.col("place") <= most)
    return ranked.where(F.col("place") <= F.col("places")).drop("piece", "places")


def _resolve(df: DataFrame, fields: Sequence[T.StructField], tied: list[Tied]) -> None:
    length = START_CHARACTERS
    while tied:
        further = []
        found = sorted(_next_pieces(df, fields, tied, length).collect(), key=lambda r: (r["no"], r["place"]))
        for no, pieces in groupby(found, key=lambda r: r["no"]):
            group = tied[no]
            left = group.places
            for piece in pieces:
                if left <= 0:
                    break
                if piece["members"] == 1:
                    group.order.append(piece["key"])
                else:
                    same = Tied(group.col_id, group.freq, piece["digest"], min(left, piece["members"]))
                    group.order.append(same)
                    further.append(same)
                left -= piece["members"]
        tied, length = further, 2 * length


def ranked_by_value(ranked: DataFrame, k: int, df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The top ``k`` values of a column in order of count and value, from its top ``k + 1`` by key.

    ``ranked`` has the rows of :func:`siftwell.functions.frequency.top_values` for ``k + 1``. Runs at
    once; the table is read again only if long texts compete for a place, and then as often as
    their common start doubles. Null texts are no values; an empty table gives no rows.
    """
    rows = sorted(ranked.collect(), key=lambda r: (r["col_id"], r["rank"]))

    def start(row: Row):
        # Rows without text never tie.
        text = row["txt"]
        return (row["col_id"], row["freq"], row["rank"] if text is None else text[:START_CHARACTERS])

    groups: list[tuple[list[Row], Tied | None]] = []
    for (i, freq, begin), members in groupby(rows, key=start):
        members = list(members)
        places = k + 1 - members[0]["rank"]
        tie = None
        competing = len(members) > 1 and places > 0 and may_be_long(fields[i].dataType)
        if competing and any(len(m["txt"]) > START_CHARACTERS for m in members):
            digest = hashlib.sha256(begin.encode()).hexdigest()
            tie = Tied(i, freq, digest, min(places, len(members)))
        groups.append((members, tie))
    _resolve(df, fields, [t for _, t in groups if t])
    result = []
    for members, tie in groups:
        keys = [m["txt"] for m in members]
        if tie:
            found = tie.keys()
            keys = found if len(found) == tie.places else keys
        for m, key in zip(members, keys):
            result.append((m["col_id"], m["num"], m["real"], key, m["freq"], m["rank"]))
    return df.sparkSession.createDataFrame([r for r in result if r[5] <= k], RANKED)
