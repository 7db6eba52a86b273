"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the
last by the assistant. Dynamic programming over the automaton of these rules chooses, for every
turn, to keep it, to give it another role, to merge it into the turn before, or to put an empty
turn before it; empty turns complete the end. The sum of costs is least; among equal sums fewer
empty turns win, then fewer merges, then the order of ``ACTIONS``.

Turns are range-partitioned by conversation and turn, so a conversation with a third of all rows is
spread over many partitions. Each partition sums its first and last stretch up in a 4 x 4 matrix of
least costs, from state to state; chaining these (two for each partition at most, on the driver)
fixes the state in which every stretch begins and ends, and then each partition repairs its own
stretches.

The result has a row for each given turn and each inserted one. ``rendered``, concatenated by
``seq``, is the conversation's text: a turn opens with ``<|im_start|>role`` and a line feed, and
closes with ``<|im_end|>`` and a line feed.

Edge cases: rows equal in ``conv_id, turn, role, text`` are one turn; turns of equal number are
ordered by role and text, null numbers come last; rows of null ``conv_id`` are one conversation; a
null text is empty; a null or unknown role fits any at a small cost; ``<|`` in a text is rendered
as ``< |``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.sources.workspace import materialize

ROLES = (None, "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Turns that may follow each state.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ACTIONS = ("keep", "merge", "relabel")
MERGE_COST, INSERT_COST, RELABEL_COST, NAME_COST = 1, 2, 3, 1
#: A sum of costs, numbers of inserted turns and of merges, in one integer.
UNIT = 1 << 40
COST, INSERTED, MERGED = UNIT * UNIT, UNIT, 1
RESULT = (
    "conv_id long, seq long, position long, role string, action string, text string, rendered string"
)


def _label(role: int, given: int) -> int:
    return 0 if role == given else NAME_COST if given == START else RELABEL_COST


def _options() -> dict[tuple[int, int], list[tuple[int, int, str, int | None]]]:
    """For state and given role: value, next state, action, role of an empty turn put before."""
    table = {}
    for state in STATES:
        for given in STATES:
            found = []
            for role in (SYSTEM, USER, ASSISTANT):
                value = COST * _label(role, given)
                action = "keep" if role == given else "relabel"
                if role in LEGAL[state]:
                    found.append((value, role, action, None))
                for empty in LEGAL[state]:
                    if role in LEGAL[empty]:
                        found.append((value + COST * INSERT_COST + INSERTED, role, action, empty))
            if state != START:
                value = COST * (MERGE_COST + _label(state, given)) + MERGED
                found.append((value, state, "merge", None))
            best: dict[int, tuple] = {}
            for option in sorted(found, key=lambda o: (o[0], ACTIONS.index(o[2]))):
                best.setdefault(option[1], option)
            table[state, given] = list(best.values())
    return table


OPTIONS = _options()
#: Empty turns that complete a conversation.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
CLOSE = [(COST * INSERT_COST + INSERTED) * len(CLOSING[s]) for s in STATES]

Vector = list[int | None]


def _step(vector: Vector, given: int) -> tuple[Vector, list[tuple[int, tuple] | None]]:
    """Values after one more turn, and for each state whence and by which option it is reached."""
    after: Vector = [None] * 4
    whence: list[tuple[int, tuple] | None] = [None] * 4
    for state in STATES:
        if vector[state] is None:
            continue
        for option in OPTIONS[state, given]:
            value, to = vector[state] + option[0], option[1]
            if after[to] is None or value < after[to]:
                after[to], whence[to] = value, (state, option)
    return after, whence


def entry(state: int) -> Vector:
    return [0 if s == state else None for s in STATES]


def transfer(roles: list[int]) -> list[Vector]:
    """Least values of a stretch of turns, by state before and state after."""
    rows = [entry(s) for s in STATES]
    for given in roles:
        rows = [_step(row, given)[0] for row in rows]
    return rows


def best_path(roles: list[int], first: int, last: int | None) -> tuple[list[tuple], int]:
    """The options of least value from a state to another (None: to the end), and the end state."""
    vector, steps = entry(first), []
    for given in roles:
        vector, whence = _step(vector, given)
        steps.append(whence)
    if last is None:
        open_ends = [(v + CLOSE[s], s) for s, v in enumerate(vector) if v is not None]
        last = min(open_ends)[1]
    path, state = [], last
    for whence in reversed(steps):
        state, option = whence[state]
        path.append(option)
    return path[::-1], last


def chain_stretches(matrices: list[list[Vector]]) -> list[tuple[int, int, int]]:
    """For the stretches of one conversation: state before, state after, value before."""
    vectors = [entry(START)]
    for matrix in matrices:
        sums = [
            [v + matrix[s][to] for s, v in enumerate(vectors[-1]) if v is not None and matrix[s][to] is not None]
            for to in STATES
        ]
        vectors.append([min(x) if x else None for x in sums])
    state = min((v + CLOSE[s], s) for s, v in enumerate(vectors[-1]) if v is not None)[1]
    found = []
    for matrix, vector in zip(reversed(matrices), reversed(vectors[:-1])):
        before = min(
            (v + matrix[s][state], s)
            for s, v in enumerate(vector)
            if v is not None and matrix[s][state] is not None
        )[1]
        found.append((before, state, vector[before]))
        state = before
    return found[::-1]


def _role(name: str | None) -> int:
    return ROLES.index(name) if name in ROLES else START


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[tuple]]]:
    """Consecutive rows of one partition number and conversation."""
    current, rows = None, []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("part", "conv_id", "role", "text")]
        for part, conv, role, text in zip(*columns):
            if (part, conv) != current:
                if rows:
                    yield *current, rows
                current, rows = (part, conv), []
            rows.append((role, text))
    if rows:
        yield *current, rows


def _sums(batches: Iterable[pa.RecordBatch], shared: set) -> Iterator[pa.RecordBatch]:
    for part, conv, rows in _stretches(batches):
        if (part, conv) not in shared:
            continue
        matrix = transfer([_role(role) for role, _ in rows])
        text = ";".join(",".join("" if v is None else str(v) for v in row) for row in matrix)
        yield pa.record_batch(
            {
                "part": pa.array([part], pa.int32()),
                "conv_id": pa.array([conv], pa.int64()),
                "n": pa.array([len(rows)], pa.int64()),
                "matrix": pa.array([text], pa.string()),
            }
        )


def _repair(batches: Iterable[pa.RecordBatch], plan: dict) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def packed() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4)
        names = ("conv_id", "seq", "position", "role", "action", "text", "rendered")
        columns = list(zip(*rows)) or [[]] * len(names)
        rows.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for part, conv, turns in _stretches(batches):
        first, last, seq, position, final = plan.get((part, conv), (START, None, 0, -1, True))
        path, end = best_path([_role(role) for role, _ in turns], first, last)
        todo: list[tuple[int, str, str]] = []
        for (_, to, action, empty), (_, text) in zip(path, turns):
            if empty is not None:
                todo.append((empty, "insert", ""))
            todo.append((to, action, text))
        if final:
            todo += [(role, "insert", "") for role in CLOSING[end]]
        for k, (role, action, text) in enumerate(todo):
            safe = text.replace("<|", "< |")
            if action == "merge":
                shown = f"\n{safe}"
            else:
                position += 1
                shown = f"{'<|im_end|>\n' if position else ''}<|im_start|>{ROLES[role]}\n{safe}"
            if final and k == len(todo) - 1:
                shown += "<|im_end|>\n"
            rows.append((conv, seq, position, ROLES[role], action, text, shown))
            seq += 1
            if len(rows) >= 5000:
                yield packed()
    if rows:
        yield packed()


def _plan(sums: DataFrame) -> dict:
    """Where the stretches of conversations on several partitions begin and end.

    ``sums`` has two rows for each partition at most.
    """
    stretches: dict = {}
    for row in sums.orderBy("part").collect():
        matrix = [[int(v) if v else None for v in line.split(",")] for line in row.matrix.split(";")]
        stretches.setdefault(row.conv_id, []).append((row.part, row.n, matrix))
    plan = {}
    for conv, parts in stretches.items():
        rows_before = 0
        for (part, n, _), (first, last, value) in zip(parts, chain_stretches([m for *_, m in parts])):
            inserted, merged = value // INSERTED % UNIT, value % UNIT
            turns = rows_before + inserted - merged
            final = part == parts[-1][0]
            plan[part, conv] = (first, last, rows_before + inserted, turns - 1, final)
            rows_before += n
    return plan


def format_chats(turns: DataFrame) -> DataFrame:
    """Repaired and rendered turns of ``conv_id, turn, role, text``."""
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        "role",
        F.coalesce(turns["text"], F.lit("")).alias("text"),
    ).distinct()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored, _ = materialize(dealt.withColumn("part", F.spark_partition_id()), "turns")
    spread = (
        stored.groupBy("conv_id")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low < high")
        .collect()
    )
    shared = {(p, r.conv_id) for r in spread for p in range(r.low, r.high + 1)}
    again = stored.repartition("part").sortWithinPartitions("part", *order)
    again = again.select("part", "conv_id", "role", "text")
    schema = "part int, conv_id long, n long, matrix string"
    plan = _plan(again.mapInArrow(lambda b: _sums(b, shared), schema)) if shared else {}
    return again.mapInArrow(lambda b: _repair(b, plan), RESULT)
