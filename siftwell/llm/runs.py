"""Periodic runs of words: suffix automaton with link-cut access.

A run is a longest stretch of words with smallest period ``q`` that holds at least two periods.
The automaton of a stretch of words has a tree of suffix links, in which the states from a prefix
up to the root are the suffixes of that prefix. Link-cut paths colour each state with the place of
its last occurrence: appending word ``i`` accesses the state of the prefix that ends there, which
walks the coloured segments above it and recolours them all with ``i``. A segment holds the
suffixes of lengths ``low < length <= high`` that were last seen ending at ``j``; if the distance
``d = i - j`` lies in that range, the suffix of length ``d`` was last seen right before itself, so
a square of smallest period ``d`` ends here. The first square of a run is extended to the right,
to the run; its further squares are told by the end of the last run of their period. Accesses take
amortised logarithmic time, so a text of n words takes O(n log n), however it repeats.

Only words that can lie in a run reach the automaton: a run of at least ``least`` words and two
periods is covered by repeats of ``ceil(least / 2)`` words inside itself, so the words covered by
such repeats fall into stretches, each is cut again by its own repeats until nothing changes, and
every run lies wholly in one of them. Repeats are found by 64-bit hashes, whose collisions could
only add words; the automaton compares words themselves.

Edge cases: null, empty and short texts have no runs; a text is one task's row however long, and
takes some 0.7 kB of memory for each word that lies in a repeat; equal runs do not exist; equal rows
get equal results; an empty table gives an empty result; rows of a null ``doc_id`` are treated like
all others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.frames import WordHashes, map_rows, mix64, plain_texts, rolling, text_bytes

#: Least number of words of a run.
LEAST = 12

Run = tuple[int, int, int]


class SuffixAutomaton:
    """States of all stretches of a word sequence: longest length and suffix link of each."""

    def __init__(self, words: Sequence[int]):
        self.length, self.link = [0], [-1]
        #: The state of each prefix.
        self.prefix: list[int] = []
        length, link, nexts = self.length, self.link, [{}]
        last = 0
        for word in words:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            nexts.append({})
            at = last
            while at >= 0 and word not in nexts[at]:
                nexts[at][word] = new
                at = link[at]
            if at >= 0:
                found = nexts[at][word]
                if length[found] == length[at] + 1:
                    link[new] = found
                else:
                    copy = len(length)
                    length.append(length[at] + 1)
                    link.append(link[found])
                    nexts.append(nexts[found].copy())
                    link[found] = link[new] = copy
                    while at >= 0 and nexts[at].get(word) == found:
                        nexts[at][word] = copy
                        at = link[at]
            last = new
            self.prefix.append(new)


class LastSeen:
    """Link-cut paths over a fixed tree: where each state was last seen.

    All states of a preferred path share a colour, kept at the root of the path's splay tree. Splay
    trees are ordered by depth; ``up`` of such a root is the tree's parent of its topmost state.
    """

    def __init__(self, parents: Sequence[int]):
        n = len(parents)
        # State 0, the root of the tree, is never accessed; 0 means none.
        self.up = [max(p, 0) for p in parents]
        self.left, self.right = [0] * n, [0] * n
        self.colour = [0] * n

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree; the colour moves along."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner:
                if (left[g] == p) == (left[p] == x):
                    self._rotate(p, g)
                else:
                    self._rotate(x, p)
                self._rotate(x, up[x])
            else:
                self._rotate(x, p)

    def _rotate(self, x: int, p: int) -> None:
        up, left, right = self.up, self.left, self.right
        g = up[p]
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
            else:
                self.colour[x] = self.colour[p]
        else:
            self.colour[x] = self.colour[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved:
            up[moved] = p
        up[p] = x
        up[x] = g

    def access(self, state: int, colour: int) -> Iterator[tuple[int, int, int]]:
        """Recolour the path from ``state`` to the root.

        Gives, from below, the lowest state of each old segment, the state above its topmost one,
        and the old colour (0: never seen).
        """
        up, right = self.up, self.right
        below, at = 0, state
        while at:
            self._splay(at)
            seen, above = self.colour[at], up[at]
            lower = right[at]
            if lower:
                self.colour[lower] = seen
            right[at] = below
            if below:
                up[below] = at
            if seen:
                yield at, above, seen
            below, at = at, above
        self.colour[below] = colour


def runs_of_ids(words: Sequence[int], least: int = LEAST) -> list[Run]:
    """``start, length, period`` of all runs of at least ``least`` words, by start and period."""
    automaton = SuffixAutomaton(words)
    length, seen = automaton.length, LastSeen(automaton.link)
    ends: dict[int, int] = {}
    found = []
    n = len(words)
    for i, state in enumerate(automaton.prefix):
        # Colours count from 1, so that 0 is no place.
        for lowest, above, colour in seen.access(state, i + 1):
            period = i + 1 - colour
            if length[above] < period <= length[lowest] and ends.get(period, -1) < i:
                end = i
                while end + 1 < n and words[end + 1] == words[end + 1 - period]:
                    end += 1
                start = i - 2 * period + 1
                while start and words[start - 1] == words[start - 1 + period]:
                    start -= 1
                ends[period] = end
                if end - start + 1 >= least:
                    found.append((start, end - start + 1, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeated_stretches(hashes: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Cut places into stretches covered by repeats of ``width`` words within themselves.

    ``group`` numbers the texts, whose places are consecutive. Returns a number for each place, 0
    outside; every run of at least twice ``width`` words lies in one stretch.
    """
    places = np.arange(len(hashes))
    group = group.astype(np.int64) + 1
    while True:
        grams = rolling(hashes[places], width)
        own = group[places]
        n = len(grams)
        if not n:
            return np.zeros(len(hashes), np.int64)
        whole = (own[:n] == own[width - 1 :]) & (places[width - 1 :] - places[:n] == width - 1)
        starts = np.nonzero(whole)[0]
        key = grams[starts] ^ mix64(own[starts].astype(np.uint64))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        repeated = np.zeros(len(starts), bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        edges = np.zeros(len(places) + 1, np.int64)
        edges[starts[repeated]] += 1
        edges[starts[repeated] + width] -= 1
        covered = np.cumsum(edges[:-1]) > 0
        left = places[covered]
        breaks = np.ones(len(left), bool)
        breaks[1:] = (np.diff(left) > 1) | (np.diff(own[covered]) != 0)
        again = np.zeros(len(hashes), np.int64)
        again[left] = np.cumsum(breaks)
        if len(left) == len(places):
            return again
        places, group = left, again


def runs_of_texts(texts: list[list[bytes]], hashes: WordHashes, least: int = LEAST) -> list[list[Run]]:
    """Runs of each of several word sequences."""
    found: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(words) for words in texts], np.int64)
    group = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    values = np.concatenate([np.empty(0, np.uint64), *(hashes.of(words) for words in texts)])
    stretch = repeated_stretches(values, group, (least + 1) // 2)
    inside = np.nonzero(stretch)[0]
    cuts = np.nonzero(np.diff(stretch[inside]))[0] + 1
    for places in np.split(inside, cuts):
        if len(places) < least:
            continue
        text = int(group[places[0]])
        start = int(places[0] - first[text])
        numbers: dict[bytes, int] = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in texts[text][start : start + len(places)]]
        found[text] += [(start + s, length, period) for s, length, period in runs_of_ids(ids, least)]
    return found


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((s + q, s + n) for s, n, q in runs):
        kept += words[at : max(at, start)]
        at = max(at, end)
    return kept + words[at:]


SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, kept_text string"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, runs, kept_text``: runs by start and period, and the text with each run collapsed.

    Kept words are joined by one space.
    """

    hashes: list[WordHashes] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not hashes:
            hashes.append(WordHashes())
        texts = [t.split() for t in text_bytes(batch["text"])]
        found = runs_of_texts(texts, hashes[0], least)
        kept = [b" ".join(without_repeats(w, r) if r else w) for w, r in zip(texts, found)]
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "runs": pa.array(rows, pa.list_(kind)),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    return map_rows(plain_texts(docs), run, SCHEMA, 500)
