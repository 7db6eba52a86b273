"""Secret scans with linking of multipart credentials.

Base spans are matches of three fixed rules. Beyond these, a credential often comes in parts, none
of which is telling alone: an identifier (a user name, an access key), a secret (a password the
base rules leave, a bare token of 40 characters) and an endpoint (an address, a host). Weak candidates of each kind
are joined by interval within a scope, which is the paragraph around a part, ``REACH`` code points
to either side at most. A weak secret is reported when an identifier lies in its scope, a weak
identifier when a secret does, an endpoint when both do; base spans count as parts too. The join
is by binary search over the sorted parts of one document, so a document with many parts costs no
more than sorting them. Every rule reads a text in time linear in its length.

Offsets are code points, ends are exclusive. Edge cases: a null or empty text has no spans (the
hash is that of the empty string); a weak candidate that overlaps a base span is not reported, the
base span stays; equal rows get equal results; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.frames import map_rows, plain_texts

KINDS = ("assign", "access", "hex", "id", "secret", "endpoint")
BASE_KINDS = KINDS[:3]
#: Code points to either side of a part within which others can complete it.
REACH = 200

# The rules of the base spans.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# The rules of the weak candidates; the last group is the part. Keywords may end a
# longer name (``DB_USER``); an access key named secret is a secret.
WEAK_ID = re.compile(
    r"""(?i:user(?:name|_?id)?|login|account|client_?id|(?<!secret)(?<!secret_)access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.ASCII,
)
WEAK_SECRETS = (
    re.compile(
        r"""(?i:pass(?:word|wd|phrase)?|pwd|secret(?:_?(?:access_?)?key)?|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""",
        re.ASCII,
    ),
    re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/]{40})(?![A-Za-z0-9+/=_-])", re.ASCII),
)
WEAK_HOST = re.compile(
    r"""(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]{4,}(?::[0-9]+)?)""",
    re.ASCII,
)
# What follows the scheme of an address, and a scheme read backwards from there.
ADDRESS = re.compile(r"""://[^\s"'<>]+""", re.ASCII)
SCHEME = re.compile(r"[A-Za-z0-9+.-]*", re.ASCII)
SCHEME_START = re.compile(r"\b[A-Za-z]", re.ASCII)
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost matches of each base rule; an assignment to fewer than 12 characters is dropped.

    The other two rules take maximal runs, so their least length can be part of the pattern.
    """
    assigned: list[Span] = []
    if ":" in text or "=" in text:
        found = ASSIGN.finditer(text)
        assigned = [m.span() for m in found if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    access = [m.span() for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return {"assign": assigned, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def addresses(text: str) -> list[Span]:
    """Addresses with their scheme, each character read a bounded number of times.

    Searching for schemes first would read a long dotted run from each of its words to its end.
    """
    found: list[Span] = []
    done, at = 0, text.find("://")
    while at >= 0:
        back, step = at, 64
        while back > done:
            piece = text[max(done, back - step) : back]
            run = len(SCHEME.match(piece[::-1])[0])
            back -= run
            if run < len(piece):
                break
            step *= 2
        start = SCHEME_START.search(text, back, at)
        done = at + 3
        # What follows is read only where a scheme was found, and then never again.
        if start and (rest := ADDRESS.match(text, at)):
            found.append((start.start(), rest.end()))
            done = rest.end()
        at = text.find("://", done)
    return found


class Intervals:
    """Spans ordered by start, to ask whether one lies within limits."""

    def __init__(self, spans: Iterable[Span]):
        ordered = sorted(spans)
        self.starts = [a for a, _ in ordered]
        self.least_end = [b for _, b in ordered]
        for i in range(len(ordered) - 2, -1, -1):
            self.least_end[i] = min(self.least_end[i], self.least_end[i + 1])

    def within(self, low: int, high: int) -> bool:
        at = bisect_left(self.starts, low)
        return at < len(self.starts) and self.least_end[at] <= high


def _clear_of(spans: Iterable[Span], taken: list[Span]) -> list[Span]:
    """Spans that overlap none of ``taken``."""
    ordered = sorted(taken)
    starts, furthest = [a for a, _ in ordered], [b for _, b in ordered]
    for i in range(1, len(furthest)):
        furthest[i] = max(furthest[i], furthest[i - 1])
    kept = []
    for a, b in spans:
        before = bisect_left(starts, b)
        if not before or furthest[before - 1] <= a:
            kept.append((a, b))
    return kept


def linked_spans(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Weak candidates whose complementary parts lie in their scope."""
    none: dict[str, list[Span]] = {"id": [], "secret": [], "endpoint": []}
    if not base["access"] and ":" not in text and "=" not in text:
        return none
    taken = [span for spans in base.values() for span in spans]
    names = _clear_of((m.span(1) for m in WEAK_ID.finditer(text)), taken)
    if not names and not base["access"]:
        return none
    keys: list[Span] = []
    for rule in WEAK_SECRETS:
        keys += _clear_of((m.span(1) for m in rule.finditer(text)), taken + names + keys)
    keys.sort()
    if not keys and not base["assign"] and not base["hex"]:
        return none
    breaks = [m.start() for m in BLANK_LINE.finditer(text)]
    identifiers = Intervals(names + base["access"])
    secrets = Intervals(keys + base["assign"] + base["hex"])

    def scope(span: Span) -> Span:
        at = bisect_right(breaks, span[0])
        low = breaks[at - 1] if at else 0
        high = breaks[at] if at < len(breaks) else len(text)
        return max(low, span[0] - REACH), min(high, span[1] + REACH)

    places = {*addresses(text), *(m.span(1) for m in WEAK_HOST.finditer(text))}
    places = sorted(_clear_of(places, taken + names + keys))
    return {
        "id": [s for s in names if secrets.within(*scope(s))],
        "secret": [s for s in keys if identifiers.within(*scope(s))],
        "endpoint": [
            s for s in places if identifiers.within(*scope(s)) and secrets.within(*scope(s))
        ],
    }


def joined_spans(spans: dict[str, list[Span]], kinds: Iterable[str]) -> str:
    """``kind:start:end`` by start, then by kind in the given order."""
    rows = [(a, rank, b, kind) for rank, kind in enumerate(kinds) for a, b in spans[kind]]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(rows))


def _scan_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts: list[list[int]] = [[] for _ in BASE_KINDS]
    hashes, texts = [], []
    for text in batch["text"].to_pylist():
        spans = base_spans(text)
        for column, kind in zip(counts, BASE_KINDS):
            column.append(len(spans[kind]))
        hashes.append(hashlib.sha256(joined_spans(spans, BASE_KINDS).encode()).hexdigest())
        texts.append(joined_spans({**spans, **linked_spans(text, spans)}, KINDS))
    return pa.record_batch(
        {
            "doc_id": batch["doc_id"].cast(pa.int64()),
            **{f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(BASE_KINDS, counts)},
            "base_sha256": pa.array(hashes, pa.string()),
            "spans": pa.array(texts, pa.string()),
        }
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their hash, and all spans as text."""
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
    return map_rows(plain_texts(docs), _scan_batch, schema)
