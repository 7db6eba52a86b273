"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is normalised as the model file says and searched from left to right. At each position the
search keeps the piece by which the best path arrives and where that piece began; only a window of
the longest piece's length can still matter. Whenever the paths of all positions in the window run
through one boundary, the ids before it are committed and forgotten, so memory does not grow with
the text.

For a unigram model the best path has the highest sum of scores. In a merge (BPE) model scores are
merge ranks whose sum means nothing; there a path survives if each piece may follow the one before
it, that is if merging the two pieces' text yields just these two. Exactly one such path reaches
each position, and it is the model's own encoding.

No piece of the usual models has the space mark inside, behind other characters; then every such
place is a boundary of all paths, and the committed ids of a stretch between two of them are
remembered (a bounded number), to be used again where it returns. Models with other pieces are
searched in one stretch. In a merge model the new stretches of many texts, of whatever length, are
searched side by side: one streaming search each, a vector operation for all.

Edge cases: null and empty texts have no ids and decode to the empty text; characters without a
piece become byte pieces, or the unknown id in models without these; decoding gives back the text
except for what normalisation changes (a space mark U+2581 in the text becomes a space) and for
unknown ids; equal texts get equal ids; an empty table gives an empty result; other columns are
ignored or, in ``encode_documents``, kept unless they are named like a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import batched

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import map_rows, plain_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: What an unknown character costs beyond the worst piece, in a unigram model.
UNKNOWN_PENALTY = 10.0
NONE = -1
#: Stretches remembered in each of two generations; those in use move to the younger one.
REMEMBERED = 100_000
#: Longest stretch that is remembered.
SHORT = 64
#: Texts that are encoded at once.
ROWS = 500
#: Stretches that one such search takes.
SIDE_BY_SIDE = 16_384
#: Slots of the table that finds pieces by hash, and of the one that remembers pairs.
TABLE_BITS, PAIR_BITS = 19, 20
HASH_BASE = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def code_points(texts: list[str]) -> np.ndarray:
    """The code points of all texts in a row."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class PieceTable:
    """Pieces by the polynomial hash of their code points: open addressing, many keys at a time."""

    def __init__(self, pieces: dict[str, int]):
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self.ids = np.full(1 << TABLE_BITS, NONE, np.int32)
        names = list(pieces)
        sizes = np.array([len(p) for p in names])
        codes = code_points(names).astype(np.uint64) + np.uint64(1)
        power = np.ones(int(sizes.max(initial=0)) + 1, np.uint64)
        for k in range(1, len(power)):
            power[k : k + 1] = power[k - 1 : k] * HASH_BASE
        self.power = power
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(codes)) - 1
        hashes = np.add.reduceat(codes * power[left], ends - sizes) if names else np.empty(0, np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        places = (hashes * SPREAD >> np.uint64(64 - TABLE_BITS)).tolist()
        for at, key, piece in zip(places, hashes, pieces.values()):
            while self.ids[at] != NONE:
                at = (at + 1) & ((1 << TABLE_BITS) - 1)
            self.keys[at], self.ids[at] = key, piece

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes * SPREAD >> np.uint64(64 - TABLE_BITS)).view(np.int64)
        found = self.ids.take(at)
        other = np.nonzero((found != NONE) & (self.keys.take(at) != hashes))[0]
        while len(other):
            at[other] = (at[other] + 1) & ((1 << TABLE_BITS) - 1)
            found[other] = self.ids[at[other]]
            wrong = (found[other] != NONE) & (self.keys[at[other]] != hashes[other])
            other = other[wrong]
        return found


class _Paths:
    """Committed ids of many lanes, in steps of a vector for all lanes that still have some."""

    def __init__(self, lanes: int):
        self.counts = np.zeros(lanes, np.int64)
        self.lanes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, lanes, last, back, top, done) -> None:
        """Follow paths from the rows ``top`` back to the rows ``done``."""
        at, steps = top.copy(), []
        while (live := np.nonzero(at > done)[0]).size:
            own = lanes[live]
            steps.append((own, last[at[live], own]))
            at[live] = back[at[live], own]
        length = np.zeros(len(self.counts), np.int64)
        for own, _ in steps:
            length[own] += 1
        after = self.counts + length
        for back_by, (own, ids) in enumerate(steps, 1):
            self.lanes.append(own)
            self.places.append(after[own] - back_by)
            self.ids.append(ids)
        self.counts = after

    def _flat(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(self.counts) - self.counts
        flat = np.empty(int(self.counts.sum()), np.int32)
        for own, places, ids in zip(self.lanes, self.places, self.ids):
            flat[starts[own] + places] = ids
        return flat, starts

    def lists(self) -> list[bytes]:
        flat, starts = self._flat()
        content, ends = flat.tobytes(), (4 * (starts + self.counts)).tolist()
        return [content[a:b] for a, b in zip((4 * starts).tolist(), ends)]

    def gaps(self) -> list[int]:
        """Lanes with a character that has no piece."""
        found = [own[ids == NONE] for own, ids in zip(self.lanes, self.ids)]
        return np.unique(np.concatenate([np.empty(0, np.int64), *found])).tolist()


class Vocabulary:
    """Pieces, scores and byte pieces of a model file's content."""

    def __init__(self, content: bytes, kind: str):
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"kind must be bpe or unigram, not {kind!r}")
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.normalize = model.normalize
        pieces, scores, table, raw = {}, [], [], {}
        for i in range(model.piece_size()):
            piece = model.id_to_piece(i)
            scores.append(model.get_score(i))
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                raw[value] = i
                table.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                table.append(b"")
            else:
                pieces[piece] = i
                table.append(piece.replace(SPACE, " ").encode())
        self.setup(pieces, scores, table, raw, model.unk_id(), kind)

    def setup(self, pieces, scores, table, raw, unknown, kind) -> None:
        self.pieces: dict[str, int] = pieces
        self.names = {i: piece for piece, i in pieces.items()}
        self.scores: list[float] = scores
        self.table: list[bytes] = table
        self.raw = [raw[b] for b in range(256)] if len(raw) == 256 else None
        self.unknown = unknown
        self.kind = kind
        self.longest = max(map(len, pieces), default=1)
        self.worst = min((scores[i] for i in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        alone = not any("\n" in piece for piece in pieces)
        self.stretch = re.compile(
            (rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
            if self.apart
            else r"(?s:.+)"
        )
        # Ids as 32-bit integers in a row.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        if kind == "bpe":
            self._merges()

    def _merges(self) -> None:
        """How merging builds each piece, as seen from either of its ends.

        ``ends[p]`` lists the parts at the right end of ``p`` in order of size, each with the rank of
        the merge that takes it up into the next; ``starts[p]`` likewise at the left end. A piece
        that merging its own characters does not yield is never an id and is left out.
        """
        self.rank = {p: -self.scores[i] for p, i in self.pieces.items()}
        last = float("inf")
        self.ends: dict[str, list[tuple[str, float]]] = {}
        self.starts: dict[str, list[tuple[str, float]]] = {}
        built = {}
        for piece in sorted(self.pieces, key=len):
            if len(piece) == 1:
                self.ends[piece] = self.starts[piece] = [(piece, last)]
            elif split := self._last_merge(piece):
                built[piece] = split
        for piece, (left, right) in built.items():
            if left in self.starts and right in self.ends:
                took = self.rank[piece]
                self.ends[piece] = [*self.ends[right][:-1], (right, took), (piece, last)]
                self.starts[piece] = [*self.starts[left][:-1], (left, took), (piece, last)]
        self.pieces = {p: i for p, i in self.pieces.items() if p in self.ends}
        self.table_of_pieces = PieceTable(self.pieces)
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_values = np.zeros(1 << PAIR_BITS, bool)

    def _last_merge(self, text: str) -> tuple[str, str] | None:
        """Merge adjacent parts, best rank first and leftmost of ties; the last two parts, if one is left."""
        parts, pair = list(text), None
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, None) for a, b in zip(parts, parts[1:])]
            known = [r for r in ranks if r is not None]
            if not known:
                return None
            at = ranks.index(min(known))
            pair = parts[at], parts[at + 1]
            parts[at : at + 2] = ["".join(pair)]
        return pair

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the text of two pieces yields the two.

        It does not if, at some time, the parts on either side of the border form a piece of better
        rank than the merges that take these parts up into their own pieces.
        """
        key = a * len(self.scores) + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            ends, starts = self.ends[self.names[a]], self.starts[self.names[b]]
            found = self.pairs[key] = self._separate(ends, starts)
        return found

    def _separate(self, ends: list[tuple[str, float]], starts: list[tuple[str, float]]) -> bool:
        i = j = 0
        while True:
            (left, left_taken), (right, right_taken) = ends[i], starts[j]
            across = self.rank.get(left + right)
            if across is not None and across < left_taken and across <= right_taken:
                return False
            if i == len(ends) - 1 and j == len(starts) - 1:
                return True
            if left_taken <= right_taken:
                i += 1
            else:
                j += 1

    def search(self, text: str) -> Iterator[tuple[int, str]]:
        """Ids of normalised text with the text they stand for; ``NONE`` for a character without piece."""
        longest, pieces, bpe = self.longest, self.pieces, self.kind == "bpe"
        may_follow = self.may_follow
        # Positions from the last commit on: the piece that arrives, where it began, its path's score.
        last, back, best = [NONE], [0], [0.0]
        base = 0
        for end in range(1, len(text) + 1):
            i = end - base
            arrived, began, score = NONE, i - 1, None
            for j in range(max(0, i - longest), i):
                piece = pieces.get(text[base + j : end])
                if piece is None:
                    continue
                if bpe:
                    if last[j] == NONE or may_follow(last[j], piece):
                        arrived, began = piece, j
                        break
                elif score is None or best[j] + self.scores[piece] > score:
                    arrived, began, score = piece, j, best[j] + self.scores[piece]
            if arrived == NONE:
                score = best[i - 1] + self.worst
            last.append(arrived)
            back.append(began)
            best.append(score if score is not None else 0.0)
            if i >= 4 * longest and (cut := self._boundary(back, i)):
                yield from self._path(text, base, last, back, cut)
                base += cut
                # The piece before the boundary still decides what may follow it.
                last, best = last[cut:], best[cut:]
                back = [0, *(b - cut for b in back[cut + 1 :])]
        yield from self._path(text, base, last, back, len(text) - base)

    def _boundary(self, back: list[int], end: int) -> int:
        """Last position that the paths of all positions in the window share; 0 if none."""
        live = set(range(end - self.longest + 1, end + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(back[furthest])
        return max(live.pop(), 0)

    @staticmethod
    def _path(text: str, base: int, last: list[int], back: list[int], end: int) -> list[tuple[int, str]]:
        found = []
        while end > 0:
            found.append((last[end], text[base + back[end] : base + end]))
            end = back[end]
        return found[::-1]

    def _searched_ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece, part in self.search(text):
            if piece != NONE:
                ids.append(piece)
            elif self.raw:
                ids += [self.raw[b] for b in part.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def follow(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """``may_follow`` of many pairs, from a table that keeps the latest pair of each slot."""
        keys = before.astype(np.int64) * len(self.scores) + pieces
        at = (keys.view(np.uint64) * SPREAD >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        new = np.nonzero(self.pair_keys.take(at) != keys)[0]
        found = self.pair_values.take(at)
        if len(new):
            asked, inverse = np.unique(keys[new], return_inverse=True)
            size = len(self.scores)
            names, ends, starts = self.names, self.ends, self.starts
            answers = np.array(
                [self._separate(ends[names[k // size]], starts[names[k % size]]) for k in asked.tolist()]
            )
            found[new] = answers[inverse]
            self.pair_keys[at[new]], self.pair_values[at[new]] = keys[new], found[new]
        return found

    def search_many(self, texts: Sequence[str]) -> dict[str, bytes]:
        """The search of many texts side by side, in a merge model: their ids as bytes.

        Texts are given in order of length. Each is a lane; all lanes share one window of twice the
        longest piece. When it is full, the ids before each lane's boundary are committed and the
        window moves on; it grows only where the paths of a lane have not met yet.
        """
        texts = texts[::-1]
        sizes = np.array([len(t) for t in texts])
        codes, begins = code_points(texts).astype(np.uint64) + np.uint64(1), np.cumsum(sizes) - sizes
        n, most, longest = len(texts), int(sizes[0]), self.longest
        power = self.table_of_pieces.power
        paths = _Paths(n)
        span, base, ended = 2 * longest, 0, n
        sums = np.zeros((span + 1, n), np.uint64)
        last = np.full((span + 1, n), NONE, np.int32)
        back = np.zeros((span + 1, n), np.int32)
        #: Row of the window up to which the ids of each lane are committed.
        done = np.zeros(n, np.int64)
        for end in range(1, most + 1):
            row = end - base
            if row > span:
                # Lanes that ended in this window go first, as far as their end.
                live = int(np.searchsorted(-sizes, -end, side="right"))
                over = np.arange(live, ended)
                paths.add(over, last, back, sizes[over] - base, done[over])
                ended = live
                met = self._met(back[:, :live], row - 1)
                paths.add(np.arange(live), last, back, met, done[:live])
                done[:live] = met
                # Rows below the boundary and out of reach are not read again.
                move = min(row - 1 - longest, int(met.min(initial=span)))
                if move > 0:
                    kept = row - move
                    for rows in (sums, last, back):
                        rows[:kept] = rows[move:row].copy()
                    back[:kept] = np.maximum(back[:kept] - move, 0)
                    done -= move
                    base += move
                    row = end - base
                if row > span:
                    span += longest
                    sums, last, back = (
                        np.concatenate([rows, np.zeros((longest, n), rows.dtype)]) for rows in (sums, last, back)
                    )
            lanes = np.arange(np.searchsorted(-sizes, -end, side="right"))
            here = codes[begins[lanes] + end - 1]
            sums[row, lanes] = sums[row - 1, lanes] * HASH_BASE + here
            last[row], back[row] = NONE, row - 1
            for j in range(max(0, row - longest), row):
                piece = self.table_of_pieces.find(sums[row].take(lanes) - sums[j].take(lanes) * power[row - j])
                hit = np.nonzero(piece != NONE)[0]
                if not len(hit):
                    continue
                own, piece = lanes[hit], piece[hit]
                before = last[j].take(own)
                fits = before == NONE
                asked = np.nonzero(~fits)[0]
                fits[asked] = self.follow(before[asked], piece[asked])
                last[row][own[fits]], back[row][own[fits]] = piece[fits], j
                if fits.any():
                    rest = np.ones(len(lanes), bool)
                    rest[hit[fits]] = False
                    lanes = lanes[rest]
                    if not len(lanes):
                        break
        over = np.arange(ended)
        paths.add(over, last, back, sizes[over] - base, done[over])
        found = dict(zip(texts, paths.lists()))
        for k in paths.gaps():
            # Characters without a piece become bytes, or unknown.
            found[texts[k]] = np.array(self._searched_ids(texts[k]), np.int32).tobytes()
        return found

    def _met(self, back: np.ndarray, end: int) -> np.ndarray:
        """For each lane the last row that the paths of all rows within reach share."""
        at = np.repeat(np.arange(end - self.longest + 1, end + 1)[:, None], back.shape[1], axis=1)
        lanes = np.arange(back.shape[1])
        while len(lanes):
            lowest = at[:, lanes].min(axis=0)
            above = at[:, lanes] > lowest
            if not above.any():
                break
            lanes, above = lanes[above.any(axis=0)], above[:, above.any(axis=0)]
            part = at[:, lanes]
            at[:, lanes] = np.where(above, back[part, lanes], part)
        return at[0].astype(np.int64)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        lists = [self.stretch.findall(self.normalize(text)) for text in texts]
        known, older = self.known, self.older
        new = {s for stretches in lists for s in stretches if s not in known}
        if len(known) + len(new) > REMEMBERED:
            older, known = known, {}
            self.known, self.older = known, older
            new = {s for stretches in lists for s in stretches}
        again = [s for s in new if s in older]
        known.update((s, older[s]) for s in again)
        new.difference_update(again)
        found: dict[str, bytes] = {}
        if self.kind == "bpe":
            for some in batched(sorted(new, key=len), SIDE_BY_SIDE):
                found.update(self.search_many(some))
        else:
            found.update((s, np.array(self._searched_ids(s), np.int32).tobytes()) for s in new)
        known.update(found)
        ids = [b"".join(map(known.__getitem__, stretches)) for stretches in lists]
        for s in found:
            if len(s) > SHORT:
                del known[s]
        return [np.frombuffer(x, np.int32) for x in ids]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids; the space that normalisation puts first is taken off."""
        known = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.table.__getitem__, known)).decode("utf-8", "replace")
        return text.removeprefix(" ")


_loaded: dict[tuple[bytes, str], Vocabulary] = {}


def vocabulary(content: bytes, kind: str) -> Vocabulary:
    """The vocabulary of a model, read once per Python worker."""
    if (content, kind) not in _loaded:
        _loaded[content, kind] = Vocabulary(content, kind)
    return _loaded[content, kind]


def model_content(path: str = MODEL) -> bytes:
    """The model file, read by the driver; tasks get its content (half a megabyte for 32,000 ids)."""
    with open(path, "rb") as file:
        return file.read()


def _id_lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    flat = np.concatenate([np.empty(0, np.int32), *found])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encoder(content: bytes, kind: str = "bpe"):
    """A column function: ids of a text column without nulls."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        words = vocabulary(content, kind)
        parts = [
            _id_lists(words.encode_many(texts.slice(at, ROWS).to_pylist()))
            for at in range(0, len(texts), ROWS)
        ]
        return pa.concat_arrays([*parts, _id_lists([])])

    return encode


def decoder(content: bytes, kind: str = "bpe"):
    """A column function: the text of an id column without nulls."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        words = vocabulary(content, kind)
        parts = [
            pa.array([words.decode(x) for x in ids.slice(at, ROWS).to_pylist()], pa.string())
            for at in range(0, len(ids), ROWS)
        ]
        return pa.concat_arrays([*parts, pa.array([], pa.string())])

    return decode


def encode_texts(docs: DataFrame, path: str = MODEL, kind: str = "bpe") -> DataFrame:
    """One row per document: ``doc_id, n_ids, ids`` and whether they decode to the text itself."""
    content = model_content(path)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(content, kind)
        texts = batch["text"].to_pylist()
        found = words.encode_many(texts)
        same = [words.decode(ids) == text for ids, text in zip(found, texts)]
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n_ids": pa.array([len(ids) for ids in found], pa.int64()),
                "ids": _id_lists(found),
                "exact": pa.array(same, pa.bool_()),
            }
        )

    schema = "doc_id long, n_ids long, ids array<int>, exact boolean"
    return map_rows(plain_texts(docs), encode, schema, ROWS)


def encode_documents(docs: DataFrame, path: str = MODEL, kind: str = "bpe") -> DataFrame:
    """All columns of the documents, with ``ids`` and ``n_ids``."""
    ids = encoder(model_content(path), kind)
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in ("ids", "n_ids")]
    coded = docs.select(*kept, ids(F.coalesce(docs["text"], F.lit(""))).alias("ids"))
    return coded.withColumn("n_ids", F.size("ids").cast("long"))
