"""Language-model scoring by online logistic context mixing.

A text is a sequence of tokens: its words (A-Z in lower case) and one end. Each token is coded as
the bits of its path in a Huffman tree over the frequent words, with an escape for the others. For
every bit four predictors give log odds: the bit's node alone, and counts in hashed tables for
three contexts of the node (the word before, the two before, the last very common word). A
logistic mixer adds them up with weights; the gate that selects the weights is the depth of the
node and the number of counts behind the first context. A final table refines the mixed
probability by what followed such values before. Rare words are spelt out by their share of all
rare words after the escape, so probabilities add up to one, with one share for all unseen words.

The training rows are read once, in ``BATCHES`` dealt by hash. Every bit of a batch is predicted by
the counts and the weights of the batches before it, then all of its bits are counted, and the mixer
takes one Newton step on the batch's slopes, with the curvature of all batches so far. So every
training row is counted and learnt from, by a model that has not seen it. Slopes and curvatures are
summed as integers, so that neither weights nor counts depend on how rows are dealt to tasks. While
scoring, the mixer goes on learning within a document, from one stretch of ``STRETCH`` tokens to the
next, and forgets this after it; so a score depends on the document and the model alone. Log odds
are in ``LEVELS_OF_ODDS`` steps, a byte each.

Words, bits, weights and the refining table cover all training rows. Bounded by parameters are the tree
(``FREQUENT`` words) and the tables (``SLOTS`` a context); both are broadcast. Counts of rare words
stay in Spark and are joined.

Edge cases: a null text is the empty text, whose only token is the end; rows of null ``doc_id``
are scored, never learnt from and never held out; equal texts get equal scores; without training
rows every token is unseen and every score 0; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import cached_property, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.frames import mix64, plain_texts, text_bytes
from siftwell.sources.workspace import materialize

FOLDS, LEFT_OUT = 7, 2
FREQUENT = 1 << 18
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
CONTEXTS = 3
#: Tables are summed in so many pieces for each context.
RANGES = 128
COMMON = 1024
STRETCH = 64
#: Training rows are dealt into so many shares by hash; where each batch of shares ends.
SHARES, BATCHES = 16, (4, 8, 16)
#: Tokens that are counted at once, and that a task counts at least before it sends its tables on.
COUNTED_AT_ONCE, TOKENS_PER_TASK = 1 << 13, 1 << 22
#: Documents and bytes that are read at once, and documents of similar length scored side by side.
ROWS, BYTES, SIDE_BY_SIDE = 2000, 1 << 24, 32
DEPTHS, LEVEL_BITS, STEPS = 8, 2, 33
LEVELS = 1 << LEVEL_BITS
GATES = DEPTHS * LEVELS
INPUTS = CONTEXTS + 1
#: Marks the mixer's sums among the counts by context.
LEARNT = -1
PRIOR = 0.4
LIMIT = 8.0
#: Errors and their variances are summed in units of 1 / UNIT; a weight's prior precision; rows of
#: one product of exact sums.
UNIT, RIDGE, ROWS_SUMMED = 1 << 14, 100.0, 1 << 13
LEVELS_OF_ODDS = 255
STEP = np.float32(2 * LIMIT / (LEVELS_OF_ODDS - 1))
END = b""


def held_out(doc_id: Column) -> Column:
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == LEFT_OUT, F.lit(False))


def _training(docs: DataFrame) -> DataFrame:
    return plain_texts(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts in a row, and which text each is from."""
    # Splits at the same six characters as ``bytes.split``; outer spaces leave empty parts.
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten().cast(pa.binary())
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full, min_count=0).as_py():
        words, owner = words.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    return words, owner


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of about ``BYTES`` of text at a time."""
    held: list[pa.Array] = []
    texts = size = 0

    def packed() -> pa.RecordBatch:
        counts = pc.value_counts(pa.chunked_array(held, pa.binary()))
        word, n = counts.field("values"), counts.field("counts").cast(pa.int64())
        return pa.record_batch(
            {
                "word": pa.concat_arrays([word, pa.array([END], pa.binary())]),
                "n": pa.concat_arrays([n, pa.array([texts], pa.int64())]),
            }
        )

    for part in chain.from_iterable(map(_parts, batches)):
        words, _ = split_words(part["text"])
        held.append(words)
        texts += part.num_rows
        size += words.nbytes
        if size >= BYTES:
            yield packed()
            held.clear()
            texts = size = 0
    if texts:
        yield packed()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each token occurs in the training rows."""
    counts = _training(docs).mapInArrow(_count_words, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, from a histogram of logarithms."""
    step = F.floor(F.log(F.col("n").cast("double")) * 16).alias("step")
    rows = counts.groupBy(step).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, words = 1 << 62, 0
    for row in sorted(rows, key=lambda r: -r["step"]):
        words += row["words"]
        if words > most:
            break
        least = row["least"]
    return least


class Code:
    """Paths of the frequent words and of the escape (the last code) in a Huffman tree."""

    def __init__(self, words: list[bytes], counts: list[int], rare: int):
        self.words, self.counts = words, np.array([*counts, max(rare, 1)], np.int64)
        n = len(words) + 1
        heap = [(int(c), k) for k, c in enumerate(self.counts)]
        heapq.heapify(heap)
        parent = np.zeros(2 * n - 1, np.int64)
        side = np.zeros(2 * n - 1, np.uint8)
        weight = np.zeros(2 * n - 1, np.int64)
        weight[:n] = self.counts
        ones = np.zeros(n - 1, np.int64)
        for node in range(n, 2 * n - 1):
            a, left = heapq.heappop(heap)
            b, right = heapq.heappop(heap)
            parent[[left, right]], side[right], weight[node] = node, 1, a + b
            ones[node - n] = b
            heapq.heappush(heap, (a + b, node))
        depth = np.zeros(2 * n - 1, np.int64)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[parent[node]] + 1
        self.length = depth[:n].astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        node = np.zeros(int(self.length.sum()), np.uint32 if n <= 1 << 20 else np.uint64)
        bit = np.zeros(len(node), node.dtype)
        at, left = np.arange(n), np.arange(n)
        for back in range(1, int(self.length.max(initial=0)) + 1):
            left = left[self.length[left] >= back]
            here = self.start[left] + self.length[left] - back
            bit[here] = side[at[left]]
            at[left] = parent[at[left]]
            node[here] = at[left] - n
        #: First gate of each node, by its depth.
        depths = np.minimum(depth[n:], DEPTHS - 1)
        self.gates = depths * LEVELS
        odds = stretched(weight[n:] - ones, ones)
        self.stretch = odds * STEP
        #: Of each step of a path the node, its log odds, its depth and the bit, in one number.
        known = odds.view(np.uint8).astype(node.dtype) << 4 | depths.astype(node.dtype) << 1
        self.steps = node << 12 | known.take(node) | bit

    @cached_property
    def node(self) -> np.ndarray:
        return (self.steps >> 12).astype(np.int32)

    @cached_property
    def bit(self) -> np.ndarray:
        return (self.steps & 1).astype(np.uint8)

    def codes(self, found: list[bytes]) -> np.ndarray:
        """Codes of tokens; words that are not frequent have the last one, the escape."""
        places = pc.index_in(pa.array(found, pa.binary()), self._set()).fill_null(len(self.words))
        return places.to_numpy(zero_copy_only=False).astype(np.int32)

    def _set(self) -> pa.Array:
        if "set" not in self.__dict__:
            self.set = pa.array(self.words, pa.binary())
            self.end = self.words.index(END) if END in self.words else len(self.words)
        return self.set

    def codes_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Codes of the tokens of some texts in a row, how many each has, and the texts' words."""
        known = self._set()
        words, owner = split_words(texts)
        lengths = np.bincount(owner, minlength=len(texts)).astype(np.int64) + 1
        codes = np.full(int(lengths.sum()), self.end, np.int32)
        found = pc.index_in(words, known).fill_null(len(self.words))
        codes[np.arange(len(words)) + owner] = found.to_numpy(zero_copy_only=False)
        return codes, lengths, words

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("set", "node", "bit")}


def context_hashes(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each token a hash of each context; ``first`` is where the token's document begins."""
    at = np.arange(len(codes))
    code = codes.astype(np.int64)
    one = np.where(at - 1 >= first, code[np.maximum(at - 1, 0)], -1)
    two = np.where(at - 2 >= first, code[np.maximum(at - 2, 0)], -1)
    seen = np.maximum.accumulate(np.where(codes < COMMON, at, -1))
    last = np.concatenate([[-1], seen[:-1]])
    common = np.where(last >= first, code[np.maximum(last, 0)], -1)
    base = np.uint64(1 << 40)
    known = mix64(np.arange(-1, COMMON).astype(np.uint64) + base * np.uint64(3))
    one, two = one.astype(np.uint64), two.astype(np.uint64)
    hashes = [mix64(one + base), mix64(one + two * base), known.take(common + 1)]
    return (np.stack(hashes) >> np.uint64(32)).astype(np.uint32)


class Bits:
    """The bits of some tokens: bit, first gate and log odds of the node, table slots, token position."""

    def __init__(self, code: Code, codes: np.ndarray, contexts: np.ndarray):
        self.length = length = code.length.take(codes)
        self.token = np.repeat(np.arange(len(codes)), length)
        begun = np.cumsum(length) - length
        path = np.arange(len(self.token)) + (code.start.take(codes) - begun).take(self.token)
        step = code.steps.take(path)
        self.bit = (step & 1).astype(np.uint8)
        self.gate = ((step >> 1) & (DEPTHS - 1)).astype(np.uint8) << np.uint8(LEVEL_BITS)
        self.odds = (step >> 4).astype(np.uint8).view(np.int8)
        spread = (step >> 12).astype(np.uint32) * np.uint32(0x9E3779B1)
        shift, odd = np.uint32(32 - SLOT_BITS), np.uint32(0x85EBCA6B)
        self.slots = [((c.take(self.token) ^ spread) * odd) >> shift for c in contexts]


def levels(n: np.ndarray) -> np.ndarray:
    """0 for no count, 1 for few, 2 for more, 3 for many."""
    return (n > 0).view(np.uint8) + (n > 4).view(np.uint8) + (n > 64).view(np.uint8)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of a 1, in steps."""
    zeros, ones = zeros.astype(np.float32), ones.astype(np.float32)
    odds = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))).clip(-LIMIT, LIMIT)
    return np.rint(odds / STEP).astype(np.int8)


def logistic(odds: np.ndarray) -> np.ndarray:
    return np.float32(1) / (np.float32(1) + np.exp(-odds))


class Odds:
    """Log odds of summed counts, in steps; those of the first context with the level beside them."""

    def __init__(self, totals: np.ndarray):
        self.tables = [stretched(zeros, ones) for zeros, ones in totals.transpose(0, 2, 1)]
        level = levels(totals[0].sum(axis=1))
        self.tables[0] = self.tables[0].astype(np.int16) << LEVEL_BITS | level

    def of(self, bits: Bits) -> tuple[list[np.ndarray], np.ndarray]:
        """For every bit the steps of all predictors, and the gate."""
        first = self.tables[0].take(bits.slots[0])
        gate = bits.gate | (first & (LEVELS - 1)).astype(np.uint8)
        others = [table.take(slot) for table, slot in zip(self.tables[1:], bits.slots[1:])]
        return [bits.odds, (first >> LEVEL_BITS).astype(np.int8), *others], gate


class Mixer:
    """Gated weights, and the table that refines the mixed probability."""

    def __init__(self):
        start = [0.25] * INPUTS
        self.weights = np.tile(np.array(start, np.float32), (GATES, 1))
        self.curve = RIDGE * np.tile(np.eye(INPUTS), (GATES, 1, 1))
        #: Bits and ones seen for each depth and step of log odds, with a prior on the diagonal.
        self.seen = np.full((DEPTHS, STEPS), 4.0)
        self.ones = 4.0 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, STEPS))) * np.ones((DEPTHS, 1))

    def mixed(self, inputs: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """Log odds of a 1; ``inputs`` has a row for each predictor."""
        total = np.zeros(len(gate), np.float32)
        for k, weights in enumerate(np.ascontiguousarray(self.weights.T)):
            total += weights.take(gate) * inputs[k]
        return total

    def learn(self, sums: np.ndarray) -> None:
        """One Newton step on the sums of a batch."""
        slopes, seen, ones = np.split(sums.astype(np.float64), Sums.CUTS)
        slopes = slopes.reshape(GATES, INPUTS + 1, INPUTS) / UNIT
        self.curve += slopes[:, :INPUTS] * float(STEP) ** 2
        moved = np.linalg.solve(self.curve, slopes[:, INPUTS:].transpose(0, 2, 1) * float(STEP))
        self.weights = (self.weights + moved[:, :, 0]).astype(np.float32)
        self.seen += seen.reshape(DEPTHS, STEPS)
        self.ones += ones.reshape(DEPTHS, STEPS)

    def refined(self, odds: np.ndarray, chance: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The mean of the mixed chance and what followed such values, between two steps."""
        table = (self.ones / self.seen).astype(np.float32).ravel()
        place = (odds + np.float32(LIMIT)) * np.float32((STEPS - 1) / (2 * LIMIT))
        low = np.minimum(place.astype(np.int64), STEPS - 2)
        part = place - low.astype(np.float32)
        key = (gate >> LEVEL_BITS) * STEPS + low
        known = table.take(key) + np.diff(table).take(key) * part
        return (known + chance) * np.float32(0.5)


class Sums:
    """What a mixer learns from bits: exact sums, the same in any order."""

    CUTS = np.cumsum([GATES * (INPUTS + 1) * INPUTS, DEPTHS * STEPS])

    def __init__(self):
        #: For each gate the curvature of each two weights, and last the slope of each.
        self.slopes = np.zeros((GATES, INPUTS + 1, INPUTS), np.int64)
        self.seen, self.ones = np.zeros((2, DEPTHS * STEPS), np.int64)

    def add(self, mixer: Mixer, steps: list[np.ndarray], gate: np.ndarray, bit: np.ndarray) -> None:
        # Sorted by gate, four steps of a byte at once.
        order = np.argsort(gate, kind="stable")
        sizes = np.bincount(gate.astype(np.intp), minlength=GATES)
        beside = np.empty((len(bit), INPUTS), np.int8)
        for k, values in enumerate(steps):
            beside[:, k] = values
        beside = beside.view(np.int32).ravel().take(order).view(np.int8).reshape(-1, INPUTS)
        bit = bit.take(order)
        right, odds = np.empty((INPUTS, len(bit))), np.zeros(len(bit), np.float32)
        for k, weights in enumerate(mixer.weights.T):
            right[k] = beside[:, k]
            odds += np.repeat(weights * STEP, sizes) * beside[:, k]
        np.clip(odds, -LIMIT, LIMIT, out=odds)
        chance = logistic(odds)
        step = np.rint((odds + np.float32(LIMIT)) * np.float32((STEPS - 1) / (2 * LIMIT)))
        first = (np.arange(GATES) >> LEVEL_BITS) * STEPS
        key = (np.repeat(first, sizes) + step.astype(np.intp)) * 2 + bit
        both = np.bincount(key, minlength=2 * DEPTHS * STEPS).reshape(-1, 2)
        self.seen += both.sum(axis=1)
        self.ones += both[:, 1]
        left = np.empty((INPUTS + 1, len(bit)))
        np.multiply(right, np.rint(chance * (1 - chance) * np.float32(UNIT)), out=left[:INPUTS])
        left[INPUTS] = np.rint((bit - chance) * np.float32(UNIT))
        ends = np.cumsum(sizes).tolist()
        for g, (begin, end) in enumerate(zip([0, *ends], ends)):
            # Whole numbers far below 2^53: products of doubles are exact.
            for at in range(begin, end, ROWS_SUMMED):
                here = slice(at, min(at + ROWS_SUMMED, end))
                self.slopes[g] += (left[:, here] @ right[:, here].T).astype(np.int64)

    def packed(self) -> np.ndarray:
        return np.concatenate([self.slopes.ravel(), self.seen, self.ones])


def _positions(lengths: np.ndarray) -> np.ndarray:
    """For every token the place where its document begins."""
    return np.repeat(np.cumsum(lengths) - lengths, lengths)


def _pieces(codes: np.ndarray, contexts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(codes), size):
        yield codes[at : at + size], contexts[:, at : at + size]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``ROWS`` rows and about ``BYTES`` of text, a row at least."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        read = sizes[at - 1] if at else 0
        end = max(at + 1, min(at + ROWS, int(np.searchsorted(sizes, read + BYTES, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def _count_and_learn(batches: Iterable[pa.RecordBatch], shared, earlier) -> Iterator[pa.RecordBatch]:
    """Counts of a task by context and range of slots, and the mixer's sums."""
    code: Code = shared.value
    odds, mixer = earlier.value
    counts = np.zeros((CONTEXTS, 2 * SLOTS), np.int32)
    sums = Sums()
    for part in chain.from_iterable(map(_parts, batches)):
        codes, lengths, _ = code.codes_of(part["text"])
        contexts = context_hashes(codes, _positions(lengths))
        for piece, around in _pieces(codes, contexts, COUNTED_AT_ONCE):
            bits = Bits(code, piece, around)
            if len(bits.bit):
                sums.add(mixer, *odds.of(bits), bits.bit)
            for c, slot in enumerate(bits.slots):
                np.add.at(counts[c], (slot << np.uint32(1) | bits.bit).astype(np.intp), np.int32(1))
    if sums.seen.any():
        width = 2 * SLOTS // RANGES
        for c in range(CONTEXTS):
            for r in range(RANGES):
                yield _row(c, r, packed_counts(counts[c, r * width : (r + 1) * width]))
        yield _row(LEARNT, 0, sums.packed())


def packed_counts(counts: np.ndarray) -> np.ndarray:
    """A mark, then all counts, or the places and counts of those in use where that is shorter."""
    used = np.nonzero(counts)[0].astype(np.int32)
    if 2 * len(used) < len(counts):
        return np.concatenate([np.array([1], np.int32), used, counts[used]])
    return np.concatenate([np.array([0], np.int32), counts])


def unpacked_counts(packed: np.ndarray, size: int) -> np.ndarray:
    if not packed[0]:
        return packed[1:]
    places, values = np.split(packed[1:], 2)
    counts = np.zeros(size, np.int32)
    counts[places] = values
    return counts


def _row(context: int, part: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "context": pa.array([context], pa.int32()),
            "part": pa.array([part], pa.int32()),
            "bytes": pa.array([values.tobytes()], pa.binary()),
        }
    )


def _sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counts of each context and range, and of what the mixer learns from."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for context, part, content in zip(*(batch[c].to_pylist() for c in ("context", "part", "bytes"))):
            if context == LEARNT:
                values = np.frombuffer(content, np.int64)
            else:
                values = unpacked_counts(np.frombuffer(content, np.int32), 2 * SLOTS // RANGES)
            key = context, part
            if key not in sums:
                sums[key] = values.astype(np.int64)
            else:
                sums[key] += values
    for (context, part), total in sums.items():
        yield _row(context, part, total)


class Model:
    """All that scoring broadcasts."""

    def __init__(self, code: Code, totals: dict[str, int], odds: Odds, mixer: Mixer):
        self.code, self.totals, self.odds, self.mixer = code, totals, odds, mixer

    def log2(self, found: list[np.ndarray]) -> np.ndarray:
        """Base-2 log probability of each document's codes."""
        lengths = np.array([len(f) for f in found])
        begins = np.cumsum(lengths) - lengths
        codes = np.concatenate(found)
        contexts = context_hashes(codes, _positions(lengths))
        total = np.zeros(len(found))
        shift = np.zeros((INPUTS, len(found)), np.float32)
        curve = np.full((INPUTS, len(found)), 200, np.float32)
        for at in range(0, int(lengths.max(initial=0)), STRETCH):
            live = np.nonzero(lengths > at)[0]
            sizes = np.minimum(lengths[live] - at, STRETCH)
            owner = np.repeat(live, sizes)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = begins[owner] + at + within
            bits = Bits(self.code, codes[place], contexts[:, place])
            if not len(bits.bit):
                continue
            # Bits come document by document; each live document has at least its token's path.
            each = np.bincount(np.repeat(np.arange(len(live)), sizes), bits.length, len(live))
            live, each = live[each > 0], each[each > 0].astype(np.int64)
            first = np.cumsum(each) - each
            steps, gate = self.odds.of(bits)
            inputs, gate = [s * STEP for s in steps], gate.astype(np.intp)
            odds = self.mixer.mixed(inputs, gate)
            if at:
                for k in range(INPUTS):
                    odds += np.repeat(shift[k, live], each) * inputs[k]
            np.clip(odds, -LIMIT, LIMIT, out=odds)
            chance = logistic(odds)
            one = self.mixer.refined(odds, chance, gate)
            bit = bits.bit.astype(np.float32)
            kept = np.log2(np.abs(one - (1 - bit)))
            total[live] += np.add.reduceat(kept, first, dtype=np.float64)
            if (lengths > at + STRETCH).any():
                error = bit - chance
                spread = chance * (1 - chance)
                for k in range(INPUTS):
                    slope = np.add.reduceat(error * inputs[k], first)
                    curve[k, live] += np.add.reduceat(spread * inputs[k] * inputs[k], first)
                    shift[k, live] += 0.2 * slope / curve[k, live]
        return total


def fit(docs: DataFrame, frequent: int = FREQUENT) -> tuple[DataFrame, Model, int]:
    """Stored counts of all words, the model, and the least count of a frequent word."""
    session = docs.sparkSession
    counts, _ = materialize(word_counts(docs), "word-counts")
    least = frequent_from(counts, frequent)
    rare = F.col("n") < least
    row = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count("*").alias("words"),
        F.coalesce(F.sum(F.when(rare, F.col("n"))), F.lit(0)).alias("rare_tokens"),
        F.count(F.when(rare, 1)).alias("rare_words"),
    ).first()
    table = counts.where(~rare).toArrow()
    words, numbers = table["word"].to_pylist(), table["n"].to_pylist()
    order = sorted(range(len(words)), key=lambda k: (-numbers[k], words[k]))
    code = Code([words[k] for k in order], [numbers[k] for k in order], row["rare_tokens"])
    shared = session.sparkContext.broadcast(code)
    schema = "context int, part int, bytes binary"
    training = _training(docs)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARES))
    totals, mixer = np.zeros((CONTEXTS, 2 * SLOTS), np.int64), Mixer()
    width = 2 * SLOTS // RANGES
    for begin, end in zip((0, *BATCHES), BATCHES):
        batch = training.where((share >= begin) & (share < end))
        tasks = 1 + row["tokens"] * (end - begin) // SHARES // TOKENS_PER_TASK
        earlier = session.sparkContext.broadcast((Odds(totals.reshape(CONTEXTS, SLOTS, 2)), mixer))
        task = partial(_count_and_learn, shared=shared, earlier=earlier)
        counted = batch.coalesce(tasks).mapInArrow(task, schema)
        summed = counted.repartition("context", "part").mapInArrow(_sum_up, schema).toArrow()
        for context, part, content in zip(*(summed[c].to_pylist() for c in ("context", "part", "bytes"))):
            values = np.frombuffer(content, np.int64)
            if context == LEARNT:
                mixer.learn(values)
            else:
                totals[context, part * width : (part + 1) * width] += values
        earlier.unpersist()
    model = Model(code, row.asDict(), Odds(totals.reshape(CONTEXTS, SLOTS, 2)), mixer)
    return counts, model, least


def _by_length(model: Model, found: list[np.ndarray]) -> np.ndarray:
    """Base-2 log probability of each document's codes; documents of similar length go together."""
    order = np.argsort([len(f) for f in found], kind="stable")
    scores = np.empty(len(found))
    for at in range(0, len(order), SIDE_BY_SIDE):
        some = order[at : at + SIDE_BY_SIDE]
        scores[some] = model.log2([found[k] for k in some])
    return scores


def _score(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    code, totals = model.code, model.totals
    share = np.log10((code.counts + 1) / (totals["tokens"] + totals["words"] + 1))
    escape = len(code.words)
    for batch in batches:
        for part in _parts(batch):
            texts = text_bytes(part["text"])
            codes, lengths, words = code.codes_of(part["text"])
            begins = np.cumsum(lengths) - lengths
            often = codes != escape
            base = np.add.reduceat(np.where(often, share.take(codes), 0.0), begins)
            known = np.add.reduceat(often.astype(np.int64), begins)
            found = np.split(codes, begins[1:])
            rare = np.nonzero(~often)[0]
            owner = np.repeat(np.arange(len(texts)), lengths)[rare]
            # The end is a token without a word.
            is_end = rare == (begins + lengths - 1)[owner]
            spelt = pa.concat_arrays([words, pa.array([END], pa.binary())])
            spelt = spelt.take(pa.array(np.where(is_end, len(words), rare - owner)))
            found_rare = pa.table({"owner": owner, "word": spelt}).group_by(["owner", "word"], use_threads=False)
            kinds = found_rare.aggregate([([], "count_all")])
            kinds = kinds.take(np.argsort(kinds["owner"].to_numpy(), kind="stable"))
            ends = np.searchsorted(kinds["owner"].to_numpy(), np.arange(len(texts) + 1))
            pairs = pa.StructArray.from_arrays(
                [kinds["word"].combine_chunks(), kinds["count_all"].combine_chunks()], ["word", "n"]
            )
            yield pa.record_batch(
                {
                    "doc_id": part["doc_id"].cast(pa.int64()),
                    "key": pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts]),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "n_tokens": pa.array([len(f) for f in found], pa.int64()),
                    "known": pa.array(known, pa.int64()),
                    "base": pa.array(base, pa.float64()),
                    "log2": pa.array(_by_length(model, found), pa.float64()),
                    "rare": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                }
            )


def lm_scores(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: token counts, unigram score, the model's score, bits per byte."""
    counts, model, least = fit(docs, frequent)
    totals = model.totals
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        "doc_id long, key binary, n_bytes long, n_tokens long, known long, base double, log2 double, "
        "rare array<struct<word:binary,n:long>>"
    )
    scored, _ = materialize(plain_texts(docs).mapInArrow(lambda b: _score(b, shared), schema), "scored")
    rare = scored.where(F.size("rare") > 0).groupBy("key").agg(F.first("rare").alias("rare"))
    rare = rare.select("key", F.inline("rare"))
    seen = counts.where(F.col("n") < least).select("word", F.col("n").alias("c"))
    joined = rare.join(seen, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))

    def share(total: int) -> Column:
        return F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(total))))

    sums = joined.groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_rare"),
        share(totals["tokens"] + totals["words"] + 1).alias("base_rare"),
        share(totals["rare_tokens"] + totals["rare_words"] + 1).alias("log_rare"),
    )
    rows = scored.drop("rare").join(sums, "key", "left")
    zero = F.lit(0.0)
    score = F.col("log2") * float(np.log10(2)) + F.coalesce("log_rare", zero)
    bits = -score / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", zero)).alias("base_score"),
        score.alias("score"),
        bits.alias("bits_per_byte"),
    )
