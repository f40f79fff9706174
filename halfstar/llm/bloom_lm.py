"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne 2007).

The filter holds the counts of words and word pairs as quantised logarithms: an n-gram of level q is entered q times, together with the
numbers 1 to q. A reader asks for 1, 2, ... until it is told no; the level so found is never below the true one. A pair is only asked
for up to the level of the rarer of its words, which it cannot exceed.

The filter is cut into segments by the hash of the n-gram. Each has as many bits as its own entries need for a rate of false
answers of FALSE_POSITIVES, so the rate does not depend on the corpus. A filter of up to BROADCAST_BYTES is broadcast. A larger one
stays where it is stored: the n-grams that steps of texts ask for are shuffled to the segments, which send back their levels, and the
exact counts of words with them. Both ways ask the same filter and give the same scores.

Probabilities of a word after another are interpolated with those of words (Jelinek and Mercer):
b c(v w) / c(v) + (1 - b) p(w). The first word follows the end of a text.

Counts are added up per step of texts before the shuffle, which moves a row for each step and segment, not for each n-gram. Each task
then takes whole segments of the filter and holds the n-grams of one segment at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import in_small_batches, partitions, stored
from .words import grouped, mix, salted, word_hashes

#: Bytes of the filter at least, segments that it is built in (as a power of 2), probes for each entry.
FILTER_BYTES, SEGMENT_BITS, PROBES = 1 << 26, 12, 3
#: Chance, at most, that one entry is found by mistake; it takes 6.5 bits an entry.
FALSE_POSITIVES = 0.05
#: Largest filter that is broadcast: each Python worker holds it once, the driver a few times.
BROADCAST_BYTES = 3 << 25
#: Base of the logarithms that counts are quantised by, and the weight b of pairs.
LOG_BASE, PAIR_WEIGHT = 1.5, 0.3
#: Most frequent words whose exact counts are broadcast; the others are joined.
FREQUENT = 1 << 18
#: Bytes of text that are hashed together, and tokens, about, whose n-grams are counted together before the shuffle.
COUNT_STEP, COUNT_TOKENS = 1 << 25, 1 << 21
#: Tokens of a step that are worked on at once, where it needs several numbers for each.
SLICE = 1 << 18
#: Bytes of text that are scored together.
SCORE_STEP = 1 << 20
#: Segments whose n-grams a task hands over at once.
PACKED = 1 << 8

END = np.uint64(0x2545F4914F6CDD1D)
_SEGMENT = np.uint64(64 - SEGMENT_BITS)
_ZSTD = pa.Codec("zstd")
_TEXT_STEP = pa.schema({"step": pa.int64(), "n_words": pa.int64(), "n": pa.int64(), "words": pa.binary(), "seq": pa.binary(), "ids": pa.list_(pa.int64()), "sizes": pa.binary()})


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of each text, its words and one end, and where each text's begin."""
    words, at = word_hashes(texts)
    return np.insert(words, at[1:], END), at + np.arange(len(at))


def pair_hashes(tokens: np.ndarray, first: np.ndarray | list[np.uint64] = (END,)) -> np.ndarray:
    """Hash of each token with the one before; the end, or another token ``first``, comes before the first."""
    before = np.concatenate([first, tokens[:-1]])
    return salted(salted(before, 22) + tokens, 23)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(LOG_BASE) + 1e-9).astype(np.int64)


def expected_counts(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    return np.where(levels > 0, (LOG_BASE ** (levels - 1.0) + LOG_BASE ** (1.0 * levels) - 1) / 2, 0.0)


def segment_bits(entries: int) -> int:
    """Bits of a segment, in whole bytes: enough for FALSE_POSITIVES, and its share of FILTER_BYTES at least."""
    needed = entries * PROBES / -np.log(1 - FALSE_POSITIVES ** (1 / PROBES))
    return 8 * max(int(np.ceil(needed / 8)), FILTER_BYTES >> SEGMENT_BITS, 1)


def _positions(grams: np.ndarray, level: int, size: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    """Bits of an entry, within its n-gram's segment of ``size`` bits."""
    entry = salted(grams, 100 + level)
    step = (entry >> np.uint64(32)) | np.uint64(1)
    for probe in range(PROBES):
        yield (entry + np.uint64(probe) * step) % size


def _enter(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The bytes of a segment that holds these n-grams, and its number of entries."""
    levels = levels_of(counts)
    entries = int(levels.sum())
    size = segment_bits(entries)
    segment = np.zeros(size // 8, dtype=np.uint8)
    for level in range(1, int(levels.max()) + 1):
        for at in _positions(grams[levels >= level], level, np.uint64(size)):
            np.bitwise_or.at(segment, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return segment, entries


def _ask(bits: np.ndarray, base: np.ndarray, size: np.ndarray, grams: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Level of each n-gram, asked for up to ``most``; its segment has ``size`` bits from the byte ``base`` on."""
    out = np.zeros(len(grams), dtype=np.int64)
    left = np.flatnonzero(most > 0)
    level = 1
    while len(left):
        there = np.ones(len(left), dtype=bool)
        for at in _positions(grams[left], level, size[left]):
            byte = bits[base[left] + (at >> np.uint64(3)).astype(np.int64)]
            there &= ((byte >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        left = left[there]
        out[left] = level
        left = left[most[left] > level]
        level += 1
    return out


def _most(tokens: int) -> int:
    """Level of the count of all tokens, which no n-gram exceeds."""
    return int(levels_of(np.array([max(tokens, 1)]))[0])


def _logs(word: np.ndarray, before: np.ndarray, pair: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """log10 of the probability of words after others, from the levels of both and of the pair."""
    counts, of_before = (np.minimum(expected_counts(x), tokens) for x in (word, before))
    single = (counts + 0.5) / (tokens + 0.5 * (words + 1))
    pairs = np.minimum(expected_counts(np.minimum(pair, np.minimum(word, before))), of_before)
    share = np.divide(pairs, of_before, out=np.zeros(len(pairs)), where=of_before > 0)
    weight = np.where(of_before > 0, PAIR_WEIGHT, 0.0)  # nothing is known of what follows a new word
    return np.log10(weight * share + (1 - weight) * single)


@dataclass(frozen=True)
class LanguageModel:
    """The filter, and what the exact counts of words add up to.

    ``sizes`` are the bits and ``entries`` the entries of each segment; ``starts`` are the bytes where they begin in ``bits``.
    """

    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    entries: np.ndarray
    tokens: int
    words: int

    @property
    def false_positives(self) -> float:
        """Chance that one entry is found by mistake."""
        return float(((1 - np.exp(-PROBES * self.entries / self.sizes)) ** PROBES).mean())

    def levels(self, grams: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Level of each n-gram, asked for up to ``most``."""
        segment = (grams >> _SEGMENT).astype(np.int64)
        return _ask(self.bits, self.starts[segment], self.sizes[segment], grams, most)

    def log_probabilities(self, distinct: np.ndarray, inverse: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the token before."""
        levels = self.levels(salted(distinct, 21), np.full(len(distinct), _most(self.tokens)))
        of_end = int(np.searchsorted(distinct, END))
        word, before = levels[inverse], levels[np.concatenate([[of_end], inverse[:-1]])]
        pair = self.levels(pair_hashes(tokens), np.minimum(word, before))
        return _logs(word, before, pair, self.tokens, self.words)


def count(docs: DataFrame) -> DataFrame:
    """Exact counts of words and the filter's segments, from all texts of ``docs``.

    Stored rows ``(kind, key, n, bits)``: of kind 0 a word's hash and count, of kind 1 a segment, its number of
    entries and its bits.
    """

    n = partitions(docs.sparkSession)
    rows = in_small_batches(docs).select("text").mapInArrow(step_counts, "segment int, is_word boolean, grams binary, n binary")
    rows = rows.repartition(n, "segment").sortWithinPartitions("segment")
    return stored(rows.mapInArrow(_segments, "kind int, key long, n long, bits binary"), "ngram_counts")


def step_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and pairs of each step of texts: ``(segment, is_word, grams, n)``, a row for all words or pairs of a segment.

    ``grams`` holds their hashes and ``n`` their counts, as 64-bit and 32-bit integers.
    """
    held: list[np.ndarray] = []
    size = 0
    for batch in grouped(batches, COUNT_STEP):
        held.append(token_hashes(batch["text"])[0])
        size += len(held[-1])
        if size >= COUNT_TOKENS:
            yield from _step(held)
            size = 0
    if held:
        yield from _step(held)


def _step(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of some tokens, which leave ``held`` and are sorted in place."""
    tokens = np.concatenate(held)
    held.clear()
    pairs = _pairs(tokens)
    words, counts = _counted(tokens)
    del tokens
    order = np.argsort(salted(words, 21))
    words, counts = words[order], counts[order]
    yield from _packed(True, words, counts, salted(words, 21))
    grams, counts = _counted(pairs)
    del pairs
    yield from _packed(False, grams, counts, grams)


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """As `pair_hashes`, some tokens at a time."""
    pairs = np.empty_like(tokens)
    for low in range(0, len(tokens), SLICE):
        before = tokens[low - 1 : low] if low else [END]
        pairs[low : low + SLICE] = pair_hashes(tokens[low : low + SLICE], before)
    return pairs


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs; sorts ``grams`` in place."""
    grams.sort()
    cuts = _cuts(grams)
    # a step has less than 2^31 tokens, as one text has less than 2^31 bytes
    return grams[cuts], np.diff(cuts, append=len(grams)).astype(np.int32)


def _cuts(grams: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    fresh = np.ones(len(grams), dtype=bool)
    np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _packed(is_word: bool, grams: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each segment of the sorted ``keys``; some segments at a time."""
    edges = np.searchsorted(keys >> _SEGMENT, np.arange((1 << SEGMENT_BITS) + 1, dtype=np.uint64))
    for low in range(0, 1 << SEGMENT_BITS, PACKED):
        at = edges[low : low + PACKED + 1]
        used = np.flatnonzero(np.diff(at))
        if len(used):
            ends = np.append(at[used], at[-1])
            columns = [pa.array((used + low).astype(np.int32)), pa.array(np.full(len(used), is_word)), _cells(grams, ends), _cells(counts, ends)]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "is_word", "grams", "n"])


def _cells(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each two of the places ``at``."""
    offsets = ((at - at[0]) * values.itemsize).astype(np.int64)
    data = values[at[0] : at[-1]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


class _Sums:
    """Sums of the counts of n-grams; those that wait to be added stay in proportion to the distinct ones."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting, self.distinct = 0, 1 << 16

    def add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((grams, counts))
        self.waiting += len(grams)
        if self.waiting > 2 * self.distinct:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        grams, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(grams)
        grams = grams[order]
        cuts = _cuts(grams)
        out = grams[cuts], np.add.reduceat(counts[order], cuts, dtype=np.int64)
        self.parts, self.waiting, self.distinct = [out], len(cuts), max(self.distinct, len(cuts))
        return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stored rows of the segments, from rows of ``step_counts`` in their order."""
    now: int | None = None
    words, pairs = _Sums(), _Sums()

    def done() -> pa.RecordBatch:
        (word, of_word), (pair, of_pair) = words.merged(), pairs.merged()
        bits, entries = _enter(np.concatenate([salted(word, 21), pair]), np.concatenate([of_word, of_pair]))
        kind = np.append(np.zeros(len(word), dtype=np.int32), np.int32(1))
        columns = [pa.array(kind), pa.array(np.append(word.view(np.int64), now)), pa.array(np.append(of_word, entries)), pa.array([*[None] * len(word), bits.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["kind", "key", "n", "bits"])

    for batch in batches:
        for segment, is_word, grams, counts in zip(batch["segment"].to_pylist(), batch["is_word"].to_pylist(), batch["grams"], batch["n"], strict=True):
            if segment != now:
                if now is not None:
                    yield done()
                now, words, pairs = segment, _Sums(), _Sums()
            (words if is_word else pairs).add(np.frombuffer(grams.as_buffer(), dtype=np.uint64), np.frombuffer(counts.as_buffer(), dtype=np.int32))
    if now is not None:
        yield done()


def _totals(counted: DataFrame) -> tuple[int, int]:
    """Number of tokens and of different words."""
    return tuple(counted.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first())


def filter_bytes(counted: DataFrame) -> int:
    return counted.where("kind = 1").agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]


def load(counted: DataFrame) -> LanguageModel:
    """The model of stored counts; its segments come to the driver, so it is for filters of up to BROADCAST_BYTES."""
    segments = counted.where("kind = 1")
    sizes, entries = np.full(1 << SEGMENT_BITS, 8, dtype=np.uint64), np.zeros(1 << SEGMENT_BITS, dtype=np.int64)
    for row in segments.select("key", "n", F.length("bits").alias("bytes")).collect():
        sizes[row.key], entries[row.key] = 8 * row.bytes, row.n
    ends = np.cumsum((sizes >> np.uint64(3)).astype(np.int64))
    starts, bits = np.concatenate([[0], ends[:-1]]), np.zeros(ends[-1], dtype=np.uint8)
    for row in segments.select("key", "bits").toLocalIterator():
        bits[starts[row.key] : ends[row.key]] = np.frombuffer(row.bits, dtype=np.uint8)
    return LanguageModel(bits, starts, sizes, entries, *_totals(counted))


def _narrow(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Sorted keys as the steps from one to the next, or from the start of its segment, and the bytes that each step takes.

    In a large step the steps have 6 bytes; in none they have more than 7, as segments have less than 2^56 keys.
    """
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    first = np.flatnonzero(np.diff(keys >> _SEGMENT, prepend=np.uint64(1 << SEGMENT_BITS)))
    steps[first] = keys[first] & np.uint64((1 << (64 - SEGMENT_BITS)) - 1)
    width = max(1, -(-int(steps.max(initial=np.uint64(0))).bit_length() // 8))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]), width


def _wide(cells: list[np.ndarray], widths: list[int], segment: int) -> np.ndarray:
    """The keys of cells of one segment, each written by `_narrow`."""
    counts = np.array([len(x) // w for x, w in zip(cells, widths, strict=True)])
    steps = np.zeros((int(counts.sum()), 8), dtype=np.uint8)
    ends = np.cumsum(counts)
    for width in set(widths):
        of = np.array(widths) == width
        steps[np.repeat(of, counts), :width] = np.concatenate([x for x, w in zip(cells, widths, strict=True) if w == width]).reshape(-1, width)
    sums = np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)
    before = np.concatenate([[np.uint64(0)], sums])[ends - counts]
    return sums - np.repeat(before, counts) + (np.uint64(segment) << _SEGMENT)


def _planes(values: np.ndarray) -> bytes:
    """Integers, the lowest bytes of all first, compressed."""
    return _ZSTD.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T), asbytes=True)


def _of_planes(raw: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_ZSTD.decompress(raw, n * size, asbytes=True), dtype=np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and of each value the index among them."""
    order = np.argsort(values)
    ranked = values[order]
    cuts = _cuts(ranked)
    index = np.empty(len(values), dtype=np.int64)
    index[order] = np.repeat(np.arange(len(cuts)), np.diff(cuts, append=len(values)))
    return ranked[cuts], index


def _spread(values: np.ndarray, of_distinct: np.ndarray) -> np.ndarray:
    """For each value what its distinct one has; those are in their order."""
    order = np.argsort(values)
    cuts = _cuts(values[order])
    out = np.empty(len(values), dtype=of_distinct.dtype)
    out[order] = np.repeat(of_distinct, np.diff(cuts, append=len(values)))
    return out


def _text_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of words, a row for each step: ``(step, n_words, n, words, seq, ids, sizes)``.

    ``words`` are the different words, the most frequent first; ``seq`` has the number of each of the ``n`` tokens, ``sizes`` the tokens of
    each text and ``ids`` their ``doc_id``. A step has about COUNT_TOKENS tokens and whole texts.
    """
    task, step = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
    held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def done() -> pa.RecordBatch:
        tokens, sizes, ids = (list(x) for x in zip(*held, strict=True))
        held.clear()
        words, index = _numbered(np.concatenate(tokens))
        counts = np.bincount(index)
        order = np.argsort(-counts, kind="stable")  # those of a count stay sorted
        rank = np.empty(len(words), dtype=np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        words = words[order]
        words[1:] -= words[:-1].copy()
        values = [(task << 32) + step, len(words), len(index), _planes(words), _planes(rank[index]), pa.concat_arrays(ids).to_pylist(), np.concatenate(sizes).astype("<i4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TEXT_STEP.types, strict=True)], schema=_TEXT_STEP)

    size = 0
    for batch in grouped(batches, SCORE_STEP):
        tokens, at = token_hashes(batch["text"])
        held.append((tokens, np.diff(at), batch["doc_id"]))
        size += len(tokens)
        if size >= COUNT_TOKENS:
            yield done()
            step, size = step + 1, 0
    if held:
        yield done()


def _tokens(step: dict) -> tuple[np.ndarray, np.ndarray]:
    """Different words of a row of `_text_steps`, and the number of each token's word."""
    words = np.cumsum(_of_planes(step["words"], step["n_words"], np.uint64), dtype=np.uint64)
    return words, _of_planes(step["seq"], step["n"], np.uint32)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What steps ask of the segments: ``(segment, kind, key, n, words, pairs)``, a row for each step and segment, of kind 2.

    ``key`` is the step; ``words`` and ``pairs`` are its n-grams, sorted and without repeats, by `_narrow`; ``n`` has the widths of both.
    """
    for batch in batches:
        for step in batch.to_pylist():
            words, seq = _tokens(step)
            pairs = _pairs(words[seq])
            pairs.sort()
            asked = [np.sort(salted(words, 21)), pairs[_cuts(pairs)]]
            (words, width), (pairs, wide) = map(_narrow, asked)
            starts = np.arange((1 << SEGMENT_BITS) + 1, dtype=np.uint64)
            of_word, of_pair = (np.searchsorted(x >> _SEGMENT, starts) for x in asked)
            used = np.flatnonzero(np.diff(of_word) + np.diff(of_pair))
            for low in range(0, len(used), PACKED):
                part = used[low : low + PACKED]
                m = len(part)
                cells = (pa.array([x[a:b].tobytes() for a, b in zip(at[part], at[part + 1], strict=True)], pa.binary()) for x, at in ((words, of_word), (pairs, of_pair)))
                columns = [pa.array(part.astype(np.int32)), pa.array(np.full(m, 2, dtype=np.int32)), pa.array(np.full(m, step["step"])), pa.array(np.full(m, 8 * width + wide)), *cells]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "kind", "key", "n", "words", "pairs"])


def _of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored words and the bits of segments in the form of `_asked`, of kinds 1 and 0; the bits are in ``pairs``."""
    for batch in batches:
        key = batch["key"].to_numpy()
        bits = batch["kind"].to_numpy() == 1
        segment = np.where(bits, key, (salted(key.view(np.uint64), 21) >> _SEGMENT).view(np.int64))
        columns = [pa.array(segment.astype(np.int32)), pa.array((~bits).astype(np.int32)), batch["key"], batch["n"], pa.nulls(len(key), pa.binary()), batch["bits"]]
        yield pa.RecordBatch.from_arrays(columns, ["segment", "kind", "key", "n", "words", "pairs"])


def _answers(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """What segments answer: ``(step, segment, words, pairs)``, a row for each of kind 2, in the order of what it asks.

    ``words`` has the levels of its words, as bytes, and then their counts, as 64-bit integers; ``pairs`` has the levels of its pairs. Rows come
    sorted by segment and kind; levels are asked for up to ``most``.
    """
    now, bits, parts, known = None, np.zeros(1, dtype=np.uint8), [], None
    none = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    for batch in batches:
        group = 4 * batch["segment"].to_numpy().astype(np.int64) + batch["kind"].to_numpy()
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1), len(group)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high == low:
                continue
            rows = batch.slice(low, high - low)
            segment, kind = divmod(int(group[low]), 4)
            if segment != now:  # one that no n-gram was entered in has no bits
                now, bits, parts, known = segment, np.zeros(1, dtype=np.uint8), [], None
            if kind == 0:
                bits = np.frombuffer(rows["pairs"][0].as_py(), dtype=np.uint8)
            elif kind == 1:
                parts.append((salted(rows["key"].to_numpy().view(np.uint64), 21), rows["n"].to_numpy()))
            else:
                if known is None:
                    keys, counts = (np.concatenate(x) for x in zip(none, *parts, strict=True))
                    order = np.argsort(keys)
                    known = keys[order], counts[order]
                yield _answered(rows, segment, bits, *known, most)


def _answered(rows: pa.RecordBatch, segment: int, bits: np.ndarray, keys: np.ndarray, counts: np.ndarray, most: int) -> pa.RecordBatch:
    widths = rows["n"].to_numpy()
    out = []
    for name, of in (("words", widths // 8), ("pairs", widths % 8)):
        cells = [np.frombuffer(x, dtype=np.uint8) for x in rows[name].to_pylist()]
        grams = _wide(cells, of.tolist(), segment)
        ends = np.cumsum([len(x) // w for x, w in zip(cells, of, strict=True)])
        n = len(grams)
        levels = _ask(bits, np.zeros(n, dtype=np.int64), np.full(n, 8 * len(bits), dtype=np.uint64), grams, np.full(n, most)).astype(np.uint8)
        exact = np.zeros(n, dtype="<i8")
        if name == "words" and len(keys) and n:
            where = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            there = keys[where] == grams
            exact[there] = counts[where[there]]
        tail = (lambda a, b: exact[a:b].tobytes()) if name == "words" else lambda a, b: b""
        out.append(pa.array([levels[a:b].tobytes() + tail(a, b) for a, b in zip([0, *ends[:-1]], ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays([rows["key"], rows["segment"], *out], ["step", "segment", "words", "pairs"])


def _joined_scores(docs: DataFrame, counted: DataFrame, tokens: int, words: int) -> DataFrame:
    """Scores by a filter that is too large to broadcast, of ``docs (doc_id, text)``: ``(doc_id, n_tokens, n_known, base_score, score)``.

    Steps of texts are stored as numbers of words. Their n-grams go to the segments, each once for a step, and levels and counts come back in
    the same order; nothing else of a text is shuffled but the numbers of its words.
    """
    spark = docs.sparkSession
    n, most = partitions(spark), _most(tokens)
    steps = stored(docs.mapInArrow(_text_steps, "step long, n_words long, n long, words binary, seq binary, ids array<long>, sizes binary"), "text_steps")
    form = "segment int, kind int, key long, n long, words binary, pairs binary"
    asked = steps.select("step", "n_words", "n", "words", "seq").mapInArrow(_asked, form).union(counted.mapInArrow(_of_segments, form))
    asked = asked.repartition(n, "segment").sortWithinPartitions("segment", "kind")
    answers = stored(asked.mapInArrow(lambda x: _answers(x, most), "step long, segment int, words binary, pairs binary"), "answers")
    none = (F.lit(None).cast(x.dataType).alias(x.name) for x in steps.schema if x.name not in ("step", "words", "seq"))
    rows = answers.select("step", "segment", "words", F.col("pairs").alias("seq"), *none).unionByName(steps.withColumn("segment", F.lit(-1)))
    rows = rows.repartition(n, "step").sortWithinPartitions("step", "segment")
    return rows.mapInArrow(lambda x: _step_scores(x, tokens, words), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def _step_scores(batches: Iterator[pa.RecordBatch], tokens: int, words: int) -> Iterator[pa.RecordBatch]:
    """Scores of the texts of steps; each row of `_text_steps` has its answers after it, by segment."""
    step: dict = {}
    of_words: list[bytes] = []
    of_pairs: list[bytes] = []

    def done() -> pa.RecordBatch:
        distinct, seq = _tokens(step)
        of_segments = [np.frombuffer(x, dtype=np.uint8).reshape(9, -1) for x in of_words]
        order = np.argsort(salted(distinct, 21))
        level, count = np.empty(len(distinct), dtype=np.uint8), np.empty(len(distinct), dtype=np.int64)
        level[order] = np.concatenate([x[0] for x in of_segments])
        count[order] = np.concatenate([x[1:].reshape(-1).view("<i8") for x in of_segments])
        pair = _spread(_pairs(distinct[seq]), np.frombuffer(b"".join(of_pairs), dtype=np.uint8))
        word = level[seq]
        before = np.concatenate([level[distinct == END], word[:-1]])
        logs = np.empty(len(seq))
        for low in range(0, len(seq), SLICE):
            logs[low : low + SLICE] = _logs(*(x[low : low + SLICE].astype(np.int64) for x in (word, before, pair)), tokens, words)
        base = np.log10((count + 0.5) / (tokens + 0.5 * (words + 1)))
        sizes = np.frombuffer(step["sizes"], dtype="<i4").astype(np.int64)
        at = np.cumsum(sizes) - sizes
        add = lambda x: pa.array(np.add.reduceat(x, at))  # noqa: E731  no text is without a token
        return pa.RecordBatch.from_arrays(
            [pa.array(step["ids"], pa.int64()), pa.array(sizes), add((count > 0).astype(np.int64)[seq]), add(base[seq]), add(logs)],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["segment"] < 0:
                if step:
                    yield done()
                step, of_words, of_pairs = row, [], []
            else:
                of_words.append(row["words"])
                of_pairs.append(row["seq"])
    if step:
        yield done()


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Scores of all texts of ``docs (doc_id, text, ...)`` by a model of those rows where ``train`` holds.

    Returns ``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, a row for each row of ``docs``. Tokens are the
    words (see ``words``) and one end. ``n_known`` counts tokens that the training rows hold; ``base_score`` adds up
    log10((c + 0.5) / (N + 0.5 (V + 1))) with the exact counts c of words; ``score`` is log10 of the text's probability by the model.

    A NULL or empty text has the end only. Rows with equal ids and texts get equal scores; NULL ids are kept. ``train``
    being NULL counts as false; without training rows every count is 0. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counted = count(docs.where("train"))
    n_tokens, n_words = _totals(counted)
    if filter_bytes(counted) > BROADCAST_BYTES:
        joined = _joined_scores(in_small_batches(docs).select("doc_id", "text"), counted, n_tokens, n_words)
        return joined.select("doc_id", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
    model = load(counted)
    exact = counted.where("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"))
    top = _frequent(exact).toArrow()  # in columns: an object for each row would take the driver many times their size
    order = np.argsort(top["word"].to_numpy().view(np.uint64))
    frequent = (top["word"].to_numpy().view(np.uint64)[order], top["c"].to_numpy()[order])
    total = n_tokens + 0.5 * (n_words + 1)
    shared = spark.sparkContext.broadcast((model, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (words, counts) = shared.value
        for batch in grouped(batches, SCORE_STEP):
            tokens, at = token_hashes(batch["text"])
            distinct, inverse = np.unique(tokens, return_inverse=True)
            logs = model.log_probabilities(distinct, inverse, tokens)
            c, found = np.zeros(len(distinct)), np.zeros(len(distinct), dtype=bool)
            if len(words):
                where = np.minimum(np.searchsorted(words, distinct), len(words) - 1)
                found = words[where] == distinct
                c[found] = counts[where[found]]
            base = np.where(found, np.log10((c + 0.5) / total), 0.0)
            names = batch["doc_id"]
            content = batch["content"].to_numpy()
            add = lambda x: np.add.reduceat(x, at[:-1])  # noqa: E731  no text is without a token
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(content), pa.array(mix(content.view(np.uint64)).view(np.int64)), pa.array(np.ones(n, dtype=np.int64)), pa.array(np.diff(at)), pa.array(add(found[inverse].astype(np.int64))), pa.array(add(base[inverse])), pa.array(add(logs))],
                _PARTS,
            )
            # words of unknown count, once for each text
            rare = np.flatnonzero(~found[inverse])
            if len(rare):
                text = np.searchsorted(at, rare, side="right") - 1
                pairs, times = np.unique(text * len(distinct) + inverse[rare], return_counts=True)
                text, word = pairs // len(distinct), distinct[pairs % len(distinct)]
                for low in range(0, len(pairs), 1 << 16):
                    t, m = text[low : low + (1 << 16)], times[low : low + (1 << 16)]
                    zero, none = pa.array(np.zeros(len(t), dtype=np.int64)), pa.array(np.zeros(len(t)))
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(t)), pa.array(content[t]), pa.array(word[low : low + (1 << 16)].view(np.int64)), zero, pa.array(m), zero, none, none], _PARTS
                    )

    rows = in_small_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("content")))
    parts = rows.mapInArrow(run, "doc_id long, content long, word long, texts long, tokens long, known long, base double, score double")
    known = parts.join(exact, "word", "left")
    rare = F.col("texts") == 0
    seen = F.coalesce("c", F.lit(0))
    sums = known.groupBy("doc_id", "content").agg(
        F.sum("texts").alias("texts"),
        F.sum(F.when(~rare, F.col("tokens"))).alias("tokens"),
        F.sum(F.when(~rare, F.col("known")).when(seen > 0, F.col("tokens")).otherwise(0)).alias("known"),
        F.sum(F.when(~rare, F.col("base")).otherwise(F.col("tokens") * F.log10((seen + 0.5) / F.lit(total)))).alias("base"),
        F.sum("score").alias("score"),
    )
    # repeated rows were added up together: share out and repeat
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("texts"))))
    return each.select(
        "doc_id",
        (F.col("tokens") / F.col("texts")).cast("long").alias("n_tokens"),
        (F.col("known") / F.col("texts")).cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("texts")).alias("base_score"),
        (F.col("score") / F.col("texts")).alias("score"),
    )


def _frequent(exact: DataFrame) -> DataFrame:
    """Words above a count that leaves at most FREQUENT of them; found from a few hundred classes of counts."""
    level = F.floor(F.log(F.col("c")) * 20)
    classes = exact.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    lowest, total = None, 0
    for row in classes:
        total += row["count"]
        if total > FREQUENT:
            break
        lowest = row["level"]
    return exact.where(F.lit(False) if lowest is None else level >= lowest)


_PARTS = ["doc_id", "content", "word", "texts", "tokens", "known", "base", "score"]
