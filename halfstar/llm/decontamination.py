"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

A short item inside a long document has a tiny Jaccard similarity to all of it, so MinHash of whole
documents would miss it. Items are therefore partitioned by size. Those of at most 8 shingles are looked up exactly: of
n shingles, of which m have to be in the document, any n - m + 1 have one that is. Larger ones fall into classes up to u = 16, 32, ...
shingles, and each class is compared with windows of 2u shingles that begin at every u-th shingle of
a document. A passage of at most u shingles lies whole in one of them, and an item of more than u/2, of which four fifths lie there, has a
similarity to it of at least 0.19: all of 64 minima differ with a chance of about 10**-6. Minima of
windows are minima of blocks of the smallest class, taken together two by two, so each shingle is hashed once for all classes. Shingles that
no item of the slice has are left out before: they can be no item's minimum, and without them a window only comes nearer to the items it holds.

A document and an item with any minimum, or any of the shingles looked up, in common are a candidate pair, which an exact count of the item's distinct
shingles in the *whole* document decides. Items come in slices of bounded size, which are broadcast; for
each slice the documents are passed over once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_small_batches
from .words import distinct_sets, grouped, salted, shingle_hashes, word_hashes

#: Words of a shingle; percent of an item's shingles that a document must hold.
WIDTH, PERCENT = 5, 80
#: Minima of a signature, and shingles of the largest items that are looked up exactly.
MINIMA, EXACT = 64, 8
#: Items and characters of items that are broadcast at once, at most (a longer item goes alone).
SLICE_ITEMS, SLICE_CHARS = 20_000, 16_000_000

_FACTORS = salted(np.arange(MINIMA, dtype=np.uint64), 11) | np.uint64(1)


def _minima(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each of the hash functions, the minimum of each block that begins at ``cuts``."""
    out = np.empty((MINIMA, len(cuts)), dtype=np.uint64)
    for k, factor in enumerate(_FACTORS):
        np.minimum.reduceat(values * factor, cuts, out=out[k])
    return out


def _changes(text: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Where a new block begins."""
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (block[1:] != block[:-1])
    return np.flatnonzero(fresh)


def _windows(minima: np.ndarray, text: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima and texts of all windows of two neighbouring blocks; ``block`` counts within a text, and empty blocks are left out."""
    next_to = np.zeros(len(text), dtype=bool)  # whether the block before is there
    next_to[1:] = (text[1:] == text[:-1]) & (block[1:] == block[:-1] + 1)
    joined = np.flatnonzero(next_to)
    windows = minima.copy()
    windows[:, joined - 1] = np.minimum(minima[:, joined - 1], minima[:, joined])
    alone = np.flatnonzero(~next_to & (block > 0))  # the window that begins with the empty block before
    return np.concatenate([windows, minima[:, alone]], axis=1), np.concatenate([text, text[alone]])


class ItemIndex:
    """Items of one slice: shingles, keys of small items, classes of the others by size and the minima of each class."""

    def __init__(self, ids: list[int], texts: list[str | None], percent: int = PERCENT, short_items: bool = False):
        words = word_hashes(pa.array(texts, pa.string()))
        values, starts = distinct_sets(*shingle_hashes(*words, WIDTH, whole_if_short=short_items))
        sizes = np.diff(starts)
        self.ids = np.array(ids, dtype=np.int64)
        self.sets = [values[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        #: Words of the items below WIDTH words, whose only shingle is their whole sequence.
        self.widths = sorted(set(np.diff(words[1]).tolist()) & set(range(1, WIDTH))) if short_items else []
        small = [(key, i) for i in np.flatnonzero((sizes > 0) & (sizes <= EXACT)) for key in self.sets[i][: sizes[i] - -(-percent * sizes[i] // 100) + 1]]
        small.sort()
        self.keys, self.of_key = np.array([k for k, _ in small], dtype=np.uint64), np.array([i for _, i in small], dtype=np.int64)
        #: All shingles of items of the classes, and which leading bits they have.
        self.known = np.unique(np.concatenate([values[:0], *(self.sets[i] for i in np.flatnonzero(sizes > EXACT))]))
        bits = int(np.clip(len(self.known), 1 << 6, 1 << 20) - 1).bit_length() + 4
        self.leading, self.shift = np.zeros(1 << bits, dtype=bool), np.uint64(64 - bits)
        self.leading[self.known >> self.shift] = True
        self.classes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        upper = np.where(sizes > EXACT, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 0)
        for u in np.unique(upper[upper > 0]):
            items = np.flatnonzero(upper == u)
            minima = np.stack([_minima(self.sets[i], np.array([0]))[:, 0] for i in items], axis=1)
            bits = int(np.clip(len(items), 1 << 6, 1 << 16) - 1).bit_length() + 8
            seen = np.zeros((MINIMA, 1 << bits), dtype=bool)
            for k in range(MINIMA):
                seen[k, minima[k] >> np.uint64(64 - bits)] = True
            self.classes.append((int(u), items, minima, seen))

    def exact(self, values: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of text and small item of which a key is among the texts' shingles."""
        found: set[tuple[int, int]] = set()
        if len(self.keys):
            low, high = (np.searchsorted(self.keys, values, side=side) for side in ("left", "right"))
            at = np.flatnonzero(low < high)
            text = np.searchsorted(np.cumsum(counts), at, side="right")
            for t, a, b in np.unique(np.stack([text, low[at], high[at]], axis=1), axis=0).tolist():
                found.update((t, i) for i in self.of_key[a:b].tolist())
        return found

    def candidates(self, values: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of text and item with a key or minimum in common; ``values`` are the texts' shingles in order."""
        found = self.exact(values, counts)
        if not len(values) or not self.classes:
            return found
        at = np.flatnonzero(self.leading[values >> self.shift])
        place = np.searchsorted(self.known, values[at])
        at = at[self.known[np.minimum(place, len(self.known) - 1)] == values[at]]
        if not len(at):
            return found
        ends = np.cumsum(counts)
        text = np.searchsorted(ends, at, side="right")
        size = self.classes[0][0]  # smaller blocks than the smallest class needs are left out
        block = (at - (ends - counts)[text]) // size
        cuts = _changes(text, block)
        minima, text, block = _minima(values[at], cuts), text[cuts], block[cuts]
        for u, items, known, seen in self.classes:
            while size < u:
                block, size = block // 2, 2 * size
                cuts = _changes(text, block)
                minima, text, block = np.minimum.reduceat(minima, cuts, axis=1), text[cuts], block[cuts]
            windows, of_window = _windows(minima, text, block)
            shift = np.uint64(64 - int(seen.shape[1]).bit_length() + 1)
            for k in range(MINIMA):
                for w in np.flatnonzero(seen[k][windows[k] >> shift]):
                    for i in np.flatnonzero(known[k] == windows[k, w]):
                        found.add((int(of_window[w]), int(items[i])))
        return found


def _slices(items: DataFrame) -> Iterator[tuple[list[int], list[str | None]]]:
    """All items, in slices of bounded size."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null and text is not null")
    n, chars = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    many = max(1, -(-n // SLICE_ITEMS), -(-(chars or 0) // SLICE_CHARS)) * 2 if n > SLICE_ITEMS or (chars or 0) > SLICE_CHARS else 1
    for k in range(many):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == k) if many > 1 else items
        rows = part.collect()
        if rows or many == 1:
            yield [r.item_id for r in rows], [r.text for r in rows]


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, short_items: bool = False) -> DataFrame:
    """Documents that hold benchmark items: ``(doc_id, item_id, n_shared, n_item)``, a row for each pair.

    ``items (item_id, text)``. An item is held when at least ``percent`` of its distinct five-word
    shingles occur anywhere in the whole document, as words in lower case (A-Z) between white space. Items of fewer
    than five words have no shingle and are in no pair; with ``short_items`` they count as one shingle, their whole sequence of words,
    and are held by documents where it occurs. Documents of fewer than five words can hold such items only.
    NULL or empty texts and items without an id are in no pair.
    Rows of ``docs`` with a NULL ``doc_id`` yield rows with a NULL; repeated rows of either table yield a row each.
    Other columns are ignored. Empty tables give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    results = [_search(docs, context.broadcast(ItemIndex(*part, percent, short_items)), percent) for part in _slices(items)]
    return reduce(DataFrame.union, results)


def _search(docs: DataFrame, shared, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in grouped(batches, 1 << 22):
            words = word_hashes(batch["text"])
            values, starts = shingle_hashes(*words, WIDTH, whole_if_short=False)
            wanted = defaultdict(list)
            for text, item in sorted(index.candidates(values, np.diff(starts))):
                wanted[text].append(item)
            rows = []
            for width in index.widths:
                spans, ends = shingle_hashes(*words, width, whole_if_short=False)
                rows += [(text, int(index.ids[item]), 1, 1) for text, item in sorted(index.exact(spans, np.diff(ends)))]
            for text, items in wanted.items():
                whole = np.unique(values[starts[text] : starts[text + 1]])
                for item in items:
                    shared_count = int(np.isin(index.sets[item], whole, assume_unique=True).sum())
                    if 100 * shared_count >= percent * len(index.sets[item]):
                        rows.append((text, int(index.ids[item]), shared_count, len(index.sets[item])))
            if rows:
                at, ids, some, all_ = zip(*rows, strict=True)
                columns = [batch["doc_id"].take(pa.array(at)), pa.array(ids, pa.int64()), pa.array(some, pa.int64()), pa.array(all_, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_shared", "n_item"])

    return in_small_batches(docs).mapInArrow(run, "doc_id long, item_id long, n_shared long, n_item long")
