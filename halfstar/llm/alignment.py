"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes, so each token list is an ascending array of end offsets. Ends that both have cut the
text into groups. **Diagonal run skipping** walks both arrays at once: while the same index shift between them goes on giving equal
ends, tokens are one to one, and slices of doubling, then halving length are compared to jump over such a stretch. Where
the ends differ, the group is resolved token by token up to the next common end, and the shift is what
it is there. Links are the pairs of tokens whose bytes overlap.

How often two ids are linked is counted over the whole corpus. The counts of the most frequent pairs, at most ``FREQUENT`` of them, are
broadcast; links of other pairs find theirs by a join.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import stored
from .token_records import LibraryEncoder, _Known
from .words import grouped, text_buffers

#: Pairs of ids whose counts are broadcast, at most (17 bytes each).
FREQUENT = 1 << 18
#: Bytes of text that are aligned at once; entries of documents that are counted at once.
STEP, COUNTED = 1 << 21, 1 << 22
#: Bytes that a byte-level vocabulary writes as themselves; the others, in order, are written as code points from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_level_entries(tokenizer: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer given as JSON; added tokens stand for their own text."""
    others = [b for b in range(256) if b not in set(_PLAIN)]
    of = {chr(b): b for b in _PLAIN} | {chr(256 + n): b for n, b in enumerate(others)}
    library = Tokenizer.from_str(tokenizer)
    added = {t["id"] for t in json.loads(tokenizer).get("added_tokens") or []}
    entries = [b""] * library.get_vocab_size()
    for entry, i in library.get_vocab().items():
        entries[i] = entry.encode() if i in added else bytes(of[c] for c in entry)
    return entries


def piece_entries(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, and byte pieces are their byte."""
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return entries


class EntryEncoder(LibraryEncoder):
    """Ids from a byte-level tokenizer; none for a chunk whose bytes they do not give back."""

    def __init__(self, tokenizer: str):
        self.entries = byte_level_entries(tokenizer)
        super().__init__(tokenizer, 2 if len(self.entries) <= 1 << 16 else 4)

    def library_ids(self, chunks: list[str]) -> list[list[int]]:
        return self.checked(super().library_ids(chunks), chunks)

    def checked(self, ids: list[list[int]], chunks: list[str]) -> list[list[int]]:
        return [x if b"".join([self.entries[i] for i in x]) == c.encode() else [] for x, c in zip(ids, chunks, strict=True)]


class PieceEncoder(EntryEncoder):
    """Ids of texts that begin with a space, from a sentencepiece model that puts that space before texts itself.

    Where no piece has U+2581 after another character, nothing is merged across a space that follows another character, so texts are cut before it and each
    distinct chunk is encoded once; else texts are encoded whole.
    """

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.entries = piece_entries(self.library)
        self.cuts = not any("▁" in self.library.id_to_piece(i).lstrip("▁") for i in range(len(self.entries)))
        self.dtype = "<u2" if len(self.entries) <= 1 << 16 else "<u4"
        self.known = _Known(self.dtype)

    def starts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        begins = at[:-1][np.diff(at) > 0]
        if not self.cuts:
            return begins
        cut = data == 32
        cut[1:] &= data[:-1] != 32
        cut[at[1:][np.diff(at) > 0] - 1] = False  # a space at the end is no chunk of its own
        cut[begins] = True
        return np.flatnonzero(cut)

    def library_ids(self, chunks: list[str]) -> list[list[int]]:
        return self.checked(self.library.encode([c[1:] for c in chunks], num_threads=1), chunks)


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Runs of one-to-one tokens, ``first in a, first in b, length``, and all other groups, ``first in a, first in b, last in a, last in b``.

    Both are flat lists of numbers. ``a`` and ``b`` are ascending ends of the same bytes, so their last ones are equal.
    """
    runs: list[int] = []
    groups: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            low, step, shift = i, 1, j - i
            i += 1
            while i < n and a[i : i + step] == b[i + shift : i + shift + step]:
                i += step
                step *= 2
            while step > 1:
                step //= 2
                if a[i : i + step] == b[i + shift : i + shift + step]:
                    i += step
            if i > n:  # equal slices end together, since the last ends are equal
                i = n
            runs += low, j, i - low
            j = i + shift
        else:
            low, begin = i, j
            while x != y:  # up to the next common end
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            groups += low, begin, i, j
            i += 1
            j += 1
    return runs, groups


def _spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indexes from each ``first`` on, one span after the other."""
    return np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


class Aligned(NamedTuple):
    """Texts in a row: their tokens, which of these end a group, the links between them."""

    rows: np.ndarray  #: index of each text in its batch
    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray  #: of each text, with the end at last
    first_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    left: np.ndarray
    right: np.ndarray


class Aligner:
    """Both tokenizers, and the bytes and names of their ids."""

    def __init__(self, tokenizer: str, model: bytes):
        self.encoders = EntryEncoder(tokenizer), PieceEncoder(model)
        self.bytes = [np.array([len(e) for e in x.entries], dtype=np.int64) for x in self.encoders]
        self.sizes = [len(x.entries) for x in self.encoders]
        self.inner, self.bar, self.semi = (np.array([f"{i}{mark}" for i in range(max(self.sizes))], dtype=object) for mark in ",|;")

    def align(self, texts: pa.Array) -> Aligned:
        """Texts that are not NULL or empty, and whose tokens join to a space and the text in both tokenizers."""
        rows = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
        space, nothing = (pa.scalar(v, pa.large_string()) for v in (" ", ""))
        spaced = pc.binary_join_element_wise(space, texts.take(pa.array(rows)).cast(pa.large_string()), nothing)
        ids = [x.encode(spaced) if len(rows) else [] for x in self.encoders]
        # chunks whose bytes are not given back have no ids, so that the bytes of their texts are fewer
        size = pc.binary_length(spaced).to_numpy()
        good = np.ones(len(rows), dtype=bool)
        for each, lengths in zip(ids, self.bytes, strict=True):
            good &= np.fromiter((lengths[x].sum() for x in each), dtype=np.int64, count=len(rows)) == size
        ids = [[x for x, fine in zip(each, good, strict=True) if fine] for each in ids]
        first = [np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)]) for each in ids]
        a, b = (np.concatenate([np.empty(0, dtype=np.int64), *each]).astype(np.int64) for each in ids)
        until_a, until_b = np.cumsum(self.bytes[0][a]), np.cumsum(self.bytes[1][b])
        runs, groups = diagonal_runs(until_a.tolist(), until_b.tolist())
        begin_a, begin_b, length = np.array(runs, dtype=np.int64).reshape(-1, 3).T.copy()
        run_a, run_b = _spans(begin_a, length), _spans(begin_b, length)
        low_a, low_b, high_a, high_b = np.array(groups, dtype=np.int64).reshape(-1, 4).T.copy()
        # inside a group, each stretch between two ends of either side is one link
        ends = np.concatenate([until_a[_spans(low_a, high_a - low_a + 1)], until_b[_spans(low_b, high_b - low_b)]])
        ends = np.unique(ends)
        ends_a, ends_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        ends_a[run_a] = ends_b[run_b] = True
        ends_a[high_a] = ends_b[high_b] = True
        left, right = np.searchsorted(until_a, ends), np.searchsorted(until_b, ends)
        return Aligned(rows[good], a, b, *first, ends_a, ends_b, np.concatenate([run_a, left]), np.concatenate([run_b, right]))

    def written(self, x: Aligned) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = (np.cumsum(ends) - ends for ends in (x.ends_a, x.ends_b))
        until_a = np.flatnonzero(x.ends_a) + 1
        before_b = np.concatenate([[0], np.flatnonzero(x.ends_b) + 1])
        parts = np.empty(len(x.a) + len(x.b), dtype=object)
        parts[np.arange(len(x.a)) + before_b[group_a]] = np.where(x.ends_a, self.bar[x.a], self.inner[x.a])
        parts[np.arange(len(x.b)) + until_a[group_b]] = np.where(x.ends_b, self.semi[x.b], self.inner[x.b])
        cuts = (x.first_a + x.first_b).tolist()
        return ["".join(parts[low:high].tolist())[:-1] for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def _aligner(tokenizer: str, model: bytes) -> Aligner:
    """One for each Python worker, which keeps what it knows from task to task."""
    return Aligner(tokenizer, model)


def _lists(values: np.ndarray, cuts: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """A list for each of ``n`` rows, empty where a row has no part of ``values``."""
    sizes = np.zeros(n, dtype=np.int64)
    sizes[rows] = np.diff(cuts)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignments(docs: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """Tokens of both tokenizers and where their groups end: ``(doc_id, a_ids, b_ids, a_ends, b_ends)``.

    ``a_ends[k]`` and ``b_ends[k]`` are the numbers of tokens up to the end of group k. A row for each row of ``docs (doc_id, text, ...)``, all lists
    empty where the text is NULL or empty or does not come back from the tokens of either side. ``tokenizer`` is the JSON of a byte-level tokenizer, given
    a space and the text; ``model`` a sentencepiece model, which puts that space before the text itself. Strings of special tokens in texts are
    plain text. Rows with a NULL or repeated ``doc_id`` are aligned each by itself, texts of any length whole; other columns are ignored; an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        for batch in grouped(batches, STEP):
            x, n = aligner.align(batch["text"]), batch.num_rows
            columns = [batch["doc_id"], _lists(x.a.astype(np.int32), x.first_a, x.rows, n), _lists(x.b.astype(np.int32), x.first_b, x.rows, n)]
            for ends, first in ((x.ends_a, x.first_a), (x.ends_b, x.first_b)):
                at = np.flatnonzero(ends)
                cuts = np.searchsorted(at, first)
                columns.append(_lists((at - np.repeat(first[:-1], np.diff(cuts)) + 1).astype(np.int32), cuts, x.rows, n))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return _texts(docs).mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def link_counts(docs: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """How far the links of each text are usual ones: ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``.

    A link is a token of each side whose bytes overlap; the count of its two ids is the number of links of the whole table that hold them. ``n_best``
    are the links of a text whose count is the highest of all pairs with the same id of the model, ties included; ``count_sum`` adds up the counts of
    its links. ``groups_sha256`` is of the groups written as ``a1,a2|b1;a3|b2,b3``, and empty where there are no tokens. Rows, NULLs and
    texts as in `alignments`; texts without tokens have zeros.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer, model))
    wide = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    kind = "int" if Tokenizer.from_str(tokenizer).get_vocab_size() * wide < 1 << 31 else "long"
    facts = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(*shared.value), TaskContext.get().partitionId() << 40
        for batch in grouped(batches, STEP):
            x, n = aligner.align(batch["text"]), batch.num_rows
            text = np.searchsorted(x.first_a, x.left, side="right") - 1
            pair = x.a[x.left] * wide + x.b[x.right]
            if kind == "int":  # both fit one number
                text = np.sort(text << 32 | pair)
                text, pair = text >> 32, text & 0xFFFFFFFF
            else:
                order = np.lexsort((pair, text))
                text, pair = text[order], pair[order]
            head = np.ones(len(pair), dtype=bool)
            head[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
            at = np.flatnonzero(head)
            cuts = np.searchsorted(text[at], np.arange(len(x.rows) + 1))
            times = np.diff(np.append(at, len(pair)))
            groups = np.concatenate([[0], np.cumsum(x.ends_a)])
            counts = [np.diff(x.first_a), np.diff(x.first_b), np.diff(groups[x.first_a]), np.bincount(text, minlength=len(x.rows)) if len(text) else np.zeros(len(x.rows))]
            digests = [""] * n
            for row, written in zip(x.rows.tolist(), aligner.written(x), strict=True):
                digests[row] = hashlib.sha256(written.encode()).hexdigest()
            columns = [pa.array(np.arange(number, number + n)), batch["doc_id"]]
            for each in counts:
                column = np.zeros(n, dtype=np.int64)
                column[x.rows] = each
                columns.append(pa.array(column))
            columns += [pa.array(digests), _lists(pair[at].astype(np.int32 if kind == "int" else np.int64), cuts, x.rows, n), _lists(times.astype(np.int32), cuts, x.rows, n)]
            yield pa.RecordBatch.from_arrays(columns, ["row", *facts, "pairs", "times"])
            number += n

    schema = f"row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<{kind}>, times array<int>"
    texts = stored(_texts(docs).mapInArrow(run, schema), "alignments")
    counts = stored(texts.select("pairs", "times").mapInArrow(_counted, f"pair {kind}, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    # a row for each id of the model at most
    best = counts.groupBy(F.expr(f"pair % {wide}").alias("b")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("b", F.expr(f"pair % {wide}")).join(F.broadcast(best), "b")
    counts = stored(counts.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "ranked_pairs")
    from_count = _frequent_from(counts)
    known = counts.where(F.col("n") >= from_count).orderBy("pair").toArrow()
    frequent = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, top = frequent.value
        for batch in batches:
            pairs, times = (batch[c].flatten().to_numpy() for c in ("pairs", "times"))
            sizes = pc.list_value_length(batch["pairs"]).to_numpy()
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            if len(keys):
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                there = keys[at] == pairs
                add = np.where(there, values[at] * times, 0)
                usual = np.where(there & top[at], times, 0)
            else:
                there, add, usual = np.zeros(len(pairs), dtype=bool), np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[cuts]) for v in (add, usual)]
            rest = np.concatenate([[0], np.cumsum(~there)])[cuts]
            columns = [batch[c] for c in ("row", *facts)] + [pa.array(v.astype(np.int64)) for v in sums]
            columns += [pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(v[~there])) for v in (pairs, times)]
            yield pa.RecordBatch.from_arrays(columns, ["row", *facts, "sum", "usual", "pairs", "times"])

    schema = schema.replace("pairs", "sum long, usual long, pairs")
    priced = stored(texts.mapInArrow(price, schema), "priced")
    others = priced.where("size(pairs) > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    others = others.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    rare = others.join(counts.where(F.col("n") < from_count), "pair").groupBy("row")
    rare = rare.agg(F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_usual"))
    joined = priced.drop("pairs", "times").join(rare, "row", "left")
    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("usual") + F.coalesce("more_usual", F.lit(0))).alias("n_best"),
        (F.col("sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with their sums over some rows."""
    keys, times, size = [], [], 0

    def summed() -> pa.RecordBatch:
        pair, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(inverse, np.concatenate(times), len(pair)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    for batch in batches:
        keys.append(batch["pairs"].flatten().to_numpy())
        times.append(batch["times"].flatten().to_numpy())
        size += len(keys[-1])
        if size >= COUNTED:
            yield summed()
            keys, times, size = [], [], 0
    if size:
        yield summed()


def _frequent_from(counts: DataFrame) -> int:
    """The count from which at most ``FREQUENT`` pairs are counted so often; pairs are tallied by powers of 2 ** (1/8)."""
    step = F.floor(F.log2("n") * 8).cast("long")
    total, limit = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("low")).collect(), reverse=True):
        total += row.pairs
        if total > FREQUENT:
            break
        limit = row.low
    return limit if limit is not None else (1 << 62)
