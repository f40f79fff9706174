"""Byte-level BPE encoding and decoding as tree reductions.

Encodings are elements of a monoid. A text (or one very long match of the pattern) is halved until the parts are
small, the parts are encoded, and neighbours are joined bottom up. A join encodes a window across the
boundary anew and lets it grow until nothing outside can change:

* Matches of the pattern. A match is found from its first character on and by looking at most two characters past its own
  end (`'ll` against `'l`), so matches that end some characters before the cut are final, and
  once a new match begins where one of the right half began, all that follow are the same.
* Tokens of one match. A sequence of tokens is the encoding of its bytes exactly if each two neighbours
  are the encoding of theirs. So the tokens outside stand as soon as the two pairs at the window's ends do.

Decoding concatenates the bytes of tokens up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .tables import in_small_batches
from .words import grouped

#: Characters of a text, bytes of a match and tokens that are handled without halving.
LEAF_CHARS, LEAF_BYTES, LEAF_TOKENS = 1 << 13, 64, 1 << 12
#: Characters before a cut within which a match may still change.
REACH = 4
#: Matches whose tokens a task remembers.
REMEMBERED = 1 << 17


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of byte strings, of which each is the id too, and the pattern whose matches are encoded apart."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """Read a rank file: a line for each token, in base64, and its rank. It has a few megabytes."""
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    @cached_property
    def tokens(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


class Encoder:
    """Encodes texts with one vocabulary; remembers the tokens of short matches."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks, self.tokens = vocabulary.ranks, vocabulary.tokens
        self.matches = regex.compile(vocabulary.pattern).findall
        self.known: dict[str, bytes] = {}
        self.stable: dict[tuple[int, int], bool] = {}

    # tokens of one match

    def merge(self, raw: bytes) -> list[int]:
        """The encoding of a few bytes: merge the pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        whole = ranks.get(raw)
        if whole is not None or not raw:
            return [whole] if raw else []
        if len(raw) > 4 * LEAF_BYTES:
            return self.merge_long(raw)
        get = ranks.get
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [get(raw[i : i + 2], _NONE) for i in range(len(raw) - 1)]
        while (best := min(pairs)) < _NONE:
            i = pairs.index(best)
            part = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + part, _NONE)
            if i < len(pairs):
                pairs[i] = get(part + parts[i + 1], _NONE)
            elif not pairs:
                break
        return [ranks[p] for p in parts]

    def merge_long(self, raw: bytes) -> list[int]:
        """The same for many bytes, with a queue of pairs instead of a search for each merge."""
        ranks, n = self.ranks, len(raw)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at a byte
        queue = [(rank, i, 2) for i in range(n - 1) if (rank := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, length = heapq.heappop(queue)
            middle = ends[i]
            if middle == 0 or middle == n or ends[middle] - i != length:
                continue  # one of the two has been merged otherwise
            end = ends[i] = ends[middle]
            ends[middle] = 0
            if end < n:
                before[end] = i
                if (rank := ranks.get(raw[i : ends[end]])) is not None:
                    heapq.heappush(queue, (rank, i, ends[end] - i))
            if i and (rank := ranks.get(raw[before[i] : end])) is not None:
                heapq.heappush(queue, (rank, before[i], end - before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : ends[i]]])
            i = ends[i]
        return out

    def fits(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= REMEMBERED:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two halves' bytes together, from the encodings of the halves."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join([self.tokens[t] for t in left[-i:] + right[:j]]))
            before = i == len(left) or self.fits(left[-i - 1], window[0])
            after = j == len(right) or self.fits(window[-1], right[j])
            if before and after:
                return left[: len(left) - i] + window + right[j:]
            i = i if before else min(len(left), 2 * i)
            j = j if after else min(len(right), 2 * j)

    def bytes_of_match(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw)
        # the rank of a whole match wins over merges, for a long one too
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        half = len(raw) // 2
        return self.join_tokens(self.bytes_of_match(raw[:half]), self.bytes_of_match(raw[half:]))

    def match(self, text: str) -> bytes:
        """The ids of one match, as little-endian 32-bit integers."""
        ids = self.bytes_of_match(text.encode("utf-8", "surrogatepass"))
        ids = pack(f"<{len(ids)}i", *ids)
        if len(text) <= LEAF_BYTES and len(self.known) < REMEMBERED:
            self.known[text] = ids
        return ids

    # matches of one text

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        """The matches of two halves' text together, from the matches of the halves."""
        if not left or not right:
            return left + right
        kept, over = len(left), 0
        while kept and over < REACH:
            kept -= 1
            over += len(left[kept])
        head, many = "".join(left[kept:]), 4
        while True:
            many = min(many, len(right))
            window = head + "".join(right[:many])
            found = self.matches(window)
            if many == len(right):
                final = len(window)
            else:
                final = len(window) - REACH
            starts, at = {}, len(head)
            for n, piece in enumerate(right[:many]):
                starts[at] = n
                at += len(piece)
            at = 0
            for n, piece in enumerate(found):
                if at in starts and at <= final:
                    return left[:kept] + found[:n] + right[starts[at] :]
                at += len(piece)
            if many == len(right):
                return left[:kept] + found
            many *= 4

    def pieces(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.matches(text)
        half = len(text) // 2
        return self.join_matches(self.pieces(text[:half]), self.pieces(text[half:]))

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, as little-endian 32-bit integers."""
        known, match = self.known, self.match
        return b"".join([known.get(p) or match(p) for p in self.pieces(text or "")])


_NONE = 1 << 62


def decode_ids(tokens: list[bytes], ids: list[int]) -> bytes:
    """The bytes of tokens, concatenated up a tree."""
    parts = [b"".join([tokens[i] for i in ids[k : k + LEAF_TOKENS]]) for k in range(0, len(ids), LEAF_TOKENS)]
    while len(parts) > 1:
        parts = [b"".join(parts[k : k + 2]) for k in range(0, len(parts), 2)]
    return parts[0] if parts else b""


def encode(docs: DataFrame, vocabulary: Vocabulary, column: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the array ``ids``: the BPE ids of each whole text.

    The ids are those of a byte-level BPE encoder that encodes each match of the vocabulary's pattern apart and knows no special
    tokens: their strings in a text are ordinary text. A NULL text counts as empty and has no ids. All rows and
    columns are kept; one of the name ``ids`` is replaced. The vocabulary is broadcast; its size does not
    grow with the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    docs = in_small_batches(docs.drop(ids))
    names = [*docs.columns, ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in grouped(batches, 1 << 22, column):
            each = [encoder.encode(t) for t in batch[column].to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in each)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(each), dtype="<i4"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), values)], names)

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(ids, ArrayType(IntegerType()))]))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with the ids of each text and the bytes that they decode to.

    The bytes come from the ids alone. One Python worker for each task does both, where the two operators chained would take two.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    docs = in_small_batches(docs.drop(ids, decoded))
    names = [*docs.columns, ids, decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in grouped(batches, 1 << 20, column):
            each = [np.frombuffer(encoder.encode(t), dtype="<i4") for t in batch[column].to_pylist()]
            ends = np.cumsum([0, *map(len, each)]).astype(np.int32)
            texts = [decode_ids(encoder.tokens, x.tolist()) for x in each]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(texts, pa.binary())], names)

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(ids, ArrayType(IntegerType())), StructField(decoded, BinaryType())]))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``df`` with the binary ``column``: the bytes that its arrays of ids stand for. A NULL array stands for none.

    An id that the vocabulary does not have raises an error.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    df = df.drop(column)
    names = [*df.columns, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out = [decode_ids(tokens, x or []) for x in part[ids].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names)

    return df.mapInArrow(run, StructType([*df.schema, StructField(column, BinaryType())]))
