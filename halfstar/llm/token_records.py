"""Token ids as length-delimited binary records, with a separate offset index.

A record is framed as ``length (u64), masked checksum of the length (u32), data, masked checksum of the data (u32)``,
all little-endian. The checksum is CRC-32, masked by a rotation and an offset so that a checksum of
data that holds checksums stays useful. The data are one document: ``doc_id (i64), whether it is NULL (u8), bytes per id
(u8)``, then the ids. The index is a table with a row for each record; readers that shuffle documents take rows of it
in any order and seek.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..sources.scratch import new_scratch_dir
from .files import chunks, new_file, open_random, open_stream, qualified
from .tables import partitions, stored
from .words import grouped, span_hashes, text_buffers

#: Chunks of text whose ids a Python worker remembers.
REMEMBERED = 1 << 20
#: Bytes that are looked up at once.
SEGMENT = 1 << 20
#: First characters of a text that put rows of one id in order; a hash of the whole text decides further.
HEAD = 16
#: Rows of one Arrow batch of results.
BATCH_ROWS = 1 << 12

_FRAME, _HEAD = struct.Struct("<QI"), struct.Struct("<qBB")
_LETTER = np.array([i < 128 and chr(i).isalnum() for i in range(256)])
_MARK = np.array([32 < i < 127 and not chr(i).isalnum() for i in range(256)])

INDEX = "part int, file string, doc_id long, offset long, bytes long, n_tokens long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = len(data).to_bytes(8, "little")
    return b"".join([length, masked_crc(length).to_bytes(4, "little"), data, masked_crc(data).to_bytes(4, "little")])


def unframe(parts: Iterable[bytes]) -> Iterator[bytes]:
    """The records of a stream of bytes; raises ValueError at a wrong checksum or a cut record."""
    buffer, at = b"", 0
    parts = iter(parts)
    while True:
        need = _FRAME.size
        while True:
            while len(buffer) - at < need:
                part = next(parts, None)
                if part is None:
                    if len(buffer) > at:
                        raise ValueError("a record is cut off")
                    return
                buffer, at = buffer[at:] + part, 0
            if need > _FRAME.size:
                break
            length, crc = _FRAME.unpack_from(buffer, at)
            if masked_crc(buffer[at : at + 8]) != crc:
                raise ValueError("wrong checksum of a length")
            need = _FRAME.size + length + 4
        data = buffer[at + _FRAME.size : at + need - 4]
        if masked_crc(data) != int.from_bytes(buffer[at + need - 4 : at + need], "little"):
            raise ValueError("wrong checksum of a record")
        at += need
        yield data


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc_id or 0, doc_id is None, width) + ids


def unpack(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = _HEAD.unpack_from(data)
    return None if null else doc_id, np.frombuffer(data, f"<u{width}", offset=_HEAD.size)


def chunk_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where texts can be cut, as a match of the pattern certainly begins there.

    That is at their first bytes; before a space between two characters that are no white space; before and after a line break or tab that
    has none beside it; and before ASCII punctuation that follows an ASCII letter or digit.
    White space beyond ASCII is told by its first byte alone, which leaves some places uncut that could be.
    """
    plain = data > 32
    wide = np.isin(data, [0xC2, 0xE1, 0xE2, 0xE3])  # white space of several bytes begins with one of these
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = plain[1:] & ~wide[1:]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = plain[:-1]
    before[2:] &= (data[1:-1] < 128) | (data[:-2] != 0xC2)
    before[3:] &= (data[2:-1] < 128) | (data[:-3] < 0xE1) | (data[:-3] > 0xE3)
    cut = (data == 32) & before & after
    breaks = (data >= 9) & (data <= 13) & before
    cut |= breaks
    cut[1:] |= breaks[:-1] & plain[1:] & ~wide[1:]
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    cut[at[at < len(data)]] = True
    last = at[1:] - 1  # a space that ends a text has nothing after it
    ends = last[(last >= 0) & (np.diff(at) > 1)]
    cut[ends[data[ends] == 32]] = False
    return np.flatnonzero(cut)


class _Known:
    """Ids of chunks by their hash: sorted hashes, and where and how many the ids are."""

    def __init__(self, dtype: str):
        self.keys = np.empty(0, dtype=np.uint64)
        self.places = np.empty((0, 2), dtype=np.int64)
        self.ids = np.empty(0, dtype=dtype)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of sorted hashes, and which of them are known."""
        if not len(self.keys):
            return np.zeros((len(keys), 2), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.places[at], self.keys[at] == keys

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for each in ids for i in each), dtype=self.ids.dtype, count=int(counts.sum()))
        places = np.stack([len(self.ids) + np.cumsum(counts) - counts, counts], axis=1)
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.places = np.insert(self.keys, at, keys), np.insert(self.places, at, places, axis=0)


def byte_level(tokenizer: str) -> bool:
    """Whether a tokenizer's JSON has only the byte-level pre-tokenizer with its pattern, and changes no text before it."""
    parts = json.loads(tokenizer)
    first = parts.get("pre_tokenizer") or {}
    return parts.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")


class LibraryEncoder:
    """Ids of whole texts from the tokenizers library, which sees each distinct chunk once.

    A space between two characters that are not white space always begins a new match of a byte-level
    tokenizer's pattern, so a text can be cut before it. ``tokenizer`` must be of that kind. Chunks are known by
    64-bit hashes; when they become too many, all are forgotten.
    """

    def __init__(self, tokenizer: str, width: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel ones
        self.library = Tokenizer.from_str(tokenizer)
        if not byte_level(tokenizer):
            raise ValueError("only tokenizers with a byte-level pre-tokenizer can be given chunks")
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = f"<u{width}"
        self.known = _Known(self.dtype)

    def starts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where texts are cut into chunks."""
        return chunk_starts(data, at)

    def library_ids(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, at = text_buffers(texts)
        starts = self.starts(data, at) if len(data) else np.empty(0, dtype=np.int64)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        hashes = np.empty(len(starts), dtype=np.uint64)
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + SEGMENT)))
            first = starts[low]
            part = data[first : ends[high - 1]].astype(np.uint64)
            hashes[low:high] = span_hashes(part, starts[low:high] - first, ends[low:high] - first)
            low = high
        distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known.keys) > REMEMBERED:
            self.known = _Known(self.dtype)
        places, there = self.known.find(distinct)
        new = np.flatnonzero(~there)
        if len(new):
            chunks = [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in example[new]]
            found = []
            for k in range(0, len(chunks), 1 << 13):
                found += self.library_ids(chunks[k : k + (1 << 13)])
            self.known.add(distinct[new], found)
            places, _ = self.known.find(distinct)
        begin, count = places[inverse].T if len(inverse) else (np.empty(0, np.int64),) * 2
        total = int(count.sum())
        ids = self.known.ids[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(total)]
        text = np.searchsorted(at, starts, side="right") - 1
        lengths = np.bincount(text, count, len(texts)).astype(np.int64)
        return np.split(ids, np.cumsum(lengths)[:-1])


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, width: int) -> LibraryEncoder:
    """One for each Python worker, which keeps what it knows from task to task."""
    return LibraryEncoder(tokenizer, width)


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode ``docs (doc_id, text, ...)``, append ``end_id`` to each and write them in ascending order of ``doc_id``.

    ``tokenizer`` is the JSON of a byte-level tokenizer. Files are numbered by ``part``, which follows the order of
    ids; NULL ids come first and rows of one id are ordered by the beginning of their text, then by a hash of it. A NULL or empty text has the end id only.
    Returns the stored index, ``(part, file, doc_id, offset, bytes, n_tokens)``: a row for each row of ``docs``.
    Other columns are ignored. Ids take two bytes each if the vocabulary allows.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or new_scratch_dir(spark, "records"))
    size = Tokenizer.from_str(tokenizer).get_vocab_size()
    width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(tokenizer)
    end = np.array([end_id], dtype=f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, address, offset = _encoder(shared.value, width), None, "", 0
        try:
            for batch in grouped(batches, 1 << 22):
                if file is None:
                    address, file = new_file(folder, ".records")
                ids = [x.tobytes() + end for x in encoder.encode(batch["text"])]
                frames = [frame(pack(d, x, width)) for d, x in zip(batch["doc_id"].to_pylist(), ids, strict=True)]
                file.write(b"".join(frames))
                sizes = np.array([len(f) for f in frames])
                ends = offset + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch["part"], pa.array([address] * len(frames)), batch["doc_id"], pa.array(ends - sizes), pa.array(sizes), pa.array([len(x) // width for x in ids], pa.int64())],
                    [name.split()[0] for name in INDEX.split(", ")],
                )
                offset = int(ends[-1])
        finally:
            if file is not None:
                file.close()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows of one id, or of none, are dealt by their text, and equal rows by their place, so no id fills a task
    docs = docs.withColumns({"head": F.substring("text", 1, HEAD), "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "head", "hash", "place")]
    dealt = docs.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(dealt.withColumn("part", F.spark_partition_id()).mapInArrow(run, INDEX), "record_index")


def read_records(index: DataFrame) -> DataFrame:
    """All records of the files in the index, read from front to end: ``(doc_id, start, ids_crc32, n_tokens)``.

    ``start`` counts the ids of all records before; where each file begins is added up from the index, of which one row for
    each file is left by then. ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian
    unsigned 32-bit integers. A damaged file raises an error.
    """
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(files.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "record_files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                rows = []
                with open_stream(address) as stream:
                    for data in unframe(chunks(stream, 1 << 20)):
                        doc_id, ids = unpack(data)
                        rows.append((doc_id, start, zlib.crc32(ids.astype("<u4").tobytes()), len(ids)))
                        start += len(ids)
                        if len(rows) == BATCH_ROWS:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    n = partitions(index.sparkSession)
    return files.select("file", "start").repartition(n, "file").mapInArrow(run, "doc_id long, start long, ids_crc32 long, n_tokens long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "ids_crc32", "n_tokens"])


def read_at(index: DataFrame) -> DataFrame:
    """Records in the order of the given rows of an index, by seeking: ``(doc_id, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            opened = {a: open_random(a) for a in set(batch["file"].to_pylist())}
            try:
                rows = []
                for address, offset, size in zip(*(batch[c].to_pylist() for c in ("file", "offset", "bytes")), strict=True):
                    rows += [unpack(d) for d in unframe([opened[address].read_at(size, offset)])]
            finally:
                for file in opened.values():
                    file.close()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([i.tolist() for _, i in rows], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return index.select("file", "offset", "bytes").mapInArrow(run, "doc_id long, ids array<int>")
