"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their components.

Three steps keep it exact. **Keys** bring similar sets together without comparing any: sets
of nearly equal size are cut into classes by a hash of the shingle, one class more than
two similar sets can differ in shingles, so at least one class is equal in both; its hash is a key
of both. (Small sets, whose classes may be empty, use single shingles: of any two similar
sets, the first few in hash order share one.) Keys of a step of texts travel packed by buckets, in a single exchange. **Parity sketches**
then tell which sets of a key can be similar: bits in which the sketches of two sets differ stand for shingles that only one of them has, so their
number is never above the sets' difference. Sets that pass, taken transitively, form a cluster; chance keys join none, so clusters
do not grow together as the corpus grows. **Signature trees** find within each cluster which sets are really similar
(see ``signature_tree``), over blocks of bounded size. A large cluster that does not turn out to be of one piece
is split again, now by the keys that sets of different pieces share.

Sets are named by a 64-bit fingerprint, so that copies count once everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .signature_tree import MAX_BITS, Forest, Tree, bitmap_bits, link_sets
from .tables import connected_components, few, in_small_batches, partitions, smallest_reached, stored
from .words import distinct_sets, grouped, mix, salted, shingle_hashes, word_hashes

#: Sets of at most this size use single shingles as keys.
SMALL = 24
#: A block holds about so many sets, and so many shingles, at most.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 22
#: Times that each set of a broken cluster is compared under one of its keys, before all of them are looked at.
ROUNDS = 2
#: Sets whose keys or sketches make up a task.
TASK_SETS = 1 << 12
#: Texts of one step when keys are made: equal keys are combined within a step, before the shuffle.
KEY_STEP = 1 << 23
#: Texts of one step where nothing is combined.
SET_STEP = 1 << 21


def document_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text; of fewer words than ``width``, all words as one."""
    return distinct_sets(*shingle_hashes(*word_hashes(texts), width, whole_if_short=True))


def fingerprints(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash for each set; 0 for empty sets."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(salted(values, 3))])
    sizes = np.diff(starts).astype(np.uint64)
    return np.where(sizes > 0, mix(sums[starts[1:]] - sums[starts[:-1]] + sizes), np.uint64(0))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def parity_sketches(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """For each set a bitmap, of a bit or two for each shingle: whether an odd number of its shingles falls on a bit.

    Shingles that two sets share cancel out, so their sketches differ in no more bits than the sets in shingles. Halves of a sketch
    laid over each other are the sketch of half the width.
    """
    sizes = np.diff(starts)
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 64, MAX_BITS)
    first = np.concatenate([[0], np.cumsum(bits)])
    of = np.repeat(np.arange(len(sizes)), sizes)
    at = first[of] + (values & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=first[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return pa.array([packed[a:b] for a, b in zip((first[:-1] // 8).tolist(), (first[1:] // 8).tolist(), strict=True)], pa.binary())


def _bands(largest: int) -> np.ndarray:
    """Upper sizes of the bands up to that of ``largest``, each half as large again as the one before, and one more."""
    out = [SMALL]
    while out[-1] < largest:
        out.append(out[-1] * 3 // 2)
    return np.array([*out, out[-1] * 3 // 2], dtype=np.int64)


def set_keys(values: np.ndarray, starts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of sets, as (index of the set, key): similar sets have a key in common.

    Sizes from above ``SMALL`` on fall into bands, the largest size of a band being u. A set also
    takes the keys of each following band where a similar one may lie (the next one only, for percent from 67 on). Similar sets of sizes a and b differ in at most
    (a + b)(100 - p) / (100 + p) shingles. There are some classes more than that for the
    largest a and b of the band, to make up for empty ones. A set with more empty
    classes than that uses single shingles as well; two such sets then meet there, and with any other
    set it has a full class in common.
    """
    sizes = np.diff(starts)
    owners, keys = [], []
    bands = _bands(int(sizes.max(initial=1)) * 100 // percent)
    own = np.searchsorted(bands, sizes)
    single = (sizes > 0) & ((sizes <= SMALL) | (percent * sizes <= 100 * SMALL))
    set_of = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(len(bands)):
        band = own + step
        takes = sizes > SMALL if step == 0 else (100 * sizes >= percent * (bands[np.minimum(band - 1, len(bands) - 1)] + 1)) & (sizes > 0)
        if not takes.any():
            if step:
                break
            continue
        upper = bands[np.minimum(band, len(bands) - 1)]
        differ = 2 * upper * (100 - percent) // (100 + percent)
        classes = differ + 1 + differ // 20 + 2
        first = np.concatenate([[0], np.cumsum(np.where(takes, classes, 0))])
        rows = takes[set_of]
        mine, tokens = set_of[rows], values[rows]
        at = first[mine] + (salted(tokens, 4) % classes[mine].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(first[-1], dtype=np.uint64)
        np.add.at(sums, at, salted(tokens, 5))
        full = np.bincount(at, minlength=first[-1]) > 0
        owner = np.repeat(np.arange(len(sizes)), np.where(takes, classes, 0))
        number = (np.arange(first[-1]) - first[owner] + (upper[owner] << 20)).astype(np.uint64)
        owners.append(owner[full])
        keys.append(salted(sums[full] ^ mix(number[full]), 6))
        empty = classes - np.bincount(owner[full], minlength=len(sizes))
        # a similar set is not larger than this one's size over p, nor than the band allows
        most = np.minimum(differ, sizes * (100 - percent) // percent)
        single |= takes & (empty > classes - 1 - most)
    prefix = sizes - (percent * sizes + 99) // 100 + 1
    rank = np.arange(len(values)) - starts[:-1][set_of]
    chosen = single[set_of] & (rank < prefix[set_of])
    owners.append(set_of[chosen])
    keys.append(salted(values[chosen], 7))
    return np.concatenate(owners), np.concatenate(keys)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """For each row its ``doc_id``, its ``row`` (a hash of id and text), and its set's size, fingerprint (0: empty) and parity sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, SET_STEP):
            values, starts = document_sets(batch["text"], width)
            columns = [batch["doc_id"], batch["row"], pa.array(np.diff(starts)), _signed(fingerprints(values, starts)), parity_sketches(values, starts)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_shingles", "set_id", "sketch"])

    return docs.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, n_shingles long, set_id long, sketch binary")


def _step_keys(texts: pa.Array, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct sets of some texts, sorted, and the set of each."""
    values, starts = document_sets(texts, width)
    names = fingerprints(values, starts)
    _, first = np.unique(names, return_index=True)  # copies once
    once = np.zeros(len(names), dtype=bool)
    once[first] = names[first] != 0
    kept = np.repeat(once, np.diff(starts))
    starts = np.concatenate([[0], np.cumsum(np.where(once, np.diff(starts), 0)[once])])
    owner, keys = set_keys(values[kept], starts, percent)
    owner = names[once].view(np.int64)[owner]
    order = np.lexsort((owner, keys))
    return keys[order], owner[order]


#: Sets, lower 48 bits of keys, and the place of each key's set among the sets.
_PACKED = "bucket int, names binary, keys binary, owners binary"


def _packed_keys(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Keys of all sets, a row for each step of texts and bucket of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, KEY_STEP):
            keys, owner = _step_keys(batch["text"], width, percent)
            if not len(keys):
                continue
            bucket = (keys >> np.uint64(48)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for number in np.flatnonzero(np.diff(cuts)).tolist():
                part = order[cuts[number] : cuts[number + 1]]
                names, place = np.unique(owner[part], return_inverse=True)
                low = np.ascontiguousarray(keys[part].view("<u2").reshape(-1, 4)[:, :3])
                rows.append((number, names.tobytes(), low.tobytes(), place.astype("<u2" if len(names) <= 1 << 16 else "<u4").tobytes()))
            columns = [pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PACKED.split(", ")])

    return docs.select("text").mapInArrow(run, _PACKED)


_GROUPS = "key long, sets long, set_id long"


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets ``(key, sets, set_id)`` of each key that several have, from rows that come bucket by bucket.

    Similar sets share many keys; of those that the very same sets have, one will do.
    """
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def done(bucket: int) -> Iterator[pa.RecordBatch]:
        keys, owner = (np.concatenate(x) for x in zip(*pending, strict=True))
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[fresh], owner[fresh]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sets = np.diff(np.append(first, len(keys)))
        names = [np.add.reduceat(salted(owner.view(np.uint64), salt), first) for salt in (8, 9)]
        several = np.flatnonzero(sets > 1)
        order = several[np.lexsort((first[several], names[1][several], names[0][several], sets[several]))]
        same = np.zeros(len(order), dtype=bool)
        same[1:] = np.all([x[order[1:]] == x[order[:-1]] for x in (sets, *names)], axis=0)
        chosen = np.zeros(len(sets), dtype=bool)
        chosen[order[~same]] = True
        rows = np.flatnonzero(np.repeat(chosen, sets))
        many = np.repeat(sets, sets)
        for low in range(0, len(rows), 1 << 16):
            some = rows[low : low + (1 << 16)]
            columns = [_signed(salted(keys[some], bucket + 10)), pa.array(many[some]), pa.array(owner[some])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "sets", "set_id"])

    now = None
    for batch in batches:
        for number, names, low, place in zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True):
            if number != now and pending:
                yield from done(now)
                pending = []
            now = number
            parts = np.frombuffer(low, "<u2").reshape(-1, 3).astype(np.uint64)
            keys = parts[:, 0] | parts[:, 1] << np.uint64(16) | parts[:, 2] << np.uint64(32)
            place = np.frombuffer(place, f"<u{len(place) // len(keys)}")
            pending.append((keys, np.frombuffer(names, np.int64)[place]))
    if pending:
        yield from done(now)


def _clusters(docs: DataFrame, sets: DataFrame, n_sets: int, width: int, percent: int) -> DataFrame:
    """Sets that share a key and whose sketches allow them to be similar, transitively: ``(set_id, cluster)``; sets without such a one are left out.

    A task holds the keys of one bucket, a quarter of a partition. Sets of a key that more than a block of them have are compared in blocks that are dealt by a hash, and
    where that does not make them one piece, in pairs of blocks of a band of sizes or two.
    """
    n = partitions(docs.sparkSession)
    packed = _packed_keys(docs, width, percent, 4 * n).repartition(n, "bucket").sortWithinPartitions("bucket")
    groups = stored(few(packed, n_sets, TASK_SETS).mapInArrow(_shared_keys, _GROUPS), "key_groups")
    rows = groups.count()
    sketches = sets.join(groups.select("set_id").distinct(), "set_id", "left_semi").select("set_id", F.col("n_shingles").alias("n"), "sketch")
    sketches = stored(few(sketches.dropDuplicates(["set_id"]), n_sets, TASK_SETS), "sketches")
    block = F.pmod(F.xxhash64("set_id", F.lit("block")), F.ceil(F.col("sets") / BLOCK_SETS).cast("long"))
    placed = groups.select(F.col("key").alias("cluster"), block.alias("block"), F.lit(0).alias("side"), F.col("set_id").alias("part"), "set_id")
    edges = stored(_likely(placed.join(sketches, "set_id"), percent, _tasks(rows)), "likely")
    large = groups.where(F.col("sets") > BLOCK_SETS)
    if not large.isEmpty():
        known = _named(connected_components(edges, "likely_parts"))
        parts = sketches.select("set_id", "n").join(stored(few(known, rows), "likely_parts"), "set_id", "left")
        many = large.join(parts.withColumn("part", F.coalesce("cluster", "set_id")), "set_id").withColumn("band", _band(percent))
        many = stored(few(many, rows), "large_groups")
        apart = many.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
        many = many.join(stored(few(apart.select("key"), rows), "groups_apart"), "key").select("key", "part", "set_id", "band")
        placed, tasks = _paired_blocks(many, rows)
        edges = edges.union(stored(_likely(placed.withColumnRenamed("key", "cluster").join(sketches, "set_id"), percent, tasks), "likely"))
    return _named(connected_components(edges, "clusters"))


def _named(components: DataFrame) -> DataFrame:
    return components.select(F.col("node").alias("set_id"), F.col("component").alias("cluster"))


def _by_block(placed: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """Rows dealt by ``(cluster, block)``, those of a block next to each other, to no more tasks than ``tasks`` or cores."""
    dealt = placed.select(*columns).repartition(partitions(placed.sparkSession), "cluster", "block")
    return few(dealt.sortWithinPartitions("cluster", "block"), tasks, 1)


def _tasks(rows: int, shingles: int = 0) -> int:
    """A task has about a block of sets."""
    return -(-rows // BLOCK_SETS) + shingles // BLOCK_SHINGLES


def _likely(placed: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Pairs ``(a, b)`` of sets of a block that sizes and sketches allow to be similar, enough of them to connect all these.

    ``placed (cluster, block, side, part, set_id, n, sketch)``. If a block has sets of side 1, only pairs across the sides count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            i, j = _likely_pairs(table, percent)
            names, place = np.unique(table["set_id"].to_numpy(), return_inverse=True)
            low = smallest_reached(len(names), place[i], place[j])
            hung = np.flatnonzero(low != np.arange(len(names)))
            if len(hung):
                yield pa.RecordBatch.from_arrays([pa.array(names[hung]), pa.array(names[low[hung]])], ["a", "b"])

    columns = ["cluster", "block", "side", "part", "set_id", "n", "sketch"]
    return _by_block(placed, columns, tasks).mapInArrow(run, _LINKS)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come block by block, in tables that hold whole blocks."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        cluster, block = (table[c].to_numpy() for c in ("cluster", "block"))
        cut = int(np.flatnonzero((cluster != cluster[-1]) | (block != block[-1]))[-1]) + 1 if (cluster[0], block[0]) != (cluster[-1], block[-1]) else 0
        rest = table.slice(cut)  # the last block may go on
        if cut:
            yield table.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def _likely_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of whole blocks that may be similar, in pairs; those of all blocks are tested together, by their distance in the table."""
    cluster, block, side, part, sizes = (table[c].to_numpy() for c in ("cluster", "block", "side", "part", "n"))
    raw = table["sketch"].to_pylist()
    words = np.array([len(b) // 8 for b in raw])
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (cluster[1:] != cluster[:-1]) | (block[1:] != block[:-1])
    number = np.cumsum(fresh) - 1
    across = np.maximum.reduceat(side, np.flatnonzero(fresh))[number] > 0
    # sketches by their width; those of twice the width folded as well
    place = np.zeros((2, len(words)), dtype=np.int64)
    maps = {}
    for w in np.unique(words).tolist():
        for twice in (0, 1):
            rows = np.flatnonzero(words == w << twice)
            if len(rows):
                each = np.frombuffer(b"".join([raw[i] for i in rows]), dtype=np.uint64).reshape(len(rows), 1 << twice, w)
                maps[w, twice] = np.bitwise_xor.reduce(each, axis=1)
                place[twice, rows] = np.arange(len(rows))
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    left = np.arange(len(words))
    for distance in range(1, len(words)):
        left = left[left + distance < len(words)]
        left = left[number[left] == number[left + distance]]  # blocks are contiguous, so the others are done
        if not len(left):
            break
        right = left + distance
        small, great = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
        some = (part[left] != part[right]) & (100 * small >= percent * great) & (~across[left] | (side[left] != side[right]))
        i, j = left[some], right[some]
        differ = (small[some] + great[some]) * (100 - percent) // (100 + percent)
        good = np.maximum(words[i], words[j]) > 2 * np.minimum(words[i], words[j])  # of too different widths to be compared
        for (w, of_i, of_j), at in _by_width(words[i], words[j]):
            for step in np.array_split(at, max(1, len(at) * w >> 20)):
                a, b = maps[w, of_i][place[of_i, i[step]]], maps[w, of_j][place[of_j, j[step]]]
                good[step] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= differ[step]
        found.append((i[good], j[good]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def _by_width(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
    """Pairs of the same two widths, at most a factor of two apart: the smaller one, and which of the two is twice that."""
    for w in np.unique(np.minimum(a, b)).tolist():
        for of_a, of_b in ((0, 0), (0, 1), (1, 0)):
            at = np.flatnonzero((a == w << of_a) & (b == w << of_b))
            if len(at):
                yield (w, of_a, of_b), at


_LINKS = "a long, b long"


def _link_blocks(placed: DataFrame, width: int, percent: int, tasks: int) -> DataFrame:
    """Links within each block of ``placed (cluster, block, side, part, set_id, text)``, as pairs of set and smallest linked set.

    Blocks are dealt to tasks by a hash and come together, so a task holds one block at a time. Sets of the same ``part`` are linked
    already. If a block has sets of side 1, only links across the sides are looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            blocks = np.stack([batch["cluster"].to_numpy(), batch["block"].to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]).any(axis=1)) + 1), len(blocks)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if high == low:
                    continue
                block = tuple(blocks[low])
                if block != now and pending:
                    yield from _linked(pending, width, percent)
                    pending = []
                now = block
                pending.append(batch.slice(low, high - low))
        if pending:
            yield from _linked(pending, width, percent)

    return _by_block(placed, ["cluster", "block", "side", "part", "set_id", "text"], tasks).mapInArrow(run, _LINKS)


def _linked(rows: list[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(rows).combine_chunks()
    text = table["text"].combine_chunks()
    values, starts = document_sets(text, width)
    names = table["set_id"].to_numpy()
    # a document id that stands for several texts brings other sets along; the fingerprint tells
    good = np.flatnonzero(fingerprints(values, starts).view(np.int64) == names)
    _, first = np.unique(names[good], return_index=True)
    good = good[first]  # in ascending order of names, so the smallest index is the smallest name
    if len(good) < 2:
        return
    sets = [values[starts[i] : starts[i + 1]] for i in good]
    names, side, part = names[good], table["side"].to_numpy()[good], table["part"].to_numpy()[good]
    bits = bitmap_bits(max(map(len, sets)))
    forest = Forest(len(good))
    _, first, of = np.unique(part, return_index=True, return_inverse=True)
    for i, j in enumerate(first[of].tolist()):
        forest.link(i, j)
    sides = [np.flatnonzero(side == s) for s in (0, 1) if (side == s).any()]
    trees = [Tree([sets[i] for i in members], members, bits) for members in sides]
    link_sets(trees[0], trees[-1], percent, forest)
    roots = np.array([forest.root(i) for i in range(len(good))])
    linked = part[roots] != part  # what was linked before is known
    if linked.any():
        yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(names[roots[linked]])], ["a", "b"])


def similar_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Components of documents linked by similar shingle sets: ``(doc_id, n_shingles, component_id)``.

    Two rows of ``docs (doc_id, text, ...)`` are linked when 100 * intersection >= percent * union of
    their sets of ``width``-word shingles. ``component_id`` is the smallest ``doc_id``
    that a row reaches. One row comes back for each row of ``docs``; other columns are ignored.

    A NULL or empty text, or one of white space only, has an empty set, linked with nothing: its component is its
    own id. A text of fewer words than ``width`` has one shingle of all its words. Rows with the same text are
    linked, also if they repeat a ``doc_id``; rows of one id with different texts are
    different rows. A NULL ``doc_id`` never names a component unless all its ids are NULL. An empty table
    gives an empty result. Texts of any length are used whole.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = in_small_batches(docs.withColumn("row", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")))
    sets = stored(shingle_sets(docs, width), "sets")
    n_rows = sets.count()
    clusters = _clusters(docs, sets, n_rows, width, percent)
    # one row stands for a set; whether it is repeated is known
    rows = sets.where("set_id <> 0").groupBy("set_id", "row").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    chosen = rows.groupBy("set_id").agg(F.min(F.struct("row", "copies")).alias("one"), F.max("n").alias("n"))
    members = stored(few(clusters.join(chosen.select("set_id", "one.*", "n"), "set_id"), n_rows), "members")
    links = _links(docs.where("text is not null").select("row", "text"), members, width, percent)
    found = connected_components(links, "links").select(F.col("node").alias("set_id"), "component")
    # empty sets get a key of their own each, which spreads them
    named = sets.withColumn("key", F.when(F.col("set_id") == 0, F.xxhash64("doc_id")).otherwise(F.col("set_id")))
    named = stored(
        few(
            named.join(stored(few(found, n_rows), "found"), "set_id", "left").select(
                "doc_id", "n_shingles", F.coalesce("component", "key").alias("key")
            ),
            n_rows,
        ),
        "named",
    )
    lowest = stored(few(named.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("component_id")), n_rows), "lowest")
    found = named.join(lowest, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return few(found, n_rows)


def _links(texts: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between the sets of each cluster, enough of them to connect what is connected.

    A cluster that fits one block is done at once. A larger one is dealt to blocks by a hash; then
    one set stands for each component found in a block, these are joined in the same way, and only
    where a cluster is still not in one piece do the keys decide what else can be linked.
    """
    rows, shingles = members.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = _tasks(rows, shingles)
    sizes = stored(
        few(
            members.groupBy("cluster").agg(
                F.greatest(
                    F.lit(1), F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
                ).cast("long").alias("blocks")
            ),
            rows,
        ),
        "sizes",
    )
    block = F.pmod(F.xxhash64("set_id", F.lit("block")), "blocks")
    placed = members.join(sizes, "cluster").withColumn("block", block).withColumns({"side": F.lit(0), "part": F.col("set_id")})
    moved = placed.join(texts, "row")
    if not members.where("copies > 1").isEmpty():  # repeated rows bring their text once each
        moved = moved.where("copies = 1").unionByName(moved.where("copies > 1").dropDuplicates(["set_id"]))
    placed = stored(moved.drop("row", "copies"), "placed")  # the texts of candidates, moved once; the join reads all texts, so its tasks are not made few
    links = stored(_link_blocks(placed, width, percent, tasks), "block_links")
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return links
    large = large.drop("side", "part")
    parts = _parts(large.drop("text"), links, rows)
    pieces = parts.groupBy("cluster").agg(F.count_distinct("part").alias("pieces"))
    # pieces that fit a block are joined there; of more, hardly any belong together
    pieces = stored(few(pieces.where((F.col("pieces") > 1) & (F.col("pieces") <= BLOCK_SETS)), rows), "pieces")
    heads = parts.where("set_id = part").join(pieces, "cluster").select("cluster", F.lit(0).cast("long").alias("block"), F.lit(0).alias("side"), "part", "set_id")
    if not pieces.isEmpty():
        links = links.union(stored(_link_blocks(heads.join(large.select("set_id", "text"), "set_id"), width, percent, tasks), "head_links"))
        parts = _parts(large.drop("text"), links, rows)
    broken = stored(few(parts.groupBy("cluster").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high"), rows), "broken")
    if broken.isEmpty():
        return links
    texts = large.join(broken, "cluster").select("set_id", "text")
    return links.union(_links_of_keys(texts, parts.join(broken, "cluster").select("set_id", "n", "part"), width, percent))


def _links_of_keys(texts: DataFrame, parts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between sets of different parts: such sets share a key, so only keys of several parts have to be looked at.

    The sets of such a key are a block. Those of a larger one are told apart by size first: similar
    sets are of one band of sizes or of two neighbouring ones. Before that, each set is compared under one of its keys only, twice, which
    joins most parts that belong together, as similar sets share many keys. Only within two bands that have more than a block of sets are pairs of blocks
    looked at. What moves is a set's bitmap, once for each of its blocks; texts follow only for sets whose bitmap and size allow
    that another one of the block is similar.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, KEY_STEP):
            keys, owner = _step_keys(batch["text"], width, percent)
            order = np.argsort(owner, kind="stable")  # equal names in a row are stored in less space
            keys, owner = keys[order], owner[order]
            for low in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([_signed(keys[low : low + (1 << 16)]), pa.array(owner[low : low + (1 << 16)])], ["key", "set_id"])

    keyed = stored(texts.select("text").mapInArrow(run, "key long, set_id long"), "keys_of_parts")
    rows = keyed.count()
    seen = keyed.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high")
    keyed = stored(few(keyed.join(stored(few(seen.select("key"), rows), "keys_seen"), "key"), rows), "keys_shared")
    bitmaps = stored(_bitmaps(texts, width), "bitmaps")
    texts = texts.select("set_id", "text")
    parts, links = stored(parts.withColumn("band", _band(percent)), "parts_of_keys"), None
    sets, shingles = parts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def linked(placed: DataFrame, tasks: int) -> DataFrame:
        likely = stored(_plausible(placed.join(bitmaps, "set_id"), percent, tasks), "plausible")
        return stored(_link_blocks(likely.join(texts, "set_id"), width, percent, tasks), "key_links")

    for number in range(ROUNDS):  # most of what is similar meets here, so that few keys are left
        one = keyed.groupBy("set_id").agg(F.min_by("key", F.xxhash64("key", F.lit(number))).alias("cluster"))
        one = stored(few(one, rows), "chosen_keys")
        blocks = one.groupBy("cluster").agg(F.count("*").alias("sets")).where("sets > 1")
        block = F.pmod(F.xxhash64("set_id", F.lit("block")), F.ceil(F.col("sets") / BLOCK_SETS).cast("long")).alias("block")
        placed = one.join(blocks, "cluster").join(parts, "set_id").select("cluster", block, F.lit(0).alias("side"), "part", "set_id")
        found = linked(placed, _tasks(sets, shingles))
        links = found if links is None else links.union(found)
        # parts are named by a set, so links between parts are links between these names
        joined = found.join(parts.select(F.col("set_id").alias("a"), F.col("part").alias("x")), "a")
        joined = joined.join(parts.select(F.col("set_id").alias("b"), F.col("part").alias("y")), "b")
        merged = connected_components(joined.select(F.col("x").alias("a"), F.col("y").alias("b")), "merged").select(F.col("node").alias("part"), "component")
        renamed = parts.join(stored(few(merged, sets), "merged"), "part", "left").withColumn("part", F.coalesce("component", "part"))
        parts = stored(few(renamed.select("set_id", "n", "part", "band"), sets), "parts_of_keys")
    keyed = stored(few(keyed.join(parts, "set_id"), rows), "keyed_parts")
    names = [F.bit_xor(F.xxhash64("set_id", F.lit(salt))).alias(f"names{salt}") for salt in (0, 1)]
    groups = keyed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("sets"), *names).where("low < high")
    # similar sets share many keys; of those that the very same sets have, one will do
    groups = groups.groupBy("sets", "names0", "names1").agg(F.min("key").alias("key"))
    between = stored(few(keyed.join(stored(few(groups.select("key", "sets"), rows), "keys_between"), "key"), rows), "between")
    small = between.where(F.col("sets") <= BLOCK_SETS).select("key", F.lit(0).cast("long").alias("block"), F.lit(0).alias("side"), "part", "set_id")
    large, tasks = _paired_blocks(between.where(F.col("sets") > BLOCK_SETS), rows)
    rows = between.count()
    return links.union(linked(small.union(large).withColumnRenamed("key", "cluster"), tasks + _tasks(rows, rows * shingles // max(1, sets))))


def _band(percent: int) -> Column:
    """Similar sets are of one band of sizes or of two neighbouring ones."""
    return F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + 1e-9).cast("long")


def _paired_blocks(many: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Sets ``(key, part, set_id, band)`` of large keys, at most ``rows``, dealt to blocks ``(key, block, side, part, set_id)``: of each band, and pairs of blocks of a band or two.

    Comes with the tasks that are worth it, a pair of blocks each.
    """
    blocks = stored(few(many.groupBy("key", "band").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("long").alias("blocks")), rows), "band_blocks")
    tasks = blocks.agg(F.coalesce(F.sum(F.col("blocks") * F.col("blocks")), F.lit(0))).first()[0] * 3
    own = many.join(blocks, ["key", "band"]).withColumn("own", F.pmod(F.xxhash64("set_id", F.lit("band")), "blocks"))
    above = blocks.select("key", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("key", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    own = own.join(above, ["key", "band"], "left").join(below, ["key", "band"], "left")
    first, second = F.col("own"), F.col("other")

    def pairs(until: str, lower_band: Column, left: Column, right: Column, side: Column) -> DataFrame:
        """Each set once for each of the blocks that it is compared with."""
        met = own.where(F.col(until) > 0).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(until) - 1)))
        return met.select("key", F.xxhash64(lower_band, F.lit(until == "blocks"), left, right).alias("block"), side.cast("int").alias("side"), "part", "set_id")

    large = pairs("blocks", F.col("band"), F.least(first, second), F.greatest(first, second), first > second)
    large = large.union(pairs("above", F.col("band"), first, second, F.lit(0)))
    return large.union(pairs("below", F.col("band") - 1, second, first, F.lit(1))), tasks


def _bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """Sets with their size and a bitmap of two bits or more for each shingle, ``(set_id, n, bits)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, SET_STEP):
            values, starts = document_sets(batch["text"], width)
            sizes = np.diff(starts)
            out = []
            for low, size in zip(starts[:-1].tolist(), sizes.tolist(), strict=True):
                bits = min(MAX_BITS, max(512, 1 << (2 * size - 1).bit_length()))
                row = np.zeros(bits, dtype=np.uint8)
                row[values[low : low + size] & np.uint64(bits - 1)] = 1
                out.append(np.packbits(row, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch["set_id"], pa.array(sizes), pa.array(out, pa.binary())], ["set_id", "n", "bits"])

    return texts.select("set_id", "text").mapInArrow(run, "set_id long, n long, bits binary")


def _plausible(placed: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Of ``placed (cluster, block, side, part, set_id, n, bits)`` the rows that some row of another part in their block may be similar to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            yield from _may_be_similar(table, percent)

    columns = ["cluster", "block", "side", "part", "set_id", "n", "bits"]
    return _by_block(placed, columns, tasks).mapInArrow(run, "cluster long, block long, side int, part long, set_id long")


def _may_be_similar(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole blocks; pairs of all blocks are tested together, by their distance in the table."""
    cluster, block, part, sizes = (table[c].to_numpy() for c in ("cluster", "block", "part", "n"))
    raw = table["bits"].to_pylist()
    words = np.array([len(b) // 8 for b in raw])
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (cluster[1:] != cluster[:-1]) | (block[1:] != block[:-1])
    number = np.cumsum(fresh)
    # bitmaps by their width; those of twice the width folded as well
    place = np.zeros((2, len(words)), dtype=np.int64)
    maps, hidden = {}, {}
    for w in np.unique(words).tolist():
        for twice in (0, 1):
            rows = np.flatnonzero(words == w << twice)
            if len(rows):
                each = np.frombuffer(b"".join([raw[i] for i in rows]), dtype=np.uint64).reshape(len(rows), 1 << twice, w)
                maps[w, twice] = np.bitwise_or.reduce(each, axis=1)
                hidden[w, twice] = sizes[rows] - np.bitwise_count(maps[w, twice]).sum(axis=1).astype(np.int64)
                place[twice, rows] = np.arange(len(rows))
    keep = np.zeros(len(words), dtype=bool)
    left = np.arange(len(words))
    for distance in range(1, len(words)):
        left = left[left + distance < len(words)]
        left = left[number[left] == number[left + distance]]  # blocks are contiguous, so the others are done
        if not len(left):
            break
        right = left + distance
        some = part[left] != part[right]
        small, great = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
        some &= 100 * small >= percent * great
        i, j, small, great = left[some], right[some], small[some], great[some]
        w = np.minimum(words[i], words[j])
        for width in np.unique(w).tolist():
            at = np.flatnonzero(w == width)
            # with a ratio of sizes above one half, widths differ by a factor of two at most; otherwise the pair is kept
            fit = at[np.maximum(words[i[at]], words[j[at]]) <= 2 * width]
            keep[i[np.setdiff1d(at, fit)]] = keep[j[np.setdiff1d(at, fit)]] = True
            for part_of in np.array_split(fit, max(1, len(fit) * width >> 20)):
                a, b = i[part_of], j[part_of]
                both, hide = np.full((len(a), width), np.uint64(2**64 - 1)), np.full(len(a), 1 << 60)
                for rows in (a, b):
                    for twice in (0, 1):
                        mine = words[rows] == width << twice
                        if mine.any():
                            spot = place[twice, rows[mine]]
                            both[mine] &= maps[width, twice][spot]
                            hide[mine] = np.minimum(hide[mine], hidden[width, twice][spot])
                shared = np.minimum(np.bitwise_count(both).sum(axis=1).astype(np.int64) + hide, small[part_of])
                good = (100 + percent) * shared >= percent * (small[part_of] + great[part_of])
                keep[a[good]] = keep[b[good]] = True
    if keep.any():
        out = table.filter(pa.array(keep)).select(["cluster", "block", "side", "part", "set_id"]).combine_chunks()
        yield from out.to_batches(1 << 16)


def _parts(placed: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """Placed sets with the component they are known to belong to."""
    found = connected_components(links, "parts").select(F.col("node").alias("set_id"), "component")
    known = placed.join(found, "set_id", "left").withColumn("part", F.coalesce("component", "set_id")).drop("component")
    return stored(few(known, rows), "parts")
