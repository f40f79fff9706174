"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosines.

Vectors of length 1 have a cosine of c at a distance of sqrt(2 - 2c). In each of several tables a vector's key is a tuple of projections on
Gaussian directions, shifted and cut into cells of a fixed width (Datar et al. 2004). The number of projections grows with the logarithm
of the number of vectors, so that a cell holds about as many unrelated ones at every size; the number of tables follows
from the chance that a pair at the threshold misses all of them.

Equal vectors count once, with their number. Vectors that meet in a cell are compared by
exact cosines in double precision; a pair counts in the first table in which it meets, so nothing needs to be
made distinct. Large cells are dealt to blocks, and their links are counted by products of blocks, some rows of a product at a time.

Each vector moves once for each table and block. Tables are searched in rounds that move about twice the vectors, so that the disk
that shuffles take does not grow with the number of tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import connected_components, in_small_batches, partitions, smallest_reached, stored

#: Cell width; chance that a pair at the threshold is missed; unrelated vectors that may share a cell: the more, the
#: fewer tables a vector has to be moved for, and the more of its cosines are worked out in one product.
WIDTH, MISSED, CROWD = 1.5, 0.02, 256
#: Vectors of a block; seed of the directions.
BLOCK, SEED = 2048, 20_240_229
#: Cosines that are worked out at once; how far one may be off by the order in which it is summed, at most.
PRODUCT, DOUBT = 1 << 19, 1e-9
#: Vectors of small cells that are compared in one product.
SMALL = 128
#: Bytes that a round of tables moves: so many, or so many times the bytes of the vectors if that is more. Bytes of a row besides its vector.
ROUND_BYTES, ROUND_TIMES, ROW_BYTES = 600_000_000, 2, 48


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance share the cell of one projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(n: int, threshold: float) -> tuple[int, int]:
    """Projections of a key and number of tables for ``n`` vectors."""
    near, far = same_cell(math.sqrt(2 - 2 * threshold)), same_cell(math.sqrt(2))
    k = max(2, math.ceil(math.log(max(n, 2) / CROWD) / -math.log(far)))
    return k, math.ceil(math.log(MISSED) / math.log(1 - near**k))


class Hashes:
    """Directions and shifts of all tables."""

    def __init__(self, dimensions: int, k: int, tables: int):
        random = np.random.default_rng(SEED)
        self.directions = random.standard_normal((dimensions, tables * k))
        self.shifts = random.uniform(0, WIDTH, tables * k)
        self.weights = random.integers(1, 1 << 62, k, dtype=np.int64) | 1
        self.k, self.tables = k, tables

    def keys(self, vectors: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """A key for each vector and each table, or those from ``first`` to before ``last``.

        They are the same wherever a row is: where the order of a sum could decide about a cell, it is summed in a fixed one.
        """
        of = slice(first * self.k, (self.tables if last is None else last) * self.k)
        directions, shifts = self.directions[:, of], self.shifts[of]
        out = np.empty((len(vectors), len(shifts) // self.k), dtype=np.int64)
        for low in range(0, len(vectors), 256):
            part = vectors[low : low + 256]
            places = (part @ directions + shifts) / WIDTH
            cells = np.floor(places)
            for row, column in zip(*np.nonzero(np.abs(places - np.rint(places)) < DOUBT), strict=True):
                place = shifts[column]
                for x, y in zip(part[row], directions[:, column], strict=True):
                    place += x * y
                cells[row, column] = np.floor(place / WIDTH)
            with np.errstate(over="ignore"):
                out[low : low + 256] = (cells.astype(np.int64).reshape(len(part), -1, self.k) * self.weights).sum(axis=2)
        return out


def _matrix(raw: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors, in double precision, from packed ones."""
    ends = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    x = np.empty((len(raw), dim))
    for size, kind in ((4 * dim, "<f4"), (8 * dim, "<f8")):
        of = sizes == size
        if of.all():
            x[:] = data.view(kind).reshape(-1, dim)
        elif of.any():
            x[of] = data[np.repeat(of, sizes)].view(kind).reshape(-1, dim)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x


def usable(column: str = "embedding"):
    """Whether a vector has components, all finite and not all zero."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Links between ``vectors (vec_id, embedding, ...)`` of cosine ``threshold`` or more: ``(vec_id, n_links, component_id, kept)``.

    A row for each row: the number of other rows it is linked to, the smallest ``vec_id`` it can reach, and whether that is its own. Pairs
    below the threshold are never linked; one at the threshold is found with a chance of 98 %, nearer ones almost surely. Vectors that are NULL, empty or zero,
    or hold NULLs, NaN or infinities link with nothing; vectors of different lengths do not link. Repeated rows and equal
    vectors link with each other, also under one id. A NULL ``vec_id`` names no component. Other columns are ignored; an empty table gives an
    empty result. The number of dimensions is taken as bounded.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("node", F.when(usable(), F.xxhash64("embedding", F.size("embedding"))))
    named = stored(rows.select("vec_id", "node"), "vectors")
    pack = lambda batches: _packed(batches)
    good = in_small_batches(rows.where("node is not null").select("node", "embedding")).mapInArrow(pack, "node long, dim int, raw binary")
    distinct = stored(good.groupBy("node", "dim").agg(F.first("raw").alias("raw"), F.count("*").alias("copies")), "distinct_vectors")
    links, edges = _search(distinct, threshold)
    found = stored(connected_components(edges, "vector_components"), "found").select("node", "component")
    sums = links.groupBy("node").agg(F.sum("n").alias("n"))
    facts = stored(
        distinct.select("node", "copies").join(sums, "node", "left").join(found, "node", "left").select(
            "node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")
        ),
        "facts",
    )
    spread = named.withColumn("node", F.coalesce("node", F.xxhash64("vec_id", F.lit("alone"))))
    named = stored(spread.join(facts, "node", "left"), "named_vectors")
    lowest = stored(named.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("component_id")), "lowest_vectors")
    joined = named.withColumn("component", F.coalesce("component", "node")).join(lowest, "component", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        values, sizes = batch["embedding"].flatten().to_numpy(), np.diff(batch["embedding"].offsets.to_numpy())  # none is empty or holds NULLs
        with np.errstate(over="ignore"):
            half = values.astype("<f4")  # half the bytes, where nothing is lost by it
        ends = np.cumsum(sizes)
        fits = np.logical_and.reduceat(half == values, ends - sizes)
        packed = [(half if fit else values)[a:b].tobytes() for a, b, fit in zip(ends - sizes, ends, fits, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], ["node", "dim", "raw"])


def _search(distinct: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """For each node counted links ``(node, n)`` of copies, and edges ``(a, b)`` that connect what is linked."""
    spark = distinct.sparkSession
    dims, n, size = [], 0, 0
    for row in distinct.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.length("raw")).alias("size")).collect():
        dims, n, size = [*dims, row["dim"]], n + row["n"], size + row["size"]
    k, tables = tables_for(n, threshold)
    hashes = spark.sparkContext.broadcast({d: Hashes(d, k, tables) for d in dims})
    each = max(1, int(max(ROUND_BYTES, ROUND_TIMES * size) // max(1, size + ROW_BYTES * n)))
    results = None
    for first in range(0, tables, each):
        found = stored(_round(distinct, hashes, threshold, first, min(first + each, tables)), "vector_links")
        results = found if results is None else results.union(found)
    return results.select("node", "n"), results.select(F.col("node").alias("a"), F.col("low").alias("b"))


def _round(distinct: DataFrame, hashes: Broadcast, threshold: float, first: int, last: int) -> DataFrame:
    """What the tables from ``first`` to before ``last`` find: ``(node, n, low)``, see `_compared`."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim = batch["dim"].to_numpy()
            for d in np.unique(dim):
                part = batch if (dim == d).all() else batch.take(pa.array(np.flatnonzero(dim == d)))
                for low in range(0, part.num_rows, 1024):
                    some = part.slice(low, 1024)
                    keys = hashes.value[int(d)].keys(_matrix(some["raw"], int(d)), first, last)
                    cells = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * (last - first), pa.int32()), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([some["node"], some["dim"], some["raw"], some["copies"], cells], ["node", "dim", "raw", "copies", "cells"])

    keys = in_small_batches(distinct.select("node", "dim", "raw", "copies")).mapInArrow(keyed, "node long, dim int, raw binary, copies long, cells array<long>")
    cells = keys.select("node", "dim", "raw", "copies", F.posexplode("cells").alias("table", "cell")).withColumn("table", F.col("table") + first)
    # a cell of several blocks becomes pairs of blocks; each vector goes to the pairs of its own
    large = cells.groupBy("dim", "table", "cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large = stored(large.select("dim", "table", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large_cells")
    met = cells.join(F.broadcast(large), ["dim", "table", "cell"], "left")  # a row for BLOCK vectors of a table at most
    met = met.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("dim", "table", "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "raw", "copies")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        now, size = None, 0
        for batch in batches:
            group = np.stack([batch[c].to_numpy().astype(np.int64) for c in order], axis=1)
            cuts = np.append(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1, len(group)).tolist()
            begun = low = 0
            for high in cuts:
                if high == low:
                    continue
                dim, table, cell, x, y = group[low].tolist()
                # small blocks that are compared with themselves share a product
                if (dim, table, cell, x, y) != now and not (now and x == y and now[3] == now[4] and now[:2] == (dim, table) and size + high - low <= SMALL):
                    if low > begun:
                        pending.append(batch.slice(begun, low - begun))
                    if size:
                        yield from _compared(pending, now, hashes.value, threshold)
                    pending, size, begun = [], 0, low
                now, size, low = (dim, table, cell, x, y), size + high - low, high
            if low > begun:
                pending.append(batch.slice(begun, low - begun))
        if size:
            yield from _compared(pending, now, hashes.value, threshold)

    order = ["dim", "table", "cell", "x", "y"]
    many = partitions(distinct.sparkSession) * 2
    pairs = met.repartition(many, *order).sortWithinPartitions(*order).select(*order, "side", "node", "raw", "copies")
    return pairs.mapInArrow(compare, "node long, n long, low long")


def _linked(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``left`` and ``right`` whose cosine is the threshold or more, of some of ``left`` at a time; pairs of one block once."""
    same = right is left
    step = max(1, PRODUCT // len(right))
    for low in range(0, len(left), step):
        others = right[low:] if same else right
        cosines = vectors[left[low : low + step]] @ vectors[others].T
        i, j = np.nonzero(cosines >= threshold - DOUBT)
        if same:
            once = i < j
            i, j = i[once], j[once]
        # the cosine that counts, summed one by one, where the order could decide
        open_ = np.flatnonzero(cosines[i, j] < threshold + DOUBT)
        i, j = left[low + i], others[j]
        if len(open_):
            below = np.concatenate([(vectors[i[x]] * vectors[j[x]]).sum(axis=1) < threshold for x in np.array_split(open_, -(-len(open_) * vectors.shape[1] // PRODUCT))])
            i, j = np.delete(i, open_[below]), np.delete(j, open_[below])
        if len(i):
            yield i, j


def _compared(rows: list[pa.RecordBatch], group: tuple, hashes: dict[int, Hashes], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links that two blocks of a cell add: ``(node, n, low)``, the copies linked to a node and the smallest node that it reaches by them.

    If ``group`` has a block with itself, ``rows`` may hold more such blocks of its table. Of the pairs at the threshold those count that met in no table before; the others counted there.
    """
    table = pa.Table.from_batches(rows).combine_chunks()
    dim, number, _, x, y = (int(v) for v in group)
    nodes, copies, side = (table[c].to_numpy() for c in ("node", "copies", "side"))
    left = np.flatnonzero(side == 0)
    right = left if x == y else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return
    vectors = _matrix(table["raw"].combine_chunks(), dim)
    n = len(vectors)
    have, keys = np.zeros(n, dtype=bool), np.zeros((number, n), dtype=np.int64)
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    counts, low, all_ = np.zeros(n, dtype=np.int64), np.arange(n), np.arange(n)
    place = np.cumsum(np.append(0, np.any([np.diff(table[c].to_numpy()) != 0 for c in ("cell", "x")], axis=0)))
    for i, j in _linked(vectors, left, right, threshold):
        if place[-1]:
            one = place[i] == place[j]
            i, j = i[one], j[one]
        if number and len(i):
            new = np.zeros(n, dtype=bool)
            new[i] = new[j] = True
            new &= ~have
            keys[:, new] = hashes[dim].keys(vectors[new], 0, number).T
            have |= new
            for of_table in keys:
                fresh = of_table[i] != of_table[j]
                i, j = i[fresh], j[fresh]
                if not len(i):
                    break
        if len(i):
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            # the smallest node that each one reaches here: its neighbours alone would leave out a node whose neighbours hang under others
            low = smallest_reached(n, np.concatenate([rank[i], all_]), np.concatenate([rank[j], low]))
    linked = np.flatnonzero(counts > 0)
    if len(linked):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(counts[linked]), pa.array(nodes[order][low[rank[linked]]])], ["node", "n", "low"])
