"""Hard-negative mining by Fagin's threshold algorithm.

A candidate's score is its integer inner product with an anchor. A block of candidates holds one list for each dimension,
sorted by that component. An anchor reads each list from the end that its component's sign prefers, all to the same depth; a
row that turns up is fetched whole and scored. What has not turned up can reach at most the sum over dimensions of the
anchor's component times the last one read: the threshold. Reading stops once the threshold lies strictly below the
kth score of every window (so that ties are all seen), or below what the window takes at all.

Candidates stay where they are stored, as blocks of a task; anchors, the stated queries, are broadcast in slices of bounded size. A
task keeps the best k of each window over its blocks. A first pass over a sixteenth of the rows gives every window a score that the kth one reaches
for certain, which the pass over all rows starts from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Candidates of a block; anchors of a slice and their components, at most; entries that are read first from each list.
BLOCK, SLICE_ANCHORS, SLICE_COMPONENTS, DEPTH = 8192, 8192, 1 << 22, 16
#: One row in so many gives the first bounds.
SAMPLE = 16

_LONG = np.iinfo(np.int64)
_NAMELESS = _LONG.max  # stands for a NULL id, which comes after all others
_FOUND = "window int, score long, vec_id long, row long"


class Windows(NamedTuple):
    """Windows of some anchors, those of one anchor side by side: what they take and how many."""

    vectors: list[np.ndarray]  #: of each anchor
    labels: list[int]
    rows: list[int]
    first: np.ndarray  #: of each anchor's windows, with the end at last
    low: list[int]  #: scores that a window takes
    high: list[int]
    same: bool  #: rows of the anchor's label, or of all others
    k: int


def score_type(vectors: np.ndarray, anchor: np.ndarray) -> type:
    """A type in which products of these whole numbers and their sums are exact."""
    most = max((abs(int(f(x))) for x in (vectors, anchor) for f in (np.min, np.max) if x.size), default=0)
    return np.float64 if most * most * max(1, vectors.shape[1]) < 1 << 53 else object


class Block:
    """Candidates of one number of dimensions, and their order in each of them."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.whole, self.labels, self.ids, self.rows = vectors, labels, ids, rows
        self.order = np.argsort(vectors, axis=0, kind="stable").T
        self.typed = {np.float64: vectors.astype(np.float64)}

    def scan(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rows as they turn up, their scores, and the threshold of the rest, `None` if there is no rest."""
        kind = score_type(self.whole, anchor)
        if kind not in self.typed:
            self.typed[kind] = self.whole.astype(kind)
        vectors, anchor = self.typed[kind], anchor.astype(kind)
        n, (up, down) = len(vectors), (np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0))
        fresh = np.ones(n, dtype=bool)
        low, high = 0, DEPTH
        while True:
            high = min(high, n) if len(up) or len(down) else n
            if high < n:
                read = np.concatenate([self.order[up, n - high : n - low].ravel(), self.order[down, low:high].ravel()])
                turned = np.zeros(n, dtype=bool)
                turned[read] = True
                turned &= fresh
            else:  # all lists are at their ends
                turned = fresh.copy()
            fresh &= ~turned
            rows = np.flatnonzero(turned)
            scores = vectors[rows] @ anchor
            last = not fresh.any()
            threshold = None
            if not last:
                threshold = int(vectors[self.order[up, n - high], up] @ anchor[up] + vectors[self.order[down, high - 1], down] @ anchor[down])
            yield rows, np.clip(scores, _LONG.min, _LONG.max).astype(np.int64), threshold
            if last:
                return
            low, high = high, high * 2


class Best:
    """The best k rows of each window so far, and a score that each window's kth is known to reach."""

    def __init__(self, windows: int, k: int, bounds: np.ndarray | None = None):
        self.k = k
        self.scores, self.ids, self.rows = (np.zeros((windows, k), dtype=np.int64) for _ in range(3))
        self.filled = np.zeros(windows, dtype=np.int64)
        self.bounds = np.full(windows, _LONG.min) if bounds is None else bounds.copy()

    def add(self, w: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        n = self.filled[w]
        if len(scores) > 4 * self.k:  # leave out what lies below the kth of these, ties kept
            good = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids, rows = scores[good], ids[good], rows[good]
        scores, ids, rows = (np.concatenate([old[w, :n], new]) for old, new in ((self.scores, scores), (self.ids, ids), (self.rows, rows)))
        order = np.lexsort((rows, ids, -scores))[: self.k]
        self.filled[w] = n = len(order)
        for old, new in ((self.scores, scores), (self.ids, ids), (self.rows, rows)):
            old[w, :n] = new[order]
        if n == self.k:
            self.bounds[w] = max(self.bounds[w], self.scores[w, n - 1])


def search_block(block: Block, windows: Windows, best: Best) -> None:
    """Put the best rows of a block into all windows."""
    for a, anchor in enumerate(windows.vectors):
        if len(anchor) != block.whole.shape[1]:
            continue
        open_ = list(range(windows.first[a], windows.first[a + 1]))
        if not open_:
            continue
        for rows, scores, threshold in block.scan(anchor):
            fits = (block.labels[rows] == windows.labels[a]) == windows.same
            fits &= block.rows[rows] != windows.rows[a]
            at, values = rows[fits], scores[fits]
            for w in open_:
                take = (values >= max(windows.low[w], int(best.bounds[w]))) & (values <= windows.high[w])
                if take.any():
                    best.add(w, values[take], block.ids[at[take]], block.rows[at[take]])
            if threshold is not None:
                open_ = [w for w in open_ if threshold >= max(int(best.bounds[w]), windows.low[w])]
                if not open_:
                    break


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of ``(row, vec_id, label, vector)``, of one number of dimensions each."""
    pending: dict[int, list[tuple[np.ndarray, ...]]] = {}

    def made(dim: int) -> Block:
        vectors, labels, ids, rows = (np.concatenate(x) for x in zip(*pending.pop(dim), strict=True))
        return Block(vectors, labels, ids, rows)

    for batch in batches:
        sizes = pc.list_value_length(batch["vector"]).to_numpy()
        for dim in np.unique(sizes).tolist():
            part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            vectors = part["vector"].flatten().to_numpy().reshape(part.num_rows, dim)
            ids = pc.fill_null(part["vec_id"], int(_NAMELESS)).to_numpy()
            pending.setdefault(dim, []).append((vectors, part["label"].to_numpy(), ids, part["row"].to_numpy()))
            if sum(len(x[0]) for x in pending[dim]) >= BLOCK:
                yield made(dim)
    for dim in list(pending):
        yield made(dim)


def _pass(rows: DataFrame, windows, bounds: np.ndarray | None) -> DataFrame:
    """The best rows of each window in each task, of a score that is not below the given bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = windows.value
        best = Best(len(wanted.low), wanted.k, bounds)
        for block in _blocks(batches):
            search_block(block, wanted, best)
        w, at = np.nonzero(np.arange(wanted.k) < best.filled[:, None])
        ids = best.ids[w, at]
        columns = [pa.array(w.astype(np.int32)), pa.array(best.scores[w, at]), pa.array(ids, mask=ids == _NAMELESS), pa.array(best.rows[w, at])]
        for low in range(0, len(w), 1 << 16):
            yield pa.RecordBatch.from_arrays([c[low : low + (1 << 16)] for c in columns], ["window", "score", "vec_id", "row"])

    return rows.select("row", "vec_id", "label", "vector").mapInArrow(run, _FOUND)


def _search(rows: DataFrame, windows: Windows, label: str) -> DataFrame:
    """The first k of each window over all rows, ``(window, rank, score, vec_id, row)``."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(windows)
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")

    def first(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= windows.k)

    some = first(_pass(rows.where(F.pmod("row", F.lit(SAMPLE)) == 0), shared, None)).where(F.col("rank") == windows.k)
    bounds = np.full(len(windows.low), _LONG.min)
    for r in some.select("window", "score").collect():
        bounds[r.window] = r.score
    return stored(first(_pass(rows, shared, bounds)), label)


def quantised(vectors: DataFrame, scale: float = 256.0, label: Column | None = None) -> DataFrame:
    """Rows that take part, ``(row, vec_id, label, vector)``: a label, and a vector of finite components, each ``floor(scale * x)``.

    ``row`` tells rows apart. Products beyond a 64-bit integer are held at its limits.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        x.cast("array<double>").alias("embedding"),
    )
    rows = rows.where(F.coalesce(F.col("label").isNotNull() & x.isNotNull() & finite, F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("vector")), "quantised")


def _slices(anchors: DataFrame) -> Iterator[pa.Table]:
    """All anchors, in slices of bounded size."""
    n, components = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    many = max(-(-n // SLICE_ANCHORS), -(-components // SLICE_COMPONENTS))
    many = 2 * many if many > 1 else many  # slices by hash differ in size
    for k in range(many):
        part = anchors.where(F.pmod(F.xxhash64("row"), F.lit(many)) == k) if many > 1 else anchors
        found = part.select("row", "vec_id", "label", "vector").toArrow()
        if found.num_rows:
            yield found


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Negatives that score high, but not too near the positive: ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` are those of `quantised`; ``anchors`` says which of them are anchors. A row's score is the integer inner product with the
    anchor; higher scores come first, ties by smaller ``vec_id`` (NULL last). An anchor's positives are its first ``positives`` other rows of its
    label. For each of them come the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of the positive's score, ranked from
    1; fewer, or none, if there are no more. Vectors of other lengths than the anchor's are not compared with it. Rows repeated with the same id or vector are rows
    of their own, as anchors, positives and negatives. No anchors, or an empty table, give an empty result.
    """
    spark = rows.sparkSession
    results = []
    for part in _slices(rows.where(anchors)):
        vectors = [np.array(v, dtype=np.int64) for v in part["vector"].to_pylist()]
        ids, labels, keys = (part[c].to_pylist() for c in ("vec_id", "label", "row"))
        n = len(ids)
        nearest = Windows(vectors, labels, keys, np.arange(n + 1), [int(_LONG.min)] * n, [int(_LONG.max)] * n, True, positives)
        chosen = sorted(_search(rows, nearest, "positives").select("window", "rank", "vec_id", "score").collect())
        first = np.searchsorted([r.window for r in chosen], np.arange(n + 1))
        lows, highs = [-(-low * r.score // 100) for r in chosen], [high * r.score // 100 for r in chosen]
        found = _search(rows, Windows(vectors, labels, keys, first, lows, highs, False, negatives), "negatives")
        # five numbers for each positive of the slice
        named = pa.table(
            {
                "window": pa.array(range(len(chosen)), pa.int32()),
                "anchor_id": pa.array([ids[r.window] for r in chosen], pa.int64()),
                "positive_id": pa.array([r.vec_id for r in chosen], pa.int64()),
                "positive_score": pa.array([r.score for r in chosen], pa.int64()),
            }
        )
        results.append(found.join(F.broadcast(spark.createDataFrame(named)), "window"))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.union, results).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
