"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

After Wang and Manning (2012): a logistic regression on features x * r, where r is the log ratio
of a feature's share among toxic and among other texts. The features of a text are the hashed
character n-grams of its distinct words, each word marked at both ends; a feature's value is the
number of distinct words that hold it. The scaled vector of a text has length 1, so that long texts count like short ones.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .tables import in_small_batches, stored
from .words import grouped, mix, salted, span_hashes

#: Sizes of the n-grams, number of hashed features.
SIZES, FEATURES = (3, 4, 5), 1 << 18
#: Labelled rows that a model is fitted on, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 8_192
#: L2 penalty, iterations and step of the regression; texts have length 1, so this step is stable.
PENALTY, ITERATIONS, STEP_SIZE = 1e-5, 40, 3.0
#: Tasks that a gradient is summed over; each sends one vector back.
GRADIENT_TASKS = 8
#: Counts that smooth each feature.
SMOOTHING = 2.0
#: Bytes of text that are handled at once.
STEP = 1 << 19

@dataclass(frozen=True)
class ToxicityModel:
    """Log-count ratio and regression weight of each hashed n-gram, and the intercept."""

    ratios: np.ndarray
    weights: np.ndarray
    intercept: float


@cache
def _letters() -> np.ndarray:
    """Which code points are letters or digits."""
    return np.fromiter((chr(i).isalnum() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def text_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each text, as (index of the text, hashed n-gram, number of distinct words that hold it).

    Words are runs of letters and digits in lower case; what stands around them counts as one mark on either
    side. All texts are handled at once, in arrays of code points.
    """
    lower = [(t or "").lower() for t in texts]
    chars = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = _letters()[chars]
    marked = np.where(inside, chars, 0).astype(np.uint64)
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    firsts = 1 + np.cumsum([0, *(len(t) + 1 for t in lower)])
    text = np.searchsorted(firsts, begins, side="right") - 1
    # each word of a text once
    _, once = np.unique(salted(span_hashes(marked, begins, ends) + mix(text.astype(np.uint64)), 31), return_index=True)
    begins, ends, text = begins[once], ends[once], text[once]
    rolling = np.zeros(len(marked), dtype=np.uint64)
    found, last = [], max(SIZES)
    for k in range(last):
        rolling = rolling[: len(marked) - k] * np.uint64(0x100000001B3) + marked[k:]
        n = k + 1
        if n in SIZES:
            many = np.maximum(ends - begins + 3 - n, 0)
            at = np.repeat(begins - 1 - np.cumsum(many) + many, many) + np.arange(many.sum())
            found.append(np.repeat(text, many) * FEATURES + (salted(rolling[at], n) % np.uint64(FEATURES)).astype(np.int64))
    pairs, counts = np.unique(np.concatenate(found), return_counts=True)
    return pairs // FEATURES, pairs % FEATURES, counts


def scaled(text: np.ndarray, grams: np.ndarray, counts: np.ndarray, ratios: np.ndarray, n: int) -> np.ndarray:
    """Values of the features of ``n`` texts: counts times log-count ratios, at length 1 for each text."""
    values = counts * ratios[grams]
    length = np.sqrt(np.bincount(text, values * values, n))
    return values / np.where(length > 0, length, 1)[text]


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled ids, those with the smallest hashes: ``(text, toxic)``.

    Ids and labels that are NULL are left out; of several labels of one id the largest counts, of several texts
    all are used. The chosen ids are at most ``rows``, which bounds what is broadcast.
    """
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit a model on a bounded sample of labelled rows.

    Without any labelled row, or with labels of one kind only, the model scores every text by that share.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, STEP):
            text, grams, counts = text_features(batch["text"].to_pylist())
            ends = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (grams.astype(np.int32), counts.astype(np.float64))]
            yield pa.RecordBatch.from_arrays([batch["toxic"], *lists], ["toxic", "grams", "counts"])

    sample = in_small_batches(training_sample(docs, labels, rows)).mapInArrow(extract, "toxic int, grams array<int>, counts array<double>")
    sample = stored(sample, "toxic_sample")
    shares = sample.agg(F.count("*"), F.sum("toxic")).first()
    total, toxic = shares[0], shares[1] or 0
    if toxic == 0 or toxic == total:
        share = min(max(toxic / total if total else 0.0, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(FEATURES), np.zeros(FEATURES), float(np.log(share / (1 - share))))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, FEATURES))
        for batch in batches:
            lengths = batch["grams"].value_lengths().to_numpy(zero_copy_only=False)
            side = np.repeat(batch["toxic"].to_numpy(), lengths)
            for k in (0, 1):
                sums[k] += np.bincount(batch["grams"].flatten().to_numpy()[side == k], batch["counts"].flatten().to_numpy()[side == k], FEATURES)
        there = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[1, there]), pa.array(sums[0, there])], ["gram", "p", "q"])

    # at most FEATURES rows come back, in columns: an object for each of them would take the driver many times their size
    sums = sample.mapInArrow(add_up, "gram long, p double, q double").groupBy("gram").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow()
    ratio = np.zeros(FEATURES)
    ratio[sums["gram"].to_numpy()] = log_count_ratios(sums["p"].to_numpy(), sums["q"].to_numpy())
    return _regression(sample.coalesce(GRADIENT_TASKS), ratio, total)


def _regression(sample: DataFrame, ratios: np.ndarray, rows: int) -> ToxicityModel:
    """Logistic regression by Nesterov's accelerated gradient; each step is a pass over the stored sample."""
    context = sample.sparkSession.sparkContext
    scale = context.broadcast(ratios)
    point, before = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)  # the intercept last
    for step in range(ITERATIONS):
        ahead = point + step / (step + 3) * (point - before)
        shared = context.broadcast(ahead.astype(np.float32))  # executors keep each on disk for a while

        def gradient(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            at, ratios = shared.value.astype(np.float64), scale.value
            out = np.zeros(FEATURES + 1)
            for batch in batches:
                lengths = batch["grams"].value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(lengths)), lengths)
                grams = batch["grams"].flatten().to_numpy()
                values = scaled(row, grams, batch["counts"].flatten().to_numpy(), ratios, len(lengths))
                logit = np.bincount(row, values * at[grams], len(lengths)) + at[-1]
                error = 1 / (1 + np.exp(-logit)) - batch["toxic"].to_numpy()
                out[:-1] += np.bincount(grams, values * error[row], FEATURES)
                out[-1] += error.sum()
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], ["gradient"])

        parts = sample.mapInArrow(gradient, "gradient binary").toArrow()["gradient"]
        slope = sum(np.frombuffer(p.as_buffer()) for p in parts) / rows
        slope[:-1] += PENALTY * ahead[:-1]
        before, point = point, ahead - STEP_SIZE * slope
        shared.destroy()
    return ToxicityModel(ratios, point[:-1], float(point[-1]))


def log_count_ratios(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log ratio of each feature's share among toxic and other texts.

    The counts that smooth it are dealt to the two sides by their totals, so a feature that was never seen has ratio 0
    and a rare one is near it, whichever side is larger.
    """
    share = toxic.sum() / (toxic.sum() + other.sum())
    p, q = toxic + SMOOTHING * share, other + SMOOTHING * (1 - share)
    return np.log(p / p.sum()) - np.log(q / q.sum())


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1: how likely each whole ``text`` is toxic.

    All columns and rows are kept; a column of the name ``score`` is replaced. A NULL or empty text, or one without
    words, gets the score of no features. Rows with equal texts get equal scores. The model's size is
    fixed by its number of features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = in_small_batches(docs.drop("score"))
    names = [*docs.columns, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in grouped(batches, STEP):
            text, grams, counts = text_features(batch["text"].to_pylist())
            values = scaled(text, grams, counts, model.ratios, batch.num_rows)
            logits = np.bincount(text, values * model.weights[grams], batch.num_rows) + model.intercept
            scores = 1.0 / (1.0 + np.exp(-logits))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    schema = StructType([*docs.schema, StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)
