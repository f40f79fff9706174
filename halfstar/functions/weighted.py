"""Aggregates over ratings that may already be counted.

Every function here takes either cleaned ratings, where a row is one rating, or
a counted frame, where a column tells how many ratings a row stands for. The caller
names that column as ``weight``; no name of a column has a meaning by itself.
Counting first makes the rows behind a popular movie as few as its distinct
(year, rating) pairs, so nothing that follows is skewed.

Averages and deviations come from plain sums. For half-star values these sums
are exact in DOUBLE, so the order in which tasks are merged cannot change them.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F


#: The column of frames made by ``count_ratings`` that tells the number of ratings.
COUNTED = "n"


def weight_of(weight: str | None) -> Column:
    """How many ratings a row stands for: one, unless a column tells."""
    return F.lit(1).cast("bigint") if weight is None else F.col(weight)


def count_ratings(df: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """Number of ratings ``n`` per distinct value of ``keys``."""
    return df.groupBy(*keys).agg(F.sum(weight_of(weight)).alias(COUNTED))


def rating_sums(df: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """Per key: number of ratings ``n``, their sum ``s`` and sum of squares ``q``."""
    rating, w = F.col("rating").cast("double"), weight_of(weight)
    return df.groupBy(*keys).agg(
        F.sum(w).alias("n"),
        F.sum(rating * w).alias("s"),
        F.sum(rating * rating * w).alias("q"),
    )


def merge_sums(*names: str) -> list[Column]:
    """Aggregates that add up columns under their own names; n, s and q by default."""
    return [F.sum(c).alias(c) for c in names or ("n", "s", "q")]


def mean() -> Column:
    return F.col("s") / F.col("n")


def sample_stddev() -> Column:
    """Sample standard deviation from n, s and q; NULL for a single rating."""
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    spread = F.greatest(q - s * s / n, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


def with_running_share(counts: DataFrame, key: str) -> DataFrame:
    """Add ``upto``, ratings of the key up to this value, and ``total``, all of them.

    ``counts`` has one row per (key, rating). A window is as long as the distinct
    ratings of its key: ten for half stars, and bounded by the FLOAT type for any.
    """
    per_key = Window.partitionBy(key)
    ascending = per_key.orderBy("rating").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.select(
        "*",
        F.sum("n").over(ascending).alias("upto"),
        F.sum("n").over(per_key).alias("total"),
    )


def lower_median() -> Column:
    """Aggregate over ``with_running_share``: the smallest value reaching half of all."""
    return F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("rating")))
