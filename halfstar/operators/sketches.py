"""Stored sketches that roll up: distinct users and rating quantiles of any years, without the ratings.

A sketch per key and year is made once, from the ratings. Sketches of several years, or genres, are united into
one that is as good as if it had seen all their ratings, so a question about a range reads only small binary rows. Distinct
counts are HyperLogLog sketches, quantiles are KLL sketches; both are DataSketches built-ins of Spark, which combine
rows before the shuffle.

With many groups in a task, raise ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` (128 groups by default) above
the number of keys times years, or tasks sort the ratings first.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .genres import with_genre

#: Logarithm of a distinct count's registers, and its relative standard error: 1.04 / sqrt(2 ** LG_K).
LG_K = 12
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
#: Size of a quantile sketch, and the error of a rank that it keeps to with 99 % confidence.
KLL_K, RANK_ERROR = 200, 0.0165


def user_sketches(ratings: DataFrame) -> DataFrame:
    """Users of each year, ``(year, users)``."""
    return ratings.groupBy("year").agg(F.hll_sketch_agg("user_id", LG_K).alias("users"))


def genre_user_sketches(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Users who rated a movie of a genre in a year, ``(genre, year, users)``.

    A rating counts for each genre of its movie; the sketches are combined in the task that reads the ratings.
    """
    rated = with_genre(ratings.select("movie_id", "user_id", "year"), movies)
    return rated.groupBy("genre", "year").agg(F.hll_sketch_agg("user_id", LG_K).alias("users"))


def _in_years(sketches: DataFrame, first: int | None, last: int | None) -> DataFrame:
    year = F.col("year")
    for bound in ([year >= first] if first is not None else []) + ([year <= last] if last is not None else []):
        sketches = sketches.where(bound)
    return sketches


def distinct_users(
    sketches: DataFrame, *keys: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Estimated distinct users per ``keys`` over a range of years; all years count without bounds.

    Without keys, one row for everything. A user of several years or genres counts once.
    """
    users = F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users")
    return _in_years(sketches, first, last).groupBy(*keys).agg(users)


def distinct_is_near(estimate: Column, exact: Column, sigmas: float = 4.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.ceil(exact * sigmas * DISTINCT_ERROR)


def rating_sketches(ratings: DataFrame, *keys: str) -> DataFrame:
    """Quantile sketches of the ratings of each key and year, ``(*keys, year, ratings)``; values of any kind."""
    sketch = F.kll_sketch_agg_float("rating", KLL_K).alias("ratings")
    return ratings.where(F.col("rating").isNotNull()).groupBy(*keys, "year").agg(sketch)


def rating_quantile(
    sketches: DataFrame,
    *keys: str,
    share: float = 0.5,
    first: int | None = None,
    last: int | None = None,
) -> DataFrame:
    """Number of ratings and a quantile of them per ``keys`` over a range of years, ``(*keys, n, quantile)``.

    The quantile is a rating that occurs, at a rank that is off by ``RANK_ERROR`` of all at most; exact for
    keys of fewer ratings than ``KLL_K``.
    """
    merged = _in_years(sketches, first, last).groupBy(*keys).agg(F.kll_merge_agg_float("ratings", KLL_K).alias("all"))
    return merged.select(
        *keys,
        F.kll_sketch_get_n_float("all").alias("n"),
        F.kll_sketch_get_quantile_float("all", F.lit(float(share))).alias("quantile"),
    )


def quantile_is_near(quantiles: DataFrame, counts: DataFrame, *keys: str, share: float = 0.5) -> DataFrame:
    """``quantiles`` with ``near``: whether the rank of each is within the error, by exact ``counts (*keys, rating, n)``."""
    both = quantiles.join(counts.withColumnRenamed("n", "times"), list(keys))
    below = F.sum(F.when(F.col("rating") < F.col("quantile"), F.col("times")).otherwise(0))
    upto = F.sum(F.when(F.col("rating") <= F.col("quantile"), F.col("times")).otherwise(0))
    slack = F.first("n") * RANK_ERROR + 1
    wanted = F.first("n") * share
    near = (below <= wanted + slack) & (upto >= wanted - slack) & (upto > below)
    return both.groupBy(*keys).agg(F.first("n").alias("n"), F.first("quantile").alias("quantile"), near.alias("near"))
