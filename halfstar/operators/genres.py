"""Results per genre. A rating counts once for every genre of its movie.

Ratings are summed per movie before they meet the genres. The multiplication by
genres happens on rows as few as the movies, and should the movies be too many
to broadcast, the join shuffles sums and not a popular movie's ratings.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as X, weighted as V
from .ordering import top_rows


def movie_genres(movies: DataFrame) -> DataFrame:
    """One row per genre entry of a movie; a repeated entry repeats."""
    return movies.select("movie_id", F.explode("genre_array").alias("genre"))


def with_genre(sums: DataFrame, movies: DataFrame) -> DataFrame:
    """Repeat each row of ``sums`` for every genre entry of its movie.

    The list of genres is joined first and exploded after, so that a shuffled
    join moves one row per movie and not one per entry. Movies, far larger than as
    they are stored, are not broadcast.
    """
    wide = sums.join(movies.select("movie_id", "genre_array").hint("merge"), "movie_id")
    return wide.withColumn("genre", F.explode("genre_array")).where(
        F.col("genre") != X.NO_GENRE
    )


def genre_stats(
    ratings: DataFrame, movies: DataFrame, weight: str | None = None
) -> DataFrame:
    """Volume, mean, deviation and number of rated movies per genre."""
    return (
        with_genre(V.rating_sums(ratings, "movie_id", weight=weight), movies)
        .groupBy("genre")
        .agg(*V.merge_sums(), F.count_distinct("movie_id").alias("num_movies"))
        .select(
            "genre",
            F.col("n").alias("total_ratings"),
            F.round(V.mean(), 3).alias("avg_rating"),
            "num_movies",
            F.round(V.sample_stddev(), 3).alias("rating_stddev"),
        )
    )


def genre_year_trends(
    ratings: DataFrame,
    movies: DataFrame,
    first: int = 1995,
    last: int = 2023,
    weight: str | None = None,
) -> DataFrame:
    """Volume and mean per genre and year of rating."""
    in_range = ratings.where(F.col("year").between(first, last))
    return _trends(_genre_years(in_range, movies, weight))


def _genre_years(ratings: DataFrame, movies: DataFrame, weight: str | None) -> DataFrame:
    """Number and sum of ratings per genre and year."""
    sums = V.rating_sums(ratings, "movie_id", "year", weight=weight)
    return with_genre(sums, movies).groupBy("genre", "year").agg(*V.merge_sums("n", "s"))


def _trends(sums: DataFrame) -> DataFrame:
    return sums.select(
        "genre",
        "year",
        F.col("n").alias("rating_count"),
        F.round(V.mean(), 3).alias("avg_rating"),
    )


def largest_genre_trends(
    ratings: DataFrame,
    movies: DataFrame,
    k: int = 6,
    first: int = 1995,
    last: int = 2023,
    weight: str | None = None,
) -> DataFrame:
    """``genre_year_trends`` of the ``k`` genres with most ratings of all years, from one scan.

    The sums of a genre's years, a short list, are gathered beside its total; only the trends are
    cut to the range of years.
    """
    years = F.collect_list(F.struct("year", "n", "s")).alias("years")
    totals = _genre_years(ratings, movies, weight).groupBy("genre").agg(
        F.sum("n").alias("total_ratings"), years
    )
    largest = top_rows(totals, "genre_stats", k).select("genre", F.inline("years"))
    return _trends(largest.where(F.col("year").between(first, last)))
