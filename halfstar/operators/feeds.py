"""Small frames for charts and dashboards, computed in Spark from the marts."""

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as X
from .movies import global_mean_rating, hidden_gems, movie_stats
from .ordering import top_rows


def overview_kpis(
    stats: DataFrame, users: DataFrame, ratings: DataFrame, weight: str | None = None
) -> DataFrame:
    """One row of headline numbers.

    ``mean_of_movie_means`` weighs every listed movie alike; ``global_mean``
    weighs every rating alike.
    """
    people = users.agg(
        F.sum("total_ratings").alias("total_ratings"),
        F.count("user_id").alias("unique_users"),
    )
    return stats.agg(
        F.count("movie_id").alias("movies_analysed"),
        F.avg("avg_rating").alias("mean_of_movie_means"),
    ).select(
        people.select("total_ratings").scalar().alias("total_ratings"),
        "movies_analysed",
        people.select("unique_users").scalar().alias("unique_users"),
        "mean_of_movie_means",
        global_mean_rating(ratings, weight).scalar().alias("global_mean"),
    )


def genre_volume_by_year(trends: DataFrame) -> DataFrame:
    """Ratings per year summed over genres: a rating counts once for each genre."""
    return trends.groupBy("year").agg(F.sum("rating_count").alias("rating_count"))


def genre_popularity(genres: DataFrame) -> DataFrame:
    return genres.orderBy("total_ratings", "genre")


def top_genre_trends(genres: DataFrame, trends: DataFrame, k: int = 6) -> DataFrame:
    """``genre_year_trends`` of the ``k`` genres with most ratings."""
    largest = top_rows(genres, "genre_stats", k).select("genre")
    return trends.join(largest, "genre", "left_semi")


def chosen_genre_trends(trends: DataFrame, chosen: list[str]) -> DataFrame:
    """``genre_year_trends`` of the genres a reader picked."""
    return trends.where(F.col("genre").isin(*chosen))


def top_n_bayesian(bayesian: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(bayesian, "movie_bayesian", n).select(
        "clean_title",
        "bayesian_avg",
        "avg_rating",
        "median_rating",
        "total_ratings",
        "genres",
        "release_year",
    )


def gems_explorer(
    ratings: DataFrame,
    movies: DataFrame,
    lo: int = 100,
    hi: int = 500,
    min_avg: float = 4.0,
    limit: int | None = 50,
) -> DataFrame:
    """Best movies with lo to hi ratings; ``lo`` may lie below the marts' threshold.

    The table shows ``limit`` of them; None gives all, which the scatter plot and
    ``gems_count`` are made of.
    """
    gems = hidden_gems(movie_stats(ratings, movies, lo), min_avg, lo, hi)
    return gems if limit is None else top_rows(gems, "hidden_gems", limit)


def gems_count(gems: DataFrame) -> DataFrame:
    """How many gems there are, as a frame with one row."""
    return gems.agg(F.count(F.lit(1)).alias("gems"))


def tag_coverage(tags: DataFrame, k: int = 25) -> DataFrame:
    return top_rows(tags, "top_tags", k)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows of ``df`` per equal-width bin between the least and greatest value.

    Empty bins have no row. Equal values are counted first; the range and the
    bins both read those counts.
    """
    value = F.col("value")
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low, high = counts.agg(F.min(value)).scalar(), counts.agg(F.max(value)).scalar()
    width = (high - low) / bins
    number = F.col("bin")
    return (
        counts.groupBy(X.equal_width_bin(value, low, high, bins).alias("bin"))
        .agg(F.sum("n").alias("users"))
        .select(
            "bin",
            (low + (number - 1) * width).alias("bin_from"),
            (low + number * width).alias("bin_to"),
            "users",
        )
    )


def ratings_per_user_histogram(users: DataFrame, bins: int = 60) -> DataFrame:
    return histogram(users, "total_ratings", bins)


def average_given_histogram(users: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(users, "avg_rating_given", bins)


def user_segments_right_closed(users: DataFrame) -> DataFrame:
    """Users per right-closed segment, largest first."""
    segment = X.segment_right_closed(F.col("avg_rating_given")).alias("segment")
    return (
        users.select(segment)
        .where(F.col("segment").isNotNull())
        .groupBy("segment")
        .count()
        .orderBy(F.desc("count"), "segment")
    )
