"""From raw tables to typed, enriched ones. Duplicates are kept."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as X


def _complete(df: DataFrame, *required: str) -> DataFrame:
    """Rows without NULL in ``required``; as plain tests, which scans can push down."""
    return df.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required)))


def clean_ratings(raw: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Complete ratings within [low, high], with UTC time and its parts.

    The parts come from the epoch itself, so a query that only groups by year or
    hour never builds the timestamp.
    """
    seconds = F.col("timestamp")
    day = X.utc_date(seconds)
    return (
        _complete(raw, "user_id", "movie_id")
        .where(F.col("rating").between(low, high))  # neither NULL nor NaN is
        .select(
            "user_id",
            "movie_id",
            "rating",
            X.utc_from_epoch(seconds).alias("rated_at"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            X.utc_hour(seconds).alias("hour"),
        )
    )


def clean_movies(raw: DataFrame) -> DataFrame:
    """Movies with an id and a title; year, bare title and list of genres added."""
    title = F.col("title")
    return _complete(raw, "movie_id", "title").select(
        "movie_id",
        "title",
        "genres",
        X.year_in_title(title).alias("release_year"),
        X.title_without_year(title).alias("clean_title"),
        F.split("genres", X.GENRE_SEPARATOR).alias("genre_array"),
    )


def clean_tags(raw: DataFrame) -> DataFrame:
    """Complete, non-blank tags, with a normalised spelling and UTC time."""
    bare = F.trim("tag")
    return (
        _complete(raw, "user_id", "movie_id", "tag")
        .where(F.length(bare) > 0)
        .select(
            "user_id",
            "movie_id",
            "tag",
            F.lower(bare).alias("tag_lower"),
            X.utc_from_epoch(F.col("timestamp")).alias("tagged_at"),
        )
    )
