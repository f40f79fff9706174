"""Results on tags."""

from pyspark.sql import DataFrame, functions as F


def top_tags(tags: DataFrame, min_count: int = 50, approx: bool = False) -> DataFrame:
    """Uses, tagged movies and tagging users of each tag used often enough."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return (
        tags.groupBy("tag_lower")
        .agg(
            F.count(F.lit(1)).alias("tag_count"),
            distinct("movie_id").alias("movies_tagged"),
            distinct("user_id").alias("users_who_tagged"),
        )
        .where(F.col("tag_count") >= min_count)
    )


def movie_tag_richness(tags: DataFrame, movies: DataFrame) -> DataFrame:
    """All and distinct tags of each movie."""
    per_movie = tags.groupBy("movie_id").agg(
        F.count("tag_lower").alias("total_tags"),
        F.count_distinct("tag_lower").alias("unique_tags"),
    )
    return per_movie.join(
        movies.select("movie_id", "clean_title", "genres"), "movie_id"
    )
