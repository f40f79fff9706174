"""Results over all ratings: by value, by year and by hour of the day."""

from pyspark.sql import DataFrame, functions as F

from ..functions import weighted as V


def rating_distribution(ratings: DataFrame, weight: str | None = None) -> DataFrame:
    return V.count_ratings(ratings, "rating", weight=weight).withColumnRenamed("n", "count")


def yearly_trends(
    ratings: DataFrame,
    first: int = 1995,
    last: int = 2023,
    counts: DataFrame | None = None,
    approx: bool = False,
) -> DataFrame:
    """Volume, mean, active users and rated movies per year.

    Two distinct counts in one aggregate would triple every rating. Here a rating becomes two rows,
    one for its movie and one for its user, which are combined per (year, key) before the
    shuffle: one pass over the input. With ``counts``, ratings counted per movie, year and
    value in column ``n``, volume, mean and movies come from these, and only the users from two
    columns of the ratings. ``approx=True`` takes both distinct counts from sketches.
    """
    in_range = F.col("year").between(first, last)
    rated = ratings.where(in_range)
    if approx:
        rating = F.col("rating").cast("double")
        return rated.groupBy("year").agg(
            F.count(F.lit(1)).alias("total_ratings"),
            F.round(F.sum(rating) / F.count(F.lit(1)), 3).alias("avg_rating"),
            F.approx_count_distinct("user_id").alias("active_users"),
            F.approx_count_distinct("movie_id").alias("movies_rated"),
        )
    year, rating = "year", F.col("rating").cast("double")
    if counts is None:
        sides = F.array(
            F.struct(F.lit(True).alias("movie"), F.col("movie_id").alias("key")),
            F.struct(F.lit(False).alias("movie"), F.col("user_id").alias("key")),
        )
        keys = rated.select(year, rating.alias("rating"), F.inline(sides)).groupBy(year, "movie", "key")
        per_key = keys.agg(
            F.count(F.when(F.col("movie"), 1)).alias("n"),
            F.sum(F.when(F.col("movie"), F.col("rating")).otherwise(0.0)).alias("s"),
        )
    else:
        movies = V.rating_sums(counts.where(in_range), year, "movie_id", weight=V.COUNTED)
        users = rated.select(year, "user_id").distinct()
        per_key = movies.select(year, F.lit(True).alias("movie"), F.col("movie_id").alias("key"), "n", "s").union(
            users.select(year, F.lit(False), "user_id", F.lit(0), F.lit(0.0))
        )
    return (
        per_key.groupBy(year)
        .agg(
            *V.merge_sums("n", "s"),
            F.count(F.when(~F.col("movie"), F.col("key"))).alias("active_users"),
            F.count(F.when(F.col("movie"), F.col("key"))).alias("movies_rated"),
        )
        .select(
            year,
            F.col("n").alias("total_ratings"),
            F.round(V.mean(), 3).alias("avg_rating"),
            "active_users",
            "movies_rated",
        )
    )


def hourly_activity(ratings: DataFrame, weight: str | None = None) -> DataFrame:
    return V.rating_sums(ratings, "hour", weight=weight).select(
        "hour",
        F.col("n").alias("rating_count"),
        F.round(V.mean(), 3).alias("avg_rating"),
    )
