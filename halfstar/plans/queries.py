"""Registered queries: every operator on the stand-in tables of a test folder.

The stand-in has about 30 ratings per movie at any scale, so thresholds on the
number of ratings are lower here than the defaults of the operators.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.weighted import COUNTED, count_ratings
from ..operators import (
    cleaning,
    feeds,
    genres,
    movies as movie_ops,
    quality,
    sketches,
    tagging,
    timeline,
    users as user_ops,
)
from ..operators.ordering import in_report_order, report_keys, top_rows
from ..sources import delimited, store
from ..sources.scratch import new_scratch_dir
from . import increments, pipeline, standin

Query = Callable[[SparkSession, str], DataFrame]

MIN_RATINGS, MIN_VOTES = 30, 150
GEMS_LO, GEMS_HI = 30, 35
LIMITS = pipeline.Thresholds(
    min_ratings=MIN_RATINGS, min_votes=MIN_VOTES, gems_lo=GEMS_LO, gems_hi=GEMS_HI
)
SLICE_YEAR, LOOKUP_MOVIE, LOOKUP_USER = 1998, 17, 7


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_ratings(standin.ratings_raw(spark, sf_dir))


def _movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_movies(standin.movies_raw(spark, sf_dir))


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_tags(standin.tags_raw(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_ops.user_activity(_ratings(spark, sf_dir))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_ops.user_profile(_ratings(spark, sf_dir))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_ops.movie_stats(
        _ratings(spark, sf_dir), _movies(spark, sf_dir), MIN_RATINGS
    )


def _bayesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_ops.movie_ranking(
        _ratings(spark, sf_dir), _movies(spark, sf_dir), MIN_RATINGS, MIN_VOTES
    )


def _genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres.genre_stats(_ratings(spark, sf_dir), _movies(spark, sf_dir))


def _genre_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres.genre_year_trends(_ratings(spark, sf_dir), _movies(spark, sf_dir))


def _top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.top_tags(_tags(spark, sf_dir))


def _richness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.movie_tag_richness(_tags(spark, sf_dir), _movies(spark, sf_dir))


def _round6(df: DataFrame, *names: str) -> DataFrame:
    """Round columns the operators leave unrounded, for comparison between engines."""
    return df.withColumns({name: F.round(name, 6) for name in names})


# Sources, cleaning and quality


def _csv_roundtrip(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_scratch_dir(spark, "csv")
        delimited.write_source(standin.RAW[table](spark, sf_dir), folder, table)
        return delimited.read_source(spark, folder, table)

    return query


def scan_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies whose titles hold quotes, backslashes and line breaks, written and read again."""
    folder = new_scratch_dir(spark, "csv")
    broken = F.concat("title", F.lit('\n"second" \\ line, with a comma'))
    title = F.when(F.col("movie_id") % 5 == 0, broken).otherwise(F.col("title"))
    movies = standin.movies_raw(spark, sf_dir).withColumn("title", title)
    delimited.write_source(movies, folder, "movies")
    return delimited.read_source(spark, folder, "movies", multi_line=True)


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_row_counts(standin.raw_tables(spark, sf_dir))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_tables(spark, sf_dir)
    return quality.quality_reports({t: raw[t] for t in ("ratings", "movies", "tags")})


def clean_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _movies(spark, sf_dir).drop("genre_array")


def movie_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres.movie_genres(_movies(spark, sf_dir))


# Marts, in report order


def _report(mart: str, build: Query) -> Query:
    return lambda spark, sf_dir: in_report_order(build(spark, sf_dir), mart)


def _top(mart: str, build: Query, k: int, *columns: str) -> Query:
    return lambda spark, sf_dir: top_rows(build(spark, sf_dir), mart, k).select(*columns)


def global_mean_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round6(movie_ops.global_mean_rating(_ratings(spark, sf_dir)), "c")


def rating_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_ops.rating_median(_ratings(spark, sf_dir))


def rating_median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_ops.rating_median(_ratings(spark, sf_dir), exact=False)


def movie_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order(_stats(spark, sf_dir), "movie_stats").drop("genre_array")


def movie_bayesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order(_bayesian(spark, sf_dir), "movie_bayesian").drop("genre_array")


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round6(in_report_order(_users(spark, sf_dir), "user_activity"), "rating_stddev")


def hidden_gems(spark: SparkSession, sf_dir: str) -> DataFrame:
    gems = movie_ops.hidden_gems(_stats(spark, sf_dir), 4.0, GEMS_LO, GEMS_HI)
    return in_report_order(gems, "hidden_gems")


def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.rating_distribution(_ratings(spark, sf_dir))


def yearly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.yearly_trends(_ratings(spark, sf_dir))


#: Relative error that sketches are held to; their standard error is 5 %.
_NEAR = 0.2


def _near(approximate: str, exact: str) -> Column:
    return F.abs(F.col(approximate) - F.col(exact)) <= _NEAR * F.col(exact) + 1


def yearly_trends_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and mean are exact; the two distinct counts are compared with the exact ones."""
    ratings = _ratings(spark, sf_dir)
    exact = timeline.yearly_trends(ratings).select(
        "year", F.col("active_users").alias("users"), F.col("movies_rated").alias("movies")
    )
    both = timeline.yearly_trends(ratings, approx=True).join(exact, "year")
    return both.select(
        "year",
        "total_ratings",
        "avg_rating",
        _near("active_users", "users").alias("users_near"),
        _near("movies_rated", "movies").alias("movies_near"),
    )


def top_tags_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses are exact; the two distinct counts are compared with the exact ones."""
    tags = _tags(spark, sf_dir)
    exact = tagging.top_tags(tags).select(
        "tag_lower",
        F.col("movies_tagged").alias("movies"),
        F.col("users_who_tagged").alias("users"),
    )
    both = tagging.top_tags(tags, approx=True).join(exact, "tag_lower")
    return both.select(
        "tag_lower",
        "tag_count",
        _near("movies_tagged", "movies").alias("movies_near"),
        _near("users_who_tagged", "users").alias("users_near"),
    )


def hourly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.hourly_activity(_ratings(spark, sf_dir))


def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_ops.user_segments(_users(spark, sf_dir))


def decade_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movie_ops.decade_quality(_stats(spark, sf_dir))


# Stored marts


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_dir(spark, "mart")
    store.write_mart(_stats(spark, sf_dir), root, "movie_stats")
    return store.read_mart(spark, root, "movie_stats").drop("genre_array")


def ratings_year_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_dir(spark, "ratings")
    store.write_ratings(_ratings(spark, sf_dir), root)
    return store.ratings_of_years(spark, root, SLICE_YEAR, SLICE_YEAR)


def tags_for_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_dir(spark, "tags")
    store.write_tags(_tags(spark, sf_dir), root)
    return store.tags_for_movie(spark, root, LOOKUP_MOVIE)


def tags_for_movie_other_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_dir(spark, "tags")
    store.write_tags(_tags(spark, sf_dir), root, buckets=3)
    return store.tags_for_movie(spark, root, LOOKUP_MOVIE)


def tags_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_scratch_dir(spark, "tags")
    store.write_tags(_tags(spark, sf_dir), root)
    return store.tags_of_user(spark, root, LOOKUP_USER)


def ratings_of_busy_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of the years that have more of them than the mean year, which a stored mart tells."""
    root = new_scratch_dir(spark, "ratings")
    store.write_ratings(_ratings(spark, sf_dir), root)
    store.write_mart(timeline.yearly_trends(store.read_mart(spark, root, "ratings")), root, "yearly_trends")
    years = store.read_mart(spark, root, "yearly_trends")
    mean = years.agg(F.avg("total_ratings")).scalar()
    return store.ratings_of_named_years(spark, root, years.where(F.col("total_ratings") > mean))


def top_stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most active users, from the first part of a mart that is stored in report order."""
    root, keys = new_scratch_dir(spark, "ordered"), report_keys("user_activity")
    store.write_in_order(_users(spark, sf_dir), root, "user_activity", keys)
    first = store.first_rows(spark, root, "user_activity", keys, 10)
    return first.select("user_id", "total_ratings", "unique_movies_rated", "avg_rating_given", "active_days")


def csv_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a source file that do not fit its schema, kept while the others are stored."""
    folder, root = new_scratch_dir(spark, "csv"), new_scratch_dir(spark, "parsed")
    misfit = F.when(F.col("movie_id") % 7 == 0, F.lit("unknown")).otherwise(F.col("tmdb_id").cast("string"))
    delimited.write_source(standin.links_raw(spark, sf_dir).withColumn("tmdb_id", misfit), folder, "links")
    _, rejected = delimited.store_source(spark, folder, "links", root)
    return rejected.drop("file")


def csv_stored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows of the same file, all of them."""
    folder, root = new_scratch_dir(spark, "csv"), new_scratch_dir(spark, "parsed")
    misfit = F.when(F.col("movie_id") % 7 == 0, F.lit("unknown")).otherwise(F.col("tmdb_id").cast("string"))
    delimited.write_source(standin.links_raw(spark, sf_dir).withColumn("tmdb_id", misfit), folder, "links")
    return delimited.store_source(spark, folder, "links", root)[0]


def genre_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of each genre over some years, from stored sketches, held against the exact number."""
    root = new_scratch_dir(spark, "sketches")
    ratings, movies = _ratings(spark, sf_dir), _movies(spark, sf_dir)
    store.write_mart(sketches.genre_user_sketches(ratings, movies), root, "genre_users")
    found = sketches.distinct_users(store.read_mart(spark, root, "genre_users"), "genre", first=1993, last=1996)
    some = ratings.where(F.col("year").between(1993, 1996)).select("movie_id", "user_id").distinct()
    exact = genres.with_genre(some, movies).groupBy("genre").agg(F.count_distinct("user_id").alias("users"))
    near = sketches.distinct_is_near(F.col("distinct_users"), F.col("users")).alias("near")
    return found.join(exact, "genre").select("genre", "users", near)


def movie_medians_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of movies over some years, from stored sketches of single years, held against exact ranks."""
    root = new_scratch_dir(spark, "sketches")
    ratings = _ratings(spark, sf_dir)
    store.write_mart(sketches.rating_sketches(ratings, "movie_id"), root, "movie_ratings")
    stored = store.read_mart(spark, root, "movie_ratings")
    medians = sketches.rating_quantile(stored, "movie_id", first=1993, last=1996)
    some = ratings.where(F.col("year").between(1993, 1996))
    checked = sketches.quantile_is_near(medians, count_ratings(some, "movie_id", "rating"), "movie_id")
    return checked.select("movie_id", "n", "near")


def _store(spark: SparkSession, sf_dir: str, *marts: str) -> str:
    """Run the job for some marts, or all; returns where it has put them. Each query runs it anew, from the tables as they are."""
    root = new_scratch_dir(spark, "pipeline")
    pipeline.run_all(spark, standin.raw_tables(spark, sf_dir), root, LIMITS, marts or pipeline.MARTS)
    return root


def _stored(mart: str, *rounded: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = store.read_mart(spark, _store(spark, sf_dir, mart), mart)
        return in_report_order(_round6(df, *rounded).drop("genre_array"), mart)

    return query


def pipeline_mart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the whole job and count the rows of every stored mart."""
    root = _store(spark, sf_dir)
    marts = {name: store.read_mart(spark, root, name) for name in pipeline.MARTS}
    return quality.table_row_counts(marts)


# Marts after batches


#: Days from which on the second and the third batch of ratings begin; the third also has some of the years before.
_SECOND, _THIRD = 9_496 * 86_400, 10_227 * 86_400


def _batches(spark: SparkSession, sf_dir: str, mart: str) -> str:
    """Ratings added in three batches, the later ones with years that are there already; returns the store's root."""
    root = new_scratch_dir(spark, "batches")
    increments.set_movies(spark, root, standin.movies_raw(spark, sf_dir), LIMITS)
    at, late = F.coalesce("timestamp", F.lit(0)), F.pmod(F.xxhash64("user_id", "movie_id"), F.lit(10)) == 0
    number = F.when(late | (at >= _THIRD), 2).when(at >= _SECOND, 1).otherwise(0)
    ratings = standin.ratings_raw(spark, sf_dir).withColumn("batch", number)
    for k in range(3):
        increments.add_ratings(spark, root, ratings.where(F.col("batch") == k).drop("batch"), LIMITS, [mart])
    return root


def _after_batches(mart: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = increments.mart(spark, _batches(spark, sf_dir, mart), mart)
        return in_report_order(df.drop("genre_array"), mart)

    return query


# Feeds


def feed_overview_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, movies = _ratings(spark, sf_dir), _movies(spark, sf_dir)
    counts = count_ratings(ratings, "movie_id", "rating")
    stats = movie_ops.movie_stats(counts, movies, MIN_RATINGS, COUNTED)
    kpis = feeds.overview_kpis(stats, user_ops.user_profile(ratings), counts, COUNTED)
    return _round6(kpis, "mean_of_movie_means", "global_mean")


def feed_genre_volume_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.genre_volume_by_year(_genre_years(spark, sf_dir)).orderBy("year")


def feed_genre_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.genre_popularity(_genre_stats(spark, sf_dir))


def feed_top_genre_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = genres.largest_genre_trends(_ratings(spark, sf_dir), _movies(spark, sf_dir))
    return in_report_order(trends, "genre_year_trends")


def feed_chosen_genre_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest genres are offered; a reader who changes nothing gets the first five."""
    trends = genres.largest_genre_trends(_ratings(spark, sf_dir), _movies(spark, sf_dir), 5)
    return in_report_order(trends, "genre_year_trends")


def feed_top_n_bayesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.top_n_bayesian(_bayesian(spark, sf_dir))


def feed_gems_explorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.gems_explorer(
        _ratings(spark, sf_dir), _movies(spark, sf_dir), lo=25, hi=40, min_avg=3.5
    )


def _all_gems(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, movies = _ratings(spark, sf_dir), _movies(spark, sf_dir)
    return feeds.gems_explorer(ratings, movies, lo=25, hi=40, min_avg=3.5, limit=None)


def feed_gems_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order(_all_gems(spark, sf_dir), "hidden_gems")


def feed_gems_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.gems_count(_all_gems(spark, sf_dir))


def feed_tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.tag_coverage(_top_tags(spark, sf_dir))


def feed_hist_ratings_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = feeds.ratings_per_user_histogram(_profiles(spark, sf_dir))
    return _round6(hist, "bin_from", "bin_to").orderBy("bin")


def feed_hist_avg_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = feeds.average_given_histogram(_profiles(spark, sf_dir))
    return _round6(hist, "bin_from", "bin_to").orderBy("bin")


def feed_user_segments_right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.user_segments_right_closed(_profiles(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "scan_csv_roundtrip": _csv_roundtrip("movies"),
    "scan_csv_ratings": _csv_roundtrip("ratings"),
    "scan_csv_tags": _csv_roundtrip("tags"),
    "scan_csv_links": _csv_roundtrip("links"),
    "scan_csv_multiline": scan_csv_multiline,
    "table_row_counts": table_row_counts,
    "quality_report": quality_report,
    "clean_ratings": _ratings,
    "clean_movies": clean_movies,
    "clean_tags": _tags,
    "movie_genres": movie_genres,
    "global_mean_rating": global_mean_rating,
    "rating_median": rating_median,
    "rating_median_approx": rating_median_approx,
    "movie_stats": movie_stats,
    "movie_bayesian": movie_bayesian,
    "hidden_gems": hidden_gems,
    "decade_quality": _report("decade_quality", decade_quality),
    "user_activity": user_activity,
    "user_segments": _report("user_segments", user_segments),
    "genre_stats": _report("genre_stats", _genre_stats),
    "genre_year_trends": _report("genre_year_trends", _genre_years),
    "rating_distribution": _report("rating_distribution", rating_distribution),
    "yearly_trends": _report("yearly_trends", yearly_trends),
    "yearly_trends_approx": yearly_trends_approx,
    "hourly_activity": _report("hourly_activity", hourly_activity),
    "top_tags": _report("top_tags", _top_tags),
    "top_tags_approx": top_tags_approx,
    "movie_tag_richness": _report("movie_tag_richness", _richness),
    "top_movies_by_avg": _top(
        "movie_stats", _stats, 10,
        "clean_title", "avg_rating", "median_rating", "total_ratings", "release_year",
    ),
    "top_active_users": _top(
        "user_activity", _users, 10,
        "user_id", "total_ratings", "unique_movies_rated", "avg_rating_given", "active_days",
    ),
    "top_tag_rich_movies": _top(
        "movie_tag_richness", _richness, 15,
        "clean_title", "unique_tags", "total_tags", "genres",
    ),
    "parquet_roundtrip": parquet_roundtrip,
    "ratings_year_slice": ratings_year_slice,
    "tags_for_movie": tags_for_movie,
    "tags_for_movie_other_buckets": tags_for_movie_other_buckets,
    "tags_of_user": tags_of_user,
    "ratings_of_busy_years": ratings_of_busy_years,
    "top_stored_users": top_stored_users,
    "csv_rejected_rows": csv_rejected_rows,
    "csv_stored_links": csv_stored_links,
    "genre_audience": genre_audience,
    "movie_medians_rolled_up": movie_medians_rolled_up,
    "pipeline_mart_rows": pipeline_mart_rows,
    "pipeline_movie_stats": _stored("movie_stats"),
    "pipeline_movie_bayesian": _stored("movie_bayesian"),
    "pipeline_hidden_gems": _stored("hidden_gems"),
    "pipeline_genre_stats": _stored("genre_stats"),
    "pipeline_genre_year_trends": _stored("genre_year_trends"),
    "pipeline_rating_distribution": _stored("rating_distribution"),
    "pipeline_yearly_trends": _stored("yearly_trends"),
    "pipeline_user_activity": _stored("user_activity", "rating_stddev"),
    "pipeline_top_tags": _stored("top_tags"),
    "marts_after_batches": _after_batches("movie_stats"),
    "genre_trends_after_batches": _after_batches("genre_year_trends"),
    "yearly_trends_after_batches": _after_batches("yearly_trends"),
    "feed_overview_kpis": feed_overview_kpis,
    "feed_genre_volume_by_year": feed_genre_volume_by_year,
    "feed_genre_popularity": feed_genre_popularity,
    "feed_top_genre_trends": feed_top_genre_trends,
    "feed_top_n_bayesian": feed_top_n_bayesian,
    "feed_gems_explorer": feed_gems_explorer,
    "feed_chosen_genre_trends": feed_chosen_genre_trends,
    "feed_gems_all": feed_gems_all,
    "feed_gems_count": feed_gems_count,
    "feed_tag_coverage": feed_tag_coverage,
    "feed_hist_ratings_per_user": feed_hist_ratings_per_user,
    "feed_hist_avg_given": feed_hist_avg_given,
    "feed_user_segments_right_closed": feed_user_segments_right_closed,
}
