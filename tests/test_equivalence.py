"""The marts against plain SQL forms, and results that settings must not change."""

import pytest
from pyspark.sql import functions as F

import frames
from halfstar.functions.weighted import count_ratings
from halfstar.operators import cleaning, feeds, genres, movies, timeline, users


@pytest.fixture(scope="module", params=[True, False], ids=["half stars", "any value"])
def tables(spark, request):
    raw = frames.skewed_ratings(spark, half_stars=request.param)
    ratings = cleaning.clean_ratings(raw).repartition(5)
    return ratings, cleaning.clean_movies(frames.genre_movies(spark))


def rows(df):
    """Rows in a comparable order, doubles to nine digits."""
    doubles = {c: F.round(c, 9) for c, t in df.dtypes if t == "double"}
    return sorted((tuple(r) for r in df.withColumns(doubles).collect()), key=repr)


def plain(sql, tables):
    ratings, listed = tables
    return ratings.sparkSession.sql(sql, ratings=ratings, movies=listed)


def test_movie_stats(tables):
    expected = plain(
        """SELECT movie_id, a.total_ratings, a.avg_rating, a.rating_stddev, a.min_rating,
             a.max_rating, a.median_rating, clean_title, genres, genre_array, release_year
           FROM (SELECT movie_id, count(rating) total_ratings, round(avg(rating), 3) avg_rating,
                   round(stddev(rating), 3) rating_stddev, min(rating) min_rating,
                   max(rating) max_rating,
                   CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY rating) AS FLOAT)
                     AS median_rating
                 FROM {ratings} GROUP BY movie_id) a
           JOIN {movies} USING (movie_id) WHERE total_ratings >= 20""",
        tables,
    )
    assert rows(movies.movie_stats(*tables, min_ratings=20)) == rows(expected)


def test_medians(tables):
    ratings, _ = tables
    exact = movies.rating_median(ratings)
    assert rows(exact) == rows(movies.rating_median(ratings, exact=False))
    by_user = movies.rating_median(ratings, "user_id")
    assert rows(by_user) == rows(movies.rating_median(ratings, "user_id", exact=False))


def test_genre_stats(tables):
    expected = plain(
        """SELECT genre, count(rating) total_ratings, round(avg(rating), 3) avg_rating,
             count(DISTINCT movie_id) num_movies, round(stddev(rating), 3) rating_stddev
           FROM (SELECT movie_id, explode(genre_array) genre FROM {movies})
           JOIN {ratings} USING (movie_id)
           WHERE genre <> '(no genres listed)' GROUP BY genre""",
        tables,
    )
    assert rows(genres.genre_stats(*tables)) == rows(expected)


def test_genre_year_trends(tables):
    expected = plain(
        """SELECT genre, year, count(rating) rating_count, round(avg(rating), 3) avg_rating
           FROM (SELECT movie_id, explode(genre_array) genre FROM {movies})
           JOIN {ratings} USING (movie_id)
           WHERE genre <> '(no genres listed)' AND year BETWEEN 2001 AND 2004
           GROUP BY genre, year""",
        tables,
    )
    ratings, listed = tables
    counts = count_ratings(ratings, "movie_id", "year", "rating")
    assert rows(genres.genre_year_trends(ratings, listed, 2001, 2004)) == rows(expected)
    assert rows(genres.genre_year_trends(counts, listed, 2001, 2004, "n")) == rows(expected)


def test_yearly_trends(tables):
    expected = plain(
        """SELECT year, count(rating) total_ratings, round(avg(rating), 3) avg_rating,
             count(DISTINCT user_id) active_users, count(DISTINCT movie_id) movies_rated
           FROM {ratings} WHERE year BETWEEN 1995 AND 2023 GROUP BY year""",
        tables,
    )
    ratings, _ = tables
    counts = count_ratings(ratings, "movie_id", "year", "rating")
    assert rows(timeline.yearly_trends(ratings)) == rows(expected)
    assert rows(timeline.yearly_trends(ratings, counts=counts)) == rows(expected)
    sketched = timeline.yearly_trends(ratings, approx=True)
    assert sketched.columns == expected.columns
    exact = {r.year: r for r in expected.collect()}
    for r in sketched.collect():
        assert r.total_ratings == exact[r.year].total_ratings
        assert r.active_users == pytest.approx(exact[r.year].active_users, rel=0.2)


def test_user_activity(tables):
    expected = plain(
        """SELECT user_id, count(rating) total_ratings, round(avg(rating), 3) avg_rating_given,
             stddev(rating) rating_stddev, count(DISTINCT movie_id) unique_movies_rated,
             min(rated_at) first_rating_at, max(rated_at) last_rating_at,
             datediff(max(rated_at), min(rated_at)) active_days
           FROM {ratings} GROUP BY user_id""",
        tables,
    )
    assert rows(users.user_activity(tables[0])) == rows(expected)


def test_counted_ratings_stand_for_ratings(tables):
    ratings, listed = tables
    counts = count_ratings(ratings, "movie_id", "year", "rating")
    for mart in (
        lambda r, w: movies.movie_stats(r, listed, 20, w),
        lambda r, w: movies.movie_ranking(r, listed, 20, 30, w),
        lambda r, w: genres.genre_stats(r, listed, w),
        lambda r, w: genres.largest_genre_trends(r, listed, 3, 2001, 2004, w),
        timeline.rating_distribution,
        movies.global_mean_rating,
        lambda r, w: movies.rating_median(r, weight=w),
        lambda r, w: movies.rating_median(r, exact=False, weight=w),
    ):
        assert rows(mart(counts, "n")) == rows(mart(ratings, None))


def test_a_column_named_n_means_nothing(spark, tables):
    ratings, listed = tables
    noisy = ratings.withColumn("n", F.lit(7))
    assert rows(movies.movie_stats(noisy, listed, 20)) == rows(movies.movie_stats(ratings, listed, 20))
    assert rows(timeline.yearly_trends(noisy)) == rows(timeline.yearly_trends(ratings))
    assert rows(timeline.hourly_activity(noisy)) == rows(timeline.hourly_activity(ratings))


def test_counted_median_is_exact_where_a_sketch_is_asked_for(spark):
    counted = spark.createDataFrame([(1, 1.0, 2), (1, 5.0, 9)], "movie_id int, rating float, n long")
    assert movies.rating_median(counted, exact=False, weight="n").first().median_rating == 5.0


def test_listed_twice_movie_counts_twice(spark, tables):
    ratings, listed = tables
    doubled = listed.unionAll(listed.where("movie_id = 1"))
    once, twice = (
        {r.genre: r for r in genres.genre_stats(ratings, m).collect()} for m in (listed, doubled)
    )
    # movie 1 is "Comedy|Drama"
    extra = ratings.where("movie_id = 1").count()
    assert twice["Comedy"].total_ratings == once["Comedy"].total_ratings + extra
    assert twice["Comedy"].num_movies == once["Comedy"].num_movies


@pytest.mark.parametrize(
    "setting, values",
    [
        ("spark.sql.shuffle.partitions", ["1", "16"]),
        ("spark.sql.session.timeZone", ["UTC", "America/New_York"]),
        ("spark.sql.adaptive.enabled", ["true", "false"]),
        ("spark.sql.autoBroadcastJoinThreshold", ["10MB", "-1"]),
    ],
)
def test_settings_do_not_change_results(spark, setting, values):
    before = spark.conf.get(setting)
    results = []
    try:
        for value in values:
            spark.conf.set(setting, value)
            ratings = cleaning.clean_ratings(frames.skewed_ratings(spark))
            listed = cleaning.clean_movies(frames.genre_movies(spark))
            people = users.user_activity(ratings)
            results.append(
                [
                    rows(movies.movie_ranking(ratings, listed, 20, 30)),
                    rows(genres.genre_stats(ratings, listed)),
                    rows(genres.genre_year_trends(ratings, listed)),
                    rows(timeline.yearly_trends(ratings)),
                    rows(timeline.hourly_activity(ratings)),
                    rows(people),
                    rows(feeds.average_given_histogram(people)),
                    rows(feeds.top_genre_trends(
                        genres.genre_stats(ratings, listed),
                        genres.genre_year_trends(ratings, listed),
                        2,
                    )),
                ]
            )
    finally:
        spark.conf.set(setting, before)
    assert results[0] == results[1]


def test_totals_agree(tables):
    ratings, listed = tables
    n = ratings.count()

    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    people = users.user_activity(ratings)
    assert total(timeline.rating_distribution(ratings), "count") == n
    assert total(timeline.hourly_activity(ratings), "rating_count") == n
    assert total(people, "total_ratings") == n
    assert total(timeline.yearly_trends(ratings, 2001, 2003), "total_ratings") < n
    distinct_users = ratings.select("user_id").distinct().count()
    assert total(users.user_segments(people), "user_count") == distinct_users
    assert total(feeds.ratings_per_user_histogram(people), "users") == distinct_users
    assert total(feeds.average_given_histogram(people), "users") == distinct_users


def test_bayesian_average_lies_between_global_and_movie_mean(tables):
    ratings, listed = tables
    c = movies.global_mean_rating(ratings).first().c
    for r in movies.movie_ranking(ratings, listed, 1, 30).collect():
        low, high = sorted([c, r.avg_rating])
        assert low - 1e-4 <= r.bayesian_avg <= high + 1e-4
