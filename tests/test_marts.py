"""Golden cases of the marts."""

import datetime

import pytest

import frames
from halfstar.functions.weighted import count_ratings
from halfstar.operators import cleaning, feeds, genres, movies, tagging, timeline, users
from halfstar.operators.ordering import REPORT_ORDER, in_report_order, top_rows


def clean(df):
    return cleaning.clean_ratings(df)


def stats_of(spark, values_by_movie, min_ratings=1):
    ratings = clean(frames.ratings_of(spark, values_by_movie))
    listed = cleaning.clean_movies(frames.some_movies(spark, values_by_movie))
    return movies.movie_stats(ratings, listed, min_ratings)


def test_statistics_of_single_and_equal_ratings(spark):
    rows = {r.movie_id: r for r in stats_of(spark, {1: [3.5], 2: [4.5] * 7}).collect()}
    assert rows[1].rating_stddev is None
    assert rows[2].rating_stddev == 0.0
    assert (rows[1].min_rating, rows[1].max_rating, rows[1].median_rating) == (3.5, 3.5, 3.5)


@pytest.mark.parametrize(
    "values, median",
    [([1, 2], 1.0), ([1, 2, 3], 2.0), ([5, 5, 1, 1], 1.0), ([5, 5, 5, 1], 5.0), ([4], 4.0)],
)
def test_median_is_the_lower_element(spark, values, median):
    assert stats_of(spark, {1: values}).first().median_rating == median


def test_minimum_support(spark):
    kept = stats_of(spark, {1: [3] * 99, 2: [3] * 100}, min_ratings=100).collect()
    assert [(r.movie_id, r.total_ratings) for r in kept] == [(2, 100)]


def test_ratings_of_unlisted_movies_drop_out(spark):
    ratings = clean(frames.ratings_of(spark, {1: [3], 2: [4]}))
    listed = cleaning.clean_movies(frames.some_movies(spark, [1]))
    assert [r.movie_id for r in movies.movie_stats(ratings, listed, 1).collect()] == [1]


def test_average_is_rounded_half_up_on_the_decimal(spark):
    row = stats_of(spark, {1: [4] * 37 + [4.5] * 3}).first()  # 161.5 / 40 = 4.0375
    assert row.avg_rating == 4.038


def test_movie_stats_schema(spark):
    assert stats_of(spark, {1: [3]}).dtypes == [
        ("movie_id", "int"), ("total_ratings", "bigint"), ("avg_rating", "double"),
        ("rating_stddev", "double"), ("min_rating", "float"), ("max_rating", "float"),
        ("median_rating", "float"), ("clean_title", "string"), ("genres", "string"),
        ("genre_array", "array<string>"), ("release_year", "int"),
    ]


def test_bayesian_average(spark):
    ratings = clean(frames.ratings_of(spark, {1: [4.5] * 500, 2: [2.5] * 500}))
    listed = cleaning.clean_movies(frames.some_movies(spark, [1, 2]))
    assert movies.global_mean_rating(ratings).first().c == 3.5
    ranked = movies.movie_ranking(ratings, listed, min_ratings=100, min_votes=500)
    assert {r.movie_id: r.bayesian_avg for r in ranked.collect()} == {1: 4.0, 2: 3.0}


def test_bayesian_average_of_no_ratings(spark):
    none = clean(frames.ratings(spark, []))
    listed = cleaning.clean_movies(frames.some_movies(spark, [1]))
    assert movies.global_mean_rating(none).first().c is None
    assert movies.movie_ranking(none, listed).collect() == []


def test_hidden_gems_bounds_are_inclusive(spark):
    stats = stats_of(spark, {1: [4] * 3, 2: [4] * 5, 3: [4] * 6, 4: [3.5] * 4})
    gems = movies.hidden_gems(stats, min_avg=4.0, lo=3, hi=5)
    assert sorted(r.clean_title for r in gems.collect()) == ["Film 1", "Film 2"]
    assert gems.columns == [
        "clean_title", "avg_rating", "median_rating", "total_ratings", "genres", "release_year",
    ]


def test_decades(spark):
    years = [1899, 1900, 1999, 2029, 2030]
    listed = cleaning.clean_movies(
        frames.movies(spark, [(i, f"F ({y})", "Drama") for i, y in enumerate(years)] + [(9, "No year", "x")])
    )
    ratings = clean(frames.ratings_of(spark, {i: [3] for i in [0, 1, 2, 3, 4, 9]}))
    rows = movies.decade_quality(movies.movie_stats(ratings, listed, 1)).collect()
    assert sorted(r.decade for r in rows) == [1900, 1990, 2020]
    assert movies.decade_quality(movies.movie_stats(ratings, listed, 1)).dtypes == [
        ("decade", "int"), ("num_movies", "bigint"), ("avg_rating", "double"),
        ("avg_ratings_received", "double"),
    ]


def test_user_activity(spark):
    day = 86400
    raw = frames.ratings(
        spark,
        [(1, 1, 4.0, day - 60), (1, 2, 5.0, day + 60), (1, 1, 4.0, day - 60), (2, 1, 3.0, 0)],
    )
    rows = {r.user_id: r for r in users.user_activity(clean(raw)).collect()}
    first = rows[1]
    assert (first.total_ratings, first.unique_movies_rated, first.active_days) == (3, 2, 1)
    assert first.avg_rating_given == 4.333
    assert first.rating_stddev == pytest.approx((1 / 3) ** 0.5)
    assert first.first_rating_at == datetime.datetime(1970, 1, 1, 23, 59)
    assert (rows[2].active_days, rows[2].rating_stddev) == (0, None)


def edge_users(spark):
    """Averages 3.9996 (rounds to 4.0), 4.0, 3.0 and 2.5."""
    rows = [(1, m, 4.0, 0) for m in range(1249)] + [(1, 2000, 3.5, 0)]
    rows += [(2, 1, 4.0, 0), (3, 1, 3.0, 0), (4, 1, 2.5, 0)]
    return users.user_activity(clean(frames.ratings(spark, rows)))


def test_segments_disagree_at_the_edges(spark):
    people = edge_users(spark)
    left = {r.segment: r.user_count for r in users.user_segments(people).collect()}
    assert left == {"Generous (≥4.0)": 2, "Moderate (3–4)": 1, "Harsh (<3.0)": 1}
    right = {r.segment: r["count"] for r in feeds.user_segments_right_closed(people).collect()}
    assert right == {"Moderate (3–4)": 2, "Harsh (<3)": 2}


def test_right_closed_segments_leave_out_what_no_bin_holds(spark):
    averages = spark.createDataFrame([(0.0,), (5.1,), (5.2,), (None,)], "avg_rating_given double")
    rows = feeds.user_segments_right_closed(averages).collect()
    assert [tuple(r) for r in rows] == [("Generous (≥4)", 1)]


def test_repeated_genre_counts_twice_but_is_one_movie(spark):
    listed = cleaning.clean_movies(
        frames.movies(spark, [(1, "A (1999)", "Drama|Drama"), (2, "B (1999)", "(no genres listed)")])
    )
    ratings = clean(frames.ratings_of(spark, {1: [3, 4], 2: [5]}))
    rows = genres.genre_stats(ratings, listed).collect()
    assert [(r.genre, r.total_ratings, r.num_movies, r.avg_rating) for r in rows] == [
        ("Drama", 4, 1, 3.5)
    ]
    trends = genres.genre_year_trends(ratings, listed).collect()
    assert [(r.genre, r.year, r.rating_count) for r in trends] == [("Drama", 2000, 4)]


def test_year_bounds_are_inclusive(spark):
    start = {1994: 757382400, 1995: 788918400, 2023: 1672531200, 2024: 1704067200}
    ratings = clean(frames.ratings(spark, [(1, 1, 3.0, s) for s in start.values()]))
    assert sorted(r.year for r in timeline.yearly_trends(ratings).collect()) == [1995, 2023]


def test_top_tags_threshold_and_counts(spark):
    rows = [(u, u % 3, " Noir ", 0) for u in range(50)] + [(u, 1, "war", 0) for u in range(49)]
    found = tagging.top_tags(cleaning.clean_tags(frames.tags(spark, rows))).collect()
    assert [tuple(r) for r in found] == [("noir", 50, 3, 50)]


def test_tag_richness(spark):
    rows = [(1, 1, "a", 0), (2, 1, "A ", 0), (3, 1, "b", 0), (1, 9, "c", 0)]
    listed = cleaning.clean_movies(frames.some_movies(spark, [1]))
    found = tagging.movie_tag_richness(cleaning.clean_tags(frames.tags(spark, rows)), listed)
    assert [tuple(r) for r in found.collect()] == [(1, 3, 2, "Film 1", "Drama")]


def test_top_rows_break_ties_by_key(spark):
    stats = stats_of(spark, {m: [3, 4] for m in (5, 3, 9, 1)})
    assert [r.movie_id for r in top_rows(stats, "movie_stats", 3).collect()] == [1, 3, 5]


def test_report_order(spark):
    stats = stats_of(spark, {1: [3], 2: [5], 3: [5, 5], 4: [4]})
    assert [r.movie_id for r in in_report_order(stats, "movie_stats").collect()] == [3, 2, 4, 1]
    assert len(REPORT_ORDER) == 13


def test_gems_explorer_reaches_below_the_marts_threshold(spark):
    ratings = clean(frames.ratings_of(spark, {1: [4.5] * 60, 2: [4.5] * 40}))
    listed = cleaning.clean_movies(frames.some_movies(spark, [1, 2]))
    rows = feeds.gems_explorer(ratings, listed, lo=50).collect()
    assert [(r.clean_title, r.total_ratings) for r in rows] == [("Film 1", 60)]


def test_histogram_bins(spark):
    values = spark.createDataFrame([(v,) for v in [0.0, 2.4, 2.5, 9.9, 10.0, None]], "v double")
    rows = feeds.histogram(values, "v", 4).orderBy("bin").collect()
    assert [tuple(r) for r in rows] == [(1, 0.0, 2.5, 2), (2, 2.5, 5.0, 1), (4, 7.5, 10.0, 2)]
    assert feeds.histogram(values, "v", 4).dtypes[0] == ("bin", "int")


def test_histogram_of_one_value_and_of_nothing(spark):
    same = spark.createDataFrame([(3,), (3,)], "v int")
    assert [tuple(r) for r in feeds.histogram(same, "v", 60).collect()] == [(1, 3.0, 3.0, 2)]
    assert feeds.histogram(same.limit(0), "v", 60).collect() == []


def test_chosen_genres(spark):
    trends = spark.createDataFrame([("War", 2000), ("Drama", 2000)], "genre string, year int")
    assert [r.genre for r in feeds.chosen_genre_trends(trends, ["War"]).collect()] == ["War"]


def test_overview_has_both_means(spark):
    ratings = clean(frames.ratings_of(spark, {1: [5] * 3, 2: [2]}))
    listed = cleaning.clean_movies(frames.some_movies(spark, [1, 2]))
    stats = movies.movie_stats(ratings, listed, 1)
    row = feeds.overview_kpis(stats, users.user_activity(ratings), ratings).first()
    assert tuple(row) == (4, 2, 4, 3.5, 4.25)


def test_counted_ratings_of_nothing(spark):
    assert count_ratings(clean(frames.ratings(spark, [])), "rating").collect() == []
