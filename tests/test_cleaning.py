"""Golden cases of the scan and of cleaning."""

import datetime

import pytest
from pyspark.sql import functions as F

import frames
from halfstar.operators import cleaning, quality
from halfstar.operators.genres import movie_genres
from halfstar.sources import delimited, schemas


@pytest.mark.parametrize(
    "title, year, clean",
    [
        ("A (1999)", 1999, "A"),
        ("B (2001) ", 2001, "B"),
        ("Babylon 5", None, "Babylon 5"),
        ("C (19994)", None, "C (19994)"),
        ("X (1994) (2000)", 2000, "X (1994)"),
        (" (2005)", 2005, ""),
        ("Tab (2003)\t", 2003, "Tab"),
    ],
)
def test_release_year_and_title(spark, title, year, clean):
    row = cleaning.clean_movies(frames.movies(spark, [(1, title, "Drama")])).first()
    assert (row.release_year, row.clean_title) == (year, clean)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_missing_year_is_null_in_either_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = cleaning.clean_movies(frames.movies(spark, [(1, "No year", "Drama")])).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert row.release_year is None


def test_movies_without_id_or_title_are_dropped(spark):
    raw = frames.movies(spark, [(None, "A (1999)", "x"), (1, None, "x"), (2, "B (1999)", None)])
    rows = cleaning.clean_movies(raw).collect()
    assert [(r.movie_id, r.genre_array) for r in rows] == [(2, None)]


def test_genre_lists(spark):
    raw = frames.movies(
        spark,
        [(1, "A (1999)", None), (2, "B (1999)", ""), (3, "C (1999)", "Drama|Drama"), (4, "D (1999)", "Action|War")],
    )
    rows = movie_genres(cleaning.clean_movies(raw)).collect()
    assert sorted(map(tuple, rows)) == [(2, ""), (3, "Drama"), (3, "Drama"), (4, "Action"), (4, "War")]


def test_only_ratings_within_bounds_stay(spark):
    values = [0.0, 0.5, 5.0, 5.5, float("nan"), None]
    raw = frames.ratings(spark, [(1, 1, v, 0) for v in values])
    assert sorted(r.rating for r in cleaning.clean_ratings(raw).collect()) == [0.5, 5.0]


def test_ratings_without_user_or_movie_are_dropped(spark):
    raw = frames.ratings(spark, [(None, 1, 3.0, 0), (1, None, 3.0, 0), (1, 1, 3.0, None)])
    rows = cleaning.clean_ratings(raw).collect()
    assert [(r.user_id, r.rated_at, r.year, r.hour) for r in rows] == [(1, None, None, None)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_parts_are_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = frames.ratings(
            spark, [(1, 1, 3.0, 1699162200), (2, 1, 3.0, 1699165800), (3, 1, 3.0, -1)]
        )
        rows = cleaning.clean_ratings(raw).orderBy("user_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.hour for r in rows] == [5, 6, 23]
    assert [(r.year, r.month) for r in rows] == [(2023, 11), (2023, 11), (1969, 12)]
    assert rows[0].rated_at == datetime.datetime(2023, 11, 5, 5, 30)
    assert rows[2].rated_at == datetime.datetime(1969, 12, 31, 23, 59, 59)


LIMIT = (2**63 - 1) // 1_000_000


@pytest.mark.parametrize(
    "seconds", [10**13, LIMIT + 1, -LIMIT - 1, 1_700_000_000_000_000, 2**63 - 1, -(2**63)]
)
def test_a_time_beyond_timestamps_is_null(spark, seconds):
    row = cleaning.clean_ratings(frames.ratings(spark, [(1, 1, 3.0, seconds)])).first()
    assert (row.rating, row.rated_at, row.year, row.month, row.hour) == (3.0, *[None] * 4)
    assert cleaning.clean_tags(frames.tags(spark, [(1, 1, "a", seconds)])).first().tagged_at is None


@pytest.mark.parametrize("seconds", [LIMIT, -LIMIT, 0])
def test_a_time_within_timestamps_has_all_parts(spark, seconds):
    parts = cleaning.clean_ratings(frames.ratings(spark, [(1, 1, 3.0, seconds)]))
    names = ("rated_at", "year", "month", "hour")
    assert parts.where(" and ".join(f"{c} is not null" for c in names)).count() == 1


def test_a_time_in_milliseconds_does_not_fail(spark):
    raw = frames.ratings(spark, [(1, 1, 3.0, 1_700_000_000_000)])
    assert cleaning.clean_ratings(raw).select("year", "hour").first() == (55840, 22)


def test_cleaned_schemas(spark):
    types = dict(cleaning.clean_ratings(frames.ratings(spark, [])).dtypes)
    assert types == {
        "user_id": "int", "movie_id": "int", "rating": "float", "rated_at": "timestamp_ntz",
        "year": "int", "month": "int", "hour": "int",
    }
    types = dict(cleaning.clean_movies(frames.movies(spark, [])).dtypes)
    assert types == {
        "movie_id": "int", "title": "string", "genres": "string", "release_year": "int",
        "clean_title": "string", "genre_array": "array<string>",
    }
    types = dict(cleaning.clean_tags(frames.tags(spark, [])).dtypes)
    assert types == {
        "user_id": "int", "movie_id": "int", "tag": "string", "tag_lower": "string",
        "tagged_at": "timestamp_ntz",
    }


def test_tags_are_normalised_and_blank_ones_dropped(spark):
    raw = frames.tags(
        spark, [(1, 1, " Sci-Fi ", 0), (2, 1, "sci-fi", 0), (3, 1, "   ", 0), (4, 1, "\t", 0), (5, 1, None, 0)]
    )
    rows = cleaning.clean_tags(raw).orderBy("user_id").collect()
    assert [(r.user_id, r.tag_lower) for r in rows] == [(1, "sci-fi"), (2, "sci-fi"), (4, "\t")]


def test_duplicates_are_reported_and_kept(spark):
    raw = frames.ratings(spark, [(1, 1, 3.0, 0), (1, 1, 3.0, 0), (2, 1, None, 0), (None, 1, None, 0)])
    report = {r.column_name: r for r in quality.quality_report(raw, "ratings").collect()}
    assert set(report) == {"user_id", "movie_id", "rating", "timestamp"}
    assert {r.row_count for r in report.values()} == {4}
    assert {r.duplicate_rows for r in report.values()} == {1}
    assert {c: r.null_count for c, r in report.items()} == {
        "user_id": 1, "movie_id": 0, "rating": 2, "timestamp": 0,
    }
    assert cleaning.clean_ratings(raw).count() == 2


def test_quality_report_of_an_empty_table(spark):
    rows = quality.quality_report(frames.movies(spark, []), "movies").collect()
    assert [(r.row_count, r.null_count, r.duplicate_rows) for r in rows] == [(0, 0, 0)] * 3


def test_csv_scan_golden_lines(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(
        "movieId,title,genres\n"
        '1,"Plain, with comma (1999)",Drama\n'
        '2,"""G"" Cats (1998)",Musical\n'
        "abc,T (1990),Drama\n"
        "4,,Drama\n"
        "5,Ünïcode (2001) ,Action|Drama\n",
        encoding="utf-8",
    )
    raw = delimited.read_source(spark, str(tmp_path), "movies")
    report = delimited.unparsable_rows(spark, str(tmp_path), "movies").collect()
    assert [tuple(r) for r in report] == [("movies", 5, 1)]
    assert raw.columns == ["movie_id", "title", "genres"]
    assert [tuple(r) for r in raw.orderBy(F.col("movie_id").asc_nulls_last()).collect()] == [
        (1, "Plain, with comma (1999)", "Drama"),
        (2, '"G" Cats (1998)', "Musical"),
        (4, None, "Drama"),
        (5, "Ünïcode (2001) ", "Action|Drama"),
        (None, "T (1990)", "Drama"),
    ]
    assert [r.movie_id for r in cleaning.clean_movies(raw).orderBy("movie_id").collect()] == [1, 2, 5]


def test_csv_links_keep_leading_zeros(spark, tmp_path):
    (tmp_path / "links.csv").write_text("movieId,imdbId,tmdbId\n1,0114709,862\n2,,\n")
    rows = delimited.read_source(spark, str(tmp_path), "links").orderBy("movie_id").collect()
    assert [tuple(r) for r in rows] == [(1, "0114709", 862), (2, None, None)]


def test_csv_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n1,"two\nlines (1999)",Drama\n')
    path = str(tmp_path / "movies.csv")
    row = delimited.read_csv(spark, path, schemas.MOVIES, multi_line=True).first()
    assert row.title == "two\nlines (1999)"


def test_csv_round_trip_of_odd_titles(spark, tmp_path):
    titles = ['a "quoted" one', "back\\slash \\", "two\nlines", "cr\r\nlf", " padded ", "", None, '"', "é, ü"]
    movies = frames.movies(spark, [(i, t, "Drama") for i, t in enumerate(titles)])
    delimited.write_source(movies, str(tmp_path), "movies")
    back = delimited.read_source(spark, str(tmp_path), "movies", multi_line=True)
    found = {r.movie_id: r.title for r in back.collect()}
    # an empty field is NULL; a line break of another system is read as \n
    expected = dict(enumerate(titles)) | {5: None}
    assert {k: (v or "").replace("\r\n", "\n") or None for k, v in found.items()} == {
        k: (v or "").replace("\r\n", "\n") or None for k, v in expected.items()
    }
