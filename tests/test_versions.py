"""Versions of stored tables: nothing half done is ever read; marts by need; marts after batches."""

import os

import pytest
from pyspark.sql import functions as F

import frames
from compare import sorted_rows
from halfstar.functions.weighted import count_ratings
from halfstar.operators import cleaning, genres, movies, timeline
from halfstar.plans import increments, pipeline, standin
from halfstar.sources import store, versions

SF_DIR = "/root/testdata/sf0.001"
LIMITS = pipeline.Thresholds(min_ratings=20, min_votes=50, min_tag_count=3, gems_lo=20, gems_hi=40)


def same(a, b):
    return sorted_rows(a.toArrow()) == sorted_rows(b.select(a.columns).toArrow())


@pytest.fixture(scope="module")
def raw(spark):
    return standin.raw_tables(spark, SF_DIR)


# versions


def test_a_failed_job_leaves_the_marts_that_were_there(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert versions.newest(spark, root) == 0
    first = pipeline.publish(spark, raw, root, LIMITS, ["genre_stats"])
    before = store.read_mart(spark, versions.current(spark, root), "genre_stats").toArrow()

    def broken(*args, **kwargs):
        raise RuntimeError("lost in the middle")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline.genres, "genre_stats", broken)  # the counts are rewritten by then
        with pytest.raises(RuntimeError, match="lost in the middle"):
            pipeline.publish(spark, raw, root, LIMITS, ["genre_stats"])
    assert versions.newest(spark, root) == first == 1
    assert store.read_mart(spark, versions.current(spark, root), "genre_stats").toArrow().equals(before)
    assert pipeline.publish(spark, raw, root, LIMITS, ["genre_stats"]) == 2


def test_a_reader_stays_on_its_version(spark, tmp_path):
    root = str(tmp_path)
    for n in (5, 3):
        draft = versions.Draft(spark, root)
        draft.replace(spark.range(n), "numbers")
        draft.commit()
        if n == 5:
            reading = versions.Version(spark, root)
            open_frame = reading.read("numbers")
    assert open_frame.count() == reading.read("numbers").count() == 5
    assert versions.Version(spark, root).read("numbers").count() == 3
    assert versions.Version(spark, root, 1).read("numbers").count() == 5
    deleted = versions.drop_old(spark, root)
    assert len(deleted) == 2 and versions.drop_old(spark, root) == []
    assert versions.Version(spark, root).read("numbers").count() == 3
    with pytest.raises(LookupError):
        versions.Version(spark, root, 1)


def test_nothing_is_seen_before_the_commit(spark, tmp_path):
    root = str(tmp_path)
    draft = versions.Draft(spark, root)
    assert draft.append(spark.range(4).withColumn("year", F.lit(2000)), "t", "year").count() == 4
    assert versions.newest(spark, root) == 0 and versions.Version(spark, root).tables() == []
    draft.commit()
    unfinished = versions.Draft(spark, root)
    unfinished.replace(spark.range(9).withColumn("year", F.lit(2000)), "t", "year")
    assert versions.Version(spark, root).read("t").count() == 4
    versions.drop_old(spark, root)  # a job under way keeps its folders
    unfinished.commit()
    assert versions.Version(spark, root).read("t").count() == 9


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path)
    drafts = [versions.Draft(spark, root) for _ in range(2)]
    for n, draft in enumerate(drafts):
        draft.replace(spark.range(n + 1), "t")
    drafts[0].commit()
    with pytest.raises(versions.ConcurrentWrite):
        drafts[1].commit()
    assert versions.Version(spark, root).read("t").count() == 1


def test_replaced_parts_share_the_folders_of_the_others(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001), (4, None)], "x int, year int")
    draft = versions.Draft(spark, root)
    draft.replace(rows, "t", "year")
    draft.commit()
    old = {e.part: e.folder for e in versions.Version(spark, root).entries}
    draft = versions.Draft(spark, root)
    null = versions.part_name("year", None)
    draft.replace(rows.where("x = 2 or year is null"), "t", "year", ["year=2000", null])
    draft.append(rows.where("x = 3"), "t", "year")
    draft.commit()
    new = versions.Version(spark, root)
    assert sorted((r.x, r.year) for r in new.read("t").collect()) == [(2, 2000), (3, 2001), (3, 2001), (4, None)]
    assert old["year=2001"] in {e.folder for e in new.entries} and old["year=2000"] not in {e.folder for e in new.entries}
    assert new.read("t", [null]).collect() == [(4, None)]
    assert new.read("t", ["year=1990"], rows.schema).count() == 0
    versions.drop_old(spark, root)
    assert sorted(r.x for r in versions.Version(spark, root).read("t").collect()) == [2, 3, 3, 4]
    assert os.path.isdir(old["year=2001"].removeprefix("file:")) and not os.path.isdir(old["year=2000"].removeprefix("file:"))


# marts by need


def test_a_mart_is_written_with_what_it_needs_only(spark, raw, tmp_path):
    expected = {
        "movie_stats": {"ratings", "movies", "rating_counts", "movie_stats"},
        "hourly_activity": {"ratings", "hourly_activity"},
        "top_tags": {"tags", "top_tags"},
        "table_row_counts": {"quality_report", "table_row_counts"},
        "user_segments": {"ratings", "user_activity", "user_segments"},
    }
    for mart, folders in expected.items():
        pipeline.run_all(spark, raw, str(tmp_path / mart), LIMITS, [mart])
        assert set(os.listdir(tmp_path / mart)) == folders == set(pipeline.closure([mart]))
    assert pipeline.closure(pipeline.MARTS) == pipeline.MARTS
    with pytest.raises(ValueError):
        pipeline.closure(["no_such_mart"])


# marts after batches


def expected_marts(ratings, listed):
    stats = movies.movie_stats(ratings, listed, LIMITS.min_ratings)
    return {
        "ratings": ratings,
        "yearly_trends": timeline.yearly_trends(ratings),
        "genre_year_trends": genres.genre_year_trends(ratings, listed),
        "rating_distribution": timeline.rating_distribution(ratings),
        "hourly_activity": timeline.hourly_activity(ratings),
        "genre_stats": genres.genre_stats(ratings, listed),
        "movie_stats": stats,
        "movie_bayesian": movies.movie_bayesian(stats, ratings, LIMITS.min_votes),
        "hidden_gems": movies.hidden_gems(stats, LIMITS.gems_min_avg, LIMITS.gems_lo, LIMITS.gems_hi),
        "decade_quality": movies.decade_quality(stats),
    }


def test_marts_after_batches_equal_those_at_once(spark, raw, tmp_path):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    number = F.pmod(F.xxhash64("user_id", "timestamp"), F.lit(3))
    # the last batch has nulls, an unknown year and nothing to add to most years
    parts = [raw["ratings"].where(number == 0), raw["ratings"].where((number == 1) & (F.col("timestamp") < 820454400)), raw["ratings"].limit(0), frames.ratings(spark, [(1, 1, 3.0, None), (None, 2, 3.0, 5), (7, 17, 4.5, 0), (7, 17, 4.5, 0)])]
    added = None
    for part in parts:
        part = part.select(raw["ratings"].columns)
        added = part if added is None else added.unionByName(part)
        increments.add_ratings(spark, root, part, LIMITS)
    ratings, listed = cleaning.clean_ratings(added), cleaning.clean_movies(raw["movies"])
    for name, df in expected_marts(ratings, listed).items():
        assert same(df, increments.mart(spark, root, name)), name
    some = increments.ratings_of_years(spark, root, 1994, 1995)
    assert same(ratings.where("year between 1994 and 1995"), some)
    assert versions.newest(spark, root) == 5


def test_only_touched_years_are_read_and_replaced(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    increments.add_ratings(spark, root, raw["ratings"], LIMITS)
    before = versions.Version(spark, root)
    read = []
    original = versions._read
    monkeypatch.setattr(versions, "_read", lambda *a: read.extend(a[3]) or original(*a))
    increments.add_ratings(spark, root, frames.ratings(spark, [(3, 17, 4.0, 852076800)]), LIMITS)  # 1997
    monkeypatch.undo()
    after = versions.Version(spark, root)
    years = {e.part for e in read if e.part}
    assert years == {"year=1997"}
    assert not any(e.table == "ratings" and e in before.entries for e in read)
    for table in ("rating_counts", "year_users", "yearly_trends", "genre_year_trends"):
        new = {e.part for e in set(after.entries) - set(before.entries) if e.table == table}
        assert new == {"year=1997"} and after.parts(table) == before.parts(table)
    files = after.read("rating_counts", ["year=1997"]).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("year=1997" in r.f for r in files)


def test_movies_can_be_replaced_without_the_ratings(spark, raw, tmp_path):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"].where("movie_id % 2 = 0"), LIMITS)
    increments.add_ratings(spark, root, raw["ratings"], LIMITS)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    ratings, listed = cleaning.clean_ratings(raw["ratings"]), cleaning.clean_movies(raw["movies"])
    for name in ("genre_year_trends", "movie_stats", "yearly_trends"):
        assert same(expected_marts(ratings, listed)[name], increments.mart(spark, root, name)), name


def test_a_failed_batch_can_be_added_again(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    with monkeypatch.context() as patch:
        patch.setattr(increments.movie_ops, "decade_quality", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increments.add_ratings(spark, root, raw["ratings"], LIMITS)
    assert versions.Version(spark, root).tables() == ["movies"]
    increments.add_ratings(spark, root, raw["ratings"], LIMITS)
    clean = cleaning.clean_ratings(raw["ratings"])
    stored = increments.mart(spark, root, "rating_counts")
    assert same(count_ratings(clean, "movie_id", "year", "rating"), stored)


def test_only_the_marts_of_a_store_are_kept_up(spark, raw, tmp_path):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    early, late = (raw["ratings"].where(c) for c in ("timestamp < 820454400", "timestamp >= 820454400 or timestamp is null"))
    increments.add_ratings(spark, root, early, LIMITS, ["yearly_trends"])
    marts = {*increments.BY_YEAR, *increments.WHOLE}
    assert set(versions.Version(spark, root).tables()) & marts == {"yearly_trends"}
    increments.add_ratings(spark, root, late, LIMITS, ["genre_year_trends", "hidden_gems"])
    assert set(versions.Version(spark, root).tables()) & marts == {"yearly_trends", "genre_year_trends", "hidden_gems", "movie_stats"}
    ratings, listed = cleaning.clean_ratings(raw["ratings"]), cleaning.clean_movies(raw["movies"])
    for name in ("yearly_trends", "genre_year_trends", "hidden_gems", "movie_stats"):
        assert same(expected_marts(ratings, listed)[name], increments.mart(spark, root, name)), name
    with pytest.raises(ValueError):
        increments.add_ratings(spark, root, late, LIMITS, ["user_activity"])


def test_a_store_may_begin_with_an_empty_batch(spark, raw, tmp_path):
    root = str(tmp_path)
    increments.set_movies(spark, root, raw["movies"], LIMITS)
    increments.add_ratings(spark, root, raw["ratings"].limit(0), LIMITS)
    assert all(increments.mart(spark, root, m).count() == 0 for m in (*increments.BY_YEAR, *increments.WHOLE, "ratings"))
    increments.add_ratings(spark, root, raw["ratings"], LIMITS)
    ratings, listed = cleaning.clean_ratings(raw["ratings"]), cleaning.clean_movies(raw["movies"])
    for name, df in expected_marts(ratings, listed).items():
        assert same(df, increments.mart(spark, root, name)), name
