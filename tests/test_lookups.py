"""Lookups that read less than they might, rejected lines, sketches that roll up."""

import re

import pytest
from pyspark.sql import functions as F

import frames
from compare import sorted_rows
from halfstar.functions.weighted import count_ratings
from halfstar.operators import cleaning, genres, quality, sketches, users
from halfstar.operators.ordering import in_report_order, report_keys
from halfstar.plans import pipeline, standin
from halfstar.sources import delimited, store

SF_DIR = "/root/testdata/sf0.001"


def same(a, b):
    return sorted_rows(a.toArrow()) == sorted_rows(b.select(a.columns).toArrow())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    """Rows that came out of the file scans of a query, before any filter."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in node.nodeName():
        node = node.executedPlan()
    total, waiting = 0, [node]
    while waiting:
        node = waiting.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            waiting.append(node.plan())
    return total


@pytest.fixture(scope="module")
def tables(spark):
    ratings = cleaning.clean_ratings(standin.ratings_raw(spark, SF_DIR))
    return ratings, cleaning.clean_movies(standin.movies_raw(spark, SF_DIR)), cleaning.clean_tags(standin.tags_raw(spark, SF_DIR))


# pruning


def test_years_named_by_a_frame_prune_the_folders(spark, tables, tmp_path):
    root = str(tmp_path)
    store.write_ratings(tables[0], root)
    store.write_mart(count_ratings(tables[0], "year"), root, "years")
    sizes = sorted(r.n for r in store.read_mart(spark, root, "years").collect())
    years = store.read_mart(spark, root, "years").where(F.col("n") <= sizes[1])
    found = store.ratings_of_named_years(spark, root, years)
    assert "dynamicpruning" in plan(found)
    named = {r.year for r in years.collect()}
    assert 0 < len(named) < 4 and same(tables[0].where(F.col("year").isin(named)), found)
    # the only rows that leave a scan are those of the named years, and the small frame's own
    assert rows_scanned(found.select("user_id")) <= tables[0].where(F.col("year").isin(named)).count() + 2 * len(sizes)


def test_lookups_by_user_skip_row_groups(spark, tmp_path):
    # movies, and with them buckets, have users of their own, but for one
    rows = [(u, u % 97, f"t{u}", u) for u in range(1, 4000)] + [(5000, 3, "x", 1)]
    tags = cleaning.clean_tags(frames.tags(spark, rows))
    store.write_tags(tags, str(tmp_path))
    found = store.tags_of_user(spark, str(tmp_path), 5000)
    assert same(tags.where("user_id = 5000"), found)
    assert "EqualTo(user_id,5000)" in plan(found)
    assert 0 < rows_scanned(found) < len(rows) / 8
    missing = store.tags_of_user(spark, str(tmp_path), 2500 * 2 + 1)
    assert missing.count() == 0


def test_first_rows_read_the_first_part_only(spark, tables, tmp_path):
    root, keys = str(tmp_path), report_keys("user_activity")
    people = users.user_activity(tables[0])
    store.write_in_order(people, root, "user_activity", keys)
    stored = store.read_mart(spark, root, "user_activity")
    assert same(people, stored.drop("part"))
    assert stored.select("part").distinct().count() > 3
    first = store.first_rows(spark, root, "user_activity", keys, 10)
    want = [tuple(r) for r in in_report_order(people, "user_activity").limit(10).collect()]
    assert [tuple(r) for r in first.collect()] == want
    assert rows_scanned(first) < people.count() / 2
    everything = store.first_rows(spark, root, "user_activity", keys, 10**6)
    assert same(people, everything)
    store.write_in_order(people.where("false"), root, "nobody", keys)
    nobody = store.first_rows(spark, root, "nobody", keys, 3)
    assert nobody.count() == 0 and nobody.dtypes == people.dtypes


# rejected lines


def test_lines_that_do_not_fit_are_kept_with_their_file(spark, tmp_path):
    folder = tmp_path / "ratings.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,4\n1,x,3.5,4\n,,,\n")
    (folder / "b.csv").write_text('userId,movieId,rating,timestamp\n5,6,4.0,"7"\n1,2\n9,9,abc,9\n1,2,3.0,4,5\n')
    typed, rejected = delimited.store_source(spark, str(tmp_path), "ratings", str(tmp_path / "out"))
    lines = sorted((r.file.rpartition("/")[2], r.line) for r in rejected.collect())
    assert lines == [("a.csv", "1,x,3.5,4"), ("b.csv", "1,2"), ("b.csv", "1,2,3.0,4,5"), ("b.csv", "9,9,abc,9")]
    assert same(delimited.read_source(spark, str(tmp_path), "ratings"), typed)
    report = delimited.unparsable_rows(spark, str(tmp_path), "ratings").first()
    assert (report.row_count, report.unparsable) == (typed.count(), len(lines)) == (7, 4)
    assert "rejected=true" in rejected.select(F.input_file_name()).first()[0]
    assert len(re.findall("FileScan parquet", plan(rejected))) == 1


def test_a_file_without_rejected_lines(spark, tmp_path):
    delimited.write_source(standin.links_raw(spark, SF_DIR), str(tmp_path), "links")
    typed, rejected = delimited.store_source(spark, str(tmp_path), "links", str(tmp_path / "out"))
    assert rejected.count() == 0 and same(standin.links_raw(spark, SF_DIR), typed)


# counts without a pass of their own


def test_rows_are_counted_as_they_are_stored(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    raw = standin.raw_tables(spark, SF_DIR)
    for table, df in raw.items():
        delimited.write_source(df, source, table)
    expected = sorted(map(tuple, quality.table_row_counts(raw).collect()))

    def not_again(*args):
        raise AssertionError("links were scanned for their number")

    monkeypatch.setattr(pipeline.quality, "table_row_counts", not_again)
    pipeline.run_from_csv(spark, source, root)
    assert sorted(map(tuple, store.read_mart(spark, root, "table_row_counts").collect())) == expected
    assert store.write_counted(spark.range(17), root, "numbers") == 17
    assert store.write_counted(spark.range(0), root, "nothing") == 0


# sketches


def test_users_of_any_years_from_stored_sketches(spark, tables, tmp_path):
    ratings, movies, _ = tables
    store.write_mart(sketches.user_sketches(ratings), str(tmp_path), "users")
    stored = store.read_mart(spark, str(tmp_path), "users")
    assert "user_id" not in stored.columns
    for first, last in ((None, None), (1994, 1994), (1993, 1996)):
        exact = ratings.where(F.col("year").between(first or 0, last or 9999)).select("user_id").distinct().count()
        estimate = sketches.distinct_users(stored, first=first, last=last).first()[0]
        assert abs(estimate - exact) <= 4 * sketches.DISTINCT_ERROR * exact + 1
    by_genre = sketches.genre_user_sketches(ratings, movies)
    exact = genres.with_genre(ratings.select("movie_id", "user_id"), movies).groupBy("genre").agg(F.count_distinct("user_id").alias("users"))
    both = sketches.distinct_users(by_genre, "genre").join(exact, "genre")
    assert both.count() == exact.count() and both.where(~sketches.distinct_is_near(F.col("distinct_users"), F.col("users"))).count() == 0


def test_sketches_are_united_in_any_order(spark):
    rows = spark.range(200_000).selectExpr("cast(id % 50000 as int) as user_id", "cast(id % 9 as int) as year")
    whole = rows.withColumn("year", F.lit(1))
    one = sketches.distinct_users(sketches.user_sketches(whole)).first()[0]
    many = sketches.distinct_users(sketches.user_sketches(rows)).first()[0]
    assert abs(one - 50_000) < 4 * sketches.DISTINCT_ERROR * 50_000 and abs(many - 50_000) < 4 * sketches.DISTINCT_ERROR * 50_000


def test_medians_of_any_values_roll_up(spark):
    values = spark.range(60_000).selectExpr("cast(id % 3 as int) as movie_id", "cast(1990 + id % 7 as int) as year", "cast(sqrt(id) * 0.01 as float) as rating")
    per_year = sketches.rating_sketches(values, "movie_id")
    for share, first, last in ((0.5, None, None), (0.9, 1991, 1993), (0.1, 1996, 1996)):
        found = sketches.rating_quantile(per_year, "movie_id", share=share, first=first, last=last)
        some = values.where(F.col("year").between(first or 0, last or 9999))
        checked = sketches.quantile_is_near(found, count_ratings(some, "movie_id", "rating"), "movie_id", share=share).collect()
        assert len(checked) == 3 and all(r.near for r in checked)
        assert sum(r.n for r in checked) == some.count()
    wrong = sketches.rating_quantile(per_year, "movie_id", share=0.6)
    assert not any(r.near for r in sketches.quantile_is_near(wrong, count_ratings(values, "movie_id", "rating"), "movie_id").collect())


# users without their movies


def test_profiles_are_the_activity_without_movies(spark, tables):
    ratings = tables[0]
    assert same(users.user_profile(ratings), users.user_activity(ratings).drop("unique_movies_rated"))


@pytest.mark.parametrize("name", ["feed_hist_ratings_per_user", "feed_hist_avg_given", "feed_user_segments_right_closed", "feed_overview_kpis"])
def test_feeds_on_users_do_not_shuffle_pairs(spark, name):
    from __spark_entry__ import queries

    assert not re.search(r"hashpartitioning\(user_id#\d+, movie_id", plan(queries()[name](spark, SF_DIR)))


def test_chosen_genres_are_taken_from_one_scan(spark):
    from __spark_entry__ import queries

    df = queries()["feed_chosen_genre_trends"](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet .*?/lineitem\.parquet", final)) == 1
