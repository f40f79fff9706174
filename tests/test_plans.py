"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from halfstar.functions.weighted import count_ratings
from halfstar.operators import genres, movies, timeline, users
from halfstar.operators.cleaning import clean_movies
from halfstar.plans import standin
from halfstar.plans.queries import QUERIES
from halfstar.sources import store

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    """The plan as adaptive execution has left it, subqueries included."""
    df.collect()
    return planned(df)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    store.write_ratings(queries()["clean_ratings"](spark, SF_DIR), root)
    store.write_tags(queries()["clean_tags"](spark, SF_DIR), root)
    counts = count_ratings(store.read_mart(spark, root, "ratings"), "movie_id", "year", "rating")
    store.write_mart(counts, root, "rating_counts")
    return root


NO_LAZY_RESULT = {"pipeline_mart_rows"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in NO_LAZY_RESULT])
def test_no_cartesian_product_and_no_python(spark, name):
    plan = planned(queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InMemoryRelation"):
        assert operator not in plan


def test_ranking_counts_the_ratings_once(spark, stored):
    listed = clean_movies(standin.movies_raw(spark, SF_DIR))
    from_store = movies.movie_ranking(store.read_mart(spark, stored, "ratings"), listed, 30, 150)
    for df in (queries()["movie_bayesian"](spark, SF_DIR), from_store):
        assert "ReusedExchange [movie_id" in executed(df)


def scans(df):
    """Table scans that a query runs; what it reuses runs once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plan)


@pytest.mark.parametrize(
    "name", ["user_activity", "user_segments", "top_active_users", "yearly_trends", "feed_top_genre_trends"]
)
def test_each_input_is_read_once(spark, name):
    assert scans(queries()[name](spark, SF_DIR)).count("lineitem") == 1


def test_top_rows_are_taken_without_a_full_sort(spark):
    for name in ("top_movies_by_avg", "top_active_users", "feed_top_n_bayesian"):
        plan = planned(queries()[name](spark, SF_DIR))
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_year_slice_reads_only_its_folder(spark, stored):
    df = store.ratings_of_years(spark, stored, 1998, 1998).select("user_id")
    plan = planned(df)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<user_id:int>" in plan
    files = df.select(F.input_file_name().alias("file")).distinct().collect()
    assert files and all("year=1998" in f.file for f in files)


def test_tag_lookup_prunes_bucket_and_pushes_movie(spark, stored):
    plan = planned(store.tags_for_movie(spark, stored, 17))
    assert "PartitionFilters: [isnotnull(tag_bucket" in plan
    assert "EqualTo(movie_id,17)" in plan


def test_marts_read_only_their_columns(spark, stored):
    ratings = store.read_mart(spark, stored, "ratings")
    assert "ReadSchema: struct<rating:float,hour:int>" in planned(timeline.hourly_activity(ratings))
    plan = planned(users.user_activity(ratings))
    assert "ReadSchema: struct<user_id:int,movie_id:int,rating:float,rated_at:timestamp_ntz>" in plan
    counts = store.read_mart(spark, stored, "rating_counts")
    plan = planned(timeline.yearly_trends(ratings, 1996, 1997, counts))
    assert "ReadSchema: struct<user_id:int>" in plan


def test_each_stored_mart_query_runs_the_job(spark, monkeypatch):
    from halfstar.plans import queries as registered

    runs, run_all = [], registered.pipeline.run_all
    monkeypatch.setattr(registered.pipeline, "run_all", lambda *a, **b: runs.append(a[2]) or run_all(*a, **b))
    counts = [queries()[name](spark, SF_DIR).count() for name in ("pipeline_movie_stats", "pipeline_movie_stats", "pipeline_genre_stats")]
    assert len(set(runs)) == 3 and counts[0] == counts[1] > 0 and counts[2] > 0


def test_stored_movies_are_not_broadcast(spark, tmp_path):
    """As stored they take far less room than their rows, so their size on disk must not send them to the driver."""
    listed = clean_movies(standin.movies_raw(spark, SF_DIR))
    store.write_mart(listed, str(tmp_path), "movies")
    rows = [(u, 1 + u % 9, float(1 + u % 5), 2000) for u in range(90)]
    ratings = spark.createDataFrame(rows, "user_id int, movie_id int, rating float, year int")
    kept = store.read_mart(spark, str(tmp_path), "movies")
    for df in (movies.movie_stats(ratings, kept, 1), genres.genre_stats(ratings, kept)):
        assert "Broadcast" not in executed(df)
