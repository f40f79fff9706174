"""The whole job: source tables to stored marts.

Every stage reads what an earlier one has written, not a cache. A lost executor
then costs the tasks it ran and not the stages before them, and a later session
can go on from any stored table.
"""

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions.weighted import COUNTED, count_ratings
from ..operators import (
    cleaning,
    genres,
    movies as movie_ops,
    quality,
    tagging,
    timeline,
    users as user_ops,
)
from ..sources import store, versions
from ..sources.delimited import read_source
from ..sources.schemas import SOURCES


@dataclass(frozen=True)
class Thresholds:
    """The default limits of the marts."""

    min_ratings: int = 100
    min_votes: int = 500
    min_tag_count: int = 50
    gems_min_avg: float = 4.0
    gems_lo: int = 100
    gems_hi: int = 500
    first_year: int = 1995
    last_year: int = 2023
    first_decade: int = 1900
    last_decade: int = 2020
    tag_buckets: int = store.TAG_BUCKETS


MARTS = (
    "quality_report",
    "table_row_counts",
    "ratings",
    "movies",
    "tags",
    "rating_counts",
    "rating_distribution",
    "yearly_trends",
    "hourly_activity",
    "user_activity",
    "user_segments",
    "genre_stats",
    "genre_year_trends",
    "movie_stats",
    "movie_bayesian",
    "hidden_gems",
    "decade_quality",
    "top_tags",
    "movie_tag_richness",
)


#: What each mart is derived from. Marts that are not named here come from the source tables.
NEEDS = {
    "table_row_counts": ("quality_report",),
    "rating_counts": ("ratings",),
    "rating_distribution": ("rating_counts",),
    "yearly_trends": ("ratings", "rating_counts"),
    "hourly_activity": ("ratings",),
    "user_activity": ("ratings",),
    "user_segments": ("user_activity",),
    "genre_stats": ("rating_counts", "movies"),
    "genre_year_trends": ("rating_counts", "movies"),
    "movie_stats": ("rating_counts", "movies"),
    "movie_bayesian": ("movie_stats", "rating_counts"),
    "hidden_gems": ("movie_stats",),
    "decade_quality": ("movie_stats",),
    "top_tags": ("tags",),
    "movie_tag_richness": ("tags", "movies"),
}


def closure(marts: Iterable[str]) -> tuple[str, ...]:
    """The given marts and all that they are derived from, in the order of ``MARTS``."""
    wanted, waiting = set(), list(marts)
    while waiting:
        mart = waiting.pop()
        if mart not in MARTS:
            raise ValueError(f"no mart is called {mart}")
        if mart not in wanted:
            wanted.add(mart)
            waiting += NEEDS.get(mart, ())
    return tuple(m for m in MARTS if m in wanted)


def read_sources(
    spark: SparkSession, directory: str, multi_line: bool = False
) -> dict[str, DataFrame]:
    return {table: read_source(spark, directory, table, multi_line) for table in SOURCES}


def write_reports(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    marts: Iterable[str] = MARTS,
    known_counts: Mapping[str, int] | None = None,
) -> None:
    """Store the quality of the analysed sources and the row counts of all.

    The row counts are taken from the quality report; only links, which it does
    not cover, are counted on their own, unless ``known_counts`` has them.
    """
    wanted = closure(marts)
    if "quality_report" in wanted:
        audited = {name: raw[name] for name in ("ratings", "movies", "tags")}
        store.write_mart(quality.quality_reports(audited), root, "quality_report")
    if "table_row_counts" in wanted:
        report = store.read_mart(spark, root, "quality_report")
        known = report.select("table_name", "row_count").distinct()
        if known_counts and "links" in known_counts:
            links = spark.createDataFrame([("links", known_counts["links"])], known.schema)
        else:
            links = quality.table_row_counts({"links": raw["links"]})
        store.write_mart(known.unionByName(links), root, "table_row_counts")


def write_clean_tables(
    raw: dict[str, DataFrame],
    root: str,
    limits: Thresholds = Thresholds(),
    marts: Iterable[str] = MARTS,
) -> None:
    wanted = closure(marts)
    if "movies" in wanted:
        store.write_mart(cleaning.clean_movies(raw["movies"]), root, "movies")
    if "tags" in wanted:
        store.write_tags(cleaning.clean_tags(raw["tags"]), root, limits.tag_buckets)
    if "ratings" in wanted:
        store.write_ratings(cleaning.clean_ratings(raw["ratings"]), root)


def write_analytics(
    spark: SparkSession,
    root: str,
    limits: Thresholds = Thresholds(),
    marts: Iterable[str] = MARTS,
) -> None:
    """Derive marts, and what they need, from the stored clean tables.

    ``rating_counts`` (movie, year, value) carries everything that does not ask
    for users or hours, so those marts never touch the ratings again.
    """
    t, wanted = limits, closure(marts)
    made: dict[str, DataFrame] = {}

    def clean(name: str) -> DataFrame:
        return store.read_tags(spark, root) if name == "tags" else store.read_mart(spark, root, name)

    def keep(name: str, build: Callable[[], DataFrame]) -> None:
        if name in wanted:
            df = build()
            store.write_mart(df, root, name)
            made[name] = store.read_mart(spark, root, name, df.schema)

    made.update({name: clean(name) for name in ("ratings", "movies", "tags") if name in wanted})
    keep("rating_counts", lambda: count_ratings(made["ratings"], "movie_id", "year", "rating"))

    def movie_marts() -> None:
        keep("movie_stats", lambda: movie_ops.movie_stats(made["rating_counts"], made["movies"], t.min_ratings, COUNTED))
        keep("movie_bayesian", lambda: movie_ops.movie_bayesian(made["movie_stats"], made["rating_counts"], t.min_votes, COUNTED))
        keep("hidden_gems", lambda: movie_ops.hidden_gems(made["movie_stats"], t.gems_min_avg, t.gems_lo, t.gems_hi))
        keep("decade_quality", lambda: movie_ops.decade_quality(made["movie_stats"], t.first_decade, t.last_decade))

    def genre_marts() -> None:
        keep("genre_stats", lambda: genres.genre_stats(made["rating_counts"], made["movies"], COUNTED))
        keep("genre_year_trends", lambda: genres.genre_year_trends(made["rating_counts"], made["movies"], t.first_year, t.last_year, COUNTED))

    def time_marts() -> None:
        keep("rating_distribution", lambda: timeline.rating_distribution(made["rating_counts"], COUNTED))
        keep("yearly_trends", lambda: timeline.yearly_trends(made["ratings"], t.first_year, t.last_year, made["rating_counts"]))
        keep("hourly_activity", lambda: timeline.hourly_activity(made["ratings"]))

    def user_marts() -> None:
        keep("user_activity", lambda: user_ops.user_activity(made["ratings"]))
        keep("user_segments", lambda: user_ops.user_segments(made["user_activity"]))

    def tag_marts() -> None:
        keep("top_tags", lambda: tagging.top_tags(made["tags"], t.min_tag_count))
        keep("movie_tag_richness", lambda: tagging.movie_tag_richness(made["tags"], made["movies"]))

    _side_by_side(user_marts, movie_marts, genre_marts, time_marts, tag_marts)


def _side_by_side(*jobs: Callable[[], None]) -> None:
    """Run independent jobs together: the tail of one leaves its slots to the next.

    The jobs carry a tag of their own and the caller's local properties. When one of them
    fails, the Spark jobs of the others are cancelled and its error is raised.
    """
    session = SparkSession.active()
    context, tag = session.sparkContext, f"halfstar-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], None]) -> Callable[[], None]:
        def run() -> None:
            context.addJobTag(tag)
            job()

        return inheritable_thread_target(session)(run)

    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(tagged(job)) for job in jobs]
        done, others = wait(running, return_when=FIRST_EXCEPTION)
        failed = [job for job in done if job.exception()]
        while failed and others:  # a job may be between two Spark jobs
            context.cancelJobsWithTag(tag)
            _, others = wait(others, timeout=0.2)
        for job in failed or running:
            job.result()


def run_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    limits: Thresholds = Thresholds(),
    marts: Iterable[str] = MARTS,
    known_counts: Mapping[str, int] | None = None,
) -> None:
    """Write marts below ``root``: all of ``MARTS``, or the given ones and what they are derived from.

    ``known_counts`` has rows of source tables, where these were counted as they were stored.
    """
    wanted = closure(marts)
    _side_by_side(
        lambda: write_clean_tables(raw, root, limits, wanted),
        lambda: write_reports(spark, raw, root, wanted, known_counts),
    )
    write_analytics(spark, root, limits, wanted)


def publish(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    limits: Thresholds = Thresholds(),
    marts: Iterable[str] = MARTS,
) -> int:
    """`run_all` into a new version of the marts below ``root``; returns its number.

    Readers take ``versions.current(spark, root)`` as the root of `store`'s functions. They see the marts of
    one job only: the former ones until this job has ended, and also if it fails.
    """
    return versions.publish(spark, root, lambda folder: run_all(spark, raw, folder, limits, marts))


def run_from_csv(
    spark: SparkSession,
    directory: str,
    root: str,
    limits: Thresholds = Thresholds(),
    multi_line: bool = False,
) -> None:
    """``run_all`` on the CSV files of ``directory``, which are parsed once.

    The typed rows are stored below ``root`` first; reports and clean tables read them from there.
    ``multi_line`` is for files with line breaks inside fields.
    """
    parsed = read_sources(spark, directory, multi_line)
    counts = {t: store.write_counted(df, f"{root}/raw", t) for t, df in parsed.items()}
    raw = {t: store.read_mart(spark, f"{root}/raw", t, df.schema) for t, df in parsed.items()}
    run_all(spark, raw, root, limits, known_counts=counts)
