"""Marts kept up with ratings that arrive in batches.

Beside the ratings, each version holds counts that can be added up: per (year, movie, value), per (movie, value),
per (hour, value), and the users of each year. A batch is cleaned and stored once; its counts are then added
to the stored ones, of which only the years that the batch touches are read and replaced. Marts by year are derived anew for
those years alone, all others from the counts, which are as few as a movie has values. No
rating that was stored before is read again. All of it becomes one new version.

Batches hold new ratings; rows repeated in another batch count again, as rows repeated within one do.
What depends on every pair of user and movie, `user_activity` and what follows from it, has no small counts
and is derived from the stored ratings (see `pipeline`).
"""

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.weighted import COUNTED, count_ratings
from ..operators import cleaning, genres, movies as movie_ops, timeline
from ..sources.versions import Draft, Version, part_name
from .pipeline import Thresholds

#: Marts that lie in year folders, and all others that can be kept up.
BY_YEAR = ("yearly_trends", "genre_year_trends")
WHOLE = (
    "rating_distribution",
    "hourly_activity",
    "genre_stats",
    "movie_stats",
    "movie_bayesian",
    "hidden_gems",
    "decade_quality",
)
#: Marts that are derived from `movie_stats`.
_OF_STATS = {"movie_bayesian", "hidden_gems", "decade_quality"}


def set_movies(
    spark: SparkSession, root: str, raw_movies: DataFrame, limits: Thresholds = Thresholds()
) -> int:
    """Start a store with its movies, or replace them: marts are derived anew, from the counts."""
    draft = Draft(spark, root)
    draft.replace(cleaning.clean_movies(raw_movies), "movies")
    if kept := _kept(draft):
        _derive(draft, limits, kept, draft.parts("rating_counts"))
    return draft.commit()


def add_ratings(
    spark: SparkSession,
    root: str,
    raw_ratings: DataFrame,
    limits: Thresholds = Thresholds(),
    marts: Iterable[str] | None = None,
) -> int:
    """Add a batch of raw ratings to a store that has movies; returns the number of the new version.

    The marts that the store has are kept up, and those of ``marts`` from now on, too; a store without any
    gets all, unless ``marts`` names some. A batch that is empty, or has no row that survives cleaning, changes no mart.
    """
    draft = Draft(spark, root)
    before = set(draft.entries)
    batch = draft.append(cleaning.clean_ratings(raw_ratings), "ratings", by="year")
    touched = sorted({e.part for e in draft.entries if e.table == "ratings" and e.part and e not in before})
    _add_up(draft, count_ratings(batch, "movie_id", "year", "rating"), "rating_counts", touched)
    users = batch.select("year", "user_id").distinct()
    known = draft.read("year_users", touched, users.schema)
    draft.replace(known.unionByName(users).distinct(), "year_users", "year", touched)
    _add_up(draft, count_ratings(batch, "movie_id", "rating"), "movie_counts")
    _add_up(draft, count_ratings(batch, "hour", "rating"), "hour_counts")
    kept = _kept(draft)
    new = set(BY_YEAR + WHOLE if marts is None and not kept else marts or ()) - kept
    if new & _OF_STATS:
        new |= {"movie_stats"} - kept
    if unknown := new - {*BY_YEAR, *WHOLE}:
        raise ValueError(f"no marts that can be kept up: {sorted(unknown)}")
    if touched:
        _derive(draft, limits, kept, touched)
    _derive(draft, limits, new, draft.parts("rating_counts"))
    return draft.commit()


def _kept(draft: Draft) -> set[str]:
    return set(draft.tables()) & {*BY_YEAR, *WHOLE}


def _add_up(draft: Draft, counts: DataFrame, table: str, parts: Sequence[str] | None = None) -> None:
    """Replace stored counts, or given parts of them, by their sum with new ones."""
    keys = [c for c in counts.columns if c != COUNTED]
    known = draft.read(table, parts, counts.schema).select(*counts.columns)
    total = count_ratings(known.unionByName(counts), *keys, weight=COUNTED)
    draft.replace(total, table, "year" if parts is not None else None, parts)


def _derive(draft: Draft, limits: Thresholds, marts: set[str], parts: Sequence[str]) -> None:
    """Derive marts from the counts: those by year for the years of some parts."""
    t = limits
    movies = draft.read("movies")
    counts = draft.read("movie_counts")

    def keep(mart: str, build: Callable[[], DataFrame]) -> None:
        if mart in marts:
            draft.replace(build(), mart)

    if marts & set(BY_YEAR):
        some = parts or None  # without any part, the tables are stored whole, and empty
        years, users = draft.read("rating_counts", some), draft.read("year_users", some)
        if "yearly_trends" in marts:
            trends = timeline.yearly_trends(users, t.first_year, t.last_year, years)
            draft.replace(trends, "yearly_trends", "year", parts)
        if "genre_year_trends" in marts:
            trends = genres.genre_year_trends(years, movies, t.first_year, t.last_year, COUNTED)
            draft.replace(trends, "genre_year_trends", "year", parts)
    keep("rating_distribution", lambda: timeline.rating_distribution(counts, COUNTED))
    keep("hourly_activity", lambda: timeline.hourly_activity(draft.read("hour_counts"), COUNTED))
    keep("genre_stats", lambda: genres.genre_stats(counts, movies, COUNTED))
    keep("movie_stats", lambda: movie_ops.movie_stats(counts, movies, t.min_ratings, COUNTED))
    if marts & _OF_STATS:
        stats = draft.read("movie_stats")
        keep("movie_bayesian", lambda: movie_ops.movie_bayesian(stats, counts, t.min_votes, COUNTED))
        keep("hidden_gems", lambda: movie_ops.hidden_gems(stats, t.gems_min_avg, t.gems_lo, t.gems_hi))
        keep("decade_quality", lambda: movie_ops.decade_quality(stats, t.first_decade, t.last_decade))


def mart(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A mart, or the stored ratings, as of the newest version or a given one."""
    return Version(spark, root, version).read(name)


def ratings_of_years(
    spark: SparkSession, root: str, first: int, last: int, version: int | None = None
) -> DataFrame:
    """Stored ratings of some years, from their folders only."""
    store = Version(spark, root, version)
    parts = [part_name("year", y) for y in range(first, last + 1)]
    return store.read("ratings", [p for p in store.parts("ratings") if p in parts])
