"""Report order of each mart, and the top rows in that order.

Marts are stored unsorted. Every order ends in keys that break ties, so a limit
after it is reproducible.
"""

from pyspark.sql import Column, DataFrame, functions as F

# A leading minus sorts descending.
REPORT_ORDER = {
    "movie_stats": ["-avg_rating", "-total_ratings", "movie_id"],
    "movie_bayesian": ["-bayesian_avg", "movie_id"],
    "hidden_gems": [
        "-avg_rating",
        "clean_title",
        "-total_ratings",
        "release_year",
        "genres",
        "median_rating",
    ],
    "decade_quality": ["decade"],
    "user_activity": ["-total_ratings", "user_id"],
    "user_segments": ["-user_count", "segment"],
    "genre_stats": ["-total_ratings", "genre"],
    "genre_year_trends": ["genre", "year"],
    "rating_distribution": ["rating"],
    "yearly_trends": ["year"],
    "hourly_activity": ["hour"],
    "top_tags": ["-tag_count", "tag_lower"],
    "movie_tag_richness": ["-unique_tags", "movie_id"],
}


def report_keys(mart: str) -> list[Column]:
    return [
        F.desc(key[1:]) if key.startswith("-") else F.asc(key)
        for key in REPORT_ORDER[mart]
    ]


def in_report_order(df: DataFrame, mart: str) -> DataFrame:
    return df.orderBy(*report_keys(mart))


def top_rows(df: DataFrame, mart: str, k: int) -> DataFrame:
    """The first ``k`` rows in report order; every task keeps only its own first k."""
    return in_report_order(df, mart).limit(k)
