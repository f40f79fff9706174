"""DuckDB SQL equal to the registered queries, on the base tables alone.

Each statement is a chain of views (below, in order of use) and a final SELECT.
``r(x, d)`` stands for rounding half up on the decimal value, as Spark does.
"""

import re

VIEWS = {
    "ratings_raw": """
        SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS movie_id,
          CAST(CASE WHEN (l_orderkey + l_linenumber) % 997 = 0 THEN NULL
                    WHEN (l_orderkey + l_linenumber) % 499 = 1 THEN 5.5
                    ELSE 0.5 * greatest(1, least(10, 1 + l_partkey % 8
                         + CAST(l_quantity AS INT) % 5 + o_custkey % 5 - 2))
               END AS FLOAT) AS rating,
          CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400
            + (l_orderkey * 3607 + l_linenumber * 977) % 86400 AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        CROSS JOIN (VALUES (1), (2)) copies(copy)
        WHERE copy = 1 OR l_orderkey % 500 = 0""",
    "movies_raw": """
        SELECT CAST(p_partkey AS INT) AS movie_id,
          CASE WHEN p_partkey % 400 = 3 THEN NULL
               WHEN p_partkey % 17 = 0 THEN p_name
               WHEN p_partkey % 10 = 1
                 THEN concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ') ')
               ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
          CASE WHEN p_partkey % 50 = 7 THEN '(no genres listed)'
               ELSE concat(replace(p_name, ' ', '|'), '|', p_type) END AS genres
        FROM part""",
    "tags_raw": """
        SELECT CAST(user_id AS INT) AS user_id,
          CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 200 ELSE 1 + event_id // 5 END AS INT)
            AS movie_id,
          CASE WHEN event_id % 211 = 0 THEN NULL
               WHEN event_id % 101 = 0 THEN '   '
               WHEN event_id % 3 = 0 THEN upper(word)
               WHEN event_id % 3 = 1 THEN concat(' ', word, ' ')
               ELSE word END AS tag,
          CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', date_trunc('second', ts)) AS BIGINT)
            AS timestamp
        FROM (SELECT *, CASE WHEN event_id % 10 = 9
                             THEN concat('rare-', CAST(event_id // 70 AS VARCHAR))
                             ELSE concat(event_type, '-', CAST(event_id % 31 AS VARCHAR))
                        END AS word
              FROM events)""",
    "links_raw": """
        SELECT CAST(p_partkey AS INT) AS movie_id,
          lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdb_id,
          CAST(CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_partkey + 100 END AS INT) AS tmdb_id
        FROM part""",
    "ratings": """
        SELECT user_id, movie_id, rating, rated_at,
          CAST(year(rated_at) AS INT) AS year, CAST(month(rated_at) AS INT) AS month,
          CAST(hour(rated_at) AS INT) AS hour
        FROM (SELECT *, TIMESTAMP '1970-01-01' + to_seconds(timestamp) AS rated_at FROM ratings_raw)
        WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating BETWEEN 0.5 AND 5.0""",
    "movies": r"""
        SELECT movie_id, title, genres,
          TRY_CAST(regexp_extract(title, '\((\d{4})\)\s*$', 1) AS INT) AS release_year,
          trim(regexp_replace(title, '\s*\(\d{4}\)\s*$', '')) AS clean_title
        FROM movies_raw WHERE movie_id IS NOT NULL AND title IS NOT NULL""",
    "tags": """
        SELECT user_id, movie_id, tag, lower(trim(tag)) AS tag_lower,
          TIMESTAMP '1970-01-01' + to_seconds(timestamp) AS tagged_at
        FROM tags_raw
        WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND length(trim(tag)) > 0""",
    "movie_genres": """
        SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies""",
    "global_mean": "SELECT avg(rating) AS c FROM ratings",
    "all_movie_stats": """
        SELECT movie_id, total_ratings, r(a, 3) AS avg_rating, r(sd, 3) AS rating_stddev,
          min_rating, max_rating, median_rating, clean_title, genres, release_year
        FROM (SELECT movie_id, count(rating) AS total_ratings, avg(rating) AS a,
                stddev_samp(rating) AS sd, min(rating) AS min_rating, max(rating) AS max_rating,
                quantile_disc(rating, 0.5) AS median_rating
              FROM ratings GROUP BY movie_id)
        JOIN movies USING (movie_id)""",
    "movie_stats": "SELECT * FROM all_movie_stats WHERE total_ratings >= 30",
    "movie_bayesian": """
        SELECT s.*, r((c * 150 + avg_rating * total_ratings) / (150 + total_ratings), 4)
          AS bayesian_avg
        FROM movie_stats s, global_mean""",
    "hidden_gems": """
        SELECT clean_title, avg_rating, median_rating, total_ratings, genres, release_year
        FROM movie_stats WHERE avg_rating >= 4.0 AND total_ratings BETWEEN 30 AND 35""",
    "decade_quality": """
        SELECT CAST(release_year // 10 * 10 AS INT) AS decade, count(*) AS num_movies,
          r(avg(avg_rating), 3) AS avg_rating, r(avg(total_ratings), 0) AS avg_ratings_received
        FROM movie_stats WHERE release_year BETWEEN 1900 AND 2029 GROUP BY 1""",
    "user_activity": """
        SELECT user_id, count(rating) AS total_ratings, r(avg(rating), 3) AS avg_rating_given,
          r(stddev_samp(rating), 6) AS rating_stddev,
          count(DISTINCT movie_id) AS unique_movies_rated,
          min(rated_at) AS first_rating_at, max(rated_at) AS last_rating_at,
          CAST(date_diff('day', CAST(min(rated_at) AS DATE), CAST(max(rated_at) AS DATE)) AS INT)
            AS active_days
        FROM ratings GROUP BY user_id""",
    "user_segments": """
        SELECT CASE WHEN avg_rating_given >= 4.0 THEN 'Generous (≥4.0)'
                    WHEN avg_rating_given >= 3.0 THEN 'Moderate (3–4)'
                    ELSE 'Harsh (<3.0)' END AS segment,
          count(*) AS user_count, r(avg(total_ratings), 1) AS avg_ratings_per_user,
          r(avg(unique_movies_rated), 1) AS avg_unique_movies
        FROM user_activity GROUP BY 1""",
    "genre_stats": """
        SELECT genre, count(rating) AS total_ratings, r(avg(rating), 3) AS avg_rating,
          count(DISTINCT movie_id) AS num_movies, r(stddev_samp(rating), 3) AS rating_stddev
        FROM movie_genres JOIN ratings USING (movie_id)
        WHERE genre <> '(no genres listed)' GROUP BY genre""",
    "genre_year_trends": """
        SELECT genre, year, count(rating) AS rating_count, r(avg(rating), 3) AS avg_rating
        FROM movie_genres JOIN ratings USING (movie_id)
        WHERE genre <> '(no genres listed)' AND year BETWEEN 1995 AND 2023
        GROUP BY genre, year""",
    "rating_distribution": "SELECT rating, count(*) AS count FROM ratings GROUP BY rating",
    "yearly_trends": """
        SELECT year, count(rating) AS total_ratings, r(avg(rating), 3) AS avg_rating,
          count(DISTINCT user_id) AS active_users, count(DISTINCT movie_id) AS movies_rated
        FROM ratings WHERE year BETWEEN 1995 AND 2023 GROUP BY year""",
    "hourly_activity": """
        SELECT hour, count(rating) AS rating_count, r(avg(rating), 3) AS avg_rating
        FROM ratings GROUP BY hour""",
    "top_tags": """
        SELECT tag_lower, count(*) AS tag_count, count(DISTINCT movie_id) AS movies_tagged,
          count(DISTINCT user_id) AS users_who_tagged
        FROM tags GROUP BY tag_lower HAVING count(*) >= 50""",
    "movie_tag_richness": """
        SELECT movie_id, total_tags, unique_tags, clean_title, genres
        FROM (SELECT movie_id, count(tag_lower) AS total_tags,
                count(DISTINCT tag_lower) AS unique_tags
              FROM tags GROUP BY movie_id)
        JOIN movies USING (movie_id)""",
    "rating_counts": """
        SELECT movie_id, year, rating, count(*) AS n FROM ratings GROUP BY ALL""",
    "quality_report": """
        SELECT * FROM quality_of_ratings UNION ALL
        SELECT * FROM quality_of_movies UNION ALL
        SELECT * FROM quality_of_tags""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}_raw"
        for t in ("ratings", "movies", "tags", "links")
    ),
}

AUDITED = {
    "ratings": ("user_id", "movie_id", "rating", "timestamp"),
    "movies": ("movie_id", "title", "genres"),
    "tags": ("user_id", "movie_id", "tag", "timestamp"),
}
for _table, _columns in AUDITED.items():
    VIEWS[f"quality_of_{_table}"] = " UNION ALL ".join(
        f"""
        SELECT '{_table}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
          count(*) - count({c}) AS null_count,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_table}_raw))
            AS duplicate_rows
        FROM {_table}_raw"""
        for c in _columns
    )


def _histogram(column: str, bins: int) -> str:
    return f"""
        SELECT CAST(b AS INT) AS bin, r(lo + (b - 1) * ((hi - lo) / {bins}), 6) AS bin_from,
          r(lo + b * ((hi - lo) / {bins}), 6) AS bin_to, count(*) AS users
        FROM (SELECT lo, hi,
                CASE WHEN hi = lo THEN 1
                     ELSE least({bins}, floor({bins} * (v - lo) / (hi - lo)) + 1) END AS b
              FROM (SELECT CAST({column} AS DOUBLE) AS v FROM user_activity),
                   (SELECT CAST(min({column}) AS DOUBLE) AS lo,
                           CAST(max({column}) AS DOUBLE) AS hi FROM user_activity))
        GROUP BY b, lo, hi"""


_STATS_COLUMNS = """movie_id, total_ratings, avg_rating, rating_stddev, min_rating, max_rating,
          median_rating, clean_title, genres, release_year"""

SELECTS = {
    "scan_csv_roundtrip": "SELECT * FROM movies_raw",
    "scan_csv_ratings": "SELECT * FROM ratings_raw",
    "scan_csv_tags": "SELECT * FROM tags_raw",
    "scan_csv_links": "SELECT * FROM links_raw",
    "scan_csv_multiline": """
        SELECT movie_id, genres,
          CASE WHEN movie_id % 5 = 0
               THEN title || chr(10) || '"second" ' || chr(92) || ' line, with a comma'
               ELSE title END AS title
        FROM movies_raw""",
    "table_row_counts": "SELECT * FROM table_row_counts",
    "quality_report": "SELECT * FROM quality_report",
    "clean_ratings": "SELECT * FROM ratings",
    "clean_movies": "SELECT * FROM movies",
    "clean_tags": "SELECT * FROM tags",
    "movie_genres": "SELECT * FROM movie_genres",
    "global_mean_rating": "SELECT r(c, 6) AS c FROM global_mean",
    "rating_median": """
        SELECT movie_id, quantile_disc(rating, 0.5) AS median_rating
        FROM ratings GROUP BY movie_id""",
    "rating_median_approx": """
        SELECT movie_id, quantile_disc(rating, 0.5) AS median_rating
        FROM ratings GROUP BY movie_id""",
    "movie_stats": f"SELECT {_STATS_COLUMNS} FROM movie_stats",
    "movie_bayesian": "SELECT * FROM movie_bayesian",
    "hidden_gems": "SELECT * FROM hidden_gems",
    "decade_quality": "SELECT * FROM decade_quality",
    "user_activity": "SELECT * FROM user_activity",
    "user_segments": "SELECT * FROM user_segments",
    "genre_stats": "SELECT * FROM genre_stats",
    "genre_year_trends": "SELECT * FROM genre_year_trends",
    "rating_distribution": "SELECT * FROM rating_distribution",
    "yearly_trends": "SELECT * FROM yearly_trends",
    "yearly_trends_approx": """
        SELECT year, total_ratings, avg_rating, true AS users_near, true AS movies_near
        FROM yearly_trends""",
    "hourly_activity": "SELECT * FROM hourly_activity",
    "top_tags": "SELECT * FROM top_tags",
    "top_tags_approx": """
        SELECT tag_lower, tag_count, true AS movies_near, true AS users_near FROM top_tags""",
    "movie_tag_richness": "SELECT * FROM movie_tag_richness",
    "top_movies_by_avg": """
        SELECT clean_title, avg_rating, median_rating, total_ratings, release_year
        FROM movie_stats ORDER BY avg_rating DESC, total_ratings DESC, movie_id LIMIT 10""",
    "top_active_users": """
        SELECT user_id, total_ratings, unique_movies_rated, avg_rating_given, active_days
        FROM user_activity ORDER BY total_ratings DESC, user_id LIMIT 10""",
    "top_tag_rich_movies": """
        SELECT clean_title, unique_tags, total_tags, genres
        FROM movie_tag_richness ORDER BY unique_tags DESC, movie_id LIMIT 15""",
    "parquet_roundtrip": f"SELECT {_STATS_COLUMNS} FROM movie_stats",
    "ratings_year_slice": "SELECT * FROM ratings WHERE year = 1998",
    "tags_for_movie": "SELECT * FROM tags WHERE movie_id = 17",
    "tags_for_movie_other_buckets": "SELECT * FROM tags WHERE movie_id = 17",
    "tags_of_user": "SELECT * FROM tags WHERE user_id = 7",
    "ratings_of_busy_years": """
        SELECT * FROM ratings WHERE year IN
          (SELECT year FROM yearly_trends
           WHERE total_ratings > (SELECT avg(total_ratings) FROM yearly_trends))""",
    "top_stored_users": """
        SELECT user_id, total_ratings, unique_movies_rated, avg_rating_given, active_days
        FROM user_activity ORDER BY total_ratings DESC, user_id LIMIT 10""",
    "csv_rejected_rows": """
        SELECT 'links' AS table_name, concat(CAST(movie_id AS VARCHAR), ',', imdb_id, ',unknown') AS line,
          movie_id, imdb_id, CAST(NULL AS INT) AS tmdb_id
        FROM links_raw WHERE movie_id % 7 = 0""",
    "csv_stored_links": """
        SELECT movie_id, imdb_id, CASE WHEN movie_id % 7 <> 0 THEN tmdb_id END AS tmdb_id
        FROM links_raw""",
    "genre_audience": """
        SELECT genre, count(DISTINCT user_id) AS users, true AS near
        FROM movie_genres JOIN ratings USING (movie_id)
        WHERE genre <> '(no genres listed)' AND year BETWEEN 1993 AND 1996 GROUP BY genre""",
    "movie_medians_rolled_up": """
        SELECT movie_id, count(*) AS n, true AS near
        FROM ratings WHERE year BETWEEN 1993 AND 1996 GROUP BY movie_id""",
    "pipeline_mart_rows": " UNION ALL ".join(
        f"SELECT '{mart}' AS table_name, count(*) AS row_count FROM {mart}"
        for mart in (
            "quality_report", "table_row_counts", "ratings", "movies", "tags",
            "rating_counts", "rating_distribution", "yearly_trends", "hourly_activity",
            "user_activity", "user_segments", "genre_stats", "genre_year_trends",
            "movie_stats", "movie_bayesian", "hidden_gems", "decade_quality", "top_tags",
            "movie_tag_richness",
        )
    ),
    "feed_overview_kpis": """
        SELECT (SELECT CAST(sum(total_ratings) AS BIGINT) FROM user_activity) AS total_ratings,
          (SELECT count(*) FROM movie_stats) AS movies_analysed,
          (SELECT count(*) FROM user_activity) AS unique_users,
          (SELECT r(avg(avg_rating), 6) FROM movie_stats) AS mean_of_movie_means,
          (SELECT r(c, 6) FROM global_mean) AS global_mean""",
    "feed_genre_volume_by_year": """
        SELECT year, CAST(sum(rating_count) AS BIGINT) AS rating_count
        FROM genre_year_trends GROUP BY year""",
    "feed_genre_popularity": "SELECT * FROM genre_stats",
    "feed_top_genre_trends": """
        SELECT * FROM genre_year_trends WHERE genre IN
          (SELECT genre FROM genre_stats ORDER BY total_ratings DESC, genre LIMIT 6)""",
    "feed_top_n_bayesian": """
        SELECT clean_title, bayesian_avg, avg_rating, median_rating, total_ratings, genres,
          release_year
        FROM movie_bayesian ORDER BY bayesian_avg DESC, movie_id LIMIT 20""",
    "feed_gems_explorer": """
        SELECT clean_title, avg_rating, median_rating, total_ratings, genres, release_year
        FROM all_movie_stats WHERE avg_rating >= 3.5 AND total_ratings BETWEEN 25 AND 40
        ORDER BY avg_rating DESC, clean_title, total_ratings DESC,
          release_year NULLS FIRST, genres NULLS FIRST, median_rating LIMIT 50""",
    "feed_chosen_genre_trends": """
        SELECT * FROM genre_year_trends WHERE genre IN
          (SELECT genre FROM genre_stats ORDER BY total_ratings DESC, genre LIMIT 5)""",
    "feed_gems_all": """
        SELECT clean_title, avg_rating, median_rating, total_ratings, genres, release_year
        FROM all_movie_stats WHERE avg_rating >= 3.5 AND total_ratings BETWEEN 25 AND 40""",
    "feed_gems_count": """
        SELECT count(*) AS gems
        FROM all_movie_stats WHERE avg_rating >= 3.5 AND total_ratings BETWEEN 25 AND 40""",
    "feed_tag_coverage": "SELECT * FROM top_tags ORDER BY tag_count DESC, tag_lower LIMIT 25",
    "feed_hist_ratings_per_user": _histogram("total_ratings", 60),
    "feed_hist_avg_given": _histogram("avg_rating_given", 40),
    "feed_user_segments_right_closed": """
        SELECT segment, count(*) AS count
        FROM (SELECT CASE WHEN avg_rating_given > 0 AND avg_rating_given <= 3 THEN 'Harsh (<3)'
                          WHEN avg_rating_given > 3 AND avg_rating_given <= 4 THEN 'Moderate (3–4)'
                          WHEN avg_rating_given > 4 AND avg_rating_given <= 5.1 THEN 'Generous (≥4)'
                     END AS segment
              FROM user_activity)
        WHERE segment IS NOT NULL GROUP BY segment""",
}

SELECTS |= {
    f"pipeline_{mart}": SELECTS[mart]
    for mart in (
        "movie_stats", "movie_bayesian", "hidden_gems", "genre_stats", "genre_year_trends",
        "rating_distribution", "yearly_trends", "user_activity", "top_tags",
    )
}

SELECTS |= {
    "marts_after_batches": SELECTS["movie_stats"],
    "genre_trends_after_batches": SELECTS["genre_year_trends"],
    "yearly_trends_after_batches": SELECTS["yearly_trends"],
}


def _views_used(sql: str) -> list[str]:
    """Views named in ``sql``, directly or through other views, those first that others use."""
    used: list[str] = []
    for name in re.findall(r"\w+", re.sub(r"'[^']*'", "", sql)):
        if name in VIEWS and name not in used:
            used.extend(v for v in _views_used(VIEWS[name]) if v not in used)
            used.append(name)
    return used


def _expand_rounding(sql: str) -> str:
    """Replace ``r(x, d)`` by its DuckDB form; x may itself hold parentheses."""
    while match := re.search(r"\br\(", sql):
        depth, end = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[match.end() : end - 1].rsplit(",", 1)
        rounded = f"CAST(round(CAST({value} AS DECIMAL(18,12)), {digits.strip()}) AS DOUBLE)"
        sql = sql[: match.start()] + rounded + sql[end:]
    return sql


def statement(name: str) -> str:
    select = SELECTS[name]
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _views_used(select))
    return _expand_rounding(f"WITH {views}\n{select}")
