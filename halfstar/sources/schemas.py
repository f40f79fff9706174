"""Schemas of the four source tables.

File sources ignore NOT NULL, so nullability is enforced by the cleaning
operators and not declared here. The names replace those in the file header.
"""

RATINGS = "user_id INT, movie_id INT, rating FLOAT, timestamp BIGINT"
MOVIES = "movie_id INT, title STRING, genres STRING"
TAGS = "user_id INT, movie_id INT, tag STRING, timestamp BIGINT"
LINKS = "movie_id INT, imdb_id STRING, tmdb_id INT"

SOURCES = {"ratings": RATINGS, "movies": MOVIES, "tags": TAGS, "links": LINKS}

# The column names in the header lines of the source files.
CSV_HEADERS = {
    "ratings": ["userId", "movieId", "rating", "timestamp"],
    "movies": ["movieId", "title", "genres"],
    "tags": ["userId", "movieId", "tag", "timestamp"],
    "links": ["movieId", "imdbId", "tmdbId"],
}
