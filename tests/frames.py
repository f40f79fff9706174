"""Small input frames for tests."""

import random

import pyarrow as pa

from halfstar.sources import schemas

EPOCH_2000 = 946684800


TYPES = {"INT": pa.int32(), "BIGINT": pa.int64(), "FLOAT": pa.float32(), "STRING": pa.string()}


def frame(spark, rows, schema):
    """A frame from Python rows that tasks read without Python workers."""
    columns = [column.split() for column in schema.split(", ")]
    values = list(zip(*rows)) or [[]] * len(columns)
    table = pa.table(
        {name: pa.array(list(v), TYPES[kind]) for (name, kind), v in zip(columns, values)}
    )
    return spark.createDataFrame(table)


def ratings(spark, rows):
    return frame(spark, rows, schemas.RATINGS)


def movies(spark, rows):
    return frame(spark, rows, schemas.MOVIES)


def tags(spark, rows):
    return frame(spark, rows, schemas.TAGS)


def some_movies(spark, ids):
    return movies(spark, [(i, f"Film {i} ({1900 + i % 130})", "Drama") for i in ids])


def ratings_of(spark, values_by_movie):
    """One user per rating; ``values_by_movie`` maps a movie to its rating values."""
    rows, user = [], 0
    for movie, values in values_by_movie.items():
        for value in values:
            user += 1
            rows.append((user, movie, float(value), EPOCH_2000 + user * 3600))
    return ratings(spark, rows)


def skewed_ratings(spark, size=4000, half_stars=True, seed=7):
    """A third of the rows is one movie, a third one user; some rows repeat exactly."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        movie = 1 if i % 3 == 0 else rng.randint(2, 60)
        user = 1 if i % 3 == 1 else rng.randint(2, 200)
        value = rng.randint(1, 10) / 2 if half_stars else rng.uniform(0.5, 5.0)
        rows.append((user, movie, value, EPOCH_2000 + rng.randint(0, 8 * 365 * 86400)))
    return ratings(spark, rows + rows[:50])


def genre_movies(spark):
    genres = ["Drama", "Comedy|Drama", "Drama|Drama", "(no genres listed)", None, "", "War|Comedy|War"]
    return movies(
        spark, [(i, f"Film {i} ({1950 + i})", genres[i % len(genres)]) for i in range(1, 61)]
    )
