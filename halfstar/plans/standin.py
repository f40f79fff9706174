"""Ratings, movies, tags and links derived from the TPC-H-like test tables.

Nulls, duplicates, out-of-range values, blank tags and missing years are planted.
``oracle.py`` states the same views in SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


# The columns used; declared, so that no footer is read to infer them.
BASE_TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item; all ratings of every 500th order occur twice.

    The orders are doubled, not the join, so the line items are read once.
    """
    orders = _table(spark, sf_dir, "orders")
    doubled = orders.unionAll(orders.where("o_orderkey % 500 = 0"))
    lines = _table(spark, sf_dir, "lineitem")
    return lines.join(doubled, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "CAST(o_custkey AS INT) AS user_id",
        "CAST(l_partkey AS INT) AS movie_id",
        """CAST(CASE WHEN (l_orderkey + l_linenumber) % 997 = 0 THEN NULL
                     WHEN (l_orderkey + l_linenumber) % 499 = 1 THEN 5.5D
                     ELSE greatest(1, least(10, 1 + l_partkey % 8
                          + CAST(l_quantity AS INT) % 5 + o_custkey % 5 - 2)) / 2
                END AS FLOAT) AS rating""",
        """CAST(datediff(l_shipdate, DATE'1970-01-01') AS BIGINT) * 86400
           + (l_orderkey * 3607 + l_linenumber * 977) % 86400 AS timestamp""",
    )


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS INT) AS movie_id",
        """CASE WHEN p_partkey % 400 = 3 THEN NULL
                WHEN p_partkey % 17 = 0 THEN p_name
                WHEN p_partkey % 10 = 1 THEN concat(p_name, ' (', 1950 + p_size, ') ')
                ELSE concat(p_name, ' (', 1950 + p_size, ')') END AS title""",
        """CASE WHEN p_partkey % 50 = 7 THEN '(no genres listed)'
                ELSE concat(replace(p_name, ' ', '|'), '|', p_type) END AS genres""",
    )


def tags_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = """CASE WHEN event_id % 10 = 9 THEN concat('rare-', event_id div 70)
                   ELSE concat(event_type, '-', event_id % 31) END"""
    return _table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS INT) AS user_id",
        """CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 200 ELSE 1 + event_id div 5 END
                AS INT) AS movie_id""",
        f"""CASE WHEN event_id % 211 = 0 THEN NULL
                 WHEN event_id % 101 = 0 THEN '   '
                 WHEN event_id % 3 = 0 THEN upper({word})
                 WHEN event_id % 3 = 1 THEN concat(' ', {word}, ' ')
                 ELSE {word} END AS tag""",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS timestamp",
    )


def links_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS INT) AS movie_id",
        "lpad(CAST(p_partkey AS STRING), 7, '0') AS imdb_id",
        "CAST(CASE WHEN p_partkey % 29 <> 0 THEN p_partkey + 100 END AS INT) AS tmdb_id",
    )


RAW = {
    "ratings": ratings_raw,
    "movies": movies_raw,
    "tags": tags_raw,
    "links": links_raw,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW.items()}
