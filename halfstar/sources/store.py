"""Parquet store: one folder per mart below a root path."""

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

TAG_BUCKETS = 64


def write_mart(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace mart ``name`` by ``df`` as Snappy Parquet, in hive folders if asked."""
    df.write.mode("overwrite").options(**(options or {})).parquet(
        f"{root}/{name}", partitionBy=list(partition_by) or None, compression="snappy"
    )


def write_counted(df: DataFrame, root: str, name: str) -> int:
    """`write_mart`, and the number of rows written, counted as they pass."""
    counted = Observation()
    write_mart(df.observe(counted, F.count(F.lit(1)).alias("rows")), root, name)
    return counted.get["rows"]


def read_mart(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A stored mart; with its ``schema`` given, no file is opened to infer it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/{name}")


def gather(df: DataFrame, column: str, spread: int | None = None) -> DataFrame:
    """Bring rows of one ``column`` value together, so that each folder gets few files.

    A value that outgrows the advisory partition size is split over several
    tasks: by the adaptive rebalance or, without adaptive execution, by a salt of
    ``spread`` values, as many as there are shuffle partitions unless given.
    """
    conf = df.sparkSession.conf
    if spread is None and conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", F.col(column))
    spread = spread or int(conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    return df.repartition(F.col(column), salt)


def write_ratings(df: DataFrame, root: str, spread: int | None = None) -> None:
    """Store cleaned ratings in one folder per year; the scan of a year reads only it."""
    write_mart(gather(df, "year", spread), root, "ratings", ["year"])


def ratings_of_years(
    spark: SparkSession, root: str, first: int, last: int
) -> DataFrame:
    """Stored ratings of the years ``first`` to ``last``, pruned to their folders."""
    return read_mart(spark, root, "ratings").where(F.col("year").between(first, last))


def ratings_of_named_years(spark: SparkSession, root: str, years: DataFrame) -> DataFrame:
    """Stored ratings of the years that a small frame names in its column ``year``.

    The years are not known when the query is planned: where ``years`` is filtered, Spark asks it for
    them as the query runs and lists only their folders (dynamic partition pruning).
    """
    return read_mart(spark, root, "ratings").join(years.select("year"), "year", "left_semi")


#: Row groups of the tags have a Bloom filter of their users, as large as their number asks for.
_USER_FILTER = {
    "parquet.bloom.filter.enabled#user_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def tag_bucket(movie_id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(movie_id), buckets).cast("int")


def write_tags(df: DataFrame, root: str, buckets: int = TAG_BUCKETS) -> None:
    """Store cleaned tags in a fixed number of hash buckets of ``movie_id``.

    Rows are sorted by movie within a file, so a lookup reads one folder and
    skips the row groups of other movies; one folder per movie would not scale. A lookup by
    user, who has no place in this order, skips row groups by their Bloom filters.
    The number of buckets is a folder of its own above them, so a reader learns it
    from the layout.
    """
    bucketed = df.withColumn("tag_buckets", F.lit(buckets)).withColumn(
        "tag_bucket", tag_bucket(F.col("movie_id"), F.col("tag_buckets"))
    )
    sorted_files = gather(bucketed, "tag_bucket").sortWithinPartitions(
        "tag_bucket", "movie_id"
    )
    write_mart(sorted_files, root, "tags", ["tag_buckets", "tag_bucket"], _USER_FILTER)


def read_tags(spark: SparkSession, root: str) -> DataFrame:
    return read_mart(spark, root, "tags").drop("tag_buckets", "tag_bucket")


def tags_for_movie(spark: SparkSession, root: str, movie_id: int) -> DataFrame:
    """Stored tags of one movie, from the folder of its bucket, whatever their number."""
    wanted = F.lit(movie_id).cast("int")
    return (
        read_mart(spark, root, "tags")
        .where(F.col("tag_bucket") == tag_bucket(wanted, F.col("tag_buckets")))
        .where(F.col("movie_id") == wanted)
        .drop("tag_buckets", "tag_bucket")
    )


def tags_of_user(spark: SparkSession, root: str, user_id: int) -> DataFrame:
    """Stored tags by one user: row groups that certainly have none are not read."""
    return read_tags(spark, root).where(F.col("user_id") == F.lit(user_id).cast("int"))


def write_in_order(df: DataFrame, root: str, name: str, keys: Sequence[Column]) -> None:
    """Replace mart ``name`` by ``df``, stored in the order of ``keys`` in numbered parts.

    The parts follow the order, so whoever wants the first rows reads the first part; a small table beside the
    mart tells how many rows each part holds. Rows with equal keys may lie in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    write_mart(dealt, root, name, ["part"])
    # part -1 holds nothing: it says what the rows look like, also where there are none
    none = spark.createDataFrame([(-1, 0, dealt.schema.json())], "part INT, rows BIGINT, schema STRING")
    counts = read_mart(spark, root, name, dealt.schema).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    write_mart(counts.withColumn("schema", F.lit(None).cast("string")).unionByName(none), root, f"{name}_parts")


def first_rows(
    spark: SparkSession, root: str, name: str, keys: Sequence[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of a mart that `write_in_order` has stored with these ``keys``."""
    rows, last, schema = 0, -1, None
    for part in read_mart(spark, root, f"{name}_parts").orderBy("part").toLocalIterator():
        rows, last, schema = rows + part["rows"], part["part"], schema or part["schema"]
        if rows >= k:
            break
    stored = read_mart(spark, root, name, StructType.fromJson(json.loads(schema)))
    return stored.where(F.col("part") <= last).drop("part").orderBy(*keys).limit(k)
