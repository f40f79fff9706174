"""Typed CSV scan, and the writer of files for it.

What is written reads back unchanged but for two things: an empty string comes back as
NULL, which is what an empty field means here, and values with line breaks need
``multi_line`` when they are read.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import CSV_HEADERS, SOURCES


def read_csv(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False
) -> DataFrame:
    """Scan comma-separated UTF-8 files with a header line and a declared schema.

    An empty field is NULL and a value that does not fit its type becomes NULL.
    Quotes inside a quoted field are doubled. Set ``multi_line`` only for files
    with line breaks inside fields: such files cannot be split between tasks.
    """
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        encoding="UTF-8",
        nullValue="",
        escape='"',
        multiLine=multi_line,
    )


def read_source(
    spark: SparkSession, directory: str, table: str, multi_line: bool = False
) -> DataFrame:
    """Scan ``<directory>/<table>.csv``, one of ratings, movies, tags or links."""
    return read_csv(spark, f"{directory}/{table}.csv", SOURCES[table], multi_line)


def unparsable_rows(
    spark: SparkSession, directory: str, table: str, multi_line: bool = False
) -> DataFrame:
    """Rows of a source file that do not fit its schema, as ``(table_name, row_count, unparsable)``.

    Such a row loses its misfit values to NULL, which the quality report cannot tell from
    values that were missing. Costs a scan of its own, so no other operator calls it.
    """
    schema = f"{SOURCES[table]}, _unparsable STRING"
    rows = spark.read.csv(
        f"{directory}/{table}.csv",
        schema=schema,
        header=True,
        encoding="UTF-8",
        nullValue="",
        escape='"',
        multiLine=multi_line,
        columnNameOfCorruptRecord="_unparsable",
    )
    # the condition asks for all columns, as only columns that are asked for are parsed
    every = F.length(F.concat_ws("", *(F.col(c).cast("string") for c in rows.columns[:-1]))) >= 0
    return rows.agg(
        F.count(F.when(every, 1)).alias("row_count"),
        F.count(F.when(every, F.col("_unparsable"))).alias("unparsable"),
    ).select(F.lit(table).alias("table_name"), "row_count", "unparsable")


def store_source(
    spark: SparkSession, directory: str, table: str, root: str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Parse a source file once into ``<root>/<table>``; returns its typed rows, and the rejected lines.

    A line that does not fit the schema is kept twice over: as a typed row, in which what did not fit is NULL, as
    `read_source` has it, and as it stands in the file, ``(table_name, file, line)`` and its typed columns. The
    rejected ones lie in a folder of their own, so reading them costs nothing of the others.
    """
    columns = [c.split()[0] for c in SOURCES[table].split(", ")]
    rows = spark.read.csv(
        f"{directory}/{table}.csv",
        schema=f"{SOURCES[table]}, line STRING",
        header=True,
        encoding="UTF-8",
        nullValue="",
        escape='"',
        multiLine=multi_line,
        columnNameOfCorruptRecord="line",
    )
    rejected = F.col("line").isNotNull()
    file = F.when(rejected, F.col("_metadata.file_path")).alias("file")
    rows.select(*columns, "line", file, rejected.alias("rejected")).write.mode("overwrite").parquet(
        f"{root}/{table}", partitionBy=["rejected"], compression="snappy"
    )
    schema = f"{SOURCES[table]}, line STRING, file STRING, rejected BOOLEAN"
    stored = spark.read.schema(schema).parquet(f"{root}/{table}")
    lines = stored.where("rejected").select(F.lit(table).alias("table_name"), "file", "line", *columns)
    return stored.select(*columns), lines


def write_source(df: DataFrame, directory: str, table: str) -> None:
    """Write a source table as CSV under its original header names, whitespace kept."""
    df.toDF(*CSV_HEADERS[table]).write.mode("overwrite").csv(
        f"{directory}/{table}.csv",
        header=True,
        nullValue="",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
