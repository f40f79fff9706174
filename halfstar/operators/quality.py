"""Reports on the raw tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def quality_report(df: DataFrame, table_name: str) -> DataFrame:
    """Rows, duplicate rows and NULLs of a table, one output row per column.

    A single pass counts each distinct row. Rows, NULLs and surplus copies all
    follow from these counts, and copies collapse before the shuffle.
    """
    distinct_rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    copies = F.col("__copies")
    nulls = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.sum(F.when(F.col(c).isNull(), copies).otherwise(0)).alias("null_count"),
        )
        for c in df.columns
    ]
    totals = distinct_rows.agg(
        F.sum(copies).alias("row_count"),
        (F.sum(copies) - F.count(copies)).alias("duplicate_rows"),
        F.array(*nulls).alias("nulls"),
    )
    return totals.select(
        F.lit(table_name).alias("table_name"),
        "row_count",
        "duplicate_rows",
        F.inline("nulls"),
    ).select(
        "table_name",
        "column_name",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
    )


def quality_reports(tables: dict[str, DataFrame]) -> DataFrame:
    reports = [quality_report(df, name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
