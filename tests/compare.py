"""Row-for-row comparison of a Spark result with a DuckDB one."""

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_on(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def sorted_rows(table: pa.Table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns), key=repr)


def assert_same(spark_df, connection, sql):
    expected = connection.sql(sql).to_arrow_table()
    actual = spark_df.toArrow()
    names, rows = sorted_rows(actual)
    expected_names, expected_rows = sorted_rows(expected)
    assert names == expected_names
    for n in names:
        assert str(actual.schema.field(n).type).removeprefix("large_") == str(
            expected.schema.field(n).type
        ).removeprefix("large_"), n
    assert len(rows) == len(expected_rows)
    different = [(a, b) for a, b in zip(rows, expected_rows) if repr(a) != repr(b)]
    assert not different, (names, different[:3])
