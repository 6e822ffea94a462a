"""Queries against their SQL."""

import duckdb
import pytest

from freightlane.llm.queries import ORACLES, QUERIES


def normal(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in values]
    return [columns[i] for i in order], sorted(plain, key=repr)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    expected = normal([d[0] for d in cursor.description], cursor.fetchall())
    df = QUERIES[name](spark, folder)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected
