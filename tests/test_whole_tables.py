"""Queries over all customers, against their DuckDB SQL without its filter on customers."""

import pytest

from rankweave.plans import registry
from tests.test_oracle import FOLDER, db, plain  # noqa: F401


@pytest.mark.parametrize(
    ("name", "only"),
    [
        ("suppression_rows", " WHERE cust_id % 10 = 3"),
        ("linear_attributions", " WHERE cust_id % 10 = 1"),
        ("populated_buckets", " WHERE cust_id < 40"),
    ],
)
def test_query_has_the_rows_of_all_customers(spark, db, name, only):  # noqa: F811
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = db.sql(registry.ORACLE_SQL[name].replace(only, ""))
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
