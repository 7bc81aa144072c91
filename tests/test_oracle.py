"""Registered queries against their DuckDB SQL; ``ORACLE=all`` compares every one."""

import datetime
import os

import duckdb
import pytest

from rankweave.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ("item_metrics", "dataset_overview", "stratified_sample", "model_input", "popularity_counts", "comparison_delta", "weighted_auc",
        "suppression_by_target", "config_offset", "label_table", "partition_quality", "write_versioned_roundtrip", "publish_ranked")
NAMES = sorted(registry.ORACLE_SQL) if os.environ.get("ORACLE") == "all" else SOME


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def plain(value):
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = db.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_every_query_is_a_function_with_a_unique_name():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert len(registry.QUERIES) > 100
