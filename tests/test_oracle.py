"""Every catalog query with SQL equals its DuckDB oracle (driver contract)."""

import pytest
from tables import MEDIUM, SMALL
from oracle_check import compare

from __spark_entry__ import entry
from clickmart.plans.catalog import all_queries as queries
from clickmart.plans.oracle import oracle_sql

SQL = oracle_sql()
QUERIES = queries()
# model-free queries that are cheap enough to also run at sf0.01
MEDIUM_KEYS = [
    "top_items_all", "top_merchants_all", "top_merchants_complete", "age_share", "sql_gender_share",
    "age_counts_raw", "pair_features", "scoring_features", "tagged_source", "join_tagged",
]


def test_every_oracle_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


def test_rows_only_keys_are_model_queries():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only == {
        "train_lr", "train_svm", "train_dt", "train_rf", "train_gbt",
        "train_svm_norm", "evaluate_all", "train_save_all", "submission",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle_small(spark, duck_small, name):
    problems, _, _ = compare(spark, duck_small, name, QUERIES[name], SQL[name], SMALL)
    assert not problems, problems


@pytest.mark.parametrize("name", MEDIUM_KEYS)
def test_query_matches_oracle_medium(spark, duck_medium, name):
    problems, n, _ = compare(spark, duck_medium, name, QUERIES[name], SQL[name], MEDIUM)
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "seller_id", "n"]
    assert len(rows) > 0
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
