"""Queries read every row of their tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from workload import history_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


def ids(frame, column):
    return {str(r[0]) for r in frame.select(column).distinct().collect()}


@pytest.mark.parametrize(
    ("name", "source", "key", "column"),
    [
        ("artifact_selfcheck", "orders", "o_orderkey", "run_id"), ("add_columns", "orders", "o_orderkey", "run_id"),
        ("upsert_outcome", "orders", "o_orderkey", "run_id"), ("question_digest", "conversations", "conv_id", "sample_id"),
    ],
)
def test_no_row_is_left_out(spark, name, source, key, column):
    frame = entry.queries()[name](spark, DATA)
    assert ids(frame, column) == ids(spark.read.parquet(f"{DATA}/{source}.parquet"), key)
    assert frame.groupBy(column).count().where("count > 1").isEmpty()


def test_every_order_is_in_history_or_batch(spark):
    orders = ids(spark.read.parquet(f"{DATA}/orders.parquet"), "o_orderkey")
    stored = ids(history_queries.stored_runs(spark, DATA), "run_id")
    batch = ids(history_queries.artifacts(spark, DATA), "run_id")
    assert stored | batch == orders and stored - batch and batch - stored
    assert {int(i) % 6 for i in stored & batch} == set(range(6))
    decided = entry.queries()["import_decision"](spark, DATA)
    assert sorted(r.run_id for r in decided.collect()) == sorted(batch)
    # of the orders that are in both, more than a third of all
    assert len(stored & batch) > len(orders) / 3
    queries = entry.queries()
    assert queries["identity_conflicts"](spark, DATA).count() > 50 and queries["downgrade_guard"](spark, DATA).count() > 200
