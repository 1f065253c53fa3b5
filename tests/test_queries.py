"""Every registered query against its SQL on the smallest data, and its plan."""

import contextlib
import io
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from workload.registry import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    return round(float(value), 9) if isinstance(value, float | Decimal) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    frame = QUERIES[name](spark, str(DATA))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    python = () if name == "redact_by_key" else ("PythonUDF", "ArrowEvalPython", "MapInPandas")  # nesting without limit
    for forbidden in (*python, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text.getvalue(), (name, forbidden)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    assert got, name
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in places) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["manifest_rollup", "metric_flatten", "assess_run", "redact_text", "import_decision"])
def test_heavy_queries_with_generated_code(spark, name):
    plain = sorted(map(repr, QUERIES[name](spark, str(DATA)).collect()))
    with generated_code(spark):
        assert sorted(map(repr, QUERIES[name](spark, str(DATA)).collect())) == plain


@contextlib.contextmanager
def generated_code(spark):
    """Spark's defaults; the other tests run interpreted, which starts faster."""
    settings = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        spark.conf.set("spark.sql.codegen.wholeStage", "true")
        spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
