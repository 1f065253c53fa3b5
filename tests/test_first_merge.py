"""A first merge."""

from pathlib import Path

from pyspark.sql import functions as F

from proofmill.session import shared_dir
from proofmill.sources import tables


def test_new_tables_are_written_once(spark, tmp_path):
    """A first merge keeps no second copy of its rows; a later one works as before."""
    held = lambda: set(Path(shared_dir(spark).removeprefix("file:"), "proofmill").glob("changes-grown-*"))
    rows = lambda n: spark.range(n).select(F.col("id").cast("string").alias("run_id"), F.lit(n).alias("x"))
    how = {"grown": lambda old, new: old.join(new, "run_id", "left_anti").unionByName(new)}
    before = held()
    first = tables.merge(spark, str(tmp_path), {"grown": rows(50)}, "run_id", how, buckets=4)
    assert held() == before
    tables.merge(spark, str(tmp_path), {"grown": rows(3)}, "run_id", how, buckets=4, after=first)
    assert len(held()) == len(before) + 1
    got = {r.run_id: r.x for r in tables.read_table(spark, str(tmp_path), "grown").collect()}
    assert got == {str(i): 3 if i < 3 else 50 for i in range(50)}
