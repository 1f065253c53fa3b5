"""What a task holds must not grow with the input."""

from pyspark.sql import functions as F

from proofmill.sources import attempts
from workload import campaign_queries, registry, report_queries


def test_tasks_of_ownership_grow_with_the_rows(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr("id % 700 as l_orderkey", "cast(id % 7 + 1 as int) as l_linenumber", "id as l_partkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(700).selectExpr(
        "id as o_orderkey", "id % 90 as o_custkey", "'F' as o_orderstatus", "'1-URGENT' as o_orderpriority", "timestamp'2026-01-01' as o_orderdate"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    whole = sorted(map(repr, report_queries.report_ownership(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(registry, "TASK_ROWS", 100)
    told = report_queries.report_ownership(spark, str(tmp_path))
    assert sorted(map(repr, told.collect())) == whole and len(whole) == 700
    assert registry.dealt(spark.range(3000), "id").rdd.getNumPartitions() == 30
    assert "hashpartitioning(run_id" in told._jdf.queryExecution().toString() and ", 30), REPARTITION_BY_NUM" in told._jdf.queryExecution().toString()


def texts(spark, root):
    """Whole files of an archive by path, and their numbers of blocks."""
    files, blocks = {}, {}
    for r in sorted(spark.read.parquet(root).collect(), key=lambda r: (r.path, r.block_start)):
        files[r.path], blocks[r.path] = files.get(r.path, "") + r.value, blocks.get(r.path, 0) + 1
    return files, blocks


def test_blocks_of_lines_grow_with_the_lines_not_with_the_keys(spark, tmp_path, monkeypatch):
    """Orders far apart lie in one block of their file; a supplier with many has blocks of a bounded number of orders, and the same files."""
    rows = spark.range(160).selectExpr("id % 4 as l_suppkey", "id * 30011 as l_orderkey")
    twice = rows.union(rows).union(spark.createDataFrame([(1, None), (None, 5), (None, None)], "l_suppkey long, l_orderkey long"))
    crowd = spark.range(60).selectExpr("9L as l_suppkey", "id as l_orderkey")
    twice.union(crowd).write.parquet(str(tmp_path / "lineitem.parquet"))
    campaign_queries.write_lines(spark, str(tmp_path), str(tmp_path / "one"))
    whole, blocks = texts(spark, str(tmp_path / "one"))
    assert set(blocks.values()) == {1}
    assert whole["a1/predictions/other/set1_s1.jsonl"] == "{foreign\n" * 40
    assert whole["a1/predictions/model-1/set1.jsonl"] == whole["a1/reviews/model-1/set1.jsonl"] == "\n"  # the order without a key
    assert whole["a9/predictions/model-4/set0_s0.jsonl"].startswith('\n{broken\n{"index":2,') and whole["a9/predictions/model-4/set0_s0.jsonl"].count("\n") == 36
    monkeypatch.setattr(campaign_queries, "SPAN", 30)
    campaign_queries.write_lines(spark, str(tmp_path), str(tmp_path / "many"))
    again, blocks = texts(spark, str(tmp_path / "many"))
    assert again == whole and blocks["a9/predictions/model-4/set0_s0.jsonl"] == 2
    assert max(text.count("{foreign") for text, in spark.read.parquet(str(tmp_path / "many")).select("value").collect()) <= 30


def test_a_campaign_is_written_from_one_reading_of_its_orders(spark, tmp_path, monkeypatch):
    spark.range(300).selectExpr("id % 20 as l_suppkey", "id as l_orderkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    readings, read = [], campaign_queries._orders
    monkeypatch.setattr(campaign_queries, "_orders", lambda *given: readings.append(given) or read(*given))
    told = campaign_queries.import_campaign(spark, str(tmp_path))
    assert told.agg(F.countDistinct("run_id").alias("n")).first().n == 20 and len(readings) == 1


def test_reports_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    files = spark.range(200).selectExpr("concat('a', id, '/reports/m/r.json') as path", "0L as block_start", """'{"dataset_name":"set","metrics":[]}' as value""")
    attempts.write_archive(files.coalesce(1), str(tmp_path / "archive"))
    told = attempts.scan_attempt_reports(spark, str(tmp_path / "archive"), archive=True)
    assert told.rdd.getNumPartitions() == 4 and told.where("is_report").count() == 200
