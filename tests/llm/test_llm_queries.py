"""The registered queries against their SQL, and the pipeline against stage by stage expectations."""


import struct
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from proofmill.llm import decontaminate, pretokens, queries, secrets
from proofmill.llm.common import folded_words
from proofmill.session import shared_dir

TABLES = ["documents", "benchmark", "embeddings", "pages", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, data, name):
    frame = queries.QUERIES[name](spark, data)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    cursor = connection.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in places) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_other_queries_return_a_row_for_each(spark, data, name):
    table = {"op8_html_extraction": "pages"}.get(name, "documents")
    n = spark.read.parquet(f"{data}/{table}.parquet").count()
    rows = queries.QUERIES[name](spark, data).count()
    assert rows >= n if name.startswith("op10") else rows == n


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert "pipeline" in entry.queries()


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    frames, seen = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, data).cache()
        frames.append(seen)
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = [f.collect() for f in frames]
    calm = {r["doc_id"] for r in rows[1]}
    assert calm <= {r["doc_id"] for r in rows[0]} and len(calm) > 0.8 * len(rows[0])
    # near copies: exactly the representatives of the brute force
    from test_superminhash import brute

    firsts = {doc for doc, _, c in brute([(r["doc_id"], r["text"]) for r in rows[1]], 5, 80) if doc == c}
    assert {r["doc_id"] for r in rows[2]} == firsts
    # benchmark passages: none is left, other documents are as before
    items = [(str(r["item_id"]), folded_words(r["text"].encode())) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    automaton = decontaminate.SuffixAutomaton(items, 10)
    before = {r["doc_id"]: r for r in rows[2]}
    assert all(not automaton.match(folded_words(r["text"].encode()))[0] for r in rows[3])
    for doc, r in before.items():
        if not automaton.match(folded_words(r["text"].encode()))[0]:
            assert r in rows[3], doc
    # secrets: none is left, all documents stay
    assert [r["doc_id"] for r in sorted(rows[3])] == [r["doc_id"] for r in sorted(rows[4])]
    left = secrets.find_secrets(frames[4]).where("size(secrets.spans) > 0")
    assert left.count() == 0
    assert all(r["n_chars"] == len(r["text"]) for r in rows[4] if r["n_chars"] is not None)
    # packing: the ids of the texts that are left
    t = pretokens.load(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    packed = {}
    for r in sorted(rows[5], key=lambda r: (r["doc_id"], r["start"])):
        packed[r["doc_id"]] = packed.get(r["doc_id"], b"") + bytes(r["ids"])
    for r in rows[4]:
        ids = t.encode(r["text"], add_special_tokens=False).ids
        assert packed[r["doc_id"]] == struct.pack(f"<{len(ids) + 1}I", *ids, 1)
    assert len(packed) == len(rows[4])


def test_pipeline_of_odd_tables(spark, odd_docs, tmp_path):
    d = str(tmp_path)
    odd_docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).where("start = 0").count() == 8  # one of the repeated rows goes
    odd_docs.limit(0).write.parquet(f"{d}/e/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").write.parquet(f"{d}/e/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{d}/e").count() == 0


def test_pipeline_leaves_its_result_only(spark, data):
    work = Path(shared_dir(spark).removeprefix("file:")) / "proofmill"
    before = set(work.glob("pipeline-*"))
    rows = corpus_pipeline.run(spark, data)
    (folder,) = set(work.glob("pipeline-*")) - before
    assert [f.name for f in folder.iterdir()] == [corpus_pipeline.STAGES[-1][0]]
    assert rows.count() > 100


def test_stages_keep_columns_of_any_name(spark, data, tmp_path):
    """Extra columns named like the stages' own results stay as they are, through every stage but the last."""
    names = ["scan_row", "scan_hits", "Secrets", "leak", "rejected", "clean_text", "toxicity", "dedup_row", "new_text", "file_mark", "FILE_PLACE", "row", "place", "group"]
    docs = spark.read.parquet(f"{data}/documents.parquet").withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id")) for n in names})
    docs.write.parquet(f"{tmp_path}/0")
    seen = spark.read.parquet(f"{tmp_path}/0")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1], start=1):
        stage(spark, seen, data).write.parquet(f"{tmp_path}/{i}")
        seen = spark.read.parquet(f"{tmp_path}/{i}")
        assert seen.columns == docs.columns
        assert all(r[n] == f"{n} {r['doc_id']}" for r in seen.collect() for n in names)
    assert seen.count() > 100 and corpus_pipeline.STAGES[-1][1](spark, seen, data).where("start = 0").count() == seen.count()
