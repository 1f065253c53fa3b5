import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from proofmill.llm import packing, pretokens, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a  b", "  x ", " \n y\n\n z ", "\x1cq r\x1f s", "café ² x½ Σίσυφος", "中文 字 ", "<|endoftext|>a<|endoftext|> b", "I'll don't 'tis", "tab\t x\xa0y z",
    "é é ñ", "x_y __ 3.14", "a \x0bb", "  a", "end ", " ", "\n", "İstanbul ẞ ß", "<|startoftext|>x  <|ENDOFTEXT|>", " lead", "​ x", "ΑΣ ΑΣ.", "K 100€", "٣٤ १२", "\x85 a\x85", "",
]


def count(text):
    parts, special = token_counts._parts(text, WORDS)
    model = pretokens.load(WORDS).model
    return special + sum(len(model.tokenize(pretokens.byte_level(p))) for part in parts for p in pretokens.word_pretokens(part, WORDS))


def same(text):
    ids = pretokens.load(BYTES).encode(text, add_special_tokens=False).ids
    assert packing.encoder(BYTES)(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert count(text) == len(pretokens.load(WORDS).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'ab1.<|>é\xa0"), st.characters(exclude_categories=("Cs",)))))
def test_any_text_as_the_library(text):
    same(text)


@pytest.mark.parametrize("frequent", [0, 3, token_counts.FREQUENT])
def test_counts_equal_the_library_at_any_cut(make, odd_docs, frequent):
    docs = odd_docs.unionByName(make([(100 + i, t, None, None, None) for i, t in enumerate(ODD)], odd_docs.schema))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, WORDS, frequent=frequent).collect()), key=repr)
    t = pretokens.load(WORDS)
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), WORDS).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 5000, 8192])
def test_pieces_are_powers_of_two(n):
    pieces = packing.pieces_of(n)
    assert [s for s, _ in pieces] == [sum(x for _, x in pieces[:i]) for i in range(len(pieces))]
    assert sum(x for _, x in pieces) == n
    assert all(x & (x - 1) == 0 and x <= 2048 for _, x in pieces)
    rest = [x for _, x in pieces if x < 2048]
    assert rest == sorted(set(rest), reverse=True)


def test_pieces_hold_every_id_once(odd_docs, tmp_path):
    rows = packing.pack(odd_docs.coalesce(1), BYTES).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows) and {r["offset"] for r in rows} == {0}
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    documents, ids = [], b""
    for r in rows:
        if r["start"] == 0:
            ids = b""
        ids += r["ids"]
        if len(ids) == 4 * r["doc_tokens"]:
            documents.append((r["doc_id"], ids))
    t = pretokens.load(BYTES)
    want = [(r["doc_id"], struct.pack("<%dI" % (len(e) + 1), *e, 1)) for r in odd_docs.collect() for e in [t.encode(r["text"] or "", add_special_tokens=False).ids]]
    assert sorted(documents, key=repr) == sorted(want, key=repr)
    folder = str(tmp_path / "buckets")
    packing.write_buckets(packing.pack(odd_docs, BYTES), folder)
    written = odd_docs.sparkSession.read.parquet(folder)
    assert sorted((r["length"], r["ids"]) for r in written.collect()) == sorted((r["length"], r["ids"]) for r in rows)
    assert all(r["length"] == 1 << r["bucket"] for r in written.collect()) and written.select("bucket").distinct().count() > 1
    assert packing.pack(odd_docs.limit(0), BYTES).count() == 0


def test_registered_packing_is_in_buckets(spark, data):
    from proofmill.llm import queries

    frame = queries.QUERIES["op10_packing"](spark, data)
    parts = [p for p in frame.select("bucket", "length").rdd.glom().collect() if p]
    assert all(1 << r["bucket"] == r["length"] for p in parts for r in p)
    assert all([r["length"] for r in p] == sorted(r["length"] for r in p) for p in parts)
    ends = sorted((p[0]["length"], p[-1]["length"]) for p in parts)
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
